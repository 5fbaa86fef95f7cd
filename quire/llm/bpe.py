"""BPE encoding and decoding with a minimal acyclic transducer for the frequent words.

A word here is what ASCII white space separates; no token of this tokenizer family spans it, so a text's ids are its words'
ids in a row. The most frequent words of the corpus are compiled, with their ids, into the minimal automaton of
Daciuk et al. (2000): states with equal right languages are shared, and the number of a word (the words before it in
order, summed along its path) addresses its ids. The automaton is one block of bytes that every worker memory-maps.
Words it does not hold are normalised, split and merged by rank, exactly as the tokenizer's definition says.
"""

from __future__ import annotations

import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import binary_rows, documents, in_arrow, most_frequent, release, save, trim_jvm

LEXICON_WORDS = 1 << 17
LEXICON_BYTES = 64
MEMO_WORDS = 125_000
#: Bytes of text that a worker encodes together; their unseen words are merged together too.
SLICE_BYTES = 1 << 20
COUNTED_WORDS = 500_000


_BEYOND_LATIN_1 = re.compile(rb"[\xc4-\xff]").search
_SLOTS = 1 << 18
_NONE = 1 << 62
SIGMA = "Σ"


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)


class WordBpe:
    """Merges of a lower-casing word-level BPE: NFC, lower case, pattern split, byte symbols, word-end suffix."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pattern = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = byte_names()
        self.inner = np.array([vocab[names[b]] for b in range(256)])
        self.last = np.array([vocab[names[b] + self.suffix] for b in range(256)])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        # an open-addressing table, read a whole array at a time
        self.keys, self.values = np.full(_SLOTS, -1), np.zeros(_SLOTS, dtype=np.int64)
        for at, (key, slot) in enumerate(zip(keys.tolist(), _slot(keys).tolist(), strict=True)):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (_SLOTS - 1)
            a, b = pairs[at]
            self.keys[slot], self.values[slot] = key, at << 20 | vocab[a + b]

    def pieces(self, chunk: str) -> list[bytes | int]:
        """What is merged on its own: words as UTF-8 bytes, and ids of special tokens."""
        out: list[bytes | int] = []
        for k, part in enumerate(self.cut.split(chunk) if self.cut else [chunk]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out += self.plain_pieces(part)
        return out

    def plain_pieces(self, part: str) -> list[bytes]:
        """Words of text without special tokens."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            if SIGMA in part:  # lower case is taken letter by letter, whatever follows
                part = "".join(map(str.lower, part))
        return [piece.encode() for piece in self.pattern.findall(part.lower())]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` in a row, and how many each has: in each round every word merges its best-ranked pair."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.inner[raw]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.last[raw[ends - 1]]
        row = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_rows = [], []
        while len(ids):
            rank = np.full(len(ids), _NONE)  # of the pair that starts here
            pair = np.flatnonzero(row[:-1] == row[1:])
            rank[pair] = self._rank(ids[pair], ids[pair + 1])
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.append(first, len(row))))
            over = best == _NONE
            done_ids.append(ids[over])
            done_rows.append(row[over])
            live = ~over
            ids, row, rank, best = ids[live], row[live], rank[live], best[live]
            here = np.flatnonzero(rank == best)
            if not len(here):
                break
            # of pairs that overlap (aaa), every second one from the left
            run = np.r_[True, here[1:] != here[:-1] + 1]
            at = np.arange(len(here))
            here = here[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]
            ids[here] = rank[here] & 0xFFFFF
            keep = np.ones(len(ids), dtype=bool)
            keep[here + 1] = False
            ids, row = ids[keep], row[keep]
        ids, row = np.concatenate([np.empty(0, dtype=np.int64), *done_ids]), np.concatenate([np.empty(0, dtype=np.int64), *done_rows])
        return ids[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(words))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 20 | merged id of each pair, _NONE where there is no merge."""
        key = a << 20 | b
        at = _slot(key)
        out = np.full(len(key), _NONE)
        left = np.arange(len(key))
        while len(left):
            held = self.keys[at]
            hit = held == key[left]
            out[left[hit]] = self.values[at[hit]]
            more = ~hit & (held >= 0)
            left, at = left[more], (at[more] + 1) & (_SLOTS - 1)
        return out

    def encode_flat(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``chunks`` in a row, and where each begins and the last ends."""
        if any(x in c for x in self.special for c in chunks):
            lists = self.encode(chunks)
            return np.array([x for ids in lists for x in ids], dtype=np.int64), np.concatenate([[0], np.cumsum([len(i) for i in lists], dtype=np.int64)])
        split = list(map(self.plain_pieces, chunks))
        pieces = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))])
        words = [p for own in split for p in own]
        if not words:
            return np.empty(0, dtype=np.int64), pieces
        ids, counts = self.merge(words)
        return ids, np.concatenate([[0], np.cumsum(counts)])[pieces]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk (a text without ASCII white space)."""
        split = [self.pieces(c) for c in chunks]
        words = [p for pieces in split for p in pieces if isinstance(p, bytes)]
        if not words:
            return split
        ids, counts = self.merge(words)
        flat, ends = ids.tolist(), np.cumsum(counts).tolist()
        out, k, begin = [], 0, 0
        for pieces in split:
            if not any(isinstance(p, int) for p in pieces):
                k += len(pieces)
                end = ends[k - 1] if pieces else begin
                out.append(flat[begin:end])
            else:
                own: list[int] = []
                for p in pieces:
                    if isinstance(p, int):
                        own.append(p)
                    else:
                        own += flat[ends[k - 1] if k else 0 : ends[k]]
                        k += 1
                end = ends[k - 1] if k else 0
                out.append(own)
            begin = end
        return out


def byte_names() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else 256 and up in turn."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: 256 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The automaton and the ids as one block: sizes, then edges sorted by state << 8 | byte, their targets, the words before
    each edge within its state, final flags by state, offsets into the ids by word number, and the ids."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        at = register.get(key)
        if at is None:
            at = register[key] = len(states)
            states.append(key)
        return at

    # a node on the open path: [final, settled edges, byte that leads on]
    ordered = sorted(words)
    path: list[list] = [[False, [], None]]
    before = b""
    for w in ordered:
        same = 0
        while same < min(len(w), len(before)) and w[same] == before[same]:
            same += 1
        while len(path) > same + 1:
            child = settle(path.pop())
            path[-1][1].append((path[-1][2], child))
        for b in w[same:]:
            path[-1][2] = b
            path.append([False, [], None])
        path[-1][0] = True
        before = w
    while len(path) > 1:
        child = settle(path.pop())
        path[-1][1].append((path[-1][2], child))
    root = settle(path.pop())
    count = np.zeros(len(states), dtype=np.int64)
    keys, targets, skips = [], [], []
    for s, (final, edges) in enumerate(states):  # children are settled before their parents
        total = int(final)
        for b, t in edges:
            keys.append(s << 8 | b)
            targets.append(t)
            skips.append(total)
            total += int(count[t])
        count[s] = total
    ids = [words[w] for w in ordered]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
    parts = [np.array(keys, dtype=np.int64), np.array(targets, dtype=np.int64), np.array(skips, dtype=np.int64), np.array([f for f, _ in states], dtype=np.int64), offsets, np.array([x for i in ids for x in i], dtype=np.int64)]
    return np.array([root, *map(len, parts)], dtype=np.int64).tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, memory-mapped from an unlinked file."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self.map, dtype=np.int64, count=7)
        self.root, at, parts = int(head[0]), 56, []
        for n in head[1:].tolist():
            parts.append(np.frombuffer(self.map, dtype=np.int64, count=n, offset=at))
            at += 8 * n
        self.keys, self.targets, self.skips, self.final, self.offsets, self.ids = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """Numbers of ``words``, -1 for those not held; all words step through the automaton together."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.flatnonzero((lengths > 0) & (lengths <= LEXICON_BYTES))
        state, number = np.full(len(words), self.root), np.zeros(len(words), dtype=np.int64)
        for depth in range(LEXICON_BYTES + 1):
            done = live[lengths[live] == depth]
            done = done[self.final[state[done]] == 1]
            out[done] = number[done]
            live = live[lengths[live] > depth]
            if not len(live):
                break
            key = state[live] << 8 | data[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            number[live] += self.skips[at]
            state[live] = self.targets[at]
        return out


def folded(text: bytes) -> bytes:
    """Lower-cased early, so that fewer words differ, where that cannot change the ids: no special token can arise, and
    no combining mark can meet a letter (Latin-1 texts)."""
    return text if b"<|" in text or _BEYOND_LATIN_1(text) else text.lower()


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words over all texts, at most ``most``; words longer than LEXICON_BYTES never."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in seen if len(w) <= LEXICON_BYTES]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for _, texts in binary_rows(batches):
            seen.update(b" ".join(map(folded, texts)).split())
            if len(seen) > COUNTED_WORDS:
                yield flush()
        yield flush()

    counts = in_arrow(docs.select(F.col("text").cast("binary").alias("text")), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return most_frequent(save(counts, "words"), most)[0]


class Encoder:
    """Words to little-endian ids and to decoded text, through a bounded memo over the automaton and the merges."""

    def __init__(self, bpe: WordBpe, block: bytes):
        self.bpe, self.lexicon = bpe, Lexicon(block)
        self.names = {i: t.encode() for i, t in self.bpe.tokens.items()}
        self.spelt = self._spelt(self.lexicon.ids)
        self.memo: dict[bytes, bytes] = {}
        self.text: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
            self.text.clear()
        new = [w for w in words if w not in self.memo]
        found = self.lexicon.find(new)
        held = np.flatnonzero(found >= 0)
        missing = np.flatnonzero(found < 0).tolist()
        ids, offsets = self.bpe.encode_flat([new[i].decode(errors="replace") for i in missing])
        lex = self.lexicon
        self._remember([new[i] for i in missing], self._spelt(ids), offsets[:-1], offsets[1:])
        self._remember([new[i] for i in held.tolist()], self.spelt, lex.offsets[found[held]], lex.offsets[found[held] + 1])

    def _spelt(self, ids: np.ndarray) -> tuple[bytes, list[bytes]]:
        """Ids as they are returned, and their tokens."""
        return ids.astype("<u4").tobytes(), list(map(self.names.__getitem__, ids.tolist()))

    def _remember(self, words: list[bytes], spelt: tuple[bytes, list[bytes]], begin: np.ndarray, end: np.ndarray) -> None:
        (packed, names), join = spelt, b" ".join
        for w, a, b in zip(words, begin.tolist(), end.tolist(), strict=True):
            self.memo[w] = packed[4 * a : 4 * b]
            self.text[w] = join(names[a:b])

    def encode(self, words: list[bytes]) -> tuple[bytes, bytes]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text: the tokens, one space between them."""
        return b"".join(map(self.memo.__getitem__, words)), b" ".join(filter(None, map(self.text.__getitem__, words)))


_current: list = []


def _encoder(bpe, block) -> Encoder:
    """One for each worker process and lexicon: a worker gets the same broadcast object in every task."""
    if not _current or _current[0] is not block:
        _current[:] = [block, Encoder(bpe.value, block.value)]
    return _current[1]


def tokenizer_spec(path: str | None = None) -> dict:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def encode(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) and decoded for every row; with ``digests`` the SHA-256 of both in their place.

    ``path``: tokenizer file on the driver. Texts are encoded whole, without added special tokens; decoding joins the tokens by
    single spaces. Null, empty and white texts have no ids and decode to the empty text. Rows with null or repeated doc_id are encoded like
    any other; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    spec = tokenizer_spec(path)
    bpe, words = WordBpe(spec), frequent_words(docs, lexicon_words)
    block = spark.sparkContext.broadcast(compile_lexicon(dict(zip(words, bpe.encode([w.decode(errors="replace") for w in words]), strict=True))))
    shipped = spark.sparkContext.broadcast(bpe)  # the merges as arrays, not the tokenizer file
    del spec, words
    release()  # what the driver compiled the lexicon from
    trim_jvm(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped, block)
        for piece, texts in binary_rows(batches, SLICE_BYTES):
            words = [folded(t).split() for t in texts]
            encoder.learn(set().union(*words))
            pairs = [encoder.encode(w) for w in words]
            columns = [piece.column(0), pa.array([len(i) // 4 for i, _ in pairs], pa.int64())]
            if digests:
                columns += [pa.array([sha256(x).hexdigest() for x in side]) for side in zip(*pairs, strict=True)]
            else:
                columns += [pa.array([np.frombuffer(i, dtype="<u4").astype(np.int32) for i, _ in pairs], pa.list_(pa.int32())), pa.array([t.decode() for _, t in pairs], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", *names])

    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")), run, schema)


def op8_query(spark, sf_dir):
    return encode(documents(spark, sf_dir), digests=True)
