"""Language-model scores by online logistic context mixing.

A text is its ASCII-lower-cased words and one end. A word is coded in bits: the Huffman path of the word among the HEAD
most frequent training words, the end and an escape; after an escape, the paths of the word's bytes and of a word end. Every bit
is predicted by three models: the path node alone, and the node hashed with two contexts (for words: the last very
frequent word and the last word; for bytes: the last 2 and the last 4 bytes). The hashed models are tables of
bit counts over all training texts. Their log odds are combined by weights that are chosen by a gate (what is being coded, and
whether the longer context was seen), start from fitted values and learn after every bit; an adaptive line from the
mixed log odds to the final ones refines the result. Learning restarts every LANE bits, so that a batch of texts runs as many parallel lanes.

Tables: 2**bits slots for each hashed model, sized by the training tokens up to MOST_BITS, so a worker's memory is bounded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import binary_rows, documents, in_arrow, keep_memory, most_frequent, release, save
from quire.llm.tokens import Words

HEAD = 1 << 18
#: A word of the head was seen this often; rarer ones are what the spelling learns from.
HEAD_COUNT = 4
FREQUENT = 256
MOST_BITS = 21
MODELS = 2
#: Floats of a bit's row of inputs, padded to 16 bytes.
WIDE = 4
BLOCK_BITS = 14
LANE = 2048
GATES = 4
RATE = 0.004
REFINE_RATE = 0.001
#: Log odds stay within this.
MOST_ODDS = 12.0
#: A bit's cost in the mixer stays within this, so that products of STEPS_AT_ONCE costs do.
MOST_COST = np.float32(30)
PRIOR = 0.4
BATCH_BYTES = 2 << 20
#: Symbols whose bits are looked up at once: few enough for the processor's caches.
SYMBOLS_AT_ONCE = 1 << 14
#: Bits of a lane that are read at once.
STEPS_AT_ONCE = 16
#: Bytes of texts that the starting weights are fitted on at once, and the passes over the first of a task.
FIT_BYTES = 1 << 18
FIRST_ROUNDS = 3
COUNTED_WORDS = 400_000
#: Partitions of the texts that one task counts together: it sends whole tables, so tasks are made coarse.
TASK_PARTS = 4
HELD_OUT, FOLDS = 1, 5
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9))


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, nodes, bits, share): symbol s has path nodes[offsets[s]:offsets[s + 1]] from the root and the bit taken at
    each; share[node] is the part of the node's count under its 1 branch. Counts are positive, two symbols at least."""
    n = len(counts)
    order = np.argsort(counts, kind="stable")
    leaves, total = counts[order].tolist(), []
    parent, bit = np.zeros(2 * n - 1, dtype=np.int64), np.zeros(2 * n - 1, dtype=np.int64)
    names = order.tolist()
    i = j = 0
    share = np.zeros(n - 1)
    for k in range(n - 1):
        pair = []
        for _ in range(2):
            if i < n and (j >= len(total) or leaves[i] <= total[j]):
                pair.append((names[i], leaves[i]))
                i += 1
            else:
                pair.append((n + j, total[j]))
                j += 1
        for b, (x, _) in enumerate(pair):
            parent[x], bit[x] = n + k, b
        total.append(pair[0][1] + pair[1][1])
        share[k] = pair[1][1] / total[-1]
    root, at = 2 * n - 2, np.arange(n)
    steps_nodes, steps_bits, steps_symbols = [], [], []
    symbol = np.arange(n)
    while len(at):
        steps_nodes.append(parent[at] - n)
        steps_bits.append(bit[at])
        steps_symbols.append(symbol)
        at = parent[at]
        live = at != root
        at, symbol = at[live], symbol[live]
    symbols, depth = np.concatenate(steps_symbols), np.repeat(np.arange(len(steps_symbols)), [len(s) for s in steps_symbols])
    to = np.lexsort((-depth, symbols))
    lengths = np.bincount(symbols, minlength=n)
    return np.concatenate([[0], np.cumsum(lengths)]), np.concatenate(steps_nodes)[to], np.concatenate(steps_bits)[to], share


class Lexicon:
    """Numbers of words, looked up many at once: a dictionary's lookups wait for memory one after another.

    A word of up to SHORT bytes is two integers, its bytes and its length, so equal integers are equal words; longer words are in a dictionary.
    """

    SHORT = 15
    MASKS = np.array([[(1 << 8 * min(n, 8)) - 1, (1 << 8 * max(n - 8, 0)) - 1] for n in range(SHORT + 1)], dtype=np.uint64)

    def __init__(self, words: list[bytes]):
        self.long = {w: i for i, w in enumerate(words) if len(w) > self.SHORT}
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        low, high = self._packed(b"".join(words), np.cumsum(size) - size, size)
        self.keys = np.stack([low, high], axis=1)
        self.shift = np.uint64(64 - max(4, (4 * len(words)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int32)
        left = np.flatnonzero(size <= self.SHORT)
        at = self._slot(low[left], high[left])
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            moved = self.slots[at] != left
            left, at = left[moved], (at[moved] + 1) & (len(self.slots) - 1)

    @classmethod
    def _packed(cls, data: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two integers of the words of ``size`` bytes at ``begin`` in ``data``."""
        eights = np.frombuffer(data + bytes(32 - len(data) % 8), dtype="<u8")
        kept = np.minimum(size, cls.SHORT)

        def eight(at: np.ndarray, mask: np.ndarray) -> np.ndarray:
            first, turn = at >> 3, ((at & 7) << 3).astype(np.uint64)
            out = eights.take(first + 1)
            out <<= np.uint64(1)
            out <<= np.uint64(63) - turn
            out |= eights.take(first) >> turn
            out &= mask
            return out

        high = kept.astype(np.uint64) << np.uint64(56)
        more = np.flatnonzero(kept > 8)
        high[more] |= eight(begin[more] + 8, cls.MASKS[:, 1].take(kept[more]))
        return eight(begin, cls.MASKS[:, 0].take(kept)), high

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ high * _MIX[1]) * _MIX[0]
        h ^= h >> np.uint64(29)
        return (h * _MIX[1] >> self.shift).astype(np.int64)

    def numbers(self, words: list[bytes], other: int) -> np.ndarray:
        """Of each word; ``other`` for words that are not in the lexicon."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        return self.find(b"".join(words), np.cumsum(size) - size, size, other)

    def find(self, data: bytes, begin: np.ndarray, size: np.ndarray, other: int) -> np.ndarray:
        """``numbers`` of the words of ``size`` bytes at ``begin`` in ``data``."""
        if not len(self.keys):
            return np.full(len(begin), other, dtype=np.int64)
        low, high = self._packed(data, begin, size)
        keys = self.keys.view(np.complex128).ravel()  # both integers of a word move as one item
        at = self._slot(low, high)
        out, left = np.full(len(begin), other, dtype=np.int64), None
        while left is None or len(left):
            found = self.slots.take(at)
            key = keys.take(found).view(np.uint64).reshape(-1, 2)  # of an empty slot, the last word's
            taken = found >= 0
            same = key[:, 0] == low
            same &= key[:, 1] == high
            same &= taken
            if left is None:
                out, left = np.where(same, found, out), np.arange(len(found))
            else:
                out[left[same]] = found[same]
            on = np.flatnonzero(taken & ~same)
            left, at, low, high = left[on], (at[on] + 1) & (len(self.slots) - 1), low[on], high[on]
        for i in np.flatnonzero(size > self.SHORT).tolist():
            out[i] = self.long.get(data[begin[i] : begin[i] + size[i]], other)
        return out


class Flat:
    """The words of some texts in a row, None for each text's end; words are cut out when they are asked for."""

    def __init__(self, data: bytes, begin: np.ndarray, end: np.ndarray):
        self.data, self.begin, self.end = data, begin, end  # of an end, both are -1

    def take(self, where: np.ndarray) -> list[bytes | None]:
        return [self.data[a:b] if a >= 0 else None for a, b in zip(self.begin[where].tolist(), self.end[where].tolist(), strict=True)]


class Code:
    """Codebook over head words, end, escape, bytes and word end; ids in that order."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, escapes: int, byte_counts: np.ndarray):
        self.lexicon = Lexicon(words)
        self.end, self.escape, self.first_byte = len(words), len(words) + 1, len(words) + 2
        a = huffman(np.array([*counts, max(1, ends), max(1, escapes)], dtype=np.int64))
        b = huffman(np.maximum(byte_counts, 1))
        nodes = len(a[3])
        self.offsets = np.concatenate([a[0], b[0][1:] + a[0][-1]])
        self.sizes = np.diff(self.offsets)
        # a node and the bit taken there travel together, as the node's number twice and the bit
        self.turned = (np.concatenate([a[1], b[1] + nodes]) * 2 + np.concatenate([a[2], b[2]])).astype(np.int32)
        share = np.clip(np.concatenate([a[3], b[3]]), 1e-6, 1 - 1e-6)
        self.prior = np.clip(np.log(share / (1 - share)), -MOST_ODDS, MOST_ODDS).astype(np.float32)

    def read(self, texts: list[bytes]) -> tuple[Flat, np.ndarray, np.ndarray]:
        """All words of lower-cased ``texts`` and each text's end in a row, their ids (escape for rare words), and the tokens of each text.

        Words are found by their bounds in all bytes at once, without a Python object for each.
        """
        words = Words([t.lower() for t in texts])
        place = np.arange(len(words.starts)) + np.repeat(np.arange(len(texts)), words.counts)
        ids = np.full(len(words.starts) + len(texts), self.end, dtype=np.int64)
        ids[place] = self.lexicon.find(words.data, words.starts, words.ends - words.starts, self.escape)
        begin, end = np.full((2, len(ids)), -1, dtype=np.int64)
        begin[place], end[place] = words.starts, words.ends
        return Flat(words.data, begin, end), ids, words.counts + 1

    def tokens(self, texts: list[list[bytes]]) -> tuple[list, np.ndarray, np.ndarray]:
        """As ``read`` gives it, with a list of the words, for texts that are lists of lower-cased words."""
        flat, ids, lengths = self.read([b" ".join(t) for t in texts])
        return flat.take(np.arange(len(ids))), ids, lengths

    def steps(self, flat: Flat | list, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts in a row, MODELS context hashes of each, and the number of symbols of each text."""
        stops = np.cumsum(lengths)
        starts = stops - lengths

        def back(x: np.ndarray, k: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            """What stands ``k`` before each entry of x, 0 before the starts of its runs."""
            out = np.empty(len(x), dtype=np.uint64)
            out[k:] = x[: max(0, len(x) - k)]
            for j in range(k):
                out[starts[lengths > j] + j] = 0
            return out

        named = (ids + 1).astype(np.uint64)
        # a text's end stops the search for its last very frequent word
        often = ids < FREQUENT
        value = np.where(often, named, np.uint64(0))
        value[stops - 1] = 0
        often[stops - 1] = True
        last = np.maximum.accumulate(np.where(often, np.arange(len(ids)), 0))
        seen = np.zeros(len(ids), dtype=np.uint64)
        seen[1:] = value.take(last[:-1])
        contexts = _hash(1, seen), _hash(2, back(named, 1, starts, lengths))
        where = np.flatnonzero(ids == self.escape)
        if not len(where):
            return ids, np.stack(contexts), lengths
        rare = flat.take(where) if isinstance(flat, Flat) else [flat[i] for i in where.tolist()]
        size = np.fromiter(map(len, rare), dtype=np.int64, count=len(rare)) + 1
        spelt = np.frombuffer(b"\x00".join(rare) + b"\x00", dtype=np.uint8).astype(np.int64)
        tail = np.cumsum(size) - 1
        spelt[tail] = 256  # the word end
        since = tail - size + 1
        letters = (spelt + 1).astype(np.uint64)
        p = [back(letters, k, since, size) for k in range(1, 5)]
        spelling = _hash(3, *p[:2]), _hash(4, *p)
        more = np.ones(len(ids), dtype=np.int64)
        more[where] += size
        place = np.cumsum(more) - more  # of each token's own symbol
        letter = np.repeat(place[where] + 1 - since, size) + np.arange(len(spelt))
        symbols = np.empty(int(more.sum()), dtype=np.int64)
        hashes = np.empty((MODELS, len(symbols)), dtype=np.uint64)
        symbols[place], symbols[letter] = ids, spelt + self.first_byte
        for own, context, spelled in zip(hashes, contexts, spelling, strict=True):
            own[place], own[letter] = context, spelled
        return symbols, hashes, np.add.reduceat(more, starts)

    def paths(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes and bits of all symbols in a row, and the number of bits of each."""
        length = self.sizes.take(symbols)
        ends = np.cumsum(length)
        which = np.repeat(self.offsets.take(symbols) - (ends - length), length)
        which += np.arange(len(which))
        turned = self.turned.take(which, mode="clip")
        return turned >> 1, (turned & 1).astype(np.int8), length

    @staticmethod
    def turns(node: np.ndarray) -> np.ndarray:
        return node.view(np.uint32) * np.uint32(0x9E3779B1)

    @staticmethod
    def slots(context: np.ndarray, turn: np.ndarray, length: np.ndarray, bits: int) -> np.ndarray:
        """Slot of every bit from its symbol's context (the upper half of its hash) and its node's turn."""
        slot = np.repeat(context, length)
        slot ^= turn
        slot *= np.uint32(0x85EBCA6B)
        slot >>= np.uint32(32 - bits)
        return slot.view(np.int32)


def _hash(kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind, dtype=np.uint64)
    for p in parts:
        h ^= p
        h *= _MIX[1]
        h ^= h >> np.uint64(29)
    h *= _MIX[0]
    return h


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Of a 1 bit; 0 where nothing was seen."""
    return np.clip(np.log((ones + PRIOR) / (zeros + PRIOR)), -MOST_ODDS, MOST_ODDS).astype(np.float32)


def _apart(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of every slot for one of its own 0s and for one of its own 1s, which is taken out of the counts; side by side."""
    out = np.empty((len(zeros), 2), dtype=np.float32)
    out[:, 0] = log_odds(np.maximum(zeros - 1, 0), ones)
    out[:, 1] = log_odds(zeros, np.maximum(ones - 1, 0))
    return out.ravel()


def start_weights() -> np.ndarray:
    w = np.full((GATES, MODELS + 1), 0.2, dtype=np.float32)
    w[:, 0] = 0.5
    return w


def _gates(last: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of each bit: whether the longer context was seen (its log odds are not 0), and whether a word is coded."""
    return (last != 0).view(np.int8) + 2 * words.view(np.int8)


def mix(x: np.ndarray, words: np.ndarray, y: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log2 probability of every text, and the weights at the lanes' ends, averaged.

    x: log odds of each bit by model (bits x WIDE, the last one free: it is overwritten); words: True for bits of word paths; y: the bits; counts: bits a text.
    """
    x[:, WIDE - 1] = _marks(x[:, MODELS], words, y)
    return _mixed(x, counts, weights)


def _marks(last: np.ndarray, words: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The bit and the gate, which travel with the log odds as the last float of a row: 1 bits are negative, the size is the gate from 1."""
    return (_gates(last, words) + 1) * (1 - 2 * y.astype(np.int8))


def _mixed(x: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``mix`` of rows that have their marks."""
    lanes = -(-counts // LANE)
    text = np.repeat(np.arange(len(counts)), lanes)
    number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = (np.cumsum(counts) - counts)[text] + number * LANE
    length = np.minimum(counts[text] - number * LANE, LANE)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    n = len(order)
    w = np.zeros((n * GATES, WIDE), dtype=np.float32)
    w.reshape(n, GATES, WIDE)[:, :, : MODELS + 1] = weights
    # four floats move as one item of 16 bytes, which is faster to take and put
    x_items, w_items = x.view(np.complex128).ravel(), w.view(np.complex128).ravel()
    slope, offset = np.ones(n, dtype=np.float32), np.zeros(n, dtype=np.float32)
    total = np.zeros(n)
    row = np.arange(n) * GATES
    live = np.searchsorted(-length, -np.arange(1, LANE + 1), side="right")  # lanes with at least that many bits
    # for a bit coded as s = -1 (a 1) or 1 and log odds o, the cost is log(1 + exp(s * o)) and its slope by o is s * c / (1 + c)
    # with c = exp(s * o); costs are multiplied up and their logarithm is taken every few bits
    product, used = np.ones(n), np.ones(WIDE, dtype=np.float32)
    used[WIDE - 1] = 0
    for start in range(0, int(length[0]) if n else 0, STEPS_AT_ONCE):
        # the next bits of every lane, laid out bit by bit
        m = int(live[start])
        block = x_items.take(begin[:m] + np.arange(start, start + STEPS_AT_ONCE)[:, None], mode="clip")
        block = block.view(np.float32).reshape(STEPS_AT_ONCE, m, WIDE)
        signs = np.copysign(np.float32(1), block[:, :, WIDE - 1])
        owns = np.abs(block[:, :, WIDE - 1]).astype(np.int64)
        owns += row[:m] - 1
        for k in range(start, min(start + STEPS_AT_ONCE, int(length[0]))):
            m = int(live[k])
            xs, s, own = block[k - start, :m], signs[k - start, :m], owns[k - start, :m]
            ws = w_items.take(own).view(np.float32).reshape(m, WIDE)
            dot = (xs * ws) @ used
            odds = slope[:m] * dot
            odds += offset[:m]
            odds *= s
            c = np.exp(np.minimum(odds, MOST_COST, out=odds), out=odds)
            one = c + 1
            product[:m] *= one
            s *= c
            s /= one
            step = -RATE * s
            for j in range(MODELS + 1):  # by columns: rows of four are too short for numpy's loops
                xs[:, j] *= step
            xs += ws
            w_items[own] = xs.view(np.complex128).ravel()
            s *= -REFINE_RATE
            offset[:m] += s
            s *= dot
            slope[:m] += s
        total -= np.log(product)
        product[:] = 1
    out = np.zeros(len(counts))
    np.add.at(out, text[order], total / np.log(2))
    return out, w.reshape(n, GATES, WIDE)[:, :, : MODELS + 1].mean(axis=0) if n else weights


class Scorer:
    def __init__(self, code: Code, bits: int, tables: list[np.ndarray], weights: np.ndarray):
        self.code, self.bits, self.tables, self.weights = code, bits, tables, weights
        self.rows = np.zeros((0, WIDE), dtype=np.float32)

    def own(self) -> Scorer:
        """For one task, which reuses its rows of inputs: fresh memory costs more than filling it."""
        return Scorer(self.code, self.bits, self.tables, self.weights)

    def pieces(self, symbols: np.ndarray, hashes: np.ndarray, odds=None) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """Log odds by model, words and bits of some symbols after others; odds(model, slots, bits) gives those of the hashed models, if not the tables."""
        odds = odds or (lambda k, slots, _: self.tables[k].take(slots, mode="clip"))  # slots have self.bits bits; numpy is faster if it need not raise
        contexts = (hashes >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(symbols), SYMBOLS_AT_ONCE):
            node, bit, length = self.code.paths(symbols[a : a + SYMBOLS_AT_ONCE])
            turn = self.code.turns(node)
            slots = (self.code.slots(c[a : a + SYMBOLS_AT_ONCE], turn, length, self.bits) for c in contexts)
            yield [self.code.prior.take(node, mode="clip"), *(odds(k, s, bit) for k, s in enumerate(slots))], node <= self.code.end, bit

    def inputs(self, flat: Flat | list, ids: np.ndarray, lengths: np.ndarray):
        """``_mixed``'s x (until the next call) and counts."""
        symbols, hashes, counts = self.code.steps(flat, ids, lengths)
        ends = np.cumsum(self.code.sizes.take(symbols))
        total = int(ends[-1]) if len(ends) else 0
        if total > len(self.rows):
            self.rows = np.zeros((0, WIDE), dtype=np.float32)  # the old ones go first
            self.rows = np.zeros((total + total // 8, WIDE), dtype=np.float32)
        x, at = self.rows[:total], 0
        for columns, words, bit in self.pieces(symbols, hashes):
            to = slice(at, at + len(bit))
            for k, column in enumerate((*columns, _marks(columns[MODELS], words, bit))):
                x[to, k] = column
            at = to.stop
        texts = np.cumsum(counts) - counts
        return x, np.diff(np.append(ends[texts] - self.code.sizes.take(symbols[texts]), total))

    def log2(self, flat: Flat | list, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log2 probability of each text, given as ``Code.read`` does."""
        return _mixed(*self.inputs(flat, ids, lengths), self.weights)[0]


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT).select(F.col("text").cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all of ``texts``: exact, each task's counts summed by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for _, texts in binary_rows(batches):
            seen.update(b" ".join(texts).lower().split())
            if len(seen) > COUNTED_WORDS:
                yield flush()
        yield flush()

    return in_arrow(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _byte_counts(words: DataFrame) -> np.ndarray:
    """Bytes and word ends of ``words`` (word, n), weighted by n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257)
        for b in batches:
            if not b.num_rows:
                continue
            words, n = b.column(0).to_pylist(), np.asarray(b.column(1))
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            total[:256] += np.bincount(np.frombuffer(b"".join(words), dtype=np.uint8), weights=np.repeat(n, lengths), minlength=256)
            total[256] += n.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(total.astype(np.int64))], names=["b", "n"])

    rows = in_arrow(words.select("word", "n"), run, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(257, dtype=np.int64)
    for r in rows:
        out[r.b] = r.n
    return out


def bit_counts(texts: DataFrame, code, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each hashed model, how often each slot saw a 0 and a 1 over all of ``texts``: exact.

    Each task fills dense tables and sends them in compressed blocks, so what it sends is bounded however much it reads; tasks
    are made coarse for that. Blocks are summed one after another by the task that gets them.
    """
    spark = texts.sparkSession
    block = min(bits, BLOCK_BITS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        total = np.zeros((MODELS, 2 << bits), dtype=np.int64)
        some, own_code = False, code.value
        for _, own in binary_rows(batches, 2 * BATCH_BYTES):
            symbols, hashes, _ = own_code.steps(*own_code.read(own))
            some = True
            for k in range(MODELS):
                # (symbol, context) pairs repeat, so each is expanded to its bits once; in the order of symbols, whose paths are read one after another
                pair = hashes[k] >> np.uint64(32)
                pair |= symbols.astype(np.uint64) << np.uint64(32)
                pair.sort()
                first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
                times, pair = np.diff(np.append(first, len(pair))), pair[first]
                symbol, context = (pair >> np.uint64(32)).astype(np.int64), pair.astype(np.uint32)
                for a in range(0, len(pair), SYMBOLS_AT_ONCE):
                    part = slice(a, a + SYMBOLS_AT_ONCE)
                    node, y, length = own_code.paths(symbol[part])
                    slot = own_code.slots(context[part], own_code.turns(node), length, bits).astype(np.int64)
                    slot <<= 1
                    slot |= y
                    np.add.at(total[k], slot, np.repeat(times[part], length))
        press = zstandard.ZstdCompressor(level=1).compress
        for k in range(MODELS if some else 0):
            parts = total[k].astype("<i8", copy=False).reshape(-1, 2 << block)
            for a in range(0, len(parts), 64):
                data = [press(p.tobytes()) for p in parts[a : a + 64]]
                yield pa.RecordBatch.from_arrays([pa.array([k * (1 << (bits - block)) + i for i in range(a, a + len(data))], pa.int32()), pa.array(data, pa.binary())], names=["block", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        unpress, press = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([press(total.astype("<i8", copy=False).tobytes())], pa.binary())], names=["block", "data"])

        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = np.frombuffer(unpress(data), dtype="<i8")
                if name != now:
                    if now is not None:
                        yield out()
                    now, total = name, part
                else:
                    total = total + part
        if now is not None:
            yield out()

    shards = max(spark.sparkContext.defaultParallelism, texts.rdd.getNumPartitions() // TASK_PARTS)
    filled = in_arrow(texts.coalesce(shards), fill, "block int, data binary")
    summed = in_arrow(filled.repartition("block").sortWithinPartitions("block"), add, "block int, data binary")
    counts = np.zeros((MODELS << bits, 2), dtype=np.int64)
    for r in summed.toLocalIterator():
        at = r.block << block
        counts[at : at + (1 << block)] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.data)), dtype="<i8").reshape(-1, 2)
    return [(c[:, 0], c[:, 1]) for c in counts.reshape(MODELS, -1, 2)]


class _Newton:
    """Weights of a logistic model for each gate, by a Newton step a slice with the curvature of all slices so far."""

    def __init__(self) -> None:
        self.weights = start_weights().astype(float)
        self.curve = np.zeros((GATES, MODELS + 1, MODELS + 1)) + np.eye(MODELS + 1)
        self.slope = np.zeros((GATES, MODELS + 1))

    def add(self, columns: list[np.ndarray], words: np.ndarray, y: np.ndarray) -> None:
        for coded in (False, True):
            own, xs, ys = words == coded, columns, y
            if not own.all():
                own = np.flatnonzero(own)
                xs, ys = [x.take(own) for x in columns], y.take(own)
            # few bits have a longer context that was not seen: they are summed apart and have no part in the others' sums
            unseen = np.flatnonzero(xs[MODELS] == 0)
            if len(unseen) < len(ys):
                self._sum(2 * coded + 1, xs, ys, unseen)
            if len(unseen):
                self._sum(2 * coded, [x.take(unseen) for x in xs], ys.take(unseen), unseen[:0])

    def _sum(self, g: int, xs: list[np.ndarray], y: np.ndarray, without: np.ndarray) -> None:
        """Slope and curvature of gate ``g`` over the bits, but for those at ``without``."""
        p, some = np.zeros(len(y), dtype=np.float32), np.empty(len(y), dtype=np.float32)
        for x, w in zip(xs, self.weights[g].astype(np.float32), strict=True):
            p -= np.multiply(x, w, out=some)
        np.exp(np.clip(p, -30, 30, out=p), out=p)
        p += 1
        np.reciprocal(p, out=p)
        off = np.subtract(y, p, dtype=np.float32)
        p *= np.subtract(1, p, out=some)
        off[without] = p[without] = 0
        for i, x in enumerate(xs):
            self.slope[g, i] += off @ x
            x_p = np.multiply(x, p, out=some)
            for j in range(i + 1):
                self.curve[g, i, j] += x_p @ xs[j]

    def step(self) -> None:
        for g in range(GATES):
            self.weights[g] += np.clip(np.linalg.solve(self.whole()[g], self.slope[g]), -1, 1)
        self.slope[:] = 0

    def whole(self) -> np.ndarray:
        """The curvature, of which only the lower half is summed."""
        return np.tril(self.curve) + np.tril(self.curve, -1).transpose(0, 2, 1)


def _fit(texts: list[bytes], scorer: Scorer, apart: list[np.ndarray], model: _Newton, rounds: int = 1) -> None:
    """``rounds`` steps of ``model`` over texts, each bit taken out of the counts that predict it (``apart``: as ``_apart`` gives it for each hashed model)."""

    def without_own(k: int, slots: np.ndarray, bit: np.ndarray) -> np.ndarray:
        slots <<= 1
        slots |= bit
        return apart[k].take(slots, mode="clip")

    symbols, hashes, _ = scorer.code.steps(*scorer.code.read(texts))
    # sums have no order, so the bits of a symbol go together: its path is read once, words come apart from letters
    order = symbols << 32
    order |= np.arange(len(symbols))
    order.sort()
    symbols, hashes = order >> 32, hashes.take(order & 0xFFFFFFFF, axis=1)
    for r in range(rounds):
        if r:  # the curvature is taken where the weights are now
            model.curve[:] = np.eye(MODELS + 1)
        for piece in scorer.pieces(symbols, hashes, without_own):
            model.add(*piece)
        model.step()


def fitted_weights(texts: DataFrame, scorer: Scorer, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Starting weights from every text: a task goes on from slice to slice, and the tasks' weights are put together by their curvature."""
    apart = [_apart(*pair) for pair in counts]
    shipped = texts.sparkSession.sparkContext.broadcast((Scorer(scorer.code, scorer.bits, [], scorer.weights), apart))  # bounded: MODELS * 8 * 2**MOST_BITS bytes and HEAD words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        known, its_odds = shipped.value
        model, some = _Newton(), False
        for _, slice_ in binary_rows(batches, FIT_BYTES):
            _fit(slice_, known, its_odds, model, 1 if some else FIRST_ROUNDS)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([model.whole().ravel().tolist()]), pa.array([model.weights.ravel().tolist()])], names=["part", "curve", "weights"])

    rows = sorted(in_arrow(texts.select("text"), run, "part long, curve array<double>, weights array<double>").collect())  # one row a task
    shipped.destroy()
    if not rows:
        return start_weights()
    curves = np.array([r.curve for r in rows]).reshape(-1, GATES, MODELS + 1, MODELS + 1)
    pulls = np.einsum("tgij,tgj->gi", curves, np.array([r.weights for r in rows]).reshape(-1, GATES, MODELS + 1))
    return np.linalg.solve(curves.sum(axis=0), pulls[:, :, None])[:, :, 0].astype(np.float32)


class Statistics:
    """What is learnt from the training texts: exact word counts (a table), the code, and the scorer."""

    def __init__(self, docs: DataFrame, head: int = HEAD):
        spark = docs.sparkSession
        texts = _training(docs)
        self.words = save(word_counts(texts), "words")
        documents_, = texts.agg(F.count("*")).first()
        row = self.words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.tokens = (row.n or 0) + documents_
        self.distinct = row.v + (documents_ > 0)
        self.ends = documents_
        words, n = most_frequent(self.words.where(F.col("n") >= HEAD_COUNT), head)
        self.head = dict(zip(words, n, strict=True))
        rest = (row.n or 0) - sum(n)
        tail = self.words.where(F.col("n") < n[-1]) if n else self.words
        byte_counts = _byte_counts(tail) if rest else _byte_counts(self.words)
        self.code = Code(list(self.head), list(self.head.values()), documents_, rest, byte_counts)
        self.bits = min(MOST_BITS, max(BLOCK_BITS, int(np.ceil(np.log2(max(2, self.tokens)))) - 1))
        counts = bit_counts(texts, spark.sparkContext.broadcast(self.code), self.bits)
        tables = [log_odds(*c) for c in counts]
        self.scorer = Scorer(self.code, self.bits, tables, start_weights())
        self.scorer.weights = fitted_weights(texts, self.scorer, counts)
        del counts
        release()


def score(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of ``docs``.

    base_score: log10 probability under training word frequencies with 0.5 added to each. score: log10 probability under the mixed
    model; bits_per_byte spreads it over the text's bytes (null for an empty text). A null text is an empty one: one token, the end.
    Rows with a null doc_id are scored, have held_out null and are not learnt from; repeated rows score alike. Without training texts base_score has N = V = 0
    and the model spells every word. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = Statistics(docs, head)
    z = float(np.log10(known.tokens + 0.5 * (known.distinct + 1)))
    log_c = np.append(np.log10(np.array([*known.head.values(), known.ends], dtype=float) + 0.5), 0.0)  # words, the end, nothing for an escape
    shipped = spark.sparkContext.broadcast((known.scorer, log_c))  # bounded: MODELS * 4 * 2**MOST_BITS bytes and HEAD words
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        scorer, logs = shipped.value
        scorer, code = scorer.own(), scorer.code
        for piece, texts in binary_rows(batches, BATCH_BYTES):
            flat, ids, lengths = code.read(texts)
            starts = np.cumsum(lengths) - lengths
            head_n, base = np.add.reduceat(ids < code.end, starts, dtype=np.int64), np.add.reduceat(logs[ids], starts)
            own = scorer.log2(flat, ids, lengths) * np.log10(2)
            # rare words, each once a text with its number; they are joined to the whole vocabulary
            where = np.flatnonzero(ids == code.escape)
            bounds = np.searchsorted(where, np.append(starts, len(ids)))
            spelt = flat.take(where)
            rare = [Counter(spelt[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32))
            words = pa.ListArray.from_arrays(offsets, pa.array([w for r in rare for w in r], pa.binary()))
            times = pa.ListArray.from_arrays(offsets, pa.array([k for r in rare for k in r.values()], pa.int64()))
            columns = [piece.column(0), *map(pa.array, (lengths, head_n, base, own, [len(t) for t in texts])), words, times]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    fields = ["doc_id", "n_tokens", "head_n", "head_score", "score", "bytes", "rare", "k"]
    scored = in_arrow(rows, run, "doc_id long, n_tokens long, head_n long, head_score double, score double, bytes long, rare array<binary>, k array<long>")
    scored = save(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = scored.select("row", F.explode(F.arrays_zip("rare", "k")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.k").alias("k"))
    found = asked.hint("merge").join(known.words, "word", "left").select("row", "k", F.coalesce("n", F.lit(0)).alias("c"))
    tail = found.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("c") + 0.5)).alias("tail_score"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_n"))
    out = scored.drop("rare", "k").join(tail, "row", "left")
    each = lambda c: F.coalesce(F.col(c), F.lit(0))
    base = F.col("head_score") + each("tail_score") - F.col("n_tokens") * F.lit(z)
    return out.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("head_n") + F.lit(int(known.ends > 0)) + each("tail_n")).cast("long").alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", F.when(F.col("bytes") > 0, -F.col("score") / F.lit(float(np.log10(2))) / F.col("bytes")).alias("bits_per_byte"),
    )


def op5_query(spark, sf_dir):
    return score(documents(spark, sf_dir))
