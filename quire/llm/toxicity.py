"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic and one on ordinary text.

The ordinary dictionary is trained by zstandard on all sampled ordinary texts. The toxic one is trained by zstandard on all sampled toxic
texts, on what ordinary text does not have: the parts of their words that hold 6-byte substrings whose document frequency
differs between the classes by the G statistic, among all texts or among those of one kind (texts grouped by their byte pairs, so that
a small language's markers are tested against that language). Trained on whole toxic texts it would hold the syllables that
both classes share. The toxic compressor has the ordinary dictionary before its own, and the ordinary one is padded to the same
length, so that shared text costs the same in both. A text is cut into windows of WINDOW words and every window is compressed with
both. The window's distance is the length under the ordinary dictionary less that under the toxic one. Windows above calibrated
distances are counted, and a logistic model of the counts, fitted on labelled texts that no dictionary saw, gives the
score. Fitting uses a bounded sample of labelled rows (SAMPLE a class, texts up to SAMPLE_BYTES); scoring covers whole texts.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import documents, per_text, release, trim_jvm
from quire.llm.tokens import scramble, window_hashes

WINDOW = 16
GRAM = 6
SAMPLE = 2000
SAMPLE_BYTES = 1 << 15
#: Sizes that the dictionaries are trained to at most, and the length of the segments that the trainer picks.
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 8192
SEGMENT = 32
PIECE = 2048
#: Groups of texts that substrings are tested in, besides all texts at once, and slots that byte pairs are hashed to for grouping.
KINDS = 8
PAIRS = 4099
#: Least G statistic of a substring and least ratio of its frequencies.
LEAST_G = 12.0
LEAST_RATIO = 4.0
DISTANCES = (1, 2, 3, 4, 6)
HELD_OUT = 2
FOLDS = 4
PREDICT = 0.3


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """All words, ASCII-lower-cased, ``size`` to a window."""
    words = text.lower().split()
    return [b" ".join(words[i : i + size]) for i in range(0, len(words), size)]


def _grams(text: bytes) -> np.ndarray:
    """Distinct substrings of GRAM bytes, packed."""
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    if len(raw) < GRAM:
        return np.empty(0, dtype=np.uint64)
    n = len(raw) - GRAM + 1
    packed = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        packed = packed << np.uint64(8) | raw[k : k + n]
    return np.unique(packed)


def _distinct(texts: list[bytes]) -> list[bytes]:
    """Near copies once: a text goes if a quarter of its 16 lowest hashes of 24-byte substrings are those of texts before it."""
    seen: set[int] = set()
    out = []
    for t in texts:
        values = scramble(np.frombuffer(t, dtype=np.uint8).astype(np.uint64))
        low = np.unique(window_hashes(values, min(24, len(t))))[:16].tolist() if t else []
        if not low or 4 * sum(x in seen for x in low) < len(low):
            out.append(t)
        seen.update(low)
    return out


def _frequencies(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct substrings of all texts and the number of texts that hold each; sorted in place, as the driver does this."""
    grams, at = np.empty(sum(max(0, len(t) - GRAM + 1) for t in texts), dtype=np.uint64), 0
    for t in texts:
        own = _grams(t)
        grams[at : at + len(own)] = own
        at += len(own)
    grams = grams[:at]
    grams.sort()
    first = np.flatnonzero(np.r_[np.ones(min(1, at), dtype=bool), grams[1:] != grams[:-1]])
    return grams[first], np.diff(np.append(first, at))


def _telling(own: list[bytes], other: list[bytes]) -> dict[int, float]:
    """Substrings that are far more frequent in ``own``, with their G statistic."""
    grams, a = _frequencies(own)
    theirs, counts = _frequencies(other)
    at = np.minimum(np.searchsorted(theirs, grams), max(0, len(theirs) - 1))
    b = np.where(theirs[at] == grams, counts[at], 0) if len(theirs) else np.zeros(len(grams))
    n, m = len(own), len(other)
    p = (a + b) / (n + m)

    def part(k, size):
        f = k / size
        return np.where(k > 0, k * np.log(np.maximum(f, 1e-12) / p), 0) + np.where(k < size, (size - k) * np.log(np.maximum(1 - f, 1e-12) / np.maximum(1 - p, 1e-12)), 0)

    g = part(a, n) + part(b, m)
    keep = (a / n >= LEAST_RATIO * b / m) & (g >= LEAST_G)
    return dict(zip(grams[keep].tolist(), g[keep].tolist(), strict=True))


def _kinds(texts: list[bytes], rounds: int = 12) -> np.ndarray:
    """A group of 0 to KINDS - 1 for each text, by the angle between square roots of byte pair counts (spherical k-means)."""
    x = np.zeros((len(texts), PAIRS), dtype=np.float32)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t, dtype=np.uint8).astype(np.int64)
        if len(raw) > 1:
            x[i] = np.bincount((raw[:-1] * 167 + raw[1:]) % PAIRS, minlength=PAIRS)
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)
    np.sqrt(x, out=x)
    for part in np.array_split(x, len(x) // 256 + 1):  # views, so that there is never a second copy of all rows
        part[:] = unit(part)
    near, centres = x @ unit(x.mean(axis=0)), []
    for k in range(KINDS):
        centres.append(x[near.argmin()])
        near = np.maximum(near, x @ centres[-1]) if k else x @ centres[-1]
    for _ in range(rounds):
        at = (x @ np.array(centres).T).argmax(axis=1)
        centres = [unit(x.mean(axis=0, where=(at == k)[:, None])) if (at == k).any() else c for k, c in enumerate(centres)]
    return at


def _telling_by_kind(own: list[bytes], other: list[bytes]) -> dict[int, float]:
    """Telling substrings of all texts and of each kind of text, with their best G statistic."""
    out = _telling(own, other)
    at = _kinds(own + other)
    for k in range(KINDS):
        a, b = ([t for t, x in zip(texts, of, strict=True) if x == k] for texts, of in ((own, at[: len(own)]), (other, at[len(own) :])))
        if a and b:
            for gram, g in _telling(a, b).items():
                out[gram] = max(g, out.get(gram, 0.0))
    return out


def telling_parts(own: list[bytes], other: list[bytes]) -> list[bytes]:
    """Of each text of ``own``, the parts of its words from the first to the last telling substring, each part once, one a line."""
    telling = set(_telling_by_kind(own, other))
    if not telling:
        return []
    holds = re.compile(b"|".join(re.escape(g.to_bytes(GRAM, "big")) for g in sorted(telling))).search
    known: dict[bytes, bytes] = {}
    for w in {w for t in own for w in t.split()}:
        line = b" " + w + b" "
        if holds(line):
            # what lies outside the telling substrings is ordinary and would shorten ordinary windows too
            at = [i for i in range(len(line) - GRAM + 1) if int.from_bytes(line[i : i + GRAM], "big") in telling]
            known[w] = line[at[0] : at[-1] + GRAM]
    return [b"\n".join(sorted({known[w] for w in t.split() if w in known})) for t in own]


#: Fixed by the dictionary format: the three offsets that stand before the content.
_OFFSETS = b"".join(n.to_bytes(4, "little") for n in (1, 4, 8))


def trained(samples: list[bytes], size: int, segment: int, overlap: int) -> bytes:
    """Content of a dictionary that zstandard trains on all of ``samples``; their distinct lines where they are too few to train on."""
    samples = [x for x in samples if x]
    try:
        block = zstandard.train_dictionary(size, samples, k=segment, d=overlap, split_point=1.0, steps=1).as_bytes()
    except zstandard.ZstdError:
        lines = sorted({line for x in samples for line in x.split(b"\n")})
        return b"\n".join(lines)[:size]
    at = block.find(_OFFSETS)  # after the entropy tables
    return block[at + len(_OFFSETS) :] if at >= 0 else block


class Compressor:
    """Length of a window compressed with one dictionary, headers left out."""

    def __init__(self, content: bytes):
        options = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0,
            strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=16, hash_log=15, chain_log=15, search_log=6, target_length=16,
        )
        words = zstandard.ZstdCompressionDict(content or b"        ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=options)
        self.compress = zstandard.ZstdCompressor(dict_data=words, compression_params=options).compress

    def __call__(self, window: bytes) -> int:
        return len(self.compress(window))


def features(distances: np.ndarray) -> np.ndarray:
    """Shares (log) and presence of windows at each calibrated distance."""
    n = max(1, len(distances))
    counts = np.array([(distances >= d).sum() for d in DISTANCES], dtype=float)
    return np.concatenate([[1.0], counts > 0, np.log1p(counts), 10 * counts / n])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton's method over weighted rows; the constant is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Two dictionaries and the logistic weights; plain bytes and numbers, so that it can be broadcast."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes], share: float | None = None):
        """Calibrated on each half of the texts with dictionaries made from the other half; the dictionaries that stay are
        made from all. One class only: a constant score.

        ``share``: of toxic among all labelled rows, which the calibration is weighted to; the sample's own if not given.
        """
        self.share = len(toxic) / max(1, len(toxic) + len(ordinary)) if share is None else share
        self.weights = None
        toxic, ordinary = (_distinct([t.lower() for t in x]) for x in (toxic, ordinary))
        if len(toxic) < 4 or len(ordinary) < 4:
            return
        x, y = [], []
        for k in (0, 1):
            self._dictionaries(toxic[k::2], ordinary[k::2])
            distance = self.distance()
            held = [(t, 1.0) for t in toxic[1 - k :: 2]] + [(t, 0.0) for t in ordinary[1 - k :: 2]]
            x += [features(distance(t)) for t, _ in held]
            y += [c for _, c in held]
        y = np.array(y)
        weight = np.where(y == 1, self.share / y.sum(), (1 - self.share) / (len(y) - y.sum())) * len(y)
        self.weights = _logistic(np.array(x), y, weight)
        self._dictionaries(toxic, ordinary)

    def _dictionaries(self, toxic: list[bytes], ordinary: list[bytes]) -> None:
        base = trained([t[i : i + PIECE] for t in ordinary for i in range(0, len(t), PIECE)], ORDINARY_BYTES, 2 * SEGMENT, 8)
        own = trained(telling_parts(toxic, ordinary), TOXIC_BYTES, SEGMENT, 6) + b"\n"
        # as long in both, so that matches in the shared text lie, and cost, the same
        self.toxic, self.ordinary = base + own, base + b"\n" * len(own)

    def distance(self):
        a, b = Compressor(self.ordinary), Compressor(self.toxic)
        return lambda text: np.array([a(w) - b(w) for w in windows(text)], dtype=np.int64)

    def scorer(self):
        if self.weights is None:
            return lambda text: self.share
        distance = self.distance()
        return lambda text: float(1 / (1 + np.exp(-np.clip(features(distance(text)) @ self.weights, -30, 30))))


def fold(doc_id, folds: int = FOLDS):
    """crc32 of doc_id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """On at most ``sample`` texts of each label, lowest hashes of doc_id first, held-out rows and null labels left out."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marked = marked.where(fold(F.col("doc_id")) != HELD_OUT)
    picked = [marked.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (1, 0)]
    picked = picked[0].union(picked[1])  # at most 2 * sample ids
    texts = docs.where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.text)))
    share = marked.agg(F.avg("toxic")).first()[0] or 0.0
    return Model([bytes(r.text) for r in rows if r.toxic == 1], [bytes(r.text) for r in rows if r.toxic == 0], share)


def _toxicity(spark, model: Model):
    """The score of the column ``text``."""
    shipped = spark.sparkContext.broadcast(model)  # under 60 kB
    release()  # the texts that the driver fitted on
    trim_jvm(spark)
    return per_text(F.col("text").cast("binary"), lambda: shipped.value.scorer(), "double")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    score: 0 to 1, from the whole text only. Null, empty and white texts score as a text without telling windows. Repeated rows
    score alike; a null doc_id gives held_out null and is never learnt from. Without labels of both classes
    the score is the share of toxic labels, 0 without any. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("score", _toxicity(docs.sparkSession, fit(docs, labels, sample)))
    predicted = (F.col("score") >= PREDICT).cast("int")
    return rows.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", predicted.alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are predicted not toxic, unchanged; see ``score``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    scored = rows.withColumn("_score", _toxicity(docs.sparkSession, fit(docs, labels, sample)))
    return scored.where(F.col("_score") < PREDICT).select("_row.*")


def op3_query(spark, sf_dir):
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
