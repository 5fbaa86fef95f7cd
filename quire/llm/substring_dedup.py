"""Substring dedup with a log-structured fingerprint index.

A window is ``window`` consecutive words of one document. Its fingerprint is the smallest hash of the ``GRAM``-word grams
in it (winnowing, Schleimer et al. 2003): equal windows have equal fingerprints, and neighbouring windows mostly share
one, so a fourteenth of the windows' number is indexed. The index is a list of sorted immutable runs, tables bucketed by fingerprint;
each new batch becomes a run, is merge-joined with the runs before it, and runs are compacted into one when there are
more than ``FANOUT``. Windows under a fingerprint that occurs twice are then verified: their 64-bit hashes over all
words (64 bits over 64-bit word hashes, so windows must share both the fingerprint's gram and that hash to count as equal) are compared within the fingerprint. A fingerprint with many occurrences is dealt out under salts; windows that are
single under their salt are settled by a second, pre-aggregated count.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import WORD, binary_rows, documents, in_arrow, partitions, save, scratch_path
from quire.llm.tokens import Words, window_hashes

WINDOW = 35
GRAM = 8
BATCHES = 3
FANOUT = 2
#: Occurrences of one fingerprint that one task verifies together.
GROUP = 256
#: Repeated fingerprints (16 bytes each) that are broadcast; beyond it they are joined to the documents.
BROADCAST_ROWS = 4_000_000


class FingerprintIndex:
    """Runs of (fp, n), each sorted by fp and bucketed alike, so that joins of runs need no exchange.

    With ``path``, a folder on storage that every executor reaches, the index is kept there: a new index on the same path takes up
    the runs that the last finished ``add`` left, so later batches meet all earlier ones. Without it ``close`` ends it.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT, path: str | None = None):
        self.spark, self.buckets, self.fanout, self.path = spark, buckets or partitions(spark), fanout, path
        self.runs: list[str] = []
        self.version = 0
        if path:
            self._open()

    def _manifests(self) -> dict[int, str]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest-*/_SUCCESS")
        found = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
        folders = [str(f.getPath().getParent().toString()) for f in found]
        return {int(f.rsplit("-", 1)[1]): f for f in folders}

    def _open(self) -> None:
        known = self._manifests()
        if not known:
            return
        self.version = max(known)
        for r in sorted(self.spark.read.parquet(known[self.version]).collect()):  # one row a run
            self.buckets = r.buckets
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {r.run} (fp BIGINT, n BIGINT) USING parquet CLUSTERED BY (fp) SORTED BY (fp) INTO {r.buckets} BUCKETS LOCATION '{self.path}/{r.run}'")
            self.runs.append(r.run)

    def _record(self) -> None:
        if self.path:
            self.version += 1
            rows = [(i, name, self.buckets) for i, name in enumerate(self.runs)]
            self.spark.createDataFrame(rows, "place int, run string, buckets int").coalesce(1).write.parquet(f"{self.path}/manifest-{self.version}")

    def _write(self, counts: DataFrame) -> str:
        name = f"quire_run_{uuid.uuid4().hex}"
        writer = counts.repartition(self.buckets, "fp").sortWithinPartitions("fp").write.bucketBy(self.buckets, "fp").sortBy("fp")
        writer.option("path", f"{self.path}/{name}" if self.path else scratch_path(self.spark, name)).saveAsTable(name)
        return name

    def add(self, fps: DataFrame) -> DataFrame:
        """Add a batch of fingerprints (fp); (fp, n) of those that occur twice or more, in it or in it and before, n in all."""
        new = self._write(fps.groupBy("fp").agg(F.count("*").alias("n")))
        run = self.spark.table(new)
        total = run.select("fp", "n")
        for i, old in enumerate(self.runs):
            total = total.hint("merge").join(self.spark.table(old).select("fp", F.col("n").alias(f"n{i}")), "fp", "left")
        n = sum((F.coalesce(f"n{i}", F.lit(0)) for i in range(len(self.runs))), F.col("n"))
        hits = save(total.select("fp", n.alias("n")).where("n > 1"), "hits")
        self.runs.append(new)
        if len(self.runs) > self.fanout:
            self.compact()
        self._record()
        return hits

    def compact(self) -> None:
        """Merge all runs into one and forget them; the files of a kept index stay until its owner removes what no manifest names."""
        merged = self.spark.table(self.runs[0])
        for name in self.runs[1:]:
            merged = merged.union(self.spark.table(name))
        new = self._write(merged.groupBy("fp").agg(F.sum("n").alias("n")))
        self.close()
        self.runs = [new]

    def close(self) -> None:
        for name in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs = []


class Windows:
    """All windows of a batch of texts, grouped into occurrences: neighbours with the same smallest gram."""

    def __init__(self, texts: list[bytes], window: int):
        self.words = words = Words(texts)
        h = words.hashes()
        grams = window_hashes(h, GRAM)
        span = window - GRAM + 1
        self.hashes = window_hashes(h, window)
        at = np.arange(max(0, len(grams)))
        size = 1
        while size * 2 <= span:
            at = self._less(grams, at[:-size], at[size:])
            size *= 2
        n = len(self.hashes)
        at = self._less(grams, at[:n], at[span - size : span - size + n])
        doc = np.repeat(np.arange(len(texts)), words.counts)[:n]
        valid = np.flatnonzero(np.arange(n) + window <= (words.first + words.counts)[doc])
        least = at[valid]
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(valid) else np.empty(0, dtype=np.int64)
        self.fp = grams[least[first]]
        self.start = valid[first]  # word of the batch
        self.length = np.diff(np.append(first, len(valid)))
        self.doc = doc[self.start]

    @staticmethod
    def _less(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = min(len(a), len(b))
        return np.where(grams[a[:n]] <= grams[b[:n]], a[:n], b[:n])


def _keyed(docs: DataFrame, *more) -> DataFrame:
    """d, th name a row up to copies of it: doc_id (null as the smallest long) and its text's hash."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(d.alias("d"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"), *more)


def _fingerprints(docs: DataFrame, window: int, batches: int) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in binary_rows(rows):
            w = Windows(texts, window)
            part = np.asarray(piece.column(0))[w.doc]
            yield pa.RecordBatch.from_arrays([pa.array(w.fp.view(np.int64)), pa.array(part)], names=["fp", "part"])

    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    return in_arrow(docs.select(part.alias("part"), F.col("text").cast("binary").alias("text")), run, "fp long, part int")


def repeated_fingerprints(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """(fp, n): fingerprints that occur twice or more, found by feeding the index batch by batch; n is their number so far at the last hit."""
    fps = save(_fingerprints(docs, window, batches), "fps")
    index, hits = FingerprintIndex(docs.sparkSession), None
    for k in range(batches):
        new = index.add(fps.where(F.col("part") == k).select("fp"))
        hits = new if hits is None else hits.union(new)
    index.close()
    return save(hits.groupBy("fp").agg(F.max("n").alias("n")), "repeated")


_OCC = "d long, th long, fp long, salt int, salts int, start int, hashes array<long>"


def _occurrence_batch(w: Windows, keep: np.ndarray, salts: np.ndarray, d: np.ndarray, th: np.ndarray) -> pa.RecordBatch:
    """The occurrences ``keep`` of a batch, with their windows' hashes."""
    length, doc = w.length[keep], w.doc[keep]
    start = w.start[keep]
    offsets = np.concatenate([[0], np.cumsum(length)])
    which = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    hashes = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(w.hashes[which].view(np.int64)))
    own = (start - w.words.first[doc]).astype(np.int32)
    mixed = (d[doc].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + own.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(33)
    salt = (mixed % salts.astype(np.uint64)).astype(np.int32)
    columns = [d[doc], th[doc], w.fp[keep].view(np.int64), salt, salts.astype(np.int32), own]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), hashes], names=["d", "th", "fp", "salt", "salts", "start", "hashes"])


def _occurrences(docs: DataFrame, repeated: DataFrame, window: int, broadcast_rows: int) -> DataFrame:
    """Every occurrence of a repeated fingerprint, salted so that no (fp, salt) has many more than GROUP."""
    spark = docs.sparkSession
    count = repeated.count()
    salts = F.ceil(F.col("n") / GROUP).cast("int")
    if count <= broadcast_rows:
        table = repeated.select("fp", salts.alias("s")).toArrow()
        fps, s = table.column("fp").to_numpy().view(np.uint64), table.column("s").to_numpy()
        order = np.argsort(fps)
        shipped = spark.sparkContext.broadcast((fps[order], s[order]))

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, many = shipped.value
            for piece, texts in binary_rows(rows):
                w = Windows(texts, window)
                if not len(known) or not len(w.fp):
                    continue
                at = np.minimum(np.searchsorted(known, w.fp), len(known) - 1)
                keep = np.flatnonzero(known[at] == w.fp)
                yield _occurrence_batch(w, keep, many[at[keep]], np.asarray(piece.column(0)), np.asarray(piece.column(1)))

        return in_arrow(_keyed(docs), run, _OCC)

    def name(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in binary_rows(rows):
            w = Windows(texts, window)
            pairs = [np.asarray(piece.column(c))[w.doc] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, pairs), pa.array(w.fp.view(np.int64))], names=["d", "th", "fp"])

    def run_joined(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in binary_rows(rows):
            w = Windows(texts, window)
            known = [np.array([(x["fp"], x["s"]) for x in r], dtype=np.int64).reshape(-1, 2) for r in piece.column(3).to_pylist()]
            keep, many = [], []
            for k in range(len(texts)):
                own = dict(zip(known[k][:, 0].astype(np.int64).view(np.uint64).tolist(), known[k][:, 1].tolist(), strict=True))
                a, b = np.searchsorted(w.doc, [k, k + 1])
                for o in range(a, b):
                    if (s := own.get(int(w.fp[o]))) is not None:
                        keep.append(o)
                        many.append(s)
            yield _occurrence_batch(w, np.array(keep, dtype=np.int64), np.array(many, dtype=np.int64), np.asarray(piece.column(0)), np.asarray(piece.column(1)))

    found = in_arrow(_keyed(docs), name, "d long, th long, fp long").join(repeated.select("fp", salts.alias("s")), "fp")
    found = found.groupBy("d", "th").agg(F.collect_set(F.struct("fp", "s")).alias("known"))
    return in_arrow(_keyed(docs).join(found.hint("shuffle_hash"), ["d", "th"]), run_joined, _OCC)


_MARKS = "d long, th long, start int, mask long, fp long, w long, n int"


def _verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (fp, salt) -> marks: (d, th, start, mask) with a bit for each window that occurs twice under its
    salt, and for salted fingerprints (fp, w, n) with the place of windows that occur once."""
    held: pa.Table | None = None

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        if not len(t):
            return
        col = {c: t.column(c).to_numpy() for c in ("d", "th", "fp", "salt", "salts", "start")}
        lists = t.column("hashes").combine_chunks()
        w, length = lists.flatten().to_numpy(), np.asarray(lists.value_lengths())
        new = np.r_[True, (col["fp"][1:] != col["fp"][:-1]) | (col["salt"][1:] != col["salt"][:-1])]
        row = np.repeat(np.arange(len(t)), length)
        group = np.cumsum(new)[row]
        order = np.lexsort((w, group))
        first = np.r_[True, (w[order][1:] != w[order][:-1]) | (group[order][1:] != group[order][:-1])]
        number = np.cumsum(first) - 1
        counts = np.bincount(number)
        n = np.empty(len(w), dtype=np.int64)
        n[order] = counts[number]
        offset = np.arange(len(w)) - np.repeat(np.cumsum(length) - length, length)
        mask = np.zeros(len(t), dtype=np.int64)
        np.bitwise_or.at(mask, row[n > 1], np.int64(1) << offset[n > 1])
        some = np.flatnonzero(mask)
        if len(some):
            nothing = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(col["d"][some]), pa.array(col["th"][some]), pa.array(col["start"][some]), pa.array(mask[some]), nothing, nothing, pa.nulls(len(some), pa.int32())], names=names)
        lead = order[first]  # one of each distinct window of a group
        lead = lead[col["salts"][row[lead]] > 1]
        if len(lead):
            r, single = row[lead], n[lead] == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["d"][r]), pa.array(col["th"][r]), pa.array((col["start"][r] + offset[lead]).astype(np.int32), mask=~single), pa.nulls(len(r), pa.int64()), pa.array(col["fp"][r]), pa.array(w[lead]), pa.array(n[lead].astype(np.int32))],
                names=names,
            )

    names = ["d", "th", "start", "mask", "fp", "w", "n"]
    for batch in rows:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        if not len(t):
            continue
        fp, salt = t.column("fp").to_numpy(), t.column("salt").to_numpy()
        last = np.flatnonzero((fp != fp[-1]) | (salt != salt[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        held = t.slice(cut)
        yield from settle(t.slice(0, cut))
    if held is not None:
        yield from settle(held)


def repeated_windows(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(d, th, start, mask): bit k of mask says that the window at word start + k occurs elsewhere too."""
    if not GRAM <= window <= GRAM + 62:
        raise ValueError(f"windows have {GRAM} to {GRAM + 62} words")
    repeated = repeated_fingerprints(docs, window, batches)
    occurrences = _occurrences(docs, repeated, window, broadcast_rows)
    n = partitions(docs.sparkSession)
    marks = save(in_arrow(occurrences.repartition(n, "fp", "salt").sortWithinPartitions("fp", "salt"), _verify, _MARKS), "marks")
    plain = marks.where("mask is not null").select("d", "th", "start", "mask")
    salted = marks.where("w is not null")
    total = salted.groupBy("fp", "w").agg(F.sum("n").alias("total")).where("total > 1")
    late = salted.where("start is not null").join(total.hint("merge"), ["fp", "w"]).select("d", "th", "start", F.lit(1).cast("long").alias("mask"))
    return plain.union(late)


def drop_repeats(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES, broadcast_rows: int = BROADCAST_ROWS, digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept: every row's words that no repeated window covers, joined by single spaces.

    A window repeats if its words, unchanged, also start anywhere else in the table, in the same document too; all its
    copies go. With ``digests`` kept_sha256 is in the place of kept. Null and empty texts have no words and keep the empty text. Repeated
    rows repeat each other's windows. Rows with a null doc_id are judged like any other. Other columns are ignored;
    an empty table gives an empty result.
    """
    marks = repeated_windows(docs, window, batches, broadcast_rows).distinct()
    marks = marks.groupBy("d", "th").agg(F.collect_list("start").alias("starts"), F.collect_list("mask").alias("masks"))
    joined = _keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).join(marks.hint("shuffle_hash"), ["d", "th"], "left")
    last = "kept_sha256" if digests else "kept"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in binary_rows(rows):
            starts, masks = (piece.column(piece.schema.get_field_index(c)).to_pylist() for c in ("starts", "masks"))
            out = []
            for text, at, bits in zip(texts, starts, masks, strict=True):
                words = text.split()
                removed = 0
                if at:
                    cover = np.zeros(len(words) + 1, dtype=np.int64)
                    mask = np.array(bits, dtype=np.int64)
                    for k in range(window - GRAM + 1):
                        here = np.array(at)[(mask >> k) & 1 == 1] + k
                        np.add.at(cover, here, 1)
                        np.add.at(cover, here + window, -1)
                    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()
                    removed = len(words) - len(kept)
                    line = b" ".join([words[i] for i in kept])
                else:
                    line = b" ".join(words)
                out.append((len(words), removed, sha256(line).hexdigest() if digests else line.decode()))
            yield pa.RecordBatch.from_arrays([piece.column(piece.schema.get_field_index("doc_id")), *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_words", "n_removed", last])

    return in_arrow(joined.select("doc_id", "text", "starts", "masks"), run, f"doc_id long, n_words long, n_removed long, {last} string")


def op7_query(spark, sf_dir):
    return drop_repeats(documents(spark, sf_dir), digests=True)


OP7_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM s QUALIFY count(*) OVER (PARTITION BY h) > 1),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
l AS (SELECT x.doc_id, word, k, k - max(i) OVER (PARTITION BY x.doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) < {WINDOW} AS gone
  FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.i = x.k),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (gone IS NOT true) AS kept FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""
