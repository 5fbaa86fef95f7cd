"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are the bytes of the ASCII-lower-cased text and its end. All n-grams of all trusted training texts are counted; counts,
continuation counts, discounts, context totals and lower orders meet in joins sharded by gram and context (Chen & Goodman 1999), and
nothing of the model is gathered or broadcast. Documents ask for probabilities in blocks, the partitions of their scan: each block's
distinct grams are listed, all distinct grams get their probability by joins with the counts, order by order, and return to
their blocks, where the texts are summed up by looking their grams up. So a gram is joined once a block, not once an occurrence.

One trusted document in CALIBRATE is left out of the counts; these give the quantiles: a document is kept if its perplexity is
at most its language's quantile over them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import binary_rows, documents, in_arrow, save

ORDER = 5
BITS = 9
SIZE = 1 << BITS
EDGE = 256
SYMBOLS = 257
QUANTILE = 0.99
#: One trusted document in so many is for the quantiles only.
CALIBRATE = 5
#: Distinct grams that a task holds before it passes them on.
HELD_GRAMS = 2_000_000
#: Trusted ids that are broadcast to pick the training texts; beyond it the texts are shuffled to them.
BROADCAST_IDS = 2_000_000
BROADCAST_LANGUAGES = 10_000
#: Bytes of texts that travel to their block in one row.
PACKED_BYTES = 1 << 20


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of all texts, each padded with ORDER - 1 edges before and one after, and how many each has."""
    pad, end = np.full(ORDER - 1, EDGE, dtype=np.int64), np.array([EDGE])
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    parts = [x for t in texts for x in (pad, np.frombuffer(t.lower(), dtype=np.uint8), end)]
    codes = np.concatenate([np.empty(0, dtype=np.int64), *parts]).astype(np.int64)
    packed = codes[: max(0, len(codes) - ORDER + 1)]
    for k in range(1, ORDER):
        packed = packed << BITS | codes[k : k + len(packed)]
    # of the grams that begin at each place, those that begin in the last ORDER - 1 places of a text's codes belong to none
    begins = np.cumsum(lengths + ORDER) - (lengths + ORDER)
    own = np.repeat(begins, lengths + 1) + np.arange(int((lengths + 1).sum())) - np.repeat(np.cumsum(lengths + 1) - (lengths + 1), lengths + 1)
    return packed[own], lengths + 1


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all parts, with their counts summed."""
    every, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    found, at = np.unique(every, return_inverse=True)
    return found, np.bincount(at, weights=counts).astype(np.int64)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Grams and counts of a task's texts, with a piece of the batch that they end in: all at once, or HELD_GRAMS and more at a time."""
    held, n, last = [], 0, None
    for piece, texts in binary_rows(batches):
        last = piece.slice(0, 1)
        held.append(np.unique(grams(texts)[0], return_counts=True))
        n += len(held[-1][0])
        if n > 2 * HELD_GRAMS:
            held = [_merged(held)]
            n = len(held[0][0])
            if n > HELD_GRAMS:
                yield last, *held[0]
                held, n = [], 0
    if held:
        yield last, *_merged(held)


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, c) over all of ``texts``: counted by each task, then summed by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, counts in _distinct(batches):
            yield from pa.Table.from_arrays([pa.array(found), pa.array(counts)], names=["gram", "c"]).to_batches(1 << 17)

    return in_arrow(texts.select(F.col("text").cast("binary").alias("text")), run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of one order from its counts of counts; 0.5, 1, 1.5 where those are too few."""
    row = counts.agg(*[F.count_if(F.col("c") == k) for k in range(1, 5)]).first()
    n1, n2, n3, n4 = row
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True)]


def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (gram, share) discounted shares of the seen grams, and (context, back) weights of the lower order.

    The highest order has counts; a lower order's count is the number of different symbols seen before the gram.
    """
    orders = [save(counts, "grams")]
    for k in range(ORDER - 1, 0, -1):
        orders.insert(0, save(orders[0].groupBy((F.col("gram") % SIZE**k).alias("gram")).agg(F.count("*").alias("c")), f"continued-{k}"))
    out = []
    for table in orders:
        d = _discounts(table)
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = table.withColumn("context", F.shiftright("gram", BITS)).withColumn("off", off)
        totals = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("off").alias("given"))
        shares = rows.join(totals.hint("merge"), "context").select("gram", ((F.col("c") - F.col("off")) / F.col("total")).alias("share"))
        out.append((shares, totals.select("context", (F.col("given") / F.col("total")).alias("back"))))
    return out


def probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, p): the probability of each gram's last symbol after the others, for all grams of ``asked`` (gram, distinct)."""
    wanted = [asked]
    for k in range(ORDER - 1, 0, -1):
        wanted.insert(0, save(wanted[0].select((F.col("gram") % SIZE**k).alias("gram")).distinct(), f"asked-{k}"))
    lower = None
    for k, (rows, (shares, back)) in enumerate(zip(wanted, model, strict=True), start=1):
        rows = rows.withColumn("context", F.shiftright("gram", BITS)).withColumn("shorter", F.col("gram") % SIZE ** (k - 1))
        rows = rows.join(shares.hint("merge"), "gram", "left").join(back.hint("merge"), "context", "left")
        less = F.lit(1 / SYMBOLS)
        if lower is not None:
            rows = rows.join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("less")).hint("merge"), "shorter")
            less = F.col("less")
        lower = save(rows.select("gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * less).alias("p")), f"p-{k}")
    return lower


def trusted_ids(labels: DataFrame, calibrate: bool) -> DataFrame:
    """doc_id of what any label marks with quality 1: what is counted, or what is left for the quantiles."""
    ids = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    left_out = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(CALIBRATE)) == 0
    return ids.where(left_out if calibrate else ~left_out)


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge")
    return rows.join(ids, "doc_id", "left_semi")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram, logp) -> one row for each block and HELD_GRAMS rows or fewer: steps from gram to gram and logs, compressed."""
    press, held, n = zstandard.ZstdCompressor(level=1).compress, [], 0

    def out() -> pa.RecordBatch:
        block, gram, logp = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((gram, block))
        block, gram, logp = block[order], gram[order], logp[order]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        ends = np.append(first[1:], len(block))
        data = [press(np.stack([np.diff(gram[a:b], prepend=0), logp[a:b].view(np.int64)]).astype("<i8").tobytes()) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        columns = [pa.array(block[first], pa.int32()), pa.array(np.zeros(len(data), dtype=np.int32)), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "kind", "data"])

    for b in batches:
        if b.num_rows:
            held.append(tuple(np.asarray(c) for c in b.columns))
            n += b.num_rows
        if n > HELD_GRAMS:
            yield out()
            held, n = [], 0
    if held:
        yield out()


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, doc_id, lang, text) -> one row for each PACKED_BYTES of texts or so: the rows, compressed together, which is denser than row by row."""
    for batch, texts in binary_rows(batches, PACKED_BYTES):
        own = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(texts, pa.large_binary())], names=["doc_id", "lang", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(own)
        yield pa.RecordBatch.from_arrays([batch.column(0)[:1], pa.array([1], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "kind", "data"])


def perplexities(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity of every row of ``docs`` (doc_id, lang, text: binary), read twice: it must be a table or saved."""
    n = docs.rdd.getNumPartitions()  # a task for each block
    blocks = docs.withColumn("block", F.spark_partition_id())  # the same in both scans of a table

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found, _ in _distinct(batches):
            block = pa.array(np.full(len(found), piece.column(0)[0].as_py(), dtype=np.int32))
            yield from pa.Table.from_arrays([block, pa.array(found)], names=["block", "gram"]).to_batches(1 << 17)

    asked = save(in_arrow(blocks.select("block", "text"), ask, "block int, gram long"), "asked")
    p = probabilities(save(asked.select("gram").distinct(), f"asked-{ORDER}"), model)
    # packed lists of grams and log probabilities go to their block before its packed texts
    told = asked.hint("merge").join(p, "gram").select("block", "gram", F.ln("p").alias("logp"))
    told = in_arrow(told, _packed, "block int, kind int, data binary")
    rows = in_arrow(blocks.select("block", "doc_id", "lang", "text"), _packed_rows, "block int, kind int, data binary")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor().decompress
        now, parts, known, logs = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column(0)).astype(np.int64) * 2 + np.asarray(batch.column(1))
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                packed, block, kind = batch.column(2).slice(a, b - a).to_pylist(), key[a] // 2, key[a] % 2
                if block != now:
                    now, parts, known = block, [], None
                if kind == 0:
                    for data in map(unpress, packed):
                        steps, told_logs = np.frombuffer(data, dtype="<i8").reshape(2, -1)
                        parts.append((np.cumsum(steps), told_logs.view("<f8")))
                    continue
                if known is None:
                    known, logs = (np.concatenate(x) for x in zip(*parts, strict=True))
                    order = np.argsort(known)
                    known, logs, parts = known[order], logs[order], []
                for part, texts in binary_rows(own for data in packed for own in pa.ipc.open_stream(data)):
                    asked_grams, size = grams(texts)
                    at = np.minimum(np.searchsorted(known, asked_grams), len(known) - 1)
                    if not np.array_equal(known[at], asked_grams):
                        raise RuntimeError("the two scans of the documents were split into different partitions; save them first")
                    sums = np.add.reduceat(logs[at], np.cumsum(size) - size)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(size), pa.array(np.exp(-sums / size))], names=["doc_id", "lang", "n_symbols", "perplexity"])

    met = told.unionByName(rows).repartitionById(n, F.col("block") % n).sortWithinPartitions("block", "kind")
    return in_arrow(met, add_up, "doc_id long, lang string, n_symbols long, perplexity double")


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, keep for every row of ``docs``, a table (or saved: it is scanned twice).

    perplexity: per symbol, the end of the text included. Null and empty texts are one symbol, the end. threshold: the
    language's quantile of the perplexity of the trusted documents that are left out of the counts; all of theirs for a
    language without any, and for a null one; without such documents at all it is null and everything is kept. Without trusted
    text every symbol is as likely as any other. Repeated rows score alike, rows with a null doc_id are never trusted; other
    columns are ignored and an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    model = kneser_ney(gram_counts(_of(rows.select("doc_id", "text"), trusted_ids(labels, calibrate=False))))
    scored = save(perplexities(rows, model), "perplexity")
    held_out = save(_of(scored, trusted_ids(labels, calibrate=True)), "calibration")
    limit = F.percentile_approx("perplexity", quantile, 10000)
    overall = held_out.agg(limit.alias("t")).first()[0]
    limits = save(held_out.where("lang is not null").groupBy("lang").agg(limit.alias("threshold")), "limits")
    if limits.count() <= BROADCAST_LANGUAGES:  # else a large language is split like any skewed key
        limits = F.broadcast(limits)
    out = scored.join(limits, "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
    return out.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"))


def op4_query(spark, sf_dir):
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
