"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into a ring of five segments. Two fingerprints at distance d <= 4 have, by the pigeonring
principle (Qin & Xiao 2018), a start from which every chain of k consecutive segments differs in at most floor(4k/5)
bits: 0, 1, 2, 3, 4. The first two links of such a chain are an equi-join: the first segment is equal and the second
differs in at most one bit, so one side stores the two segments and the other probes with the (at most 14) variants of
the second. The longer chains prune what the join finds, and the full Hamming check comes last. Keys have 25 to 26 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import binary_rows, connected_components, in_arrow, save

SEED = 42
SEGMENTS = 5
#: (shift, width) of the ring's segments; widths sum to 64.
RING = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of the XXH64 hashes of all ``shingle``-word shingles of the ASCII-lower-cased text, repeats included.

    A text of fewer words is one shingle; one without words has fingerprint zero. Bit i is set if over half the hashes
    have it.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    n, counts, digest = len(starts), np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 15):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keys: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row of ``docs``, and ``keys`` (longs) as k0, k1, ..."""
    names = ["doc_id", *[f"k{i}" for i in range(len(keys))], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in binary_rows(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(fps)], names=names)

    own = [F.col("doc_id").cast("long").alias("doc_id"), *[k.alias(n) for k, n in zip(keys, names[1:-1], strict=True)]]
    return in_arrow(docs.select(*own, F.col("text").cast("binary").alias("text")), run, ", ".join(f"{n} long" for n in names))


def _segment(fp: Column, i: int) -> Column:
    shift, width = RING[i % SEGMENTS]
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _key(i: int, first: Column, second: Column) -> Column:
    return F.lit(i).cast("long") * F.lit(1 << 26) + first * F.lit(1 << 13) + second


def near_pairs(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs (x, y), x < y as signed longs, of distinct fingerprints in column ``fp`` at Hamming distance 4 or less."""
    if not 0 <= distance < SEGMENTS:
        raise ValueError("the ring of five segments serves distances 0 to 4")
    fp = F.col("fp")
    stored = fps.select(fp.alias("x"), F.explode(F.array(*[_key(i, _segment(fp, i), _segment(fp, i + 1)) for i in range(SEGMENTS)])).alias("key"))
    probes = []
    for i in range(SEGMENTS):
        flips = [0, *(1 << b for b in range(RING[(i + 1) % SEGMENTS][1]))]
        probes += [_key(i, _segment(fp, i), _segment(fp, i + 1).bitwiseXOR(F.lit(f).cast("long"))) for f in flips]
    probing = fps.select(fp.alias("y"), F.explode(F.array(*probes)).alias("key"))
    # sizes after explode are underestimated, so a broadcast would not be checked
    found = stored.hint("merge").join(probing, "key").where("x < y")
    start = F.shiftright("key", 26)
    differ = F.col("x").bitwiseXOR(F.col("y"))
    bits = F.array(*[F.bit_count(_segment(differ, i)) for i in range(SEGMENTS)])
    chain = F.lit(True)
    total: Column = F.lit(0)
    for k in range(SEGMENTS):
        total = total + F.element_at("bits", ((start + k) % SEGMENTS + 1).cast("int"))
        chain = chain & (total <= distance * (k + 1) // SEGMENTS)
    return found.withColumn("bits", bits).where(chain).where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance).select("x", "y").distinct()


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``.

    Rows whose fingerprints differ in at most ``distance`` bits are linked; component_id is the smallest doc_id
    reachable, the row's own included. Rows of one fingerprint form one class, represented by its smallest doc_id, and
    only classes are joined, so a group of copies costs one row. Null and word-less texts have fingerprint zero and link
    like any other; rows with a null doc_id are kept and get their class's component; repeated doc_ids stay repeated
    rows. An empty table gives an empty result. Columns other than doc_id and text are ignored.
    """
    rows, named = _grouped(fingerprints(docs, shingle), distance)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _grouped(rows: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with doc_id and fp), saved, and fp, part (a name of its group, never null), component_id for every fingerprint."""
    rows = save(rows, "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = save(classes, "classes")
    pairs = near_pairs(classes.select("fp"), distance)
    # each distinct fingerprint is a node of its own number, so components are found over fingerprints
    parts = connected_components(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")))
    grouped = classes.join(parts, classes.fp == parts.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("part"))
    least = grouped.groupBy("part").agg(F.min("rep").alias("component_id"))
    return rows, grouped.select("fp", "part").join(least, "part").select("fp", "part", "component_id")


def _row_keys(columns: list[str]) -> tuple[Column, Column]:
    """128 bits of a whole row, nulls told apart from what else hashes like them."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def keep_one_per_group(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest doc_id, whole and unchanged.

    Groups are of rows, so rows that share a doc_id, or have none, go or stay by their own texts. Of rows with equal doc_id
    in one group, the one whose columns hash lowest stays; a row without doc_id stays only if its whole group has none.
    """
    rows, named = _grouped(fingerprints(docs, shingle, _row_keys(docs.columns)), distance)
    # a third of the rows may be one fingerprint, so each fingerprint's first row is found before groups meet
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "k0", "k1")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    heads = first.join(named.select("fp", "part"), "fp").groupBy("part").agg(F.min("first").alias("first"))
    heads = heads.select(F.col("first.k0").alias("_k0"), F.col("first.k1").alias("_k1"))
    k0, k1 = _row_keys(docs.columns)
    own = docs.select(F.struct(*docs.columns).alias("_row"), k0.alias("_k0"), k1.alias("_k1"))
    # rows that are equal in every column are combined before they are dealt out
    whole = own.groupBy("_k0", "_k1").agg(F.first("_row").alias("_row"))
    return whole.join(heads.hint("merge"), ["_k0", "_k1"], "left_semi").select("_row.*")


def op9_query(spark, sf_dir):
    from quire.llm.common import documents

    out = simhash_components(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
