"""Shared pieces of the training-data operators: scratch tables, tokenising, components.

Words everywhere are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; that is what
``bytes.split()`` yields, so texts are handled as UTF-8 bytes.
"""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

_FALLBACK_DIR = "/tmp/checkpoints"
_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one where that is unset and all run on one machine."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known and not spark.sparkContext.master.startswith("local"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
    return known or _FALLBACK_DIR


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/quire-{uuid.uuid4().hex}-{name}"
    _scratch.append((spark, path))
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    trim_jvm(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Delete every scratch table of this process."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session is gone already: nothing to clean with
            return


atexit.register(drop_scratch)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def most_frequent(counts: DataFrame, most: int) -> tuple[list[bytes], list[int]]:
    """Words and n of the rows of (word, n) with the highest n, by n and word: all from the lowest n at which they are ``most`` or fewer.

    A histogram of n sets the limit, so the driver gets that and at most ``most`` rows, however many partitions there are.
    """
    limit, total = None, 0
    for n, words in counts.groupBy("n").agg(F.count("*").alias("w")).orderBy(F.desc("n")).limit(most).collect():
        total += words
        if total > most:
            break
        limit = n
    if limit is None:
        return [], []
    found = counts.where(F.col("n") >= limit).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return found.column("word").to_pylist(), found.column("n").to_pylist()


def hash_sample(df: DataFrame, rows: int, most: int, *key: str) -> DataFrame:
    """At most ``most`` of about ``rows`` rows, by the hash of ``key``: for fits only. Thinned first, so that few rows meet."""
    h = F.xxhash64(*key)
    return df.where(F.pmod(h, F.lit(max(1, rows // (2 * most)))) == 0).orderBy(h, *key).limit(most)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bytes of one Arrow batch on its way to Python.
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_bytes(setting: str) -> int:
    digits = "".join(filter(str.isdigit, setting))
    unit = {"k": 10, "m": 20, "g": 30}.get(setting.strip().lower().rstrip("b")[-1:], 0)
    return int(digits or 0) << unit


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends Python at most ARROW_BYTES at once: 10,000 long texts would not fit a task's memory."""
    conf = df.sparkSession.conf
    if not 0 < _in_bytes(conf.get(_ARROW_LIMIT)) <= ARROW_BYTES:
        conf.set(_ARROW_LIMIT, str(ARROW_BYTES))
    return df


def release() -> None:
    """Give a Python worker's free memory back: workers are kept from one stage to the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trim_jvm(spark: SparkSession) -> None:
    """Give free memory of the driver JVM's native heap back.

    Planning and compiling many queries leaves the JVM's allocator hundreds of MB, over its threads' arenas, that it would keep.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    try:
        # by reflection: the server's own class is not open to Py4J
        server, kind = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), jvm.java.lang.Class.forName("javax.management.MBeanServer")
        call = next(m for m in kind.getMethods() if m.getName() == "invoke")
        of = array(jvm.java.lang.Object, 4)
        of[0], of[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        of[2], of[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        call.invoke(server, of)
    except Py4JError:  # another system, JVM or allocator
        pass


def keep_memory() -> None:
    """Reuse freed arrays of up to 32 MB, not return them to the system each time, until ``release``: a page costs more than its filling."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, the most that it may be
        libc.mallopt(-1, 256 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` over batches of bounded size, the worker's memory given back at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return small_batches(df).mapInArrow(task, schema)


def per_text(text, score, of):
    """A column of ``of`` from the column ``text`` (binary): ``score()``, called once a task, gives the function of each text (null: b'').

    Only texts go to Python and only results come back; the other columns stay in the JVM. Never evaluated twice.
    """
    arrow = pa.float64() if of == "double" else pa.int64()

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_text = score()
        try:
            for texts in columns:
                yield pa.array([of_text(t.as_py() or b"") for t in texts], arrow)
        finally:
            release()

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, of).asNondeterministic()(text)


def binary_rows(batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches holding about ``max_bytes`` of the column ``text`` (binary; null gives b'')."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index("text"))
        if not len(col):
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        part = np.cumsum(sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(col)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece = batch.slice(a, b - a)
            yield piece, [x or b"" for x in piece.column(batch.schema.get_field_index("text")).to_pylist()]


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links between longs -> (node, component), component the smallest reachable node.

    Alternating large-star and small-star steps (Kiveris et al. 2014): every step is a grouped minimum, combined before
    the shuffle, and a join; no neighbourhood is ever gathered. Null or equal ends are no link. Nodes without links do
    not appear. Each round is written to the shared folder, so a lost executor costs one round.
    """

    def directed(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def stamp(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1_000_003))).first()
        return row[0], row[1]

    links = save(directed(edges), "links")
    seen = stamp(links)
    if not seen[0]:
        return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = directed(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = save(
            directed(small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))), "links"
        )
        now = stamp(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    child = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return child.union(roots)
