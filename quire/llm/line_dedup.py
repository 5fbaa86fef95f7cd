"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every document is a sequence of line IDs; the ID of a line is its rank among the lines that occur more than once, and a
line that occurs once ends every repeat. Round k ranks the suffixes by their first 2**k lines: the pair (rank of the
first half, rank of the second half) is counted, pairs that occur once drop out (such a suffix is placed for good), and
the others get new ranks by a range-partitioned sort. What shares a rank after round k is an interval of the suffix
array whose longest common prefix is 2**k lines or more. In each interval the first suffix in document order is the
original and the others are later copies; the rounds end when no interval is left. A suffix's deepest interval with an
earlier member gives the run that it repeats; the union of these runs is what goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, documents, partitions, save

#: A run of one line counts as a repeat only if it has this many words; longer runs always do.
MIN_WORDS = 1
NEWLINE = "\n"
#: Repeated (doc_id, text hash) pairs that are broadcast to find the rows to number; beyond it the rows are shuffled to them.
BROADCAST_COPIES = 1_000_000
_DOC = ["d", "h", "n"]
_POS = [*_DOC, "i"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("h"), F.col("__row"), "text")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (__row, doc_id, text) -> d: doc_id (null as the smallest long), h: text hash, n: tells rows of one doc_id and text apart, __row, text.

    Only rows of which d and h repeat are sorted for it; the others, all as a rule, stay where they are.
    """
    keyed = _keyed(docs)
    again = save(keyed.groupBy("d", "h").agg(F.count("*").alias("c")).where("c > 1").select("d", "h"), "repeated-rows")
    found = again.count()
    if not found:
        return keyed.withColumn("n", F.lit(0))
    again = F.broadcast(again) if found <= BROADCAST_COPIES else again.hint("merge")
    alike = Window.partitionBy("d", "h").orderBy(F.xxhash64(F.to_json("__row")), F.to_json("__row"))
    copies = keyed.join(again, ["d", "h"], "left_semi").withColumn("n", F.row_number().over(alike))
    single = keyed.join(again, ["d", "h"], "left_anti").withColumn("n", F.lit(0))
    return copies.unionByName(single)


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose ``keys`` occur twice or more: position, r (orders as the keys do), later (an equal row is before it)."""
    classes = rows.groupBy(*keys).agg(F.count("*").alias("c"), F.min(F.struct(*_POS)).alias("first")).where("c > 1").drop("c")
    n = partitions(rows.sparkSession)
    classes = save(classes.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("r", F.monotonically_increasing_id()), f"{name}-ranks")
    joined = rows.join(classes, keys)
    return save(joined.select(*_POS, "r", (F.col("first") < F.struct(*_POS)).alias("later"), *[c for c in ("line", "words") if c in rows.columns]), name)


def repeated_lines(numbered: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, h, n, line): the lines, from 0, that later copies of repeated runs cover; for rows as ``_numbered`` gives them."""
    parts = F.split("text", NEWLINE, -1)
    lines = F.transform(parts, lambda x, j: F.struct(j.alias("line"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    per_doc = numbered.select(*_DOC, F.filter(lines, lambda s: s["words"] > 0).alias("lines"))
    rows = per_doc.select(*_DOC, F.posexplode("lines").alias("i", "s")).select(*_POS, "s.*")
    rows = save(rows, "lines")
    level = _ranked(rows, ["a", "b"], "level-0")
    ends = [level.where("later").where(F.col("words") >= min_words).select(*_POS, F.lit(1).alias("length"))]
    singles = level.select(*_POS, "line")
    level, length = level.select(*_POS, "r", "later"), 1
    while not level.isEmpty():
        second = level.select(*_DOC, (F.col("i") - length).alias("i"), F.col("r").alias("s"))
        level = _ranked(level.select(*_POS, F.col("r").alias("f")).join(second, _POS), ["f", "s"], f"level-{length * 2}")
        length *= 2
        ends.append(level.where("later").select(*_POS, F.lit(length).alias("length")))
    runs = ends[0]
    for e in ends[1:]:
        runs = runs.union(e)
    deepest = runs.groupBy(*_POS).agg(F.max("length").alias("length"))
    reach = F.max(F.col("i") + F.col("length")).over(Window.partitionBy(*_DOC).orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    # every line of a run is a repeated line, so the rows of level 0 are all that can go
    covered = singles.join(deepest, _POS, "left").withColumn("reach", reach).where("reach > i")
    return covered.select(*_DOC, "line")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` + n_lines, n_removed (in the place of columns so named), with the lines of later copies cut from ``text``.

    Lines are what newlines separate, compared whole and unchanged. Lines without words are not part of the sequence and
    always stay. A run of two or more consecutive lines (one, if it has ``min_words`` words) that occurs before, in an earlier
    document by doc_id or earlier in the same one, is deleted; the first copy stays. Of rows with equal doc_id the one
    whose text hashes lowest comes first, of equal texts the one whose other columns hash lowest; rows without doc_id come before all. A null text has no lines and stays null; other columns, and empty
    tables, pass through.
    """
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text")
    numbered = _numbered(docs)
    gone = repeated_lines(numbered, min_words).groupBy(*_DOC).agg(F.sort_array(F.collect_list("line")).alias("__gone"))
    rows = numbered.join(gone, _DOC, "left").withColumn("__lines", F.split("text", NEWLINE, -1))
    begin = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.get("__gone", j - 1) + 1)
    kept = F.flatten(F.transform("__gone", lambda x, j: F.slice("__lines", begin(j) + 1, x - begin(j))))
    tail = F.slice("__lines", F.get("__gone", F.size("__gone") - 1) + 2, F.size("__lines"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.concat(kept, tail), NEWLINE))
    out = {"text": text, "n_lines": F.coalesce(F.when(F.col("text").isNotNull(), F.size("__lines")), F.lit(0)).cast("long")}
    out["n_removed"] = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    keep = [c for c in docs.schema["__row"].dataType.names if c not in out]
    return rows.select(*[F.col(f"__row.`{c}`") for c in keep], *[c.alias(k) for k, c in out.items()])


def deduped_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs``, same columns, after line dedup; documents that lose every line with words go."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    out = dedup_lines(own, min_words)
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, counted).otherwise(F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op1_query(spark, sf_dir):
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = rf"""WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(a) AS x, unnest(range(len(a))) AS line FROM s),
w AS (SELECT *, len(regexp_extract_all(x, '{WORD}')) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS i FROM l WHERE regexp_matches(x, '{WORD}')),
p AS (SELECT *, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS one, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, i) AS two FROM p),
g AS (SELECT doc_id, line FROM (SELECT *, y IS NOT NULL AND two > 1 AS here FROM r)
  QUALIFY here OR (one > 1 AND words >= {MIN_WORDS}) OR coalesce(lag(here) OVER (PARTITION BY doc_id ORDER BY i), false)),
k AS (SELECT l.doc_id, string_agg(x, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL) AS kept, count(g.line) AS n_removed
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id)
SELECT s.doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM s LEFT JOIN k ON s.doc_id = k.doc_id"""
