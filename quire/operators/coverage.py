"""Do two tables describe the same pages? All checks are anti joins or grouped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = ("source", "page_number")


def missing(expected: DataFrame, provided: DataFrame, key=PAGE) -> DataFrame:
    """Keys of ``expected`` that ``provided`` lacks."""
    return expected.select(*key).distinct().join(provided.select(*key).distinct(), list(key), "left_anti")


def coverage(expected: DataFrame, provided: DataFrame, key=PAGE) -> DataFrame:
    """Keys on one side only, with problem ``missing`` or ``extra``."""
    lacking = missing(expected, provided, key).withColumn("problem", F.lit("missing"))
    return lacking.unionByName(missing(provided, expected, key).withColumn("problem", F.lit("extra")))


def auxiliary_coverage(pages: DataFrame, provided: DataFrame, key=PAGE, has_text: str = "has_text") -> DataFrame:
    """As ``coverage``, but pages without text may be left out."""
    lacking = missing(pages.where(F.col(has_text)), provided, key).withColumn("problem", F.lit("missing"))
    return lacking.unionByName(missing(provided, pages, key).withColumn("problem", F.lit("extra")))


def repeated(rows: DataFrame, key=PAGE) -> DataFrame:
    """Keys with more than one row, and how many."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def page_counts_differ(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sources whose two page lists differ in number, or do not run from 1 without gaps."""
    shape = lambda d, s: d.groupBy("source").agg(F.count("*").alias(f"{s}_n"), F.min("page_number").alias(f"{s}_lo"), F.max("page_number").alias(f"{s}_hi"))
    both = shape(left, "left").join(shape(right, "right"), "source", "full_outer")
    sound = (F.col("left_n") == F.col("right_n")) & (F.col("left_lo") == 1) & (F.col("right_lo") == 1) & (F.col("left_hi") == F.col("left_n")) & (F.col("right_hi") == F.col("right_n"))
    return both.where(~F.coalesce(sound, F.lit(False)))


def page_lists_differ(left: DataFrame, right: DataFrame) -> DataFrame:
    """source, page_number, problem: pages on one side only, and pages whose page_refs differ (``page_ref``). Both: source, page_number, page_ref."""
    theirs = right.select("source", "page_number", F.col("page_ref").alias("_theirs"))
    other = left.join(theirs, list(PAGE)).where(~F.col("page_ref").eqNullSafe(F.col("_theirs")))
    return coverage(left, right).unionByName(other.select(*PAGE, F.lit("page_ref").alias("problem")))


def not_increasing(pages: DataFrame, order: str = "position") -> DataFrame:
    """Rows whose page_number is not above that of the row before by ``order`` (0, 1, ...) in their source."""
    before = pages.select(F.col("source").alias("s"), (F.col(order) + 1).alias("o"), F.col("page_number").alias("previous"))
    rows = pages.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col(order) == F.col("o"))).drop("s", "o")
    return rows.where("page_number <= previous")
