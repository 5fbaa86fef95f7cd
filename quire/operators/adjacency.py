"""Neighbouring pages: edge scores, contiguous groups, their roll-up.

Input pages: source, page_number, vector (null: the page is skipped), category, confidence, printed_number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions.text import page_ref
from quire.operators.coverage import coverage, repeated
from quire.operators.prefix import running_sum


def edges(pages: DataFrame, weights=S.WEIGHTS, min_embedding: float = S.MIN_EMBEDDING) -> DataFrame:
    """One row for each page whose predecessor (page_number - 1 of the same source) is there too, both with vectors.

    A page without category or printed number has no such signal; the weights of the others are scaled up. ``blocked``: the
    vectors alone are too different. Pages meet by an equi-join, so no source is gathered in one task.
    """
    there = pages.where("vector is not null")
    before = there.select(
        F.col("source").alias("s"), (F.col("page_number") + 1).alias("p"), F.col("vector").alias("v"),
        F.col("category").alias("c"), F.col("confidence").alias("k"), F.col("printed_number").alias("n"),
    )
    pairs = there.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("page_number") == F.col("p")))
    scored = pairs.select(
        "source", "page_number",
        S.unit_interval(S.cosine(F.col("v"), F.col("vector"))).alias("embedding"),
        S.category_score(F.col("c"), F.col("k"), F.col("category"), F.col("confidence")).alias("category"),
        S.page_number_score(F.col("n"), F.col("printed_number")).alias("page_number_seq"),
    )
    signals = (F.col("category"), F.col("page_number_seq"))
    return scored.select(
        "*", S.available_weight(*signals, weights).alias("available_weight"),
        S.combine(F.col("embedding"), *signals, weights).alias("combined"), (F.col("embedding") < min_embedding).alias("blocked"),
    )


def islands(pages: DataFrame, evaluated: DataFrame, threshold: float = S.EDGE_THRESHOLD) -> DataFrame:
    """source, page_number, group_seq, combined for every page with a vector: a page joins the group before it if its edge is
    there, not blocked and at the threshold or above. combined is null for a group's first page."""
    joined = F.coalesce(~F.col("blocked") & (F.col("combined") >= threshold), F.lit(False))
    marks = evaluated.select(F.col("source").alias("s"), F.col("page_number").alias("p"), "combined", "blocked")
    rows = pages.where("vector is not null").select("source", "page_number")
    rows = rows.join(marks, F.col("source").eqNullSafe(F.col("s")) & (F.col("page_number") == F.col("p")), "left").withColumn("joins", joined)
    rows = rows.select("source", F.col("page_number").cast("long").alias("page_number"), "joins", F.when(F.col("joins"), F.col("combined")).alias("combined"))
    return running_sum(rows, ["source"], "page_number", (~F.col("joins")).cast("int"), "group_seq").drop("joins")


def groups(members: DataFrame) -> DataFrame:
    """source, group_seq, size, first_page, pages, representative, min_combined, mean_combined (1 without edges)."""
    rolled = members.groupBy("source", "group_seq").agg(
        F.count("*").alias("size"), F.min("page_number").alias("first_page"), F.array_sort(F.collect_list("page_number")).alias("pages"),
        F.coalesce(F.min("combined"), F.lit(1.0)).alias("min_combined"), F.coalesce(F.avg("combined"), F.lit(1.0)).alias("mean_combined"),
    )
    return rolled.withColumn("representative", page_ref(F.col("source"), F.col("first_page")))


def numbered_groups(grouped: DataFrame) -> DataFrame:
    """Groups of two pages or more, with group_id 1, 2, ... by first page in each source."""
    several = grouped.where("size > 1")
    return running_sum(several, ["source"], "first_page", F.lit(1), "group_id")


def match_summary(pages: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row for each source: pages, embedded, skipped, groups, pages in groups, unique pages."""
    counted = pages.groupBy("source").agg(F.count("*").alias("page_count"), F.count("vector").alias("embedded_page_count"))
    rolled = grouped.groupBy(F.col("source").alias("s")).agg(
        F.count_if(F.col("size") > 1).alias("group_count"), F.sum(F.when(F.col("size") > 1, F.col("size")).otherwise(0)).alias("grouped_page_count"),
        F.count_if(F.col("size") == 1).alias("unique_page_count"),
    )
    out = counted.join(rolled, F.col("source").eqNullSafe(F.col("s")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "source", "page_count", "embedded_page_count", (F.col("page_count") - F.col("embedded_page_count")).alias("skipped_page_count"),
        zero("group_count"), zero("grouped_page_count"), zero("unique_page_count"),
    )


def majority_label(labels: DataFrame, group: list[str], label: str = "label", page: str = "page_number") -> DataFrame:
    """The commonest label of each group, ties to the one that appears first."""
    counts = labels.groupBy(*group, label).agg(F.count("*").alias("_n"), F.min(page).alias("_first"))
    best = Window.partitionBy(*group).orderBy(F.desc("_n"), "_first")
    return counts.withColumn("_r", F.row_number().over(best)).where("_r = 1").select(*group, label)


def cover_violations(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """source, page_number, problem: pages in no document (``missing``), members that are no pages (``extra``), and pages in several
    documents, or several times in one (``twice``). ``documents``: source, pages."""
    members = documents.select("source", F.explode("pages").alias("page_number"))
    twice = repeated(members).select("source", "page_number", F.lit("twice").alias("problem"))
    return coverage(pages, members).unionByName(twice)


def documents(pages: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """source, first_page, pages, label: groups of any size and skipped pages, each with its majority label.

    Every page is in one document: a page without label is ``other``; see ``cover_violations`` for members that are no pages, or twice.
    """
    skipped = pages.where("vector is null").select("source", F.col("page_number").cast("long").alias("page_number"), (-F.col("page_number")).cast("long").alias("group_seq"))
    every = members.select("source", "page_number", "group_seq").unionByName(skipped)
    named = labels.select(F.col("source").alias("s"), F.col("page_number").alias("p"), "label")
    every = every.join(named, F.col("source").eqNullSafe(F.col("s")) & (F.col("page_number") == F.col("p")), "left")
    every = every.withColumn("label", F.coalesce("label", F.lit(S.OTHER)))
    rolled = every.groupBy("source", "group_seq").agg(F.array_sort(F.collect_list("page_number")).alias("pages"), F.min("page_number").alias("first_page"))
    best = majority_label(every, ["source", "group_seq"]).select(F.col("source").alias("s"), F.col("group_seq").alias("g"), "label")
    out = rolled.join(best, F.col("source").eqNullSafe(F.col("s")) & (F.col("group_seq") == F.col("g")))
    return out.select("source", "first_page", "pages", "label")
