"""Classification and selective second opinions: flags, summaries, page labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions.text import has_text, notes, page_ref


def classified(pages: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Pages with category, confidence, probabilities -> + needs_review, review_reason. A page without text has no category
    and is flagged ``empty text``."""
    blank = ~has_text(F.col("text"))
    reason = F.when(blank, F.lit("empty text")).otherwise(S.initial_review(F.col("category"), F.col("confidence"), min_confidence))
    out = pages.withColumn("review_reason", reason).withColumn("needs_review", F.col("review_reason").isNotNull())
    for c in ("category", "confidence", "probabilities"):
        out = out.withColumn(c, F.when(~blank, F.col(c)))
    return out.withColumn("page_ref", page_ref(F.col("source"), F.col("page_number")))


def triggered(pages: DataFrame, min_confidence: float = 0.5, min_margin: float = 0.5) -> DataFrame:
    """+ margin, trigger_reasons, triggered."""
    out = pages.withColumn("margin", S.margin(F.col("probabilities")))
    out = out.withColumn("trigger_reasons", S.trigger_reasons(F.col("category"), F.col("confidence"), F.col("margin"), min_confidence, min_margin))
    return out.withColumn("triggered", F.size("trigger_reasons") > 0)


def second_opinions(pages: DataFrame, ask: Callable[[DataFrame], DataFrame], key: tuple[str, ...] = ("source", "page_number")) -> DataFrame:
    """Ask about triggered pages only, and join the answers (key, verifier_category, error, and verifier_seconds if there) back.

    The filter comes before ``ask``: a Python function inside ``when`` would run for every row.
    """
    answers = ask(pages.where("triggered"))
    answers = answers.select(*key, "verifier_category", "error", *[c for c in ("verifier_seconds",) if c in answers.columns])
    out = pages.join(answers, list(key), "left")
    outcome = S.resolution(F.col("triggered"), F.col("category"), F.col("verifier_category"), F.col("error"))
    out = out.withColumn("resolution", outcome).withColumn("needs_review_before", F.col("needs_review"))
    flag, why = S.reviewed(F.col("resolution"), F.col("needs_review"), F.col("review_reason"))
    return out.withColumn("review_reason", why).withColumn("needs_review", flag)


def classification_summary(pages: DataFrame, group: tuple[str, ...] = ("source",)) -> DataFrame:
    return pages.groupBy(*group).agg(
        F.count("*").alias("page_count"), F.count("category").alias("classified_page_count"),
        F.count_if(F.col("category").isNull()).alias("skipped_page_count"), F.count_if("needs_review").alias("needs_review_page_count"),
        F.array_sort(F.collect_list(F.when(F.col("needs_review"), F.col("page_number")))).alias("needs_review_pages"),
    )


def token_usage(pages: DataFrame, group: tuple[str, ...] = ("source",)) -> DataFrame:
    """requests, input_tokens, output_tokens, classify_seconds, avg_classify_seconds_per_page (null without requests), from pages with
    category, input_tokens, output_tokens, seconds; only classified pages were requests."""
    asked = F.col("category").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(asked, F.col(c))), F.lit(0))
    out = pages.groupBy(*group).agg(F.count_if(asked).alias("requests"), total("input_tokens").cast("long").alias("input_tokens"), total("output_tokens").cast("long").alias("output_tokens"), total("seconds").alias("_seconds"))
    mean = F.when(F.col("requests") > 0, F.round(F.col("_seconds") / F.col("requests"), 3))
    return out.withColumn("classify_seconds", F.round("_seconds", 3)).withColumn("avg_classify_seconds_per_page", mean).drop("_seconds")


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """+ category_label from the dimension ``labels`` (category, label); null for a category that it lacks."""
    return pages.join(labels.select("category", F.col("label").alias("category_label")), "category", "left")


def ocr_reference() -> Column:
    """The quality of a page's text as it goes with the page."""
    return F.struct("line_count", "mean_score", "duration_seconds").alias("ocr_reference")


def category_counts(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """category, n for every row of ``categories``, zero included."""
    counted = pages.where("category is not null").groupBy("category").agg(F.count("*").alias("_n"))
    return categories.select("category").join(counted, "category", "left").select("category", F.coalesce("_n", F.lit(0)).cast("long").alias("n"))


def verification_summary(pages: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    outcomes = [F.count_if(F.col("resolution") == r).alias(f"{r}_page_count") for r in ("accepted", "mutual_other", "disagreement", "verifier_failed")]
    return pages.groupBy(*group).agg(
        F.count("*").alias("page_count"), F.count_if("triggered").alias("triggered_page_count"), *outcomes,
        F.count_if("needs_review_before").alias("needs_review_before"), F.count_if("needs_review").alias("needs_review_after"),
        F.array_sort(F.collect_list(F.when(F.col("triggered"), F.col("page_number")))).alias("triggered_pages"),
    )


def page_labels(pages: DataFrame) -> DataFrame:
    """source, page_number, label, confidence, notes: a page without category is ``other`` without confidence."""
    known = F.col("category").isNotNull()
    return pages.select(
        "source", "page_number", F.coalesce("category", F.lit(S.OTHER)).alias("label"),
        F.when(known, F.round("confidence", 3)).alias("confidence"), notes(F.col("review_reason"), F.col("mismatches")).alias("notes"),
    )
