"""Seconds spent: by page over the stages that see pages, and by stage over the pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = ["source", "page_number"]


def page_timings(ocr: DataFrame, classification: DataFrame, extraction: DataFrame) -> DataFrame:
    """source, page_number, ocr_seconds, classification_seconds, vlm_seconds, total_seconds, rounded to milliseconds.

    Each input: source, page_number, seconds. A page must be in all three; null seconds count as none.
    """
    spent = lambda df, name: df.select(*PAGE, F.coalesce("seconds", F.lit(0.0)).alias(name))
    names = ("ocr_seconds", "classification_seconds", "vlm_seconds")
    rows = spent(ocr, names[0]).join(spent(classification, names[1]), PAGE).join(spent(extraction, names[2]), PAGE)
    total = F.col(names[0]) + F.col(names[1]) + F.col(names[2])
    return rows.select(*PAGE, *[F.round(n, 3).alias(n) for n in names], F.round(total, 3).alias("total_seconds"))


def stage_timings(stages: DataFrame) -> DataFrame:
    """source, stages_seconds (map), total_seconds from (source, stage, seconds); a negative or missing total is an error."""
    checked = F.when(F.col("seconds") >= 0, F.col("seconds")).otherwise(F.raise_error(F.concat(F.lit("no total for stage "), F.col("stage"))).cast("double"))
    rows = stages.select("source", "stage", checked.alias("seconds"))
    pairs = F.array_sort(F.collect_list(F.struct("stage", F.round("seconds", 3).alias("seconds"))))
    return rows.groupBy("source").agg(F.map_from_entries(pairs).alias("stages_seconds"), F.round(F.sum("seconds"), 3).alias("total_seconds"))
