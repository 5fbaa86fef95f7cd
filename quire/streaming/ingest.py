"""Page texts as they arrive: a file stream through the same operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import has_text, page_ref, squeeze

SCHEMA = "source string, page_number int, text string, arrived timestamp"


def page_stream(spark: SparkSession, folder: str, schema: str = SCHEMA, files_per_batch: int = 100) -> DataFrame:
    """New JSON-lines files of ``folder`` as rows, with page_ref and squeezed text."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.withColumn("page_ref", page_ref(F.col("source"), F.col("page_number"))).withColumn("text", squeeze(F.col("text")))


def arrivals(pages: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Pages and blank pages for each source and window; state older than ``late`` is dropped."""
    return (
        pages.withWatermark("arrived", late)
        .groupBy(F.window("arrived", window), "source")
        .agg(F.count("*").alias("pages"), F.count_if(~has_text(F.col("text"))).alias("blank_pages"))
        .select("window.start", "source", "pages", "blank_pages")
    )


def once_each(pages: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The first of the rows that repeat a page within the watermark."""
    return pages.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["page_ref"])


def each_batch(pages: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Run a batch operator over every micro-batch; a batch is one folder of ``target``, so that a repeated one overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return pages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
