"""The whole dataflow: page texts and model answers to page labels, documents and field records.

All stages are keyed by source, so one job takes any number of inputs. What models answer is written before it is used twice, so
that no request is sent again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions.text import has_text
from quire.operators import adjacency, coverage, fields, review
from quire.sources import models
from quire.sources.reports import printed_number

PAGE = ["source", "page_number"]


@dataclass(frozen=True)
class Settings:
    min_confidence: float = 0.5
    min_margin: float = 0.5
    max_chars: int = 30_000
    floor: float = 0.75
    review_margin: float = 0.10
    weights: tuple[float, float, float] = S.WEIGHTS
    min_embedding: float = S.MIN_EMBEDDING
    edge_threshold: float = S.EDGE_THRESHOLD


@dataclass(frozen=True)
class Result:
    pages: DataFrame
    checks: DataFrame
    edges: DataFrame
    members: DataFrame
    vectors: DataFrame
    extracted: DataFrame
    page_labels: DataFrame
    documents: DataFrame
    loan_fields: DataFrame


def too_long(pages: DataFrame, most: int) -> DataFrame:
    """Pages with more than ``most`` characters; white space alone is no text."""
    return pages.where(has_text(F.col("text")) & (F.length("text") > most))


def require_short(pages: DataFrame, most: int) -> None:
    """Before any request is paid for."""
    first = too_long(pages, most).orderBy(*PAGE).select(*PAGE).first()
    if first:
        raise ValueError(f"{first.source} page {first.page_number} has more than {most} characters")


def written(df: DataFrame, scratch: str, name: str) -> DataFrame:
    path = f"{scratch.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def classify(pages: DataFrame, model: models.Model, s: Settings) -> DataFrame:
    """Only pages with text are asked about; the others are flagged."""
    require_short(pages, s.max_chars)
    asked = models.classify(pages.where(has_text(F.col("text"))).select(*PAGE, "text"), model).drop("text", "error").withColumnRenamed("seconds", "classify_seconds")
    return review.classified(pages.join(asked, PAGE, "left"), s.min_confidence)


def verify(classified: DataFrame, model: models.Model, s: Settings) -> DataFrame:
    return review.second_opinions(
        review.triggered(classified, s.min_confidence, s.min_margin), lambda rows: models.verify(rows.select(*PAGE, "text"), model).withColumnRenamed("seconds", "verifier_seconds")
    )


def check(extracted: DataFrame, pages: DataFrame, s: Settings) -> DataFrame:
    """Extracted fields of each page, against its text."""
    long = fields.unpivot(extracted).join(fields.normalized_pages(pages.select(*PAGE, "text")).drop("text"), PAGE)
    return fields.check_fields(long, s.floor, s.review_margin)


def match(pages: DataFrame, vectors: DataFrame, categories: DataFrame, numbers: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages with signals, edges, members of groups)."""
    usable = (F.col("category") != S.OTHER) & ~F.col("needs_review")
    signals = categories.select(*PAGE, F.when(usable, F.col("category")).alias("category"), F.when(usable, F.col("confidence")).alias("confidence"))
    rows = pages.select(*PAGE).join(vectors.select(*PAGE, "vector"), PAGE, "left").join(signals, PAGE, "left").join(numbers, PAGE, "left")
    return rows, *edges_and_members(rows, s)


def edges_and_members(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    edges = adjacency.edges(rows, s.weights, s.min_embedding)
    return edges, adjacency.islands(rows, edges, s.edge_threshold)


def extract(images: DataFrame, model: models.Model) -> DataFrame:
    """source, page_number, extracted, vlm_seconds."""
    return models.extract(images.select(*PAGE, "image"), model).drop("image", "error").withColumnRenamed("seconds", "vlm_seconds")


def run(
    pages: DataFrame, images: DataFrame, classifier: models.Model, verifier: models.Model, extractor: models.Model, embedder: models.Model,
    scratch: str, settings: Settings = Settings(),
) -> Result:
    """``pages``: source, page_number, text. ``images``: source, page_number, image. ``scratch``: a folder that all workers share."""
    pages = written(pages.select(*PAGE, "text"), scratch, "pages")
    if not (wrong := coverage.repeated(pages)).isEmpty():
        raise ValueError(f"a page appears more than once: {wrong.orderBy(*PAGE).first()}")
    if not (wrong := coverage.coverage(pages, images)).isEmpty():
        raise ValueError(f"images and texts are not of the same pages: {wrong.orderBy(*PAGE).limit(5).collect()}")
    reviewed = written(verify(written(classify(pages, classifier, settings), scratch, "classified"), verifier, settings), scratch, "reviewed")
    extracted = written(extract(images, extractor), scratch, "extracted")
    checks = written(check(extracted, pages, settings), scratch, "checks")
    vectors = written(models.embed(pages.where(has_text(F.col("text"))), embedder).drop("text"), scratch, "vectors")
    numbers = extracted.select(*PAGE, printed_number(F.col("extracted.page_number")).alias("printed_number"))
    rows, edges, members = match(pages, vectors, reviewed, numbers, settings)
    labels = review.page_labels(reviewed.join(fields.page_flags(checks), PAGE))
    entered = fields.entries(checks)
    address = F.col("field") == "property_address"
    clustered = fields.cluster_exact(entered.where(~address)).unionByName(fields.cluster_addresses(entered.where(address)))
    return Result(reviewed, checks, edges, members, vectors, extracted, labels, adjacency.documents(rows, members, labels), fields.loan_fields(clustered, pages))
