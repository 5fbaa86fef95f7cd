"""The driver's tables seen as document pages.

A source is a ``documents.source``; its pages are its documents by doc_id. A page's vector is the embedding of the
same number, its label probabilities a softmax over six of the vector's components (six others for the second opinion), and its
printed number is known where the document is labelled. Documents without an embedding are pages without a vector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scores import CATEGORIES
from quire.operators.prefix import numbered

# Limits that suit vectors as far apart as these.
EDGE_THRESHOLD, MIN_EMBEDDING = 0.35, 0.0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shares(vector: Column, first: int) -> Column:
    parts = [F.exp(8 * F.get(vector, F.lit(i)).cast("double")) for i in range(first, first + len(CATEGORIES))]
    total = sum(parts[1:], parts[0])
    return F.when(vector.isNotNull(), F.create_map(*[x for c, p in zip(CATEGORIES, parts, strict=True) for x in (F.lit(c), p / total)]))


def most_probable(probabilities: Column) -> Column:
    """The key of the highest value, ties to the first key."""
    best = F.array_max(F.map_values(probabilities))
    return F.get(F.filter(F.map_keys(probabilities), lambda k: F.try_element_at(probabilities, k) == best), F.lit(0))


def numbered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("source", "doc_id", "lang", "n_chars", "text")
    return numbered(docs, ["source"], "doc_id", "page_number")


def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, doc_id, page_number, without texts."""
    return numbered(read(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], "doc_id", "page_number")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, page_number, doc_id, vector, category, confidence, printed_number."""
    docs = numbered(read(spark, sf_dir, "documents").select("source", "doc_id", "lang"), ["source"], "doc_id", "page_number")
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    labelled = read(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("_labelled", F.lit(True))
    out = docs.join(vectors, "doc_id", "left").join(labelled, "doc_id", "left")
    confidence = F.when(F.col("vector").isNotNull(), F.array_max(F.map_values(_shares(F.col("vector"), 0))))
    printed = F.when(F.col("_labelled"), F.col("page_number"))
    return out.select("source", "page_number", "doc_id", "vector", F.col("lang").alias("category"), confidence.alias("confidence"), printed.alias("printed_number"))


def opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, page_number, category, confidence, probabilities, second: both opinions on every page with a vector."""
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    out = page_numbers(spark, sf_dir).join(vectors, "doc_id")
    out = out.withColumn("probabilities", _shares(F.col("vector"), 0)).withColumn("other", _shares(F.col("vector"), 6))
    out = out.withColumn("category", most_probable(F.col("probabilities"))).withColumn("second", most_probable(F.col("other")))
    return out.withColumn("confidence", F.array_max(F.map_values("probabilities"))).select(
        "source", "page_number", "doc_id", "category", "confidence", "probabilities", "second"
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field values: a nation is a source, its customers and suppliers are pages; (source, page_number, field, value, similarity, needs_review)."""
    customers = read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("source"), F.col("c_custkey").alias("page_number"), "c_name", "c_mktsegment")
    name = customers.select("source", "page_number", F.lit("borrower_name").alias("field"), F.initcap(F.lower("c_mktsegment")).alias("value"))
    mixed = F.when(F.col("page_number") % 3 == 0, F.upper("c_mktsegment")).otherwise(F.lower("c_mktsegment"))
    number = customers.select("source", "page_number", F.lit("loan_number").alias("field"), F.concat(mixed, F.lit("-"), (F.col("page_number") % 4).cast("string")).alias("value"))
    out = name.unionByName(number)
    return out.withColumn("similarity", F.when(F.col("page_number") % 5 != 0, (F.col("page_number") % 8) / 8.0)).withColumn("needs_review", F.col("page_number") % 11 == 0)
