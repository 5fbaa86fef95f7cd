"""The corpus pipeline: documents in, token ids out. Each stage takes what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.bpe import encode
from quire.llm.common import documents, save
from quire.llm.line_dedup import deduped_documents
from quire.llm.mixing import mixture
from quire.llm.simhash import keep_one_per_group
from quire.llm.toxicity import reject_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; fitted on the labels of ``sf_dir`` over the documents given."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs, single lines of any length included; documents of which nothing is left go."""
    return deduped_documents(docs, min_words=1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each SimHash group."""
    return keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as much of them, as the mix to target weights takes."""
    return mixture(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that they decode to."""
    return encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing_sources", mix_sources),
    ("bpe", tokenize),
]

#: Compression distances and the tokenizer have no SQL form; tests/llm/test_pipeline.py checks the run by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
