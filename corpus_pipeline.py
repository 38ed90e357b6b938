"""A corpus pipeline over ``documents``, part of the subpackage ``llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept.  The first four return the columns of ``documents``; the
last adds what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import credentials, jaccard, latent, linequality, mixing
from sedimenta.llm.store import Store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    return linequality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the smallest id stays."""
    return jaccard.keep_one(docs, k=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an item of the benchmark go."""
    return latent.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are replaced by a mark; no document goes."""
    return credentials.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken up to the target of their source."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secrets", secrets), ("mixing_sources", mixing_sources)]

# The classifier and the latent retrieval have no SQL form; the pipeline is
# tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir))
    return docs
