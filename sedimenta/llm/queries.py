"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sedimenta.llm import (
    alignment, credentials, htmltext, jaccard, latent, licences, linequality, merkle, mixing, multiindex,
    outliers, substring, unigram)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_components(_read(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op2_substring_dedup(spark, sf_dir):
    return substring.repeated_windows(_read(spark, sf_dir, "documents"), width=50)


def op3_secret_scans(spark, sf_dir):
    return credentials.secret_report(_read(spark, sf_dir, "documents"))


def op4_licence_scans(spark, sf_dir):
    return licences.licence_scan(_read(spark, sf_dir, "documents"))


def op5_html_extraction(spark, sf_dir):
    return htmltext.main_texts(_read(spark, sf_dir, "pages"))


def op6_token_counts(spark, sf_dir):
    return unigram.token_counts(_read(spark, sf_dir, "documents"))


def op7_source_mixing(spark, sf_dir):
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    return outliers.quality_rules(_read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark, sf_dir):
    return linequality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark, sf_dir):
    return latent.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(_read(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark, sf_dir):
    return multiindex.near_vectors(_read(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark, sf_dir):
    return alignment.alignment(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_substring_dedup, op3_secret_scans, op4_licence_scans, op5_html_extraction, op6_token_counts,
    op7_source_mixing, op8_quality_rules, op9_quality_classifier, op10_benchmark_decontamination, op11_merkle_manifest,
    op12_embedding_near_dedup, op13_cross_tokenizer_alignment)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {"op7_source_mixing": mixing.ORACLE, "op11_merkle_manifest": merkle.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
