"""Queries over the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import band_join, decontaminate, html_extract, license_scan, lm_scoring, oracles, packing, simhash_dedup, substring_dedup, suffix_dedup, toxicity, url_filter, vector_dedup, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_groups(table(spark, sf_dir, "embeddings"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scoring.lm_scores(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", F.round("log10_score", 4).alias("log10_score"), F.round("mean_log10", 4).alias("mean_log10"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: the items found in each, best window first seen."""
    hits = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "start_word", "n_words", "hamming", "similarity")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text and the removed spans of the original."""
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "text", F.size("removed").alias("n_spans"), gone.alias("n_removed"), "removed")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.flag_toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components' values of every usable vector; an exact distance beyond 64 bits is null."""
    vectors = table(spark, sf_dir, "embeddings")
    out = whitening.whiten(vectors, whitening.fit_whitening(vectors))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_numeric_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with its first ten lines near its price, and counts over all of them."""
    return band_join.near_prices(table(spark, sf_dir, "items"), table(spark, sf_dir, "sale_lines"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the bytes that repeat elsewhere counted and what is left of it as a digest."""
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


ALL = (
    op1_embedding_near_dedup,
    op2_lm_scoring,
    op3_decontamination,
    op4_url_filter,
    op5_best_fit_packing,
    op6_substring_dedup,
    op7_html_extraction,
    op8_toxicity,
    op9_simhash_near_dedup,
    op10_license_scan,
    op11_embedding_whitening,
    op12_numeric_band_join,
    op13_suffix_array_dedup,
    pipeline,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that it can express; the others are tested against brute force."""
    return oracles.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
