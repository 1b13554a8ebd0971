"""The corpus pipeline: documents in, packed training sequences out, one operator a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitemill.llm import decontaminate, packing, simhash_dedup, substring_dedup, toxicity
from sitemill.llm.common import boxed, cut, fresh, named, table

#: Documents that score this or more are rejected.
TOXIC = 0.5
#: Documents whose five-word shingles are so similar are near-duplicates.
SIMILARITY = 0.8
TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the factorization machine scores below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    whole = docs.select(boxed(docs, "doc"), named("text").alias("text"))
    return toxicity.toxicity_scores(whole, model).where(F.col("score") < TOXIC).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group by SimHash and five-word Jaccard: the one with the smallest id."""
    return simhash_dedup.keep_one(docs, similarity=SIMILARITY)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; passages that an earlier one has are cut out of its text."""
    spans = fresh(docs, "removed")
    out = substring_dedup.substring_dedup(docs, removed_col=spans).drop(spans)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: A trained model and 64-bit XXH64 fingerprints have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each materialised for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
