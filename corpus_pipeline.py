"""Corpus pipeline: language filter, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
The stages hold signatures, sampled models and permutations that SQL cannot express, so there is no ORACLE_SQL;
tests compare them with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwright.llm import bagminhash, decontaminate, langid, mixture, ring_shards
from sparkwright.session import stored

SHARDS = 24


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters, or of no clear language, go."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one of least doc_id."""
    return bagminhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are taken none, once or twice, at block borders in part."""
    return mixture.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets a shard and a slot in it."""
    return ring_shards.assign(docs, SHARDS, ["doc_id", "text"])


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing),
          ("sharding", sharding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; every stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
