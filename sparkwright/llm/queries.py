"""Registered queries of the training-data operators: each reads its whole table and returns the full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkwright.llm import bagminhash, credentials, decontaminate, langid, lm_mixing, mixture, packing, phrases, pii_anchors, ring_shards, simhash, trie_tokens, whitening


def _documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*cols)


def op1_lm_scoring(spark, sf_dir):
    return lm_mixing.score_documents(_documents(spark, sf_dir, "doc_id", "text"))


def op2_secrets(spark, sf_dir):
    return credentials.scan(_documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])


def op3_token_counts(spark, sf_dir):
    return trie_tokens.count_tokens(_documents(spark, sf_dir, "doc_id", "text"))


def op4_decontamination(spark, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.matches(_documents(spark, sf_dir, "doc_id", "text"), bench)


def op5_near_duplicates(spark, sf_dir):
    return bagminhash.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"))


def op6_pii(spark, sf_dir):
    return pii_anchors.scan(_documents(spark, sf_dir, "doc_id", "text"))


def op7_sharding(spark, sf_dir):
    """Law ``rows``: ring capacities make the shards' row counts differ by at most one."""
    docs = _documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return ring_shards.assign(docs, 24, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_mixing(spark, sf_dir):
    return mixture.taken_words(_documents(spark, sf_dir, "doc_id", "source", "text"))


def op9_fingerprints(spark, sf_dir):
    return simhash.edited_pairs(_documents(spark, sf_dir, "doc_id", "text"))


def op10_language(spark, sf_dir):
    return langid.identify(_documents(spark, sf_dir, "doc_id", "text", "lang"))


def op11_whitening(spark, sf_dir):
    return whitening.components_of_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_packing(spark, sf_dir):
    return packing.digests(packing.pack(_documents(spark, sf_dir, "doc_id", "source", "text")))


def op13_phrases(spark, sf_dir):
    return phrases.collocations(_documents(spark, sf_dir, "text", "lang"))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_secrets, op3_token_counts, op4_decontamination, op5_near_duplicates, op6_pii, op7_sharding, op8_mixing,
    op9_fingerprints, op10_language, op11_whitening, op12_packing, op13_phrases)}
SQL: dict[str, str] = {"op13_phrases": phrases.SQL}
