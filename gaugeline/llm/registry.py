"""The queries of the operators of this subpackage and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    hosts, importance, language_id, merkle, mixing, near_dedup, packing, quality, shards, syncmers, token_files, toxicity, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets are the documents labelled as good."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return importance.resample(table(spark, sf_dir, "documents"), good)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(table(spark, sf_dir, "documents"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"), size=3, percent=85)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the quality label of the same number."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return hosts.judge(table(spark, sf_dir, "pages"), outcomes)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op11_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_report(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_importance_resampling": op2_importance_resampling,
    "op3_source_mix": op3_source_mix,
    "op4_best_two_fit": op4_best_two_fit,
    "op5_orc_tokens": op5_orc_tokens,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_syncmer_fingerprints": op9_syncmer_fingerprints,
    "op10_quality_rules": op10_quality_rules,
    "op11_rendezvous_shards": op11_rendezvous_shards,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE = {
    "op3_source_mix": mixing.SQL,
    "op6_minhash_dedup": near_dedup.SQL,
    "op7_url_filter": hosts.SQL,
    "op10_quality_rules": quality.SQL,
    "op11_rendezvous_shards": shards.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
