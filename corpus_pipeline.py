"""The corpus pipeline: five stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import language_id, mixing, near_dedup, packing, quality
from gaugeline.session import new_table_path, table_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a rule rejects (null and empty texts among them); an empty table stays empty."""
    return quality.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language is not sure; rows that repeat and extra columns stay as they are."""
    return language_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five words, similarity 0.8. Rows with a null doc_id all stay."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it; a null source is a source, and an empty table stays empty."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the sequences; a null text is empty, and rows that repeat are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", pack_sequences),
]

# Language scores and tokens cannot be expressed in SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each result is written as Parquet and read again.

    What a stage stores on the way is removed when its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_path(spark, f"pipeline-{name}")
        with table_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
