"""Reciprocal rank fusion of a lexical and a semantic hit list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.operators.scale import top_rows


def fuse(
    lexical: DataFrame, semantic: DataFrame, k: int = fv.RRF_K, top_k: int = fv.FUSED_SIZE
) -> DataFrame:
    """Sum of 1 / (k + rank) over every occurrence of an id, best first.

    ``lexical`` has (query_id, id, rank, properties), ``semantic`` also
    source_type; ranks start at 1. An id found by the lexical search is an
    Indicator with the properties given there; one found only by the semantic
    search takes type and properties from its first hit. Ties go to the larger
    id.
    """
    hits = lexical.select(
        "query_id", F.col("id").cast("string").alias("id"), "rank", F.lit(0).alias("list_no"),
        F.lit("Indicator").alias("type"), "properties",
    ).unionByName(semantic.select(
        "query_id", F.col("id").cast("string").alias("id"), "rank", F.lit(1).alias("list_no"),
        F.when(F.col("source_type") == "indicator", "Indicator").otherwise("Document").alias("type"),
        "properties",
    ))
    position = F.struct("list_no", "rank")
    scored = hits.groupBy("query_id", "id").agg(
        F.round(F.sum(1.0 / (k + F.col("rank"))), 12).alias("score"),
        F.min_by(F.struct("type", "properties"), position).alias("first"),
    )
    ranked = top_rows(scored, ["query_id"], [F.col("score").desc(), F.col("id").desc()], top_k)
    return ranked.select("query_id", "id", "first.type", "first.properties", "score", "rank")
