"""Cleaning of raw observations, documents and chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.scale import latest_rows
from gaugeline.schemas import DOCUMENT_TEXT_COLUMNS


def clean_observations(
    bronze: DataFrame, tie_break: Sequence[Column] = (), raw_keys: bool = False
) -> DataFrame:
    """Trim and type observations, drop null values, keep the latest of each key.

    The key is (country, indicator, year) after cleaning. ``raw_keys=True``
    compares country codes as they arrived, so differently written codes of
    one country both survive. ``tie_break`` orders rows ingested at the same
    time; without it such ties are broken by value.
    """
    typed = bronze.filter(F.col("value").isNotNull()).select(
        F.upper(F.trim("country_code")).alias("country_code"),
        F.trim("country_name").alias("country_name"),
        F.trim("indicator_code").alias("indicator_code"),
        F.trim("indicator_name").alias("indicator_name"),
        F.col("year").cast("int").alias("year"),
        F.col("value").cast("double").alias("value"),
        F.col("_ingested_at").alias("ingested_at"),
        F.col("country_code").alias("_raw_country"),
        F.col("indicator_code").alias("_raw_indicator"),
        *[c.alias(f"_tie{i}") for i, c in enumerate(tie_break)],
    )
    ties = [F.col(f"_tie{i}").desc() for i in range(len(tie_break))] or [F.col("value").desc()]
    keys = ["_raw_country", "_raw_indicator"] if raw_keys else ["country_code", "indicator_code"]
    latest = latest_rows(typed, [*keys, "year"], [F.col("ingested_at").desc(), *ties])
    return latest.select(
        "country_code", "country_name", "indicator_code", "indicator_name",
        "year", "value", "ingested_at",
    )


def clean_documents(bronze: DataFrame) -> DataFrame:
    """Trim the text columns of document metadata; rows without an id go."""
    return bronze.filter(F.col("doc_id").isNotNull()).select(
        *[F.trim(name).alias(name) for name in DOCUMENT_TEXT_COLUMNS],
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_source").alias("source"),
    )


def clean_chunks(bronze: DataFrame) -> DataFrame:
    """Pass chunks through, dropping empty ones."""
    return bronze.filter(F.length("text") > 0).select(
        "chunk_id", "chunk_index", "text", "doc_id", "title", "display_date",
        "doc_type", "countries", "topics", "language",
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_source").alias("source"),
    )
