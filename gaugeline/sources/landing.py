"""Normalisers for landed API responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.text import (
    collapse_whitespace,
    first_long_value,
    join_list_or_scalar,
    or_empty,
)
from gaugeline.operators.scale import latest_rows
from gaugeline.schemas import DOCUMENT_PAGE, OBSERVATION_ENTRY


def normalise_observations(
    entries: DataFrame,
    country_names: DataFrame,
    indicator_names: DataFrame,
    body: str = "body",
    ingested_at: Column | None = None,
    source: str = fv.SOURCE_SYSTEM,
) -> DataFrame:
    """Typed observations from landed JSON entries.

    ``entries`` has one JSON entry per row in ``body``; the name tables have
    columns (code, name). Entries without a value are dropped and a code
    without a name is named by itself.
    """
    entry = F.from_json(body, OBSERVATION_ENTRY).alias("e")
    countries = country_names.select(F.col("code").alias("economy"), F.col("name").alias("_country"))
    series = indicator_names.select(F.col("code").alias("series"), F.col("name").alias("_series"))
    return (
        entries.select(entry)
        .select("e.*")
        .filter(F.col("value").isNotNull())
        .join(countries, "economy", "left")
        .join(series, "series", "left")
        .select(
            F.col("economy").alias("country_code"),
            F.coalesce("_country", "economy").alias("country_name"),
            F.col("series").alias("indicator_code"),
            F.coalesce("_series", "series").alias("indicator_name"),
            F.replace("time", F.lit("YR"), F.lit("")).cast("long").alias("year"),
            F.col("value").cast("double").alias("value"),
            (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
            F.lit(source).alias("_source"),
        )
    )


def document_entries(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of every landed result page, with its position.

    ``pages`` has columns (query_no, page, body) where body is a JSON page whose
    ``documents`` is a map from id to record.
    """
    page_body = F.from_json(body, DOCUMENT_PAGE)
    return (
        pages.select("query_no", "page", page_body["documents"].alias("documents"))
        .select("query_no", "page", F.posexplode(F.map_entries("documents")).alias("position", "entry"))
        .select("query_no", "page", "position", F.col("entry.key").alias("doc_id"), "entry.value.*")
    )


def normalise_documents(
    pages: DataFrame,
    body: str = "body",
    max_results: int | None = None,
    ingested_at: Column | None = None,
    source: str = fv.DOCUMENT_SOURCE,
) -> DataFrame:
    """Document metadata from landed search pages.

    A document found by several queries counts where it was seen first
    (query, page, position). All are kept, unless ``max_results`` asks for that
    many in the order they were found.
    """
    seen = [F.col("query_no"), F.col("page"), F.col("position")]
    entries = latest_rows(document_entries(pages, body), ["doc_id"], seen)
    if max_results is not None:
        entries = entries.orderBy(*seen).limit(max_results)
    display_date = F.coalesce(F.nullif("display_date", F.lit("")), F.col("docdt"), F.lit(""))
    return entries.select(
        "doc_id",
        collapse_whitespace(or_empty(F.col("display_title"))).alias("title"),
        first_long_value(F.col("abstracts")).alias("abstract"),
        display_date.alias("display_date"),
        or_empty(F.col("docty")).alias("doc_type"),
        or_empty(F.col("pdfurl")).alias("pdf_url"),
        join_list_or_scalar(F.col("count")).alias("countries"),
        collapse_whitespace(or_empty(F.col("topicv3"))).alias("topics"),
        or_empty(F.col("lang")).alias("language"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit(source).alias("_source"),
    )
