"""Queries over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.gold import Gold
from gaugeline.operators.scale import top_rows


class NotFound(LookupError):
    """A query that must return rows returned none."""


def list_countries(gold: Gold) -> DataFrame:
    return gold.dim_countries.select(
        "country_code", "country_name", "region", "income_group"
    ).orderBy("country_name")


def list_indicators(gold: Gold) -> DataFrame:
    return gold.dim_indicators.select(
        "indicator_code", "indicator_name", "category", "unit", "description"
    ).orderBy("indicator_name")


def country(gold: Gold, country_code: str) -> DataFrame:
    return gold.dim_countries.filter(F.col("country_code") == country_code.upper())


def star(gold: Gold) -> DataFrame:
    """Facts with the attributes of all three dimensions.

    Filters put on the result reach the dimension scans, and column pruning
    drops the attributes a query does not use.
    """
    indicators = gold.dim_indicators.withColumnRenamed("source_system", "_indicator_source")
    return (
        gold.fact.join(indicators, "indicator_key")
        .join(gold.dim_countries, "country_key")
        .join(gold.dim_dates.select("date_key", "full_date", "year"), "date_key")
    )


INDICATOR_COLUMNS = [
    "indicator_code", "indicator_name", "country_code", "year", "value", "category",
    "source_system",
]


def query_indicators(
    gold: Gold,
    country_code: str | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    indicator_codes: list[str] | None = None,
    category: str | None = None,
    source_system: str | None = None,
) -> DataFrame:
    """Facts of a country, newest first per indicator.

    Year bounds are closed and apply only when given and not 0.
    """
    rows = star(gold)
    if country_code:
        rows = rows.filter(F.col("country_code") == country_code.upper())
    if start_year:
        rows = rows.filter(F.col("year") >= start_year)
    if end_year:
        rows = rows.filter(F.col("year") <= end_year)
    if indicator_codes:
        rows = rows.filter(F.col("indicator_code").isin(indicator_codes))
    if category:
        rows = rows.filter(F.col("category") == category)
    if source_system and source_system.lower() != "all":
        rows = rows.filter(F.col("source_system") == source_system)
    return rows.select(*INDICATOR_COLUMNS).orderBy("indicator_code", F.col("year").desc())


def query_series(gold: Gold, indicator_code: str, country_code: str | None = "all") -> DataFrame:
    """Facts of one indicator, for one country or all, newest first."""
    rows = star(gold).filter(F.col("indicator_code") == indicator_code)
    if country_code and country_code.lower() != "all":
        rows = rows.filter(F.col("country_code") == country_code.upper())
    return rows.select(*INDICATOR_COLUMNS).orderBy("country_code", F.col("year").desc())


def require_rows(df: DataFrame, message: str = "Indicator or data not found") -> DataFrame:
    """Pass ``df`` on, or raise when it is empty."""
    if df.isEmpty():
        raise NotFound(message)
    return df


def series_by_names(gold: Gold, country_name: str, indicator_name: str) -> DataFrame:
    """Dated values of an indicator and country given by name, oldest first."""
    return (
        star(gold)
        .filter((F.col("country_name") == country_name)
                & (F.col("indicator_name") == indicator_name))
        .select("country_name", "indicator_name", "full_date", "value")
        .orderBy("full_date")
    )


def named_facts(gold: Gold) -> DataFrame:
    """Facts with names and unit; the year comes from ``period_start``."""
    return (
        gold.fact.join(gold.dim_countries, "country_key")
        .join(gold.dim_indicators.drop("source_system"), "indicator_key")
        .select(
            "country_code", "country_name", "indicator_code", "indicator_name", "unit",
            F.year("period_start").alias("year"), "period_start", "value",
        )
    )


def latest_facts(gold: Gold) -> DataFrame:
    """Most recent fact of every (country, indicator)."""
    return top_rows(
        named_facts(gold), ["country_code", "indicator_code"],
        [F.col("period_start").desc(), F.col("value").desc()], 1, "_rank",
    ).drop("_rank")


def fact_value(
    gold: Gold, country_code: str, indicator_code: str, year: int | None = None
) -> DataFrame:
    """One fact: of the given year, or else the latest."""
    rows = named_facts(gold).filter(
        (F.col("country_code") == country_code) & (F.col("indicator_code") == indicator_code)
    )
    if year is not None:
        # The same as asking for the year of period_start, but as a range the
        # scan can use.
        rows = rows.filter(F.col("period_start").between(dt.date(year, 1, 1), dt.date(year, 12, 31)))
    return rows.orderBy(F.col("period_start").desc(), F.col("value").desc()).limit(1)


def timeseries(gold: Gold, country_code: str, indicator_code: str) -> DataFrame:
    """All years of one indicator and country, oldest first."""
    return (
        named_facts(gold)
        .filter((F.col("country_code") == country_code)
                & (F.col("indicator_code") == indicator_code))
        .orderBy("period_start")
    )


def page(df: DataFrame, order: list, page_no: int, page_size: int) -> DataFrame:
    """One page of ``df`` with the total row count in ``total``.

    Pages are limits of an ordering, so a task keeps at most the rows up to the
    page's end; no window over the whole input is needed.
    """
    total = df.count()
    rows = df.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)
    return rows.withColumn("total", F.lit(total).cast("long"))


def source_conflicts(observations: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Values of one indicator, country and year that differ between sources.

    The difference is relative to the larger magnitude of the two values. A
    source system has one value per key; should it have several, the largest
    counts, so that a key has no more values than there are sources. Keys are
    grouped once, and pairs are formed within the row of a key.
    """
    keys = ["country_code", "indicator_code", "year"]
    one_each = observations.groupBy(*keys, "source_system").agg(F.max("value").alias("value"))
    listed = one_each.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("source_system", "value"))).alias("found"))
    several = listed.filter(F.size("found") > 1).select(
        *keys, "found", F.posexplode("found").alias("_n", "a"))
    later = F.slice("found", F.col("_n") + 2, F.size("found"))
    larger = F.greatest(F.abs("value_a"), F.abs("value_b"))
    return (
        several.select(*keys, "a", F.explode(later).alias("b"))
        .select(
            *keys, F.col("a.source_system").alias("source_a"), F.col("a.value").alias("value_a"),
            F.col("b.source_system").alias("source_b"), F.col("b.value").alias("value_b"))
        .withColumn("difference", F.try_divide(F.abs(F.col("value_a") - F.col("value_b")), larger))
        .filter(F.col("difference") > tolerance)
    )


def authoritative(
    observations: DataFrame, home_country: dict[str, str], source_system: str | None = None
) -> DataFrame:
    """One row per key: a national source wins in its own country, else the global one.

    ``home_country`` maps a national source to its country code. With
    ``source_system='all'`` every row is returned.
    """
    if source_system == "all":
        return observations
    if source_system:
        return observations.filter(F.col("source_system") == source_system)
    home = F.lit(None).cast("string")
    for source, code in home_country.items():
        home = F.when(F.col("source_system") == source, F.lit(code)).otherwise(home)
    priority = (
        F.when(home == F.col("country_code"), 0).when(home.isNull(), 1).otherwise(2)
    )
    ranked = observations.withColumn("_priority", priority)
    return top_rows(
        ranked, ["country_code", "indicator_code", "year"],
        [F.col("_priority"), F.col("source_system")], 1, "_rank",
    ).drop("_rank", "_priority")
