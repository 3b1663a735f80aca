"""Star schema: country, indicator and date dimensions and the fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.dates import year_end, year_start
from gaugeline.operators.scale import number_rows
from gaugeline.schemas import SEED_COUNTRIES, SEED_INDICATORS
from gaugeline.session import materialize


@dataclass
class Gold:
    """The four published tables."""

    dim_countries: DataFrame
    dim_indicators: DataFrame
    dim_dates: DataFrame
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_countries": self.dim_countries,
            "dim_indicators": self.dim_indicators,
            "dim_dates": self.dim_dates,
            "fact_economic_indicators": self.fact,
        }


def seed_countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.SEED_COUNTRY_ROWS, SEED_COUNTRIES)


def seed_indicators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.SEED_INDICATOR_ROWS, SEED_INDICATORS)


def enrich_countries(seed: DataFrame, silver: DataFrame) -> DataFrame:
    """Seed rows with a missing name filled in from the observed names.

    A code observed under two names yields two rows, one per name.
    """
    observed = silver.select("country_code", F.col("country_name").alias("_observed")).distinct()
    return seed.join(observed, "country_code", "left").select(
        "country_code",
        F.coalesce("country_name", "_observed").alias("country_name"),
        "region",
        "income_group",
        F.col("is_asean").cast("boolean").alias("is_asean"),
        F.col("is_primary").cast("boolean").alias("is_primary"),
    )


def dim_countries(seed: DataFrame, silver: DataFrame) -> DataFrame:
    """Country dimension with a surrogate key in code order, then in name order.

    The numbered input is written out first: numbering reads it more than
    once, and it hangs on a scan of all observations.
    """
    enriched = materialize(enrich_countries(seed, silver), "countries")
    return number_rows(enriched, "country_code", "country_key", ("country_name",)).select(
        F.col("country_key").cast("long").alias("country_key"),
        "country_code", "country_name", "region", "income_group", "is_asean", "is_primary",
    )


def dim_indicators(seed: DataFrame, source_system: str = fv.SOURCE_SYSTEM) -> DataFrame:
    """Indicator dimension with a surrogate key in code order."""
    return number_rows(seed, "indicator_code", "indicator_key").select(
        F.col("indicator_key").cast("long").alias("indicator_key"),
        "indicator_code", "indicator_name",
        F.lit(source_system).alias("source_system"),
        "category", "unit", "frequency", "description",
    )


def load_facts(
    silver: DataFrame,
    countries: DataFrame,
    indicators: DataFrame,
    dates: DataFrame,
    source_system: str = fv.SOURCE_SYSTEM,
) -> DataFrame:
    """Observations keyed by the three dimensions; unmatched rows are dropped.

    The dimensions are tables, so Spark knows their sizes and broadcasts those
    under its threshold; the observations are then never shuffled here.
    """
    return fact_columns(keyed_facts(silver, countries, indicators, dates, source_system), source_system)


def keyed_facts(
    silver: DataFrame, countries: DataFrame, indicators: DataFrame, dates: DataFrame, source_system: str = fv.SOURCE_SYSTEM
) -> DataFrame:
    """(indicator_key, country_key, date_key, year, value, loaded_at): what of a fact is not made of the rest."""
    start: Column = year_start(F.col("year"))
    own = indicators.filter(F.col("source_system") == source_system)
    return (
        silver.select("country_code", "indicator_code", "year", "value", "ingested_at",
                      start.alias("full_date"))
        .join(countries.select("country_code", "country_key"), "country_code")
        .join(own.select("indicator_code", "indicator_key"), "indicator_code")
        .join(dates.select("full_date", "date_key"), "full_date")
        .select("indicator_key", "country_key", "date_key", "year", "value", F.col("ingested_at").alias("loaded_at"))
    )


def fact_columns(keyed: DataFrame, source_system: str = fv.SOURCE_SYSTEM) -> DataFrame:
    """The columns of the fact table, from ``keyed_facts``."""
    return keyed.select(
        "indicator_key", "country_key", "date_key",
        year_start(F.col("year")).alias("period_start"),
        year_end(F.col("year")).alias("period_end"),
        "value",
        F.lit(source_system).alias("source_system"),
        "loaded_at",
    )


def build_gold(
    silver: DataFrame,
    country_seed: DataFrame,
    indicator_seed: DataFrame,
    calendar: DataFrame,
    source_system: str = fv.SOURCE_SYSTEM,
) -> Gold:
    """Materialise the dimensions, then the facts that refer to them.

    Facts are stored by country: a query for one country reads its partition
    only, found at run time from the filtered dimension. Adaptive execution
    sizes the write tasks, splitting a country that holds most of the facts.
    Only what cannot be made of the rest is moved for that.
    """
    countries = materialize(dim_countries(country_seed, silver), "dim_countries")
    indicators = materialize(dim_indicators(indicator_seed, source_system), "dim_indicators")
    dates = materialize(calendar, "dim_dates")
    facts = keyed_facts(silver, countries, indicators, dates, source_system)
    fact = materialize(fact_columns(facts.hint("rebalance", "country_key"), source_system), "fact", ("country_key",))
    return Gold(countries, indicators, dates, fact)
