"""Data checks. A check is a DataFrame of its violating rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.operators.gold import Gold


class ChecksFailed(RuntimeError):
    """Publishing was refused because a check found violations."""


def null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Number of nulls of each column, all columns counted in one pass."""
    return counts_as_rows(df.agg(*[
        F.count_if(F.col(c).isNull()).alias(f"not_null:{table}.{c}") for c in columns]))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; keys with a null are ignored."""
    complete = df
    for key in keys:
        complete = complete.filter(F.col(key).isNotNull())
    return complete.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted list with their row counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key is missing in the parent."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def out_of_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows whose value lies outside the closed range [low, high]."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.filter(bad)


def non_positive(df: DataFrame, keyed: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Rows at or below zero among those whose key is in ``keyed``."""
    return df.filter(F.col(value) <= 0).join(keyed.select(key).distinct(), key, "left_semi")


def future_rows(
    facts: DataFrame, dates: DataFrame, as_of: dt.date | Column | None = None
) -> DataFrame:
    """Facts dated after ``as_of`` (today unless given)."""
    limit = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    late = dates.filter(F.col("full_date") > limit).select("date_key", "full_date")
    return facts.join(late, "date_key")


def violations(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def counts_as_rows(counts: DataFrame) -> DataFrame:
    """One row of counts as rows (check, violations), named by the columns."""
    named = F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("violations")) for c in counts.columns])
    return counts.select(F.inline(named))


def fact_checks(gold: Gold, as_of: dt.date | None, gdp_codes: Sequence[str]) -> DataFrame:
    """All checks on the fact table, counted in one pass over it.

    The keys of the dimensions are joined once each, and every check is a count
    over the joined rows.
    """
    limit = F.current_date() if as_of is None else F.lit(as_of)
    dims = [
        ("indicator_key", gold.dim_indicators, F.max(F.col("indicator_code").isin(*gdp_codes)).alias("_is_gdp")),
        ("country_key", gold.dim_countries, F.lit(True).alias("_has_country")),
        ("date_key", gold.dim_dates, F.max(F.col("full_date") > limit).alias("_is_late")),
    ]
    rows = gold.fact.select("indicator_key", "country_key", "date_key", "value")
    for key, dim, flag in dims:
        known = dim.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(flag)
        rows = rows.join(known, F.col(key) == F.col(f"_{key}"), "left")
    columns = ["indicator_key", "country_key", "date_key", "value"]
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null:fact.{c}") for c in columns]
    counts += [
        F.count_if(F.col(key).isNotNull() & F.col(f"_{key}").isNull()).alias(f"relationship:fact.{key}")
        for key, _, _ in dims]
    counts += [
        F.count_if((F.col("value") <= 0) & F.col("_is_gdp")).alias("gdp_positive"),
        F.count_if(F.col("_is_late")).alias("no_future_dates"),
    ]
    return counts_as_rows(rows.agg(*counts))


def gold_checks(
    gold: Gold,
    as_of: dt.date | None = None,
    gdp_codes: Sequence[str] = fv.GDP_LEVEL_CODES,
    categories: Sequence[str] = fv.CATEGORIES,
    frequencies: Sequence[str] = fv.FREQUENCIES,
) -> DataFrame:
    """All checks on the star schema: one row per check with its violation count."""
    countries, indicators, dates = gold.dim_countries, gold.dim_indicators, gold.dim_dates
    parts = [
        fact_checks(gold, as_of, gdp_codes),
        null_counts(countries, ["country_key", "country_code"], "dim_countries"),
        null_counts(indicators, ["indicator_key", "indicator_code"], "dim_indicators"),
        null_counts(dates, ["date_key", "full_date"], "dim_dates"),
        violations("unique:dim_countries.country_key", duplicates(countries, ["country_key"])),
        violations("unique:dim_countries.country_code", duplicates(countries, ["country_code"])),
        violations("unique:dim_indicators.indicator_key", duplicates(indicators, ["indicator_key"])),
        violations("unique:dim_dates.date_key", duplicates(dates, ["date_key"])),
        violations("unique:dim_dates.full_date", duplicates(dates, ["full_date"])),
        violations("accepted:dim_countries.is_asean", unexpected_values(countries, "is_asean", [True, False])),
        violations("accepted:dim_countries.is_primary", unexpected_values(countries, "is_primary", [True, False])),
        violations("accepted:dim_indicators.category", unexpected_values(indicators, "category", categories)),
        violations("accepted:dim_indicators.frequency", unexpected_values(indicators, "frequency", frequencies)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def staging_checks(observations: DataFrame, documents: DataFrame | None = None,
                   chunks: DataFrame | None = None) -> DataFrame:
    """Checks on the cleaned layer."""
    result = null_counts(observations, ["country_code", "indicator_code", "year", "value"], "observations")
    if documents is not None:
        result = result.unionByName(null_counts(documents, ["doc_id"], "documents")).unionByName(
            violations("unique:documents.doc_id", duplicates(documents, ["doc_id"])))
    if chunks is not None:
        result = result.unionByName(null_counts(chunks, ["chunk_id", "doc_id", "text"], "chunks")).unionByName(
            violations("unique:chunks.chunk_id", duplicates(chunks, ["chunk_id"])))
    return result


def indicator_range_checks(
    named: DataFrame, rules: Sequence[tuple[str, float | None, float | None]] = tuple(fv.INDICATOR_RANGES),
) -> DataFrame:
    """Values outside the plausible range of their indicator, by code; all rules are counted in one pass."""
    bad = []
    for code, low, high in rules:
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col("value") < low)
        if high is not None:
            outside = outside | (F.col("value") > high)
        bad.append(F.count_if((F.col("indicator_code") == code) & outside).alias(f"range:{code}"))
    return counts_as_rows(named.agg(*bad))


def require_passed(checks: DataFrame) -> None:
    """Raise with the names of the failed checks, if any."""
    failed = checks.filter(F.col("violations") > 0).orderBy("check").collect()
    if failed:
        raise ChecksFailed(", ".join(f"{r['check']}={r['violations']}" for r in failed))
