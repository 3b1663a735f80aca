"""From raw observations to published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from gaugeline.functions.dates import generate_calendar
from gaugeline.operators.gold import Gold, build_gold, seed_countries, seed_indicators
from gaugeline.operators.quality import gold_checks, staging_checks
from gaugeline.operators.silver import clean_observations
from gaugeline.session import materialize
from gaugeline.sources.sinks import publish


def build_star(
    bronze: DataFrame,
    country_seed: DataFrame | None = None,
    indicator_seed: DataFrame | None = None,
    calendar: DataFrame | None = None,
    tie_break: tuple[Column, ...] = (),
) -> tuple[DataFrame, Gold]:
    """Cleaned observations and the star schema over them.

    Observations are cleaned once and stored; the dimensions and the facts
    both read that table.
    """
    spark = bronze.sparkSession
    silver = materialize(clean_observations(bronze, tie_break), "silver")
    gold = build_gold(
        silver,
        country_seed if country_seed is not None else seed_countries(spark),
        indicator_seed if indicator_seed is not None else seed_indicators(spark),
        calendar if calendar is not None else generate_calendar(spark),
    )
    return silver, gold


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Make tables available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def run_batch(
    bronze: DataFrame,
    write: Callable[[DataFrame, str], None],
    as_of: dt.date | None = None,
    **seeds: DataFrame,
) -> Gold:
    """Clean, build, check and publish; nothing is published when a check fails."""
    silver, gold = build_star(bronze, **seeds)
    checks = staging_checks(silver).unionByName(gold_checks(gold, as_of))
    publish(gold.tables(), write, checks)
    return gold
