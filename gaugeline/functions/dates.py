"""Date expressions and the calendar generator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv


def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def load_year(day: Column) -> Column:
    """Year a load run is for: before July it is still the previous year."""
    return F.when(F.month(day) < 7, F.year(day) - 1).otherwise(F.year(day))


def is_quarter_end_month(day: Column) -> Column:
    return F.month(day).isin(3, 6, 9, 12)


def calendar_columns(day: Column) -> list[Column]:
    """The columns of one calendar day; weeks start on Sunday = 1."""
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).cast("long").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_vietnam_holiday"),
        F.year(day).cast("long").alias("fiscal_year_vn"),
    ]


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of each bounds row."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def generate_calendar(
    spark: SparkSession, start: str = fv.CALENDAR_START, end: str = fv.CALENDAR_END
) -> DataFrame:
    """Parameterised calendar table; its row count follows from the two dates."""
    span = spark.range(1).select(
        F.lit(dt.date.fromisoformat(start)).alias("first_day"),
        F.lit(dt.date.fromisoformat(end)).alias("last_day"),
    )
    return calendar_between(span)


def register_calendar(spark: SparkSession) -> None:
    """The calendar as a table function for SQL: ``FROM years, LATERAL calendar(first_day, last_day)``.

    Its body is SQL, so days are made within Spark, one row of bounds in a task; many rows of bounds run side by side.
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calendar(first_day DATE, last_day DATE)
        RETURNS TABLE (date_key INT, full_date DATE, year BIGINT, quarter BIGINT, month BIGINT, month_name STRING,
                       day_of_week BIGINT, is_weekend BOOLEAN, is_vietnam_holiday BOOLEAN, fiscal_year_vn BIGINT)
        RETURN SELECT cast(date_format(day, 'yyyyMMdd') AS INT), day, cast(year(day) AS BIGINT),
                      cast(quarter(day) AS BIGINT), cast(month(day) AS BIGINT), date_format(day, 'MMMM'),
                      cast(dayofweek(day) AS BIGINT), dayofweek(day) IN (1, 7), false, cast(year(day) AS BIGINT)
               FROM explode(sequence(first_day, last_day)) AS t(day)""")
