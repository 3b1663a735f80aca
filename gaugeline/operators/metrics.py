"""Windowed event metrics.

Every function takes a batch or a streaming DataFrame; a stream must carry a
watermark on ``ts`` (see ``gaugeline.streaming.events``). All aggregates combine
in the map tasks first, so a busy key costs one row per task and window.
Rates are counts per second over tumbling windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv


def _window_columns(df: DataFrame) -> list[Column]:
    rest = [c for c in df.columns if c != "window"]
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            *[F.col(c) for c in rest]]


def flat(df: DataFrame) -> DataFrame:
    """Replace the window struct by its start and end."""
    return df.select(*_window_columns(df))


def rate(events: DataFrame, key: str = "event_type", window: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Events and events per second by window and key."""
    counted = events.groupBy(F.window("ts", window), key).agg(F.count("*").alias("n_events"))
    return flat(counted.withColumn("rate", F.col("n_events") / F.lit(float(seconds))))


def error_rate(events: DataFrame, is_error: Column, window: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Errors, all events and errors per second by window."""
    counted = events.groupBy(F.window("ts", window)).agg(
        F.count_if(is_error).alias("n_errors"), F.count("*").alias("n_events"))
    return flat(counted.withColumn("error_rate", F.col("n_errors") / F.lit(float(seconds))))


def total_count(events: DataFrame, key: str = "event_type") -> DataFrame:
    """Events so far by key."""
    return events.groupBy(key).agg(F.count("*").alias("n_events"))


def increase(events: DataFrame, key: str = "event_type", window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Events by key in every sliding window; the window is a multiple of the slide.

    In batch, events are counted by slide first, and the few counts rather than
    the events are repeated for the windows that overlap.
    """
    if events.isStreaming:
        return flat(events.groupBy(F.window("ts", window, slide), key).agg(F.count("*").alias("n_events")))
    by_slide = events.groupBy(F.window("ts", slide).alias("_slide"), key).agg(F.count("*").alias("_n"))
    return flat(by_slide.groupBy(F.window("_slide.start", window, slide), key).agg(
        F.sum("_n").alias("n_events")))


def rate_limit_violations(
    events: DataFrame, client: str, limit: int = fv.RATE_LIMIT_PER_MINUTE, window: str = "1 minute"
) -> DataFrame:
    """Clients with more than ``limit`` events in a window."""
    counted = events.groupBy(F.window("ts", window), client).agg(F.count("*").alias("n_events"))
    return flat(counted.filter(F.col("n_events") > limit))


def histogram_quantile(
    events: DataFrame, value: str, bounds: list[float], q: float = 0.95, window: str = "1 minute",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Quantile of a value by window, estimated from cumulative bucket counts.

    The value is interpolated linearly within the bucket that holds the wanted
    rank; the lowest bucket starts at 0, and ranks beyond the last bound give
    that bound. Only the counts are kept, whatever the number of events.
    """
    counts = [F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)]
    counted = events.groupBy(F.window("ts", window), *keys).agg(F.count("*").alias("n_events"), *counts)
    wanted = F.col("n_events") * F.lit(float(q))
    estimate = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, high = (0.0 if i == 0 else float(bounds[i - 1])), float(bounds[i])
        below = F.lit(0) if i == 0 else F.col(f"_le{i - 1}")
        inside = F.col(f"_le{i}") - below
        share = F.try_divide(wanted - below, inside)
        estimate = F.when(F.col(f"_le{i}") >= wanted, F.lit(low) + (high - low) * share).otherwise(estimate)
    named = counted.withColumn("quantile", estimate)
    return flat(named.select("window", *keys, "n_events", "quantile"))


def approximate_quantile(
    events: DataFrame, value: str, q: float = 0.95, window: str = "1 minute", accuracy: int = 10_000
) -> DataFrame:
    """Quantile of a value by window from a bounded sketch."""
    return flat(events.groupBy(F.window("ts", window)).agg(
        F.count("*").alias("n_events"),
        F.percentile_approx(value, F.lit(q), F.lit(accuracy)).alias("quantile")))
