"""Streams give the batch result, once, also after a restart."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import metrics
from gaugeline.sources import keyed
from gaugeline.streaming.events import read_event_stream, run_available, run_totals, run_updates, with_event_time

SF = "/root/testdata/sf0.001"
BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 200.0]

METRICS = {
    "rate": lambda e: metrics.rate(e),
    "errors": lambda e: metrics.error_rate(e, F.col("event_type") == "error", "10 minutes", 600),
    "increase": lambda e: metrics.increase(e),
    "limit": lambda e: metrics.rate_limit_violations(e, "user_id", 1, "1 hour"),
    "quantile": lambda e: metrics.histogram_quantile(e, "value", BOUNDS, 0.95, "1 hour"),
    "approximate": lambda e: metrics.approximate_quantile(e, "value", 0.95, "1 hour"),
}


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Events in three files by time, and one far later event that closes all windows."""
    folder = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(f"{SF}/events.parquet")
    n = events.count()
    for i in range(3):
        events.filter((F.col("event_id") >= n * i // 3) & (F.col("event_id") < n * (i + 1) // 3)).coalesce(1).write.mode("append").parquet(str(folder))
    closing = spark.createDataFrame([(10**9,)], "event_id long").select(
        "event_id", F.expr("timestamp_ntz'2030-01-01 00:00:00'").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    closing.write.mode("append").parquet(str(folder))
    return str(folder), events


@pytest.mark.parametrize("name", sorted(METRICS))
def test_stream_equals_batch(spark, arrivals, tmp_path, name):
    folder, events = arrivals
    # Files may arrive in any order; the watermark leaves room for that.
    stream = read_event_stream(spark, folder, watermark="60 days")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run_available(stream, METRICS[name], out, checkpoint)
    run_available(read_event_stream(spark, folder, watermark="60 days"), METRICS[name], out, checkpoint)
    got = spark.read.parquet(out)
    wanted = METRICS[name](with_event_time(events))
    assert got.count() == wanted.count() > 0
    assert got.exceptAll(wanted).count() == 0


def test_totals_are_updated(spark, arrivals, tmp_path):
    folder, events = arrivals
    seen = {}
    run_totals(
        read_event_stream(spark, folder, watermark="60 days", max_files=1), metrics.total_count,
        lambda df, _: seen.update({r["event_type"]: r["n_events"] for r in df.collect()}), str(tmp_path / "cp"))
    wanted = {r["event_type"]: r["n_events"] for r in metrics.total_count(events).collect()}
    wanted["view"] += 1
    assert seen == wanted


KEYS = {
    "rate": ["window_start", "event_type"], "errors": ["window_start"], "increase": ["window_start", "event_type"],
    "quantile": ["window_start"], "approximate": ["window_start"],
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_updates_hold_all_windows_also_after_restarts(spark, tmp_path, name):
    """Nothing closes the last windows; a batch that is run again after a failure changes nothing."""
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    events = spark.read.parquet(f"{SF}/events.parquet").filter("event_id < 4000")
    n = events.count()
    for i in range(4):
        events.filter((F.col("event_id") >= n * i // 4) & (F.col("event_id") < n * (i + 1) // 4)).coalesce(1).write.mode("append").parquet(folder)
        if i == 0:
            continue
        # Two files wait at the first run and are two micro-batches.
        run_updates(read_event_stream(spark, folder, watermark="60 days", max_files=1), METRICS[name], out, KEYS[name], checkpoint)
    wanted = METRICS[name](with_event_time(events))
    got = keyed.read_table(spark, out)
    assert got.count() == wanted.count() > 0 and got.exceptAll(wanted).count() == 0
    again = METRICS[name](with_event_time(events.filter("event_id >= 1000")))
    keyed.write_keyed(wanted.join(again.select(*KEYS[name]), KEYS[name], "left_semi").select(*got.columns), out, KEYS[name])
    assert keyed.read_table(spark, out).exceptAll(wanted).count() == 0


def test_updates_of_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/events.parquet").limit(0).coalesce(1).write.parquet(folder)
    run_updates(read_event_stream(spark, folder), METRICS["rate"], str(tmp_path / "out"), KEYS["rate"], str(tmp_path / "cp"))
    assert not keyed.versions(spark, str(tmp_path / "out")) or keyed.read_table(spark, str(tmp_path / "out")).count() == 0


def test_late_events_are_left_out(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def arrive(*minutes):
        rows = [(i, m) for i, m in enumerate(minutes)]
        spark.createDataFrame(rows, "event_id long, m int").select(
            "event_id", (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(mins=F.col("m"))).alias("ts"),
            F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
            F.lit("{}").alias("props")).coalesce(1).write.mode("append").parquet(folder)
        run_available(read_event_stream(spark, folder, watermark="10 minutes"), metrics.rate, out, checkpoint)

    arrive(0, 0, 1)
    arrive(30)      # closes the first windows
    arrive(0, 25)   # the first is too late, the second is not
    arrive(90)
    counts = {r["window_start"].minute: r["n_events"] for r in spark.read.parquet(out).collect()}
    assert counts == {0: 2, 1: 1, 25: 1, 30: 1}


def test_quantile_by_buckets(spark):
    values = [float(v) for v in range(1, 101)]
    df = spark.createDataFrame([(v,) for v in values], "value double").withColumn("ts", F.expr("timestamp'2024-01-01'"))
    one = lambda q, bounds: metrics.histogram_quantile(df, "value", bounds, q).first()["quantile"]
    assert one(0.95, [50.0, 100.0]) == pytest.approx(95.0)
    assert one(0.25, [50.0, 100.0]) == pytest.approx(25.0)
    assert one(0.95, [10.0, 50.0]) == 50.0  # beyond the last bound
