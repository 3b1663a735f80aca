"""Event streams: the source, and runs of the batch metrics over it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.sources.keyed import write_keyed
from gaugeline.sources.versions import drop_versions

EVENT_SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def with_event_time(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Give events an event-time column that watermarks accept."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", watermark) if watermark else timed


def read_event_stream(
    spark: SparkSession, path: str, watermark: str = "10 minutes", schema: str = EVENT_SCHEMA,
    max_files: int | None = None, glob: str | None = None,
) -> DataFrame:
    """Stream of the Parquet event files arriving under ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return with_event_time(reader.parquet(path), watermark)


def run_available(
    stream: DataFrame, metric: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Process what has arrived, appending closed windows as Parquet files.

    State and progress live in ``checkpoint``; a restart goes on where the last
    run stopped and writes every window once.
    """
    query = (
        metric(stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_totals(
    stream: DataFrame, metric: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Process what has arrived, handing the rows that changed to ``write``."""
    query = (
        metric(stream)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_updates(
    stream: DataFrame, metric: Callable[[DataFrame], DataFrame], folder: str, keys: list[str], checkpoint: str,
    buckets: int = 16,
) -> StreamingQuery:
    """Process what has arrived, replacing in a keyed table every window that changed.

    ``keys`` names a row of the metric. A changed window comes with all its
    events so far, so replacing it is right however often a batch is repeated
    after a failure, and the table holds open windows as well as closed ones. The
    watermark bounds the state: an event later than that is left out.
    """

    def replace(changed: DataFrame, _: int) -> None:
        write_keyed(changed, folder, keys, buckets)
        drop_versions(changed.sparkSession, folder)

    return run_totals(stream, metric, replace, checkpoint)
