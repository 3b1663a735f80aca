"""Writers: partitioned and keyed overwrite, publishing and append."""

from __future__ import annotations

from functools import reduce
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.text import canonical_uuid, or_empty
from gaugeline.operators.quality import require_passed
from gaugeline.operators.scale import latest_rows
from gaugeline.session import materialize
from gaugeline.sources.tables import path_exists


def write_by_year(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Replace the years present in ``df``, leaving other years as they are.

    Rows are brought together by year before the write. Adaptive execution
    sizes the write tasks: small years share one, and a year that holds most of
    the rows is split over many.
    """
    (
        df.hint("rebalance", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year")
        .parquet(path)
    )


def write_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def ensure_dataset(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Write an empty dataset with the full schema unless one is there."""
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def run_load(
    extract: Callable[[], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    load: Callable[[DataFrame], None],
) -> bool:
    """Extract, transform and load; an empty result skips the load."""
    df = extract().transform(transform)
    if df.isEmpty():
        return False
    load(df)
    return True


def publish(
    tables: dict[str, DataFrame],
    write: Callable[[DataFrame, str], None],
    checks: DataFrame | None = None,
) -> None:
    """Write every table with ``write(df, name)``, but only after all checks passed."""
    if checks is not None:
        require_passed(checks)
    for name, df in tables.items():
        write(df, name)


def table_writer(database: str | None = None) -> Callable[[DataFrame, str], None]:
    """Writer for ``publish`` that replaces catalog tables."""

    def write(df: DataFrame, name: str) -> None:
        target = f"{database}.{name}" if database else name
        df.write.mode("overwrite").saveAsTable(target)

    return write


def path_writer(base: str) -> Callable[[DataFrame, str], None]:
    """Writer for ``publish`` that replaces Parquet folders under ``base``."""
    return lambda df, name: write_dataset(df, f"{base}/{name}")


def jdbc_writer(url: str, schema: str, **properties: str) -> Callable[[DataFrame, str], None]:
    """Writer for ``publish`` that replaces tables of a database."""
    return lambda df, name: df.write.jdbc(url, f"{schema}.{name}", mode="overwrite", properties=properties)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    result = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        result = part if result is None else result.unionByName(part)
    return result


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts side by side with their difference."""
    return (
        source.withColumnRenamed("n_rows", "source_rows")
        .join(target.withColumnRenamed("n_rows", "target_rows"), "table_name", "full_outer")
        .select(
            "table_name",
            F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
            F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        )
        .withColumn("difference", F.col("source_rows") - F.col("target_rows"))
    )


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``old`` and ``new``, a new row replacing the old one of its key.

    ``old`` has one row per key; ``order``, then the text of the whole row,
    decides between several new rows of one key. A null in a key equals a null. The old
    rows are only checked against the new keys: with few new rows those are
    broadcast and the old table is neither moved nor sorted.
    """
    return replace_rows(old, newest(new, keys, order), keys)


def replace_rows(old: DataFrame, latest: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` with new rows of which every key has one."""
    asked = latest.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_new_{key}")) for key in keys])
    return old.join(asked, same, "left_anti").unionByName(latest)


def newest(new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row of every key: the first in ``order``, ties by the text of the whole row."""
    return latest_rows(new, keys, [*(order or []), F.to_json(F.struct(*new.columns))])


def upsert_dataset(spark: SparkSession, path: str, new: DataFrame, keys: list[str],
                   order: list[Column] | None = None) -> None:
    """Keyed overwrite of a stored dataset.

    The merged rows are written to the shared folder before the dataset is
    replaced, since it cannot be read and overwritten in one job.
    """
    rows = materialize(newest(new, keys, order), "new-rows")
    if path_exists(spark, path):
        rows = materialize(upsert(spark.read.parquet(path), rows, keys), "merged-rows")
    write_dataset(rows, path)


def indicator_search_rows(dim_indicators: DataFrame) -> DataFrame:
    """Search documents of the indicators, keyed by code."""
    return dim_indicators.select("indicator_code", "indicator_name", "category", "description")


def document_search_rows(documents: DataFrame) -> DataFrame:
    """Search documents of the document metadata, keyed by id."""
    return documents.select(
        "doc_id", "title",
        *[or_empty(F.col(c)).alias(c) for c in ("doc_type", "abstract", "topics", "countries")],
    )


def append_embeddings(df: DataFrame, path: str) -> None:
    """Add embedding rows to a stored dataset."""
    df.write.mode("append").parquet(path)


def new_sessions(requests: DataFrame) -> DataFrame:
    """Session id of every chat request and whether the session is new.

    A request that names a valid UUID keeps it; any other gets a new one. The
    result is materialised because new ids are random.
    """
    named = canonical_uuid(F.col("session_id"))
    assigned = requests.withColumn("is_new", named.isNull()).withColumn(
        "session_id", F.coalesce(named, F.uuid()))
    return materialize(assigned, "sessions")


def session_rows(assigned: DataFrame) -> DataFrame:
    """Rows for the sessions table: the new sessions with their titles."""
    return assigned.filter("is_new").select(
        F.col("session_id").alias("id"),
        F.concat(F.lit("Chat "), F.left("session_id", F.lit(8))).alias("title"),
        F.current_timestamp().alias("created_at"),
    )


def message_rows(assigned: DataFrame, role: str = "user") -> DataFrame:
    """Rows for the messages table."""
    return assigned.select(
        "session_id", F.lit(role).alias("role"), F.col("query").alias("content"),
        F.current_timestamp().alias("created_at"),
    )


def append_chat(requests: DataFrame, sessions_path: str, messages_path: str, role: str = "user") -> None:
    """Append the requests' new sessions, then their messages, to the stored tables.

    In this order, no message is ever stored without its session. A session is
    new if its request names no valid id; each such request opens one.
    """
    assigned = new_sessions(requests)
    session_rows(assigned).write.mode("append").parquet(sessions_path)
    message_rows(assigned, role).write.mode("append").parquet(messages_path)
