"""Building blocks that keep hot keys from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.session import materialize

# Rows that a task groups and sorts at once, about 300 bytes each.
ROWS_PER_TASK = 1_000_000


def top_rows(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every key.

    A ``row_number() <= k`` filter makes Spark prune to ``k`` rows per key in
    the map tasks before the shuffle, so a key holding a third of all rows
    sends only ``k`` rows per map task. (The plan shows it as
    ``WindowGroupLimit``; it applies up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, which ``build_session``
    raises.)
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def latest_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_rows(df, keys, order, 1, "_rank").drop("_rank")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    factor: int = 32,
    how: str = "inner",
) -> DataFrame:
    """Shuffle join whose hot keys are spread over ``factor`` tasks.

    The left rows of a key are split by a hash of ``spread_by`` (so a re-run
    task sends every row to the same place) and each right row is repeated once
    per split. For inner, left and left-semi/anti joins the result is the same
    as that of the plain join.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(factor)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def deal_by(df: DataFrame, keys: list[str], n_rows: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal rows by a hash of ``keys`` to as many tasks as ``n_rows`` need at ``per_task`` each.

    ``n_rows`` counts what the rows become after they are dealt (a join may
    repeat each of them), which their bytes do not tell. The number is given, so adaptive
    execution does not put the partitions together again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-n_rows // per_task)), *keys)


def number_rows(df: DataFrame, key: str, name: str, tie: tuple[str, ...] = ()) -> DataFrame:
    """Number all rows 1, 2, 3… (long) in the order of ``key``, then of the ``tie`` columns.

    Rows are dealt to ranges of the key and stored with the number of their
    range, so what follows does not depend on how the ranges were chosen. Each
    range is numbered on its own and shifted by the rows of those before it
    (one count for each range). Rows equal in all these columns are numbered in any order.
    """
    order = [key, *tie]
    sliced = materialize(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "numbered")
    counts = sliced.groupBy("_slice").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return sliced.join(shifts, "_slice").withColumn(name, (within + F.col("_shift")).cast("long")).drop("_slice", "_shift")
