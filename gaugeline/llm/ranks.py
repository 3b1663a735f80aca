"""Gapless places of rows within groups of any size, without a window over a group.

Rows are stored in ranges of (group, order); a row's place is its number within
its file part, shifted by the rows of its group in the parts before. Only one
row for each part and group is ever brought together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.session import materialize

PART_SHIFT = 33  # monotonically_increasing_id has the part above this bit


def placed(rows: DataFrame, group: Sequence[str] = (), order: Sequence[str] = (), label: str = "places") -> DataFrame:
    """``rows`` with __place (from 0, ascending by ``order``, nulls first) and __total, the rows of the group.

    A null is a group of its own. Rows that agree in ``order`` are dealt places
    among themselves in any order, once: the number that tells them apart is
    stored before they are moved, so even a group of equal rows is spread over
    ranges. An empty table gives an empty result. Column names that begin with
    ``__`` are the operator's own.
    """
    keys = [*group, *order, "__tie"]
    stored = materialize(rows.withColumn("__tie", F.monotonically_increasing_id()), f"{label}-rows")
    ranged = stored.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return numbered(ranged.drop("__tie"), group, label)


def numbered(rows: DataFrame, group: Sequence[str] = (), label: str = "places") -> DataFrame:
    """``rows`` in the order in which their partitions hold them, with __place and __total by group.

    The rows of a group must lie together in a partition.
    """
    stored = materialize(rows.withColumn("__at", F.monotonically_increasing_id()), f"{label}-ranges")
    part = F.shiftright("__at", PART_SHIFT)
    parts = stored.groupBy(part.alias("__part"), *group).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = parts.select(
        F.col("__part").alias("__p"), *[F.col(name).alias(f"__g{at}") for at, name in enumerate(group)],
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(W.partitionBy(*group)).alias("__total"))
    same = [F.col(name).eqNullSafe(F.col(f"__g{at}")) for at, name in enumerate(group)]
    return stored.join(materialize(shifts, f"{label}-shifts"), reduce(lambda a, b: a & b, same, part == F.col("__p"))).select(
        *[name for name in stored.columns if name != "__at"], (F.col("__at") + F.col("__shift")).alias("__place"), "__total")
