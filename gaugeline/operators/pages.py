"""Pages of a large ordered result: sorted once, then read by place or by key at the same cost anywhere.

Rows are stored in ranges of their order, each file part sorted, with a running number
that only grows within a part. Beside them lie the rows of each part and, as a sparse
index, the key of every ``stride``-th row. A page is a range of running
numbers, so the scan skips all row groups outside it by their bounds.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gaugeline.sources.versions import commit, read_manifest, versions, write_part

STRIDE = 10_000
PART_SHIFT = 33  # monotonically_increasing_id has the part above this bit

Order = list[tuple[str, bool]]  # column, and whether it descends


def _columns(order: Order) -> list[Column]:
    return [F.desc(name) if descends else F.asc(name) for name, descends in order]


def store_sorted(df: DataFrame, folder: str, order: Order, stride: int = STRIDE) -> dict:
    """Sort ``df`` and store it as the next version of ``folder``, with its parts and sparse index.

    Nulls come first where a column ascends and last where it descends. Rows that are equal in
    all columns of the order lie in any order, the same for every page. Columns whose name begins with ``__`` are the
    operator's own.
    """
    spark = df.sparkSession
    spread = [*_columns(order), F.xxhash64(*df.columns)]  # equal keys may fill several ranges
    ranged = df.repartitionByRange(*spread).sortWithinPartitions(*spread).withColumn("__at", F.monotonically_increasing_id())
    rows = write_part(ranged, folder)
    stored = spark.read.schema(ranged.schema).parquet(f"{folder}/{rows}")
    parts = stored.groupBy(F.shiftright("__at", PART_SHIFT).alias("part")).agg(F.min("__at").alias("first_at"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file part
    parts = parts.withColumn("first_place", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    kept = write_part(parts, folder)
    parts = spark.read.schema(parts.schema).parquet(f"{folder}/{kept}")
    place = F.col("__at") - F.col("first_at") + F.col("first_place")
    sparse = stored.select(*[name for name, _ in order], "__at").join(
        parts, F.shiftright("__at", PART_SHIFT) == F.col("part")).filter(place % stride == 0).select(
        place.alias("__place"), *[name for name, _ in order])
    index = write_part(sparse, folder)
    total = parts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    known = versions(spark, folder)
    return commit(spark, folder, known[-1] + 1 if known else 1, {
        "rows": rows, "parts": kept, "index": index, "total": total, "stride": stride, "order": order,
        "schemas": {"rows": ranged.schema.json(), "parts": parts.schema.json(), "index": sparse.schema.json()}})


def _table(spark: SparkSession, folder: str, manifest: dict, what: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest["schemas"][what]))
    return spark.read.schema(schema).parquet(f"{folder}/{manifest[what]}")


def _range(spark: SparkSession, folder: str, manifest: dict, start: int, end: int) -> DataFrame:
    """The rows with places from ``start`` up to ``end``, read by the bounds of their running numbers."""
    held = _table(spark, folder, manifest, "parts").filter(
        (F.col("first_place") < end) & (F.col("first_place") + F.col("rows") > start)).collect()  # the parts of this range
    bounds = []
    for part in held:
        low = part["first_at"] + max(start - part["first_place"], 0)
        high = part["first_at"] + min(end - part["first_place"], part["rows"]) - 1
        bounds.append(F.col("__at").between(low, high))
    rows = _table(spark, folder, manifest, "rows")
    return rows.filter(reduce(Column.__or__, bounds)) if bounds else rows.limit(0)


def read_page(spark: SparkSession, folder: str, page_no: int, page_size: int, version: int | None = None) -> DataFrame:
    """Page ``page_no`` (from 1) in order, with the number of all rows in ``total``; empty beyond the last."""
    if page_no < 1 or page_size < 1:
        raise ValueError("pages and their sizes count from 1")
    manifest = read_manifest(spark, folder, version)
    rows = _range(spark, folder, manifest, (page_no - 1) * page_size, page_no * page_size)
    return rows.orderBy("__at").drop("__at").withColumn("total", F.lit(manifest["total"]).cast("long"))


def _beyond(order: Order, key: dict, or_equal: bool = False) -> Column:
    """Whether a row comes after ``key`` in the order."""
    found, same = F.lit(False), F.lit(True)
    for name, descends in order:
        column, value = F.col(name), key[name]
        if value is None:
            after = F.lit(False) if descends else column.isNotNull()
        else:
            after = (column < F.lit(value)) | column.isNull() if descends else column > F.lit(value)
        found = found | (same & F.coalesce(after, F.lit(False)))
        same = same & column.eqNullSafe(F.lit(value))
    return found | same if or_equal else found


def read_after(spark: SparkSession, folder: str, key: dict, page_size: int, version: int | None = None) -> DataFrame:
    """The first ``page_size`` rows after ``key`` (a value for every column of the order), in order.

    The sparse index tells where the key is to within ``stride`` rows. Rows equal to
    the key in all columns of the order are passed over, so the order should tell rows apart.
    """
    manifest = read_manifest(spark, folder, version)
    order = [tuple(column) for column in manifest["order"]]
    # The last index row that does not come after the key; the page starts at it or behind it.
    at = _table(spark, folder, manifest, "index").filter(~_beyond(order, key)).agg(F.max("__place")).first()[0]
    start = at or 0
    rows = _range(spark, folder, manifest, start, start + manifest["stride"] + page_size)
    return rows.filter(_beyond(order, key)).orderBy("__at").limit(page_size).drop("__at")
