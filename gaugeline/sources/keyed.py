"""Keyed tables in versions: rows in hash buckets of their key.

A write reads and rewrites only the buckets that its keys fall into and commits a
manifest in which the other buckets keep their files. A crash at any point
leaves the version before readable, and every version stays readable until it is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.session import materialize
from gaugeline.sources.sinks import newest, replace_rows
from gaugeline.sources.versions import commit, folders, new_part, read_manifest, versions

BUCKET = "__bucket"
BUCKETS = 64

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row; a null in a key counts like a value."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, folder: str, keys: list[str], buckets: int) -> dict[str, list[str]]:
    """Write rows by bucket, sorted by key; returns the folder of every bucket that has rows."""
    part = new_part(folder)
    (rows.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
     .sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(f"{folder}/{part}"))
    names = [name for name in folders(rows.sparkSession, f"{folder}/{part}") if name.startswith(f"{BUCKET}=")]
    return {name.split("=")[1]: [f"{part}/{name}"] for name in names}


def create_table(rows: DataFrame, folder: str, keys: list[str], buckets: int = BUCKETS,
                 order: list[Column] | None = None) -> dict:
    """The first version of a table: the first row of every key in ``order``, ties by the text of the whole row."""
    spark = rows.sparkSession
    if versions(spark, folder):
        raise FileExistsError(folder)
    parts = _write_buckets(newest(rows, keys, order), folder, keys, buckets)
    return commit(spark, folder, 1, {
        "keys": keys, "buckets": buckets, "schema": rows.schema.json(), "parts": parts})


def read_table(spark: SparkSession, folder: str, version: int | None = None, only: list[int] | None = None) -> DataFrame:
    """The rows of a version, by default the last; ``only`` of some buckets."""
    return _read_parts(spark, folder, read_manifest(spark, folder, version), only)


def _read_parts(spark: SparkSession, folder: str, manifest: dict, only: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    wanted = None if only is None else {str(bucket) for bucket in only}
    paths = [f"{folder}/{part}" for bucket, parts in sorted(manifest["parts"].items()) if wanted is None or bucket in wanted
             for part in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_table(new: DataFrame, folder: str, merge: Merge) -> dict:
    """Commit ``merge(old, new)`` as the next version, over the buckets of the new rows' keys only.

    ``merge`` gets the stored rows of those buckets and all new rows, and
    returns what is to be in the buckets. It must not change keys of old rows.
    The driver gets the numbers of the buckets. Without new rows nothing is written.
    """
    spark = new.sparkSession
    before = read_manifest(spark, folder)
    keys, buckets = before["keys"], before["buckets"]
    rows = materialize(new, "keyed-new")
    touched = [row[0] for row in rows.select(bucket_of(keys, buckets)).distinct().collect()]
    if not touched:
        return before
    old = _read_parts(spark, folder, before, touched)
    written = _write_buckets(merge(old, rows).select(*old.columns), folder, keys, buckets)
    parts = {bucket: names for bucket, names in before["parts"].items() if int(bucket) not in touched}
    return commit(spark, folder, before["version"] + 1, {**before, "parts": {**parts, **written}})


def upsert_table(new: DataFrame, folder: str, order: list[Column] | None = None) -> dict:
    """Replace or add the rows of the new keys; ``order`` decides between several new rows of one key.

    It decides before the new rows are stored, in the tasks that make them: read
    back, many more of them share a task, since files are packed by their compressed bytes.
    """
    keys = read_manifest(new.sparkSession, folder)["keys"]
    return merge_table(newest(new, keys, order), folder, lambda old, rows: replace_rows(old, rows, keys))


def delete_keys(keys_gone: DataFrame, folder: str) -> dict:
    """Remove the rows whose key is among ``keys_gone`` (the key columns); a null equals a null."""
    keys = read_manifest(keys_gone.sparkSession, folder)["keys"]

    def without(old: DataFrame, gone: DataFrame) -> DataFrame:
        named = gone.select(*[F.col(key).alias(f"_gone_{key}") for key in keys]).distinct()
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_gone_{key}"))
        return old.join(named, same, "left_anti")

    return merge_table(keys_gone.select(*keys), folder, without)


def write_keyed(new: DataFrame, folder: str, keys: list[str], buckets: int = BUCKETS, order: list[Column] | None = None) -> dict:
    """Create the table, or upsert into it if it is there."""
    if versions(new.sparkSession, folder):
        return upsert_table(new, folder, order)
    return create_table(new, folder, keys, buckets, order)
