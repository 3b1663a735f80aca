"""Sharding by rendezvous hashing over weighted shards, in column expressions only.

A key draws an exponential waiting time for every shard, from a hash of key and
shard divided by the shard's weight, and goes to the shard that comes first. A
shard wins a share of the keys in proportion to its weight. A further shard
draws for itself only, so it takes rows from others and moves nothing between
them; without a shard only its own rows move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.quality import let
from gaugeline.llm.ranks import placed

SHARDS = 16
HASH_DIGITS = 13  # 52 bits, which a double holds exactly


def waits(key: Column, weights: Sequence[float]) -> Column:
    """An array with a struct (wait, shard) for every shard. A null key is a key, written ``-``."""
    if not weights or any(not weight > 0 for weight in weights):
        raise ValueError("every shard needs a weight above 0")
    name = F.coalesce(key.cast("string"), F.lit("-"))
    entries = F.array(*[F.struct(F.lit(shard).alias("shard"), F.lit(float(w)).alias("weight")) for shard, w in enumerate(weights)])

    def wait(entry: Column) -> Column:
        digest = F.md5(F.concat_ws(":", name, entry["shard"].cast("string")).cast("binary"))
        share = (F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** HASH_DIGITS)
        return F.struct((-F.log(share) / entry["weight"]).alias("wait"), entry["shard"].alias("shard"))

    return F.transform(entries, wait)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; equal waits go to the lower shard."""
    return F.array_min(waits(key, weights))["shard"]


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, behind underscores while a column has it already (in any case)."""
    while name.lower() in {other.lower() for other in taken}:
        name = f"_{name}"
    return name


def assign(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id", column: str = "shard") -> DataFrame:
    """The rows with their shard in a further column (``_shard`` where ``shard`` is taken).

    Rows that repeat a key go to one shard; a null key is a key. A narrow
    expression: nothing is moved, and an empty table gives an empty result.
    """
    return docs.withColumn(free_name(column, docs.columns), shard_of(F.col(key), weights))


def moves(docs: DataFrame, before: Sequence[float], after: Sequence[float], key: str = "doc_id") -> DataFrame:
    """The keys (one row per row of ``docs``) that change shards, with from_shard and to_shard."""
    found = docs.select(
        F.col(key), shard_of(F.col(key), before).alias("from_shard"), shard_of(F.col(key), after).alias("to_shard"))
    return found.where("from_shard != to_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id") -> None:
    """Write whole rows as Parquet, one folder a shard, sorted by key.

    Rows are dealt out in ranges of (shard, key, hash of the row), so a heavy
    shard is written by many tasks and a key that repeats is not one task.
    """
    column = free_name("shard", docs.columns)
    spread = free_name("spread", [*docs.columns, column])
    put = assign(docs, weights, key, column).withColumn(spread, F.xxhash64(*docs.columns))
    keys = [column, key, spread]
    put.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(spread).write.partitionBy(column).parquet(path)


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, and the shard when there is one more.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has no bytes and the checksum
    0. Slots ascend by doc_id within the shard, null first; rows that repeat an
    id have one shard and a slot each. Other columns are not read, and texts
    are not moved.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    drawn = waits(F.col("doc_id"), (1.0,) * (shards + 1))
    winners = let(drawn, lambda all_waits: F.struct(
        F.array_min(F.slice(all_waits, 1, shards))["shard"].alias("shard"), F.array_min(all_waits)["shard"].alias("grown_shard")))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), winners.alias("winners"),
    ).select("doc_id", "size", "text_crc32", "winners.shard", "winners.grown_shard")
    return placed(rows, ["shard"], ["doc_id", "size", "text_crc32"], "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("__place").alias("slot"), "grown_shard")


SQL = r"""
WITH RECURSIVE bits(byte, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY byte) AS steps FROM bits WHERE k = 8
), sized AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes,
         list_transform(range(17), lambda s: -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || s), 1, 13))::BIGINT::DOUBLE
                                                 + 0.5) / 4503599627370496)) AS waits
  FROM documents
), placed AS (
  SELECT doc_id, size,
         xor(list_reduce(bytes, lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
         (list_position(waits, list_min(waits[1:16])) - 1)::INTEGER AS shard,
         (list_position(waits, list_min(waits)) - 1)::INTEGER AS grown_shard
  FROM sized, crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed
"""
