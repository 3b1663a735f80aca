"""Bounded samples by a hash of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.scale import top_rows
from gaugeline.session import materialize

SPARE = 2.0


def hash_sample(ids: DataFrame, key: str | None, most: dict | int) -> DataFrame:
    """At most ``most`` rows (by value of ``key``, or the same for all) of (doc_id, key), which must be distinct.
    Without a ``key`` all rows are one group.

    The rows are those with the smallest hashes of the id. A first threshold
    from the number of rows of each key lets about ``SPARE`` times as many
    through, so a key with a third of all rows is cut before anything is moved.
    """
    order = [F.shiftrightunsigned(F.xxhash64("doc_id"), 11), F.col("doc_id")]
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    if key is None:  # one group, whose size is one number
        few = ids.where(share * ids.count() < most * SPARE + 50).withColumn("__group", F.lit(0))
        return top_rows(few, ["__group"], order, most, "__place").drop("__group", "__place")
    sizes = materialize(ids.groupBy(key).agg(F.count("*").alias("__rows")), "sample-sizes")
    limit = F.lit(most) if isinstance(most, int) else F.create_map(*[F.lit(x) for pair in most.items() for x in pair])[F.col(key)]
    few = ids.join(sizes, key).where(share * F.col("__rows") < limit * SPARE + 50).drop("__rows")
    largest = most if isinstance(most, int) else max(most.values())
    return top_rows(few, [key], order, largest, "__place").where(F.col("__place") <= limit).drop("__place")


def one_text(texts: DataFrame, key: str) -> DataFrame:
    """(doc_id, key, text): of the rows (doc_id, key, text) of one id and key the text with the smallest hash.

    With ids from ``hash_sample`` this bounds the rows, not only the ids. An
    id that repeats sends on one text from each map task.
    """
    return texts.groupBy("doc_id", key).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
