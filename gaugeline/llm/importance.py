"""Quality by importance resampling of hashed n-gram models.

The words and word pairs of target texts and of all texts are counted in hash
buckets. A text's weight is the ratio of its likelihoods under the two bucket
models. Adding Gumbel noise to the log weights and keeping the ``k`` largest
samples ``k`` documents without replacement by weight.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.llm.batches import LOWER, shingles, text_slices, words
from gaugeline.llm.sampling import hash_sample
from gaugeline.session import materialize

BUCKETS = 1 << 16
SMOOTHING = 0.5
MAX_TARGETS = 20_000  # target texts, whole, chosen by a hash of the id
KEEP_SHARE = 0.85
NO_WORDS = -1e9  # log weight of a text without a word
KEY_UNIT = 1 << 24  # keys are compared as whole multiples of 1 / KEY_UNIT
BINS = 4096


def ngrams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and word pair of a slice."""
    hashes, row, _ = words(LOWER[data], starts)
    pairs, pair_row = shingles(hashes, row, 2)
    bucket = np.concatenate((hashes, pairs)) % np.uint64(BUCKETS)
    return np.concatenate((row, pair_row)), bucket.astype(np.int64)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) over all rows of ``texts`` (text). Each task sends one row for each bucket at most."""

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, data, starts in text_slices(batch.column(0)):
                total += np.bincount(ngrams(data, starts)[1], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def target_texts(docs: DataFrame, target_ids: DataFrame, most: int = MAX_TARGETS) -> DataFrame:
    """The texts of at most ``most`` of ``target_ids`` (doc_id). The stored ids are few enough to move instead of the texts."""
    ids = target_ids.where("doc_id is not null").select("doc_id").distinct()
    chosen = materialize(hash_sample(ids, None, most), "targets")
    return docs.join(chosen, "doc_id", "left_semi").select("text")


def log_ratios(target: DataFrame, raw: DataFrame) -> np.ndarray:
    """Log likelihood ratio of every bucket; what the driver gets is one row for each bucket."""
    counts = []
    for texts in (target, raw):
        table = np.zeros(BUCKETS)
        rows = bucket_counts(texts).toPandas()
        table[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
        counts.append(np.log((table + SMOOTHING) / (table.sum() + SMOOTHING * BUCKETS)))
    return counts[0] - counts[1]


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise that depends on the id only."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def keep_largest(rows: DataFrame, key: str, k: int, kept: str = "kept") -> DataFrame:
    """``rows`` with ``kept`` true for the ``k`` largest of the long ``key``, without a sort.

    The threshold is found from counts in at most ``BINS`` ranges, dividing
    the range of the k-th row again until it is one value. Rows with that value
    (only repeated ids, as a rule) are taken in the order of a hash of the row's id.
    """
    ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).collect()[0]
    if k <= 0 or not ends["n"]:
        return rows.withColumn(kept, F.lit(False))
    if k >= ends["n"]:
        return rows.withColumn(kept, F.lit(True))
    low, width, left = ends["low"], ends["high"] - ends["low"] + 1, k
    while width > 1:
        step = -(-width // BINS)
        place = F.floor((F.col(key) - low) / step)
        found = {
            row["place"]: row["count"] for row in
            rows.where(F.col(key).between(low, low + width - 1)).groupBy(place.alias("place")).count().collect()}
        for place_found in sorted(found, reverse=True):
            if left <= found[place_found]:
                break
            left -= found[place_found]
        low, width = low + place_found * step, step
    order = W.partitionBy(key).orderBy(F.xxhash64("doc_id"), "doc_id")
    ties = rows.where(F.col(key) == low).withColumn("place", F.row_number().over(order))
    return (
        rows.where(F.col(key) != low).withColumn(kept, F.col(key) > low)
        .unionByName(ties.withColumn(kept, F.col("place") <= left).drop("place")))


def resample(
    docs: DataFrame, target_ids: DataFrame, keep_share: float = KEEP_SHARE, seed: int = 1, max_targets: int = MAX_TARGETS,
    length: int | None = None,
) -> DataFrame:
    """Per document: doc_id, n_grams, log_weight, kept; ``keep_share`` of all rows are kept.

    The target model comes from at most ``max_targets`` texts of ``target_ids`` (doc_id);
    the raw model from all texts. Without a target all weights are equal. A
    text without a word (or null) has the weight ``NO_WORDS``, so it is kept
    last. ``length`` takes every text as if it had so many n-grams, so that long texts do not
    outweigh short ones; by default the weight is that of the whole text. Equal ids get equal noise, and so do null ids. Extra columns are not read; an empty table gives an empty result.
    """
    target = target_texts(docs, target_ids, max_targets)
    ratios = np.zeros(BUCKETS) if target.isEmpty() else log_ratios(target, docs)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            count, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, end, data, starts in text_slices(batch.column(1)):
                row, bucket = ngrams(data, starts)
                count[first:end] = np.bincount(row, minlength=end - first)
                total[first:end] = np.bincount(row, weights=shared.value[bucket], minlength=end - first)
            weight = np.where(count > 0, total if length is None else length * total / np.maximum(count, 1), NO_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(weight)], ["doc_id", "n_grams", "log_weight"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    weighed = materialize(
        docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, n_grams bigint, log_weight double")
        .withColumn("key", F.floor((F.col("log_weight") + gumbel(F.col("doc_id"), seed)) * KEY_UNIT)), "importance")
    return keep_largest(weighed, "key", int(weighed.count() * keep_share)).select("doc_id", "n_grams", "log_weight", "kept")
