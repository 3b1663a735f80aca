from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import importance as imp
from gaugeline.llm.batches import LOWER, MULTIPLIER, mix, words
from tests.llm.corpora import frame, odd_rows, plain_words, prose


def bucket_of(*parts):
    value = None
    for part in parts:
        data = LOWER[np.frombuffer(part.encode(), np.uint8)]
        one = words(data, np.array([0, len(data)]))[0]
        value = one if value is None else mix(value * np.uint64(MULTIPLIER) + one)
    return int(value[0] % np.uint64(imp.BUCKETS))


def bag(text):
    found = plain_words(text)
    return Counter([bucket_of(w) for w in found] + [bucket_of(a, b) for a, b in zip(found, found[1:], strict=False)])


def corpus():
    rows = [(n, prose(n, 30 + n % 50), "en", "a") for n in range(120)]
    return rows + [(200 + n, " ".join(w + "###" for w in prose(n, 40).split()), "en", "a") for n in range(30)] + [(1000 + i, *r) for i, *r in odd_rows()[:5]]


def test_weights_by_brute_force(spark):
    rows = corpus()
    good = list(range(0, 120, 2))
    found = {r["doc_id"]: r for r in imp.resample(frame(spark, rows), spark.createDataFrame([(i,) for i in good], "doc_id bigint")).collect()}
    even = {r["doc_id"]: r for r in imp.resample(
        frame(spark, rows), spark.createDataFrame([(i,) for i in good], "doc_id bigint"), length=100).collect()}
    raw, target = Counter(), Counter()
    for i, text, *_ in rows:
        raw += bag(text)
        if i in good:
            target += bag(text)

    def log_p(counts, bucket):
        return np.log((counts[bucket] + imp.SMOOTHING) / (sum(counts.values()) + imp.SMOOTHING * imp.BUCKETS))

    for i, text, *_ in rows[::9]:
        grams = bag(text)
        if not grams:
            assert found[i]["log_weight"] == imp.NO_WORDS
            continue
        ratio = sum(n * (log_p(target, b) - log_p(raw, b)) for b, n in grams.items())
        assert found[i]["log_weight"] == pytest.approx(ratio, abs=1e-6)
        assert even[i]["log_weight"] == pytest.approx(100 * ratio / sum(grams.values()), abs=1e-6)
        assert found[i]["n_grams"] == sum(grams.values())
    assert np.mean([even[i]["kept"] for i in range(120)]) > 0.95
    assert np.mean([found[i]["kept"] for i in range(120)]) > 0.9  # long texts of words that no target has fall behind
    assert sum(r["kept"] for r in found.values()) == int(len(rows) * imp.KEEP_SHARE)


def test_keep_largest_equals_a_sort(spark):
    for k in (0, 1, 7, 500, 999, 1000, 2000):
        rows = spark.range(1000).select(F.col("id").alias("doc_id"), (F.xxhash64("id") % 977 * F.lit(10**6)).alias("key")).repartition(4)
        found = imp.keep_largest(rows, "key", k).collect()
        assert len(found) == 1000 and sum(r["kept"] for r in found) == min(k, 1000)
        kept, left = [r["key"] for r in found if r["kept"]], [r["key"] for r in found if not r["kept"]]
        assert not kept or not left or min(kept) >= max(left)


def test_repeated_ids_at_the_cut(spark):
    """Equal ids have equal noise; equal texts of one id tie, and as many rows are kept as asked for."""
    rows = [(n % 30, prose(n % 30, 20), "en", "a") for n in range(300)] + [(None, prose(1, 9), "en", "a")] * 40
    good = spark.createDataFrame([(n,) for n in range(0, 30, 3)], "doc_id bigint")
    for share in (0.1, 0.5, 0.93):
        found = imp.resample(frame(spark, rows), good, keep_share=share).collect()
        assert len(found) == 340 and sum(r["kept"] for r in found) == int(340 * share)
    assert imp.target_texts(frame(spark, rows), good, 4).count() == 40  # four ids, ten equal rows each


def test_gumbel_sampling_follows_the_weights(spark):
    # Of two equal halves, one with weight e times the other, the largest key lies in the first with p = e / (1 + e).
    wins = spark.range(4000).select(
        (imp.gumbel(F.col("id"), 1) + 1 > imp.gumbel(F.col("id"), 2)).cast("double").alias("w")).agg(F.avg("w")).collect()[0][0]
    assert wins == pytest.approx(np.e / (1 + np.e), abs=0.03)


def test_no_target_and_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint")
    docs = frame(spark, odd_rows())
    rows = imp.resample(docs, none).collect()
    assert len(rows) == docs.count() and {r["log_weight"] for r in rows} == {0.0, imp.NO_WORDS}
    assert imp.resample(docs.limit(0), none).collect() == []
