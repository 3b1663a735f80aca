"""Search through cells gives the rows of a full comparison and compares few vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import cells

SF = "/root/testdata/sf0.1"


def clustered(count, dimension=12, groups=40, seed=2):
    """Vectors around a few directions, as embeddings lie."""
    chance = np.random.default_rng(seed)
    middles = chance.normal(size=(groups, dimension))
    return (middles[chance.integers(0, groups, count)] + 0.15 * chance.normal(size=(count, dimension))).astype("float32")


def frame(spark, data, name="vec_id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"{name} long, embedding array<float>").repartition(6)


def brute(data, queries, k):
    """Ids of the k nearest rows of every query; rows and queries without direction are at -2."""
    def norm(m):
        m = m.astype("float64")
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0), n[:, 0] > 0
    rows, has = norm(data)
    asked, asks = norm(queries)
    close = np.round(asked @ rows.T, 9)
    close[:, ~has] = -2.0
    close[~asks] = -2.0
    return [np.lexsort((np.arange(len(data)), -c))[:k].tolist() for c in close]


def found(hits):
    by_query = {}
    for row in hits.orderBy("query_id", "rank").collect():
        by_query.setdefault(row["query_id"], []).append(row["id"])
    return by_query


@pytest.mark.parametrize("block", [512, 16])
def test_five_thousand_queries_without_a_driver_in_between(spark, monkeypatch, block):
    monkeypatch.setattr(cells, "BLOCK", block)
    data, queries = clustered(3000), clustered(5000, seed=9)
    store = cells.store_cells(frame(spark, data))
    got = found(cells.nearest_in_cells(store, frame(spark, queries, "query_id"), 5))
    assert got == dict(enumerate(brute(data, queries, 5)))


def test_unusable_vectors_and_queries_are_left_out(spark):
    data = clustered(300)
    nan, inf = float("nan"), float("inf")
    odd = spark.createDataFrame(
        [(900, None), (901, []), (902, [1.0]), (903, [nan] * 12), (904, [inf] * 12), (905, [None] * 12)], "vec_id long, embedding array<float>")
    store = cells.store_cells(frame(spark, data).unionByName(odd))
    queries = frame(spark, data[:3], "query_id").unionByName(odd.withColumnRenamed("vec_id", "query_id"))
    assert found(cells.nearest_in_cells(store, queries, 4)) == dict(enumerate(brute(data, data[:3], 4)))


def test_rows_and_queries_without_direction(spark):
    data = clustered(40)
    data[[3, 7, 11]] = 0.0
    queries = np.vstack([data[:2], np.zeros((1, 12), "float32")])
    store = cells.store_cells(frame(spark, data), cells=5)
    for k in (6, 39, 100):
        assert found(cells.nearest_in_cells(store, frame(spark, queries, "query_id"), k)) == dict(enumerate(brute(data, queries, k)))
    empty = cells.store_cells(frame(spark, np.zeros((4, 3), "float32")))
    assert found(cells.nearest_in_cells(empty, frame(spark, np.ones((1, 3), "float32"), "query_id"), 2)) == {0: [0, 1]}


def test_a_third_of_all_vectors_equal(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 64)
    data = clustered(1800)
    data[::3] = data[0]
    store = cells.store_cells(frame(spark, data))
    assert store.blocks.agg(F.max("n")).first()[0] <= 64  # the hot cell is many blocks
    queries = np.vstack([data[:1], clustered(20, seed=4)])
    assert found(cells.nearest_in_cells(store, frame(spark, queries, "query_id"), 8)) == dict(enumerate(brute(data, queries, 8)))


def test_empty_tables(spark):
    none = frame(spark, clustered(2)).limit(0)
    store = cells.store_cells(none)
    assert cells.nearest_in_cells(store, none.withColumnRenamed("vec_id", "query_id"), 3).count() == 0
    full = cells.store_cells(frame(spark, clustered(20)))
    assert cells.nearest_in_cells(full, none.withColumnRenamed("vec_id", "query_id"), 3).count() == 0


def test_few_vectors_are_compared(spark):
    data = clustered(20_000, groups=60)
    store = cells.store_cells(frame(spark, data))
    queries = frame(spark, clustered(50, groups=60), "query_id")
    share = cells.compared_vectors(store, queries, 10).agg(F.sum("compared") / F.sum("vectors")).first()[0]
    assert share < 0.2


def test_the_given_vectors(spark):
    """Noise in 64 dimensions has no cells to speak of: the result stays exact, the share is what it is."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = np.array([r["embedding"] for r in vectors.orderBy("vec_id").collect()], dtype="float32")
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    store = cells.store_cells(vectors)
    got = found(cells.nearest_in_cells(store, queries, 10))
    expected = brute(data, data[::50], 10)
    assert got == {50 * at: ids for at, ids in enumerate(expected)}
    share = cells.compared_vectors(store, queries, 10).agg(F.sum("compared") / F.sum("vectors")).first()[0]
    print("compared", share)
    assert share <= 1.0
