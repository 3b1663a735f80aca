"""Plans and results that must hold when one key has a third of all rows."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import scale, search
from gaugeline.operators.scale import deal_by
from gaugeline.operators.silver import clean_observations
from gaugeline.plans import adapt
from gaugeline.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    return spark.range(n, numPartitions=8).select(key.alias("key"), F.col("id"), (F.col("id") * 7919 % n).alias("order"))


def test_rows_per_key_are_cut_before_the_shuffle(spark):
    df = skewed(spark)
    top = scale.top_rows(df, ["key"], [F.col("order").desc()], 5)
    text = plan(top)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    hot = sorted((r["order"] for r in top.filter("key = 'hot'").collect()), reverse=True)
    everything = sorted((r["order"] for r in df.filter("key = 'hot'").collect()), reverse=True)
    assert hot == everything[:5]


def test_spread_join_equals_plain_join(spark):
    left, right = skewed(spark), spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), ("none", 4)], "key string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        spread = scale.spread_join(left, right, ["key"], ["id"], 8, how)
        plain = left.join(right, "key", how)
        assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0


def test_numbering_equals_one_window(spark):
    df = spark.range(5000, numPartitions=8).select(F.sha2((F.col("id") % 4000).cast("string"), 256).alias("code"), F.col("id").alias("tie"))
    found = scale.number_rows(df, "code", "n", ("tie",))
    assert found.schema["n"].dataType.simpleString() == "bigint"
    expected = {(c, t): n for n, (c, t) in enumerate(sorted((r["code"], r["tie"]) for r in df.collect()), 1)}
    assert {(r["code"], r["tie"]): r["n"] for r in found.collect()} == expected


def test_numbering_of_few_rows_nulls_and_none(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "code string")
    assert {r["code"]: r["n"] for r in scale.number_rows(df, "code", "n").collect()} == {None: 1, "a": 2, "b": 3}
    assert scale.number_rows(df.limit(0), "code", "n").collect() == []


def test_latest_row_of_a_hot_observation_key(spark):
    df = skewed(spark).select(
        F.lit("VNM").alias("country_code"), F.lit("Vietnam").alias("country_name"), F.col("key").alias("indicator_code"),
        F.col("key").alias("indicator_name"), F.lit(2020).cast("long").alias("year"), F.col("id").cast("double").alias("value"),
        F.timestamp_seconds("order").alias("_ingested_at"), F.lit("s").alias("_source"))
    out = clean_observations(df)
    assert plan(out).count("WindowGroupLimit") == 2
    last = {}
    for r in df.collect():
        last[r["indicator_code"]] = max(last.get(r["indicator_code"], (r["_ingested_at"], 0)), (r["_ingested_at"], r["value"]))
    assert {r["indicator_code"]: r["value"] for r in out.collect()} == {k: v for k, (_, v) in last.items()}


def test_one_country_reads_one_partition(spark):
    df = QUERIES["indicators_by_country"](spark, SF)
    fact_scan = [line for line in plan(df).splitlines() if "FileScan parquet" in line and "indicator_key" in line and "value" in line]
    assert fact_scan and all("dynamicpruningexpression(country_key" in line for line in fact_scan)


def test_filters_and_columns_reach_the_scan(spark):
    _, gold = adapt.order_star(spark, SF)
    text = plan(QUERIES["indicators_by_country"](spark, SF))
    assert "PushedFilters: [IsNotNull(country_code), EqualTo(country_code,NATION_3)" in text
    assert "region" not in text and "loaded_at" not in text
    assert gold.fact.columns[-1] == "loaded_at"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_tables_of_a_scope_are_removed_when_it_ends(spark, tmp_path):
    import os

    from gaugeline.session import materialize, new_table_path, table_scope

    def stored():
        folder = os.path.dirname(new_table_path(spark, "x"))
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    kept = materialize(spark.range(3).toDF("n"), "kept")
    before = stored()
    with table_scope(spark):
        inner = materialize(spark.range(5).toDF("n"), "inner")
        with table_scope(spark):
            materialize(inner, "innermost")
        assert len(stored() - before) == 1
        inner.write.parquet(str(tmp_path / "out"))
    assert stored() == before and kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_deal_by_count_of_what_rows_become(spark):
    """Few bytes that a join will repeat are dealt by what they become, and stay so."""
    rows = spark.range(1000).withColumnRenamed("id", "k")
    cores = spark.sparkContext.defaultParallelism
    assert deal_by(rows, ["k"], 10).rdd.getNumPartitions() == cores
    dealt = deal_by(rows, ["k"], 100 * cores, per_task=10)
    assert dealt.rdd.getNumPartitions() == 10 * cores
    assert dealt.groupBy("k").count().rdd.getNumPartitions() == 10 * cores


def test_search_deals_postings_by_what_the_queries_make_of_them(spark, monkeypatch):
    """A word of all rows that every query asks for counts once for each query and row."""
    asked = []
    monkeypatch.setattr(search, "deal_by", lambda df, keys, n: asked.append((keys, n)) or deal_by(df, keys, n, per_task=50))
    docs = spark.createDataFrame([(i, f"common word{i}") for i in range(40)], "doc_id long, text string")
    queries = spark.createDataFrame([(q, f"common word{q}") for q in range(30)], "query_id long, query string")
    hits = search.search(docs, queries, "doc_id", [("text", 1.0, "text")], k=2, fuzzy=False).collect()
    assert asked == [(["id"], 30 * 40 + 30)]
    assert len(hits) == 60 and {r["query_id"] for r in hits if r["rank"] == 1 and r["id"] == r["query_id"]} == set(range(30))
