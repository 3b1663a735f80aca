"""Adjacency lists give the rows that all edges give, and a hot node stays small."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import graph

EDGES = "src_type string, src string, rel string, dst_type string, dst string"
PROPS = "map<string,string>"


def built(spark, seed=3, indicators=60, countries=12):
    chance = random.Random(seed)
    names = [("Indicator", f"I{i}") for i in range(indicators)] + [("Country", f"C{i}") for i in range(countries)]
    nodes = spark.createDataFrame([(kind, i, f"name {i}", None, {"name": i}) for kind, i in names], f"type string, id string, name string, topics string, properties {PROPS}")
    rows = [("Indicator", f"I{i}", "BELONGS_TO", "IndicatorCategory", f"K{chance.randrange(5)}") for i in range(indicators) for _ in range(chance.randrange(4))]
    rows += [("Country", f"C{c}", "HAS_INDICATOR", "Indicator", f"I{i}") for c in range(countries) for i in range(indicators) if c == 0 or chance.random() < 0.3]
    rows += [("Indicator", f"I{i}", "SOURCED_FROM", "DataTable", f"T{i % 3}") for i in range(0, indicators, 2)]
    rows += [("DataTable", f"T{t}", "CONTAINS", "DataColumn", f"T{t}.c{c}") for t in range(3) for c in range(4)]
    rows += [("DataColumn", f"T{a}.c{c}", "DERIVED_FROM", "DataColumn", f"T{b}.c{d}") for a in range(3) for b in range(a) for c in range(4) for d in range(2)]
    return nodes, spark.createDataFrame(list(dict.fromkeys(rows)), EDGES), rows


def ascending(values):
    return sorted(values) or [None]


def chain(rows, start, cap):
    """The first rows of the chain, by following every edge."""
    def far(node, rel, backward=False):
        return {(s if backward else d) for _, s, r, _, d in rows if r == rel and (d if backward else s) == node}
    found = []
    for cat in ascending(far(start, "BELONGS_TO")):
        for c in ascending(far(start, "HAS_INDICATOR", True)):
            for src in ascending(far(start, "SOURCED_FROM")):
                for col in ascending(far(src, "CONTAINS")):
                    one = far(col, "DERIVED_FROM")
                    for up in ascending(one.union(*[far(x, "DERIVED_FROM") for x in one])):
                        found.append((cat, c, src, col, up))
    return found[:cap]


@pytest.mark.parametrize("cap", [1, 7, 40])
def test_rows_equal_following_every_edge(spark, cap):
    nodes, edges, rows = built(spark)
    start = nodes.filter("type = 'Indicator'").select(F.col("id").alias("i"))
    lists = graph.store_lists(edges, 40)
    got = {}
    for r in graph.indicator_rows(nodes, edges, start, cap, lists).orderBy("i", "row_no").collect():
        got.setdefault(r["i"], []).append((r["cat"], r["c"], r["src"], r["col"], r["up"]))
    assert got == {f"I{i}": chain(rows, f"I{i}", cap) for i in range(60)}


def test_country_rows_equal_following_every_edge(spark):
    nodes, edges, rows = built(spark)
    start = nodes.filter("type = 'Country'").select(F.col("id").alias("c"))
    got = {}
    for r in graph.country_rows(nodes, edges, start, 30).orderBy("c", "row_no").collect():
        got.setdefault(r["c"], []).append((r["i"], r["cat"]))
    for c in (f"C{n}" for n in range(12)):
        near = ascending({d for _, s, rel, _, d in rows if rel == "HAS_INDICATOR" and s == c})
        pairs = [(i, cat) for i in near for cat in ascending({d for _, s, rel, _, d in rows if rel == "BELONGS_TO" and s == i})]
        assert got[c] == pairs[:30]


def test_too_short_lists_are_refused(spark):
    nodes, edges, _ = built(spark)
    with pytest.raises(ValueError):
        graph.country_rows(nodes, edges, nodes.select(F.col("id").alias("c")), 30, graph.store_lists(edges, 10))


def walk(node):
    """All physical operators under a node, query stages opened."""
    yield node
    name = node.getClass().getSimpleName()
    inner = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
    children = node.children()
    for child in inner or [children.apply(i) for i in range(children.size())]:
        yield from walk(child)


def test_a_country_with_a_third_of_all_edges_sends_on_few(spark):
    tasks, cap, count = 8, 40, 60_000
    pairs = spark.range(0, count, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 5000).cast("string"))).alias("node"),
        F.format_string("i%06d", "id").alias("far"))
    first = graph.first_neighbours(pairs, cap)
    found = {r["node"]: r["far"] for r in first.collect()}
    assert found["hot"] == [f"i{3 * i:06d}" for i in range(cap)]
    limits = [node for node in walk(first._jdf.queryExecution().executedPlan()) if node.getClass().getSimpleName() == "WindowGroupLimitExec"]
    passed = min(node.metrics().apply("numOutputRows").value() for node in limits)
    kept = pairs.filter("node <> 'hot'").count()
    assert passed <= kept + cap * tasks  # of the hot node's 20,000 rows, a cap's worth from each map task


def test_empty_graph(spark):
    nodes, edges, _ = built(spark)
    lists = graph.store_lists(edges.limit(0), 30)
    assert lists.rows.count() == 0
    rows = graph.country_rows(nodes, edges.limit(0), nodes.filter("type = 'Country'").select(F.col("id").alias("c")), 30, lists).collect()
    assert len(rows) == 12 and all(r["i"] is None and r["cat"] is None for r in rows)


def test_texts_of_one_small_file_are_searched_in_several_tasks(spark, tmp_path):
    """A single file is one scan task; the characters of its texts are compared in many."""
    spark.range(400).select("id", F.concat(F.lit("about item"), (F.col("id") % 7).cast("string"), F.lit(" and more")).alias("text")).coalesce(1).write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))
    terms = spark.createDataFrame([("item3",), ("item5 and",), ("none",)], "term string")
    got = graph.containing(texts, "text", terms, "term")
    assert {(r["id"], r["term"]) for r in got.collect()} == {(i, t) for i in range(400) for t, n in (("item3", 3), ("item5 and", 5)) if i % 7 == n}
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
