"""The whole retrieval batch on the seed indicators, with branches failing or off."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.operators import graph, vector
from gaugeline.plans import retrieval
from gaugeline.plans.medallion import build_star
from gaugeline.schemas import OBSERVATIONS

QUESTIONS = [(1, "Lạm phát Việt Nam 2021"), (2, "So sánh dân số Việt Nam"), (3, "zzzzqqqq")]


@pytest.fixture(scope="module")
def world(spark):
    rows = [("VNM", "Vietnam", code, code, year, value, dt.datetime(2024, 1, 1), "world_bank")
            for code, base in (("FP.CPI.TOTL.ZG", 3.5), ("SP.POP.TOTL", 97000000.0)) for year, value in ((2020, base), (2021, base + 1))]
    _, gold = build_star(spark.createDataFrame(rows, OBSERVATIONS))
    nodes = graph.country_nodes(gold.dim_countries).unionByName(graph.indicator_nodes(gold.dim_indicators)).unionByName(
        graph.category_nodes(gold.dim_indicators))
    edges = graph.category_edges(gold.dim_indicators).unionByName(
        graph.country_indicator_edges(gold.fact, gold.dim_countries, gold.dim_indicators))
    queries = spark.createDataFrame(QUESTIONS, "query_id long, query string")
    indicators = gold.dim_indicators
    texts = indicators.select(
        F.col("indicator_key").alias("row_id"), F.col("indicator_code").alias("source_id"), F.lit("indicator").alias("source_type"),
        F.to_json(F.struct(F.col("indicator_name").alias("name"))).alias("metadata"),
        vector.indicator_text(F.col("indicator_code"), F.col("indicator_name"), F.col("category"), F.col("description")).alias("text"))
    vectors = vector.embed_hashed(texts)
    asked = vector.embed_hashed(queries.withColumnRenamed("query", "text")).filter("query_id < 3").select("query_id", "embedding")
    return queries, indicators, vectors, asked, graph.store_nodes(nodes), edges, gold


def run(world, **options):
    return {r["query_id"]: r for r in retrieval.retrieve(*world, **options).collect()}


def test_questions_get_context_and_facts(world):
    rows = run(world)
    assert "Code: FP.CPI.TOTL.ZG" in rows[1]["context"]
    assert "FACT: Vietnam - Inflation CPI (annual %) (2021): 4.5 %" in rows[1]["context"]
    assert "(2020)" not in rows[1]["context"].split(fv.FACTS_HEADING)[1]
    assert "FACT: Vietnam - Population total (2020): 97,000,000.0 People" in rows[2]["context"]  # latest only: no comparison word
    assert rows[1]["n_nodes"] > 5


def test_comparison_lists_all_years(world, spark):
    queries = spark.createDataFrame([(2, "So sánh xu hướng population Việt Nam")], "query_id long, query string")
    out = retrieval.retrieve(queries, *world[1:], use=("lexical",)).first()["context"]
    assert out.index("(2020): 97,000,000.0 People") < out.index("(2021): 97,000,001.0 People")


def test_no_hit_gives_the_message(world):
    rows = run(world, use=("lexical",))
    assert rows[3]["context"] == fv.NO_CONTEXT_MESSAGE and rows[3]["n_nodes"] == 0


def test_a_failing_branch_raises_unless_degrading_is_asked_for(world):
    broken = list(world)
    broken[2] = broken[2].withColumn("embedding", F.expr("raise_error('no vectors')").cast("array<float>"))
    broken[5] = broken[0]  # has no edge columns
    with pytest.raises(PySparkException):
        retrieval.retrieve(*broken).collect()
    rows = {r["query_id"]: r for r in retrieval.retrieve(*broken, degrade=True).collect()}
    assert rows[1]["failed_branches"] == ["semantic", "graph"]
    alone = run(world, use=("lexical",))
    assert rows[1]["context"] == alone[1]["context"]
