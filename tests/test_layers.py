"""Nodes are built after what they refer to, and wrong references are found before anything runs."""

import pytest
from pyspark.sql import functions as F

from gaugeline.plans.layers import CircularReference, Layers, UnknownReference, sql_node


def numbers(spark):
    layers = Layers({"raw": spark.range(10).toDF("n")})

    @layers.add("mart", ("both", "stg"), "marts")
    def mart(ref):
        return ref("both").join(ref("stg"), "n").select("n", "twice", "odd")

    @layers.add("both", ("stg",), "intermediate")
    def both(ref):
        return ref("stg").withColumn("twice", F.col("n") * 2).drop("odd")

    @layers.add("stg", ("raw",))
    def stg(ref):
        return ref("raw").withColumn("odd", F.col("n") % 2 == 1)

    return layers


def test_order_and_kinds(spark):
    layers = numbers(spark)
    assert [node.name for node in layers.order()] == ["stg", "both", "mart"]
    assert [node.name for node in layers.order(["both"])] == ["stg", "both"]
    found = layers.build(prefix="t_")
    assert sorted(map(tuple, found["mart"].collect())) == [(n, 2 * n, n % 2 == 1) for n in range(10)]
    assert "parquet" in found["mart"]._jdf.queryExecution().toString() and "parquet" not in found["both"]._jdf.queryExecution().toString()
    assert spark.sql("SELECT sum(twice) FROM t_mart").first()[0] == 90


def test_sql_nodes(spark):
    layers = numbers(spark)
    layers.add("total", ("mart",), "marts")(sql_node(spark, "SELECT sum(twice) AS s FROM {{mart}} WHERE odd", "u_"))
    assert layers.build(["total"], prefix="u_")["total"].first()["s"] == 50


def test_wrong_references(spark):
    layers = numbers(spark)
    layers.add("lost", ("nowhere",))(lambda ref: ref("nowhere"))
    with pytest.raises(UnknownReference):
        layers.order()
    assert [node.name for node in layers.order(["mart"])] == ["stg", "both", "mart"]
    layers = numbers(spark)
    layers.add("a", ("b",))(lambda ref: ref("b"))
    layers.add("b", ("a",))(lambda ref: ref("a"))
    with pytest.raises(CircularReference):
        layers.order()
    layers = numbers(spark)
    layers.add("sly", ("stg",))(lambda ref: ref("raw"))
    with pytest.raises(UnknownReference):
        layers.build(["sly"])
    layers.add("stg", ())(lambda ref: None)
    with pytest.raises(ValueError):
        layers.order()
