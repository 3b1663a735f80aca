"""All tables are published or none, after one pass over each."""

import pytest
from pyspark.sql import functions as F

from gaugeline.sources import gate
from gaugeline.sources.versions import folders, versions


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, name string, age int")


def checks():
    return {"people": [gate.not_null("name"), gate.within("age", 0, 120), gate.accepted("id", [1, 2, 3])]}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failing_check_publishes_nothing(spark, tmp_path):
    folder = str(tmp_path / "gold")
    other = spark.range(4).toDF("n")
    report = gate.publish_checked({"people": people(spark, (1, "a", 5), (2, "b", None)), "other": other}, folder, checks())
    assert rows(report) == [("other", None, 4, 0, 1), ("people", "age_within", 2, 0, 1), ("people", "id_accepted", 2, 0, 1), ("people", "name_not_null", 2, 0, 1)]
    bad = people(spark, (1, None, 5), (9, "x", 130), (3, None, -1))
    report = gate.publish_checked({"people": bad, "other": other.filter("n > 1")}, folder, checks())
    assert rows(report) == [("other", None, 2, 0, None), ("people", "age_within", 3, 2, None), ("people", "id_accepted", 3, 1, None), ("people", "name_not_null", 3, 2, None)]
    assert versions(spark, folder) == [1]
    assert rows(gate.read_published(spark, folder, "people")) == [(1, "a", 5), (2, "b", None)]
    assert gate.read_published(spark, folder, "other").count() == 4


def test_tables_not_named_stay_published_and_versions_stay_readable(spark, tmp_path):
    folder = str(tmp_path / "gold")
    gate.publish_checked({"people": people(spark, (1, "a", 5)), "other": spark.range(4).toDF("n")}, folder, {})
    gate.publish_checked({"people": people(spark, (2, "b", 6))}, folder, checks())
    assert rows(gate.read_published(spark, folder, "people")) == [(2, "b", 6)]
    assert rows(gate.read_published(spark, folder, "people", 1)) == [(1, "a", 5)]
    assert gate.read_published(spark, folder, "other").count() == 4


def test_an_empty_load_publishes_nothing(spark, tmp_path):
    folder = str(tmp_path / "gold")
    report = gate.publish_checked({"people": people(spark, (1, "a", 5)).limit(0)}, folder, checks())
    assert {(r["n_rows"], r["version"]) for r in report.collect()} == {(0, None)} and versions(spark, folder) == []
    with pytest.raises(ValueError):
        gate.publish_checked({"people": people(spark, (1, "a", 5))}, folder, {"nobody": []})


def test_each_table_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(1000, numPartitions=4).withColumn("name", F.lit("x")).mapInPandas(counted, "id long, name string")
    gate.publish_checked({"t": df}, str(tmp_path / "gold"), {"t": [gate.not_null("name"), gate.within("id", 0, 999)]})
    assert reads.value == 1000 and len(folders(spark, str(tmp_path / "gold/data"))) == 1
