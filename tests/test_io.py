"""Sources, sinks and landed responses."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gaugeline import session
from gaugeline.operators import chat
from gaugeline.schemas import CHUNKS, SEED_INDICATORS
from gaugeline.sources import landing, sinks, tables


def test_year_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "obs")
    first = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2020)], "v int, year long")
    sinks.write_by_year(first, path)
    sinks.write_by_year(spark.createDataFrame([(9, 2020)], "v int, year long"), path)
    stored = tables.read_observations(spark, path, first.schema)
    assert sorted((r["year"], r["v"]) for r in stored.collect()) == [(2019, 1), (2020, 9)]
    pruned = stored.filter("year = 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned
    files = tables.list_files(stored)
    assert files.agg(F.sum("n_rows")).first()[0] == 2 and files.filter("file_size > 0").count() == 2


def test_a_hot_year_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(200_000).select(
        F.concat(F.sha2(F.col("id").cast("string"), 256), F.sha2((-F.col("id")).cast("string"), 256)).alias("v"),
        F.when(F.col("id") % 3 == 0, 2000 + F.col("id") % 20).otherwise(2024).alias("year"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sinks.write_by_year(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = tables.list_files(spark.read.parquet(path))
    assert files.filter(F.col("file_path").contains("year=2024")).count() > 4
    assert files.agg(F.sum("n_rows")).first()[0] == 200_000


def test_empty_dataset_is_made_once(spark, tmp_path):
    path = str(tmp_path / "chunks")
    assert sinks.ensure_dataset(spark, path, CHUNKS) is True
    assert sinks.ensure_dataset(spark, path, CHUNKS) is False
    assert spark.read.parquet(path).schema == CHUNKS
    with pytest.raises(FileNotFoundError):
        tables.require_path(spark, str(tmp_path / "missing"))


def test_load_skips_empty_results(spark):
    loaded = []
    empty = spark.createDataFrame([], "x int")
    assert not sinks.run_load(lambda: empty, lambda d: d, loaded.append) and not loaded
    assert sinks.run_load(lambda: spark.range(2), lambda d: d.withColumn("y", F.lit(1)), loaded.append)
    assert loaded[0].columns == ["id", "y"]


def test_seed_csv(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("indicator_code,indicator_name,category,unit,frequency,description\nA,\"Name, long\",gdp,USD,annual,\n")
    row = tables.read_seed(spark, str(path), SEED_INDICATORS).first()
    assert row["indicator_name"] == "Name, long" and row["description"] is None


def test_publish_to_tables_and_reconcile(spark):
    source = {"t_one": spark.range(3), "t_two": spark.range(5)}
    sinks.publish(source, sinks.table_writer())
    assert {"t_one", "t_two"} <= set(tables.list_tables(spark))
    target = {n: spark.table(n) for n in source}
    out = sinks.reconcile(sinks.row_counts(source), sinks.row_counts(target))
    assert out.filter("difference <> 0").count() == 0
    short = sinks.reconcile(sinks.row_counts(source), sinks.row_counts({"t_one": spark.range(2)}))
    assert {r["table_name"]: r["difference"] for r in short.collect()} == {"t_one": 1, "t_two": 5}
    for name in source:
        spark.sql(f"drop table {name}")


def test_keyed_overwrite(spark, tmp_path):
    path = str(tmp_path / "rows")
    sinks.upsert_dataset(spark, path, spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), ["k"])
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", 1)], "k string, v int")
    sinks.upsert_dataset(spark, path, new, ["k"], [F.col("v").desc()])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 3), ("c", 1)]


def test_sessions(spark):
    known = "9d5ed678-fe57-bcca-6101-40957afab571"
    requests = spark.createDataFrame([(known.upper(), "q1"), (None, "q2"), ("nonsense", "q3")], "session_id string, query string")
    assigned = sinks.new_sessions(requests)
    sessions, messages = sinks.session_rows(assigned).collect(), sinks.message_rows(assigned).collect()
    assert {m["content"]: m["session_id"] for m in messages}["q1"] == known
    assert len(sessions) == 2 and all(s["title"] == "Chat " + s["id"][:8] for s in sessions)
    assert {s["id"] for s in sessions} == {m["session_id"] for m in messages} - {known}
    assert chat.unknown_roles(sinks.message_rows(assigned, "robot")).count() == 3


def test_answers_are_delivered_with_a_note(spark):
    answers = spark.createDataFrame([(1, "x" * 100), (2, "has the NOTE already")], "id int, text string")
    out = chat.deliver(answers, marker="NOTE", note=" --NOTE").orderBy("id", "piece_no").collect()
    assert [len(r["piece"]) for r in out if r["id"] == 1] == [80, 20, 7]
    assert [r["piece"] for r in out if r["id"] == 2] == ["has the NOTE already"]
    noted = answers.select(chat.with_note(F.col("text"), "NOTE", "!").alias("t")).collect()
    assert noted[0]["t"].endswith("x!") and noted[1]["t"].endswith("already")


def test_landed_observations(spark):
    bodies = [{"economy": "VNM", "series": "A", "time": "YR2020", "value": 1.5}, {"economy": "XXX", "series": "B", "time": "YR2021", "value": 2},
              {"economy": "VNM", "series": "A", "time": "YR2022", "value": None}]
    entries = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    names = spark.createDataFrame([("VNM", "Vietnam")], "code string, name string")
    series = spark.createDataFrame([("A", "Alpha")], "code string, name string")
    rows = landing.normalise_observations(entries, names, series).orderBy("year").collect()
    assert [(r["country_name"], r["indicator_name"], r["year"], r["value"]) for r in rows] == [
        ("Vietnam", "Alpha", 2020, 1.5), ("XXX", "B", 2021, 2.0)]
    assert rows[0]["_ingested_at"] is not None


def test_landed_documents_keep_the_first_sighting(spark):
    def page(**docs):
        return json.dumps({"total": len(docs), "documents": docs})

    pages = spark.createDataFrame([
        (0, 0, page(d1={"display_title": " A \n b ", "abstracts": {"x": "short", "y": "long  enough text"}, "display_date": "",
                        "docdt": "2020", "count": ["Laos", "Peru"], "lang": "en"}, d2={"display_title": "two", "count": "Laos"})),
        (0, 1, page(d3={"display_title": "three"})),
        (1, 0, page(d1={"display_title": "again"}, d4={"display_title": "four"})),
    ], "query_no int, page int, body string")
    rows = {r["doc_id"]: r for r in landing.normalise_documents(pages).collect()}
    assert rows["d1"]["title"] == "A b" and rows["d1"]["abstract"] == "long enough text"
    assert rows["d1"]["display_date"] == "2020" and rows["d1"]["countries"] == "Laos;Peru"
    assert rows["d2"]["countries"] == "Laos" and rows["d3"]["abstract"] == "" and len(rows) == 4
    assert [r["doc_id"] for r in landing.normalise_documents(pages, max_results=3).orderBy("doc_id").collect()] == ["d1", "d2", "d3"]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_table_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_recent_chat(spark):
    day = dt.datetime(2024, 1, 1)
    messages = spark.createDataFrame(
        [(f"s{i}", "user", "y" * 80, day + dt.timedelta(minutes=i)) for i in range(8)],
        "session_id string, role string, content string, created_at timestamp")
    out = chat.recent_messages(messages).collect()
    assert [r["session_id"] for r in out] == ["s7", "s6", "s5", "s4", "s3"] and len(out[0]["content"]) == 50


def test_upsert_without_order_is_determinate_and_null_safe(spark):
    old = spark.createDataFrame([(None, 1), ("a", 1), ("b", 1)], "k string, v int")
    rows = [(None, 5), ("a", 7), ("a", 3), ("a", 9)]
    found = {
        tuple(sorted(map(str, map(tuple, sinks.upsert(old, spark.createDataFrame(rows[n:] + rows[:n], "k string, v int").repartition(n + 1), ["k"]).collect()))))
        for n in range(4)}
    assert len(found) == 1 and len(found.pop()) == 3
