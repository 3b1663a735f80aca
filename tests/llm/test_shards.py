import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import shards
from tests.llm.corpora import TABLES, frame, odd_rows


def brute_shard(key, weights):
    name = "-" if key is None else str(key)
    waits = []
    for shard, weight in enumerate(weights):
        share = (int(hashlib.md5(f"{name}:{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
        waits.append((-math.log(share) / weight, shard))
    return min(waits)[1]


def brute_report(rows):
    by_shard = defaultdict(list)
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        shard = brute_shard(doc_id, [1] * 16)
        by_shard[shard].append((doc_id, len(data) + 1, zlib.crc32(data), "key", shard, brute_shard(doc_id, [1] * 17)))
    found = []
    for members in by_shard.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found += [(*row[:5], slot, row[5]) for slot, row in enumerate(members)]
    return Counter(found)


def test_report_equals_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    assert Counter(map(tuple, shards.shard_report(frame(spark, rows)).collect())) == brute_report(rows)


def test_a_hot_repeated_row_gets_a_slot_each(spark):
    rows = [(i, f"text {i}", "en", "a") for i in range(200)] + [(500, "same", "en", "a")] * 150
    found = shards.shard_report(frame(spark, rows, 7)).collect()
    assert Counter(map(tuple, found)) == brute_report(rows)
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_empty_table(spark):
    empty = frame(spark, [(1, "x", "en", "a")]).limit(0)
    assert shards.shard_report(empty).collect() == []
    assert shards.assign(empty).collect() == [] and shards.moves(empty, [1], [1, 1]).collect() == []


def test_shares_follow_weights_and_a_further_shard_only_takes(spark):
    keys = spark.range(6000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 5.0]
    held = {r["shard"]: r["count"] for r in shards.assign(keys, weights).groupBy("shard").count().collect()}
    for shard, weight in enumerate(weights):
        assert abs(held[shard] / 6000 - weight / 8) < 0.02
    grown = shards.moves(keys, weights, [*weights, 2.0]).collect()
    assert {r["to_shard"] for r in grown} == {3}
    assert abs(len(grown) / 6000 - 0.2) < 0.02
    shrunk = shards.moves(keys, weights, weights[:2]).collect()
    assert {r["from_shard"] for r in shrunk} == {2} and len(shrunk) == held[2]
    heavier = shards.moves(keys, weights, [1.0, 2.0, 6.0]).collect()
    assert {r["to_shard"] for r in heavier} == {2}  # more weight only draws rows in


def test_weights_must_be_above_zero(spark):
    for weights in ([], [1.0, 0.0], [-1.0]):
        with pytest.raises(ValueError):
            shards.shard_of(F.lit(1), weights)


def test_clashing_names_are_kept(spark):
    docs = frame(spark, odd_rows()).withColumn("shard", F.lit("mine"))
    found = shards.assign(docs)
    assert found.columns == [*docs.columns, "_shard"] and {r["shard"] for r in found.collect()} == {"mine"}


def test_written_shards_hold_all_rows_sorted(spark, tmp_path):
    rows = [r for r in odd_rows()] + [(i, f"t{i}", "en", "a") for i in range(100, 400)]
    docs = frame(spark, rows, 5)
    shards.write_shards(docs, str(tmp_path / "out"), [1.0, 3.0])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(str, back.select(*docs.columns).collect())) == Counter(map(str, docs.collect()))
    assert all(r["shard"] == brute_shard(r["doc_id"], [1.0, 3.0]) for r in back.collect())


def test_only_column_expressions(spark, capsys):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    shards.shard_report(docs).explain("formatted")
    shards.assign(docs).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan
