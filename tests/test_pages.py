"""Pages equal slices of the sorted rows, wherever they lie, and read little."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import pages
from tests.test_lists import walk

ORDER = [("code", False), ("year", True), ("n", False)]


def given(count=5000, seed=3):
    chance = random.Random(seed)
    return [(chance.choice([None, "a", "b", "c", "hot", "hot", "hot"]), chance.choice([None, 1999, 2000, 2005]), n) for n in range(count)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "code string, year int, n int").repartition(6)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0), r[2]))


def test_pages_and_keys_equal_slices(spark, tmp_path):
    rows, folder = given(), str(tmp_path / "p")
    pages.store_sorted(frame(spark, rows), folder, ORDER, stride=300)
    expected = ordered(rows)
    for page_no, size in [(1, 50), (7, 333), (100, 50), (101, 50), (2, 4999), (1, 9000)]:
        found = [tuple(r) for r in pages.read_page(spark, folder, page_no, size).collect()]
        assert found == [(*row, 5000) for row in expected[(page_no - 1) * size:page_no * size]]
    for at in (0, 1, 299, 300, 2500, 4998, 4999):
        key = dict(zip(("code", "year", "n"), expected[at]))
        assert [tuple(r) for r in pages.read_after(spark, folder, key, 40).collect()] == expected[at + 1:at + 41]
    before_all = {"code": None, "year": 9999, "n": -1}
    assert [tuple(r) for r in pages.read_after(spark, folder, before_all, 5).collect()] == expected[:5]
    between = {"code": "bb", "year": 2000, "n": 0}
    assert [tuple(r) for r in pages.read_after(spark, folder, between, 5).collect()] == [r for r in expected if (r[0] or "") > "bb"][:5]


def scanned(df):
    df.collect()
    return sum(node.metrics().apply("numOutputRows").value() for node in walk(df._jdf.queryExecution().executedPlan())
               if node.getClass().getSimpleName() == "FileSourceScanExec")


def test_a_late_page_reads_as_little_as_the_first(spark, tmp_path):
    folder = str(tmp_path / "p")
    df = spark.range(400_000).select(F.format_string("c%07d", F.pmod(F.hash("id"), F.lit(1000))).alias("code"), F.lit(1).alias("year"), F.col("id").alias("n"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages.store_sorted(df, folder, ORDER)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    first, late = (scanned(pages.read_page(spark, folder, page_no, 100)) for page_no in (1, 3900))
    assert 0 < first <= 100_000 and 0 < late <= 100_000  # a part of eight, not the whole table


def test_versions_empty_tables_and_bad_pages(spark, tmp_path):
    folder = str(tmp_path / "p")
    pages.store_sorted(frame(spark, []), folder, ORDER)
    assert pages.read_page(spark, folder, 1, 10).collect() == []
    assert pages.read_after(spark, folder, {"code": "a", "year": 1, "n": 1}, 10).collect() == []
    pages.store_sorted(frame(spark, given(10)), folder, ORDER)
    assert pages.read_page(spark, folder, 1, 50).count() == 10 and pages.read_page(spark, folder, 1, 50, version=1).count() == 0
    with pytest.raises(ValueError):
        pages.read_page(spark, folder, 0, 10)
