"""The format of landed pages: batches, conditions, streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

from gaugeline.sources import landed_pages as lp

PAGES = [(q, p, '{"documents": {"%d-%d": {"display_title": "Größe\\n%d"}}}' % (q, p, p)) for q in range(3) for p in range(12)]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "landed")
    lp.write_pages(spark.createDataFrame(PAGES, lp.SCHEMA), path)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_batch_reads_every_page_once(spark, folder, size):
    read = lp.read_landed(spark, folder, size)
    assert rows(read) == sorted(PAGES)
    assert read.rdd.getNumPartitions() == -(-len(PAGES) // size)


def test_conditions_leave_out_files(spark, folder):
    reader = lp.PageReader(folder, 1)
    left = list(reader.pushFilters([
        EqualTo(("query_no",), 1), GreaterThan(("page",), 3), LessThanOrEqual(("page",), 5),
        In(("page",), (4, 9)), IsNotNull(("body",)), EqualTo(("body",), "x")]))
    assert left == [IsNotNull(("body",)), EqualTo(("body",), "x")]
    assert [(p.query_no, p.page) for part in reader.partitions() for p in part.pages] == [(1, 4)]
    picked = lp.read_landed(spark, folder, 1).filter((F.col("query_no") == 2) & (F.col("page") >= 10))
    assert rows(picked) == [r for r in PAGES if r[0] == 2 and r[1] >= 10]
    assert picked.rdd.getNumPartitions() == 2
    assert rows(lp.read_landed(spark, folder).filter("query_no <> 2 and body is not null")) == [r for r in PAGES if r[0] != 2]


def test_nothing_landed(spark, tmp_path):
    assert rows(lp.read_landed(spark, str(tmp_path / "none"))) == []


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    path, out, progress = (str(tmp_path / name) for name in ("landed", "out", "progress"))
    df = spark.createDataFrame(PAGES, lp.SCHEMA)
    for arrived in ("query_no = 0 and page < 5", "query_no = 0 and page >= 5 or query_no = 2", "false", "query_no = 1"):
        lp.write_pages(df.filter(arrived), path)
        lp.stream_landed(spark, path, 4).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.schema(lp.SCHEMA).parquet(out)) == sorted(PAGES)
