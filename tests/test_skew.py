"""Queries on data in which one key, day, text or vector makes up a third of the rows."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
HOT = {
    "orders": """SELECT o_orderkey, CASE WHEN hot THEN 7 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
        CASE WHEN hot THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate,
        CASE WHEN hot THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
        FROM (SELECT *, o_orderkey % 3 = 0 AS hot FROM orders)""",
    "lineitem": """SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM lineitem""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-03 10:00:30' ELSE ts END AS ts,
        CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN 'error' ELSE event_type END AS event_type) FROM events""",
    "documents": """SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM documents WHERE doc_id = 17) ELSE text END AS text,
        CASE WHEN doc_id % 3 = 0 THEN 'src3' ELSE source END AS source) FROM documents""",
    "embeddings": """SELECT * REPLACE (CASE WHEN vec_id % 3 = 0 THEN (SELECT embedding FROM embeddings WHERE vec_id = 3) ELSE embedding END AS embedding,
        CASE WHEN vec_id % 3 = 0 THEN 4 ELSE label END AS label) FROM embeddings""",
}
NAMES = [
    "silver_dedup", "fact_load", "fact_load_trade", "fact_latest", "dq_unique", "dq_relationships", "dq_suite", "conflict_view",
    "partition_summary", "normalise_documents", "chunk_documents", "chunk_stats", "bm25_documents", "vector_topk", "rrf_fusion",
    "graph_edges", "graph_expand", "assemble_context", "rate_per_minute", "increase_5m", "p95_window", "rate_limit_violations",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(SF)
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"COPY ({HOT.get(name, f'SELECT * FROM {name}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_data(spark, skewed, name):
    folder, con = skewed
    assert isinstance(con, duckdb.DuckDBPyConnection)
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], folder) is None
