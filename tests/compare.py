"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

As a script: ``python -m tests.compare [sf_dir] [query …]``.
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import tempfile
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
         "varchar": "string", "timestamp_ntz": "timestamp", "float": "double"}


def kind(name: str) -> str:
    name = name.lower()
    return KINDS.get(name, name)


def spark_rows(df):
    order = sorted(df.columns)
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    rows = sorted(tuple(cell(r[c]) for c in order) for r in df.collect())
    return order, [types[c] for c in order], rows


def duck_rows(con, statement):
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    kinds = [kind(str(d[1])) for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(cell(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], [kinds[i] for i in order], rows


def compare(spark, con, name, query, statement, sf_dir):
    """None when equal, else a short description of the difference."""
    columns, types, rows = spark_rows(query(spark, sf_dir))
    other_columns, other_types, other = duck_rows(con, statement)
    if columns != other_columns:
        return f"columns {columns} != {other_columns}"
    if len(rows) != len(other):
        return f"{len(rows)} rows != {len(other)}; first only here {next((r for r in rows if r not in set(other)), None)}"[:600]
    if rows != other:
        mine, theirs = set(rows), set(other)
        return f"{len(mine - theirs)} rows differ, e.g. {sorted(mine - theirs)[:1]} / {sorted(theirs - mine)[:1]}"[:1200]
    if types != other_types:
        return f"types {list(zip(columns, types, other_types))}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from gaugeline.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, **{
        "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        statement = entry.oracle_sql().get(name)
        start = time.time()
        try:
            if statement is None:
                outcome = f"rows only: {len(spark_rows(query(spark, sf_dir))[2])}"
            else:
                difference = compare(spark, con, name, query, statement, sf_dir)
                outcome = "ok" if difference is None else "DIFF " + difference
        except Exception as error:  # noqa: BLE001
            outcome = "FAIL " + type(error).__name__ + " " + str(error)[:700]
        bad += outcome.startswith(("DIFF", "FAIL"))
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
