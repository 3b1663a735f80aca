"""Publishing behind checks: rows are counted while they are written, and published only if all checks pass.

Tables are written to fresh folders. Spark's observation metrics count every check's
failing rows during that one pass, so nothing is read again. Only if no check fails
does one commit make all tables the published ones; otherwise readers keep the version before.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sources.versions import commit, read_manifest, versions, write_part

REPORT = "table_name string, check_name string, n_rows long, n_failing long, version int"


@dataclass(frozen=True)
class RowCheck:
    """``fails`` is true for a row that must not be published; null counts as false."""

    name: str
    fails: Column


def not_null(column: str) -> RowCheck:
    return RowCheck(f"{column}_not_null", F.col(column).isNull())


def accepted(column: str, values: list) -> RowCheck:
    """A null is not among the values, but is left to ``not_null``."""
    return RowCheck(f"{column}_accepted", ~F.col(column).isin(*values))


def within(column: str, low, high) -> RowCheck:
    return RowCheck(f"{column}_within", ~F.col(column).between(low, high))


def write_observed(df: DataFrame, folder: str, checks: list[RowCheck]) -> tuple[str, int, dict[str, int]]:
    """Write a table to a fresh folder; its name, rows, and failing rows by check."""
    seen = Observation()
    counted = [F.count_if(F.coalesce(check.fails, F.lit(False))).alias(f"check_{at}") for at, check in enumerate(checks)]
    part = write_part(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counted), folder)
    found = seen.get
    return part, found["n_rows"], {check.name: found[f"check_{at}"] for at, check in enumerate(checks)}


def publish_checked(tables: dict[str, DataFrame], folder: str, checks: dict[str, list[RowCheck]]) -> DataFrame:
    """Publish all tables or none; one row for each check, and for each table without any (check_name null).

    ``version`` is the version that was published, null if none was: a check
    failed, or all tables are empty. Tables that are published and not named stay published.
    """
    spark = next(iter(tables.values())).sparkSession
    unknown = set(checks) - set(tables)
    if unknown:
        raise ValueError(f"checks of tables that are not published: {sorted(unknown)}")
    written = {name: write_observed(df, folder, checks.get(name, [])) for name, df in tables.items()}
    version = None
    if any(n for _, n, _ in written.values()) and not any(n for _, _, failing in written.values() for n in failing.values()):
        known = versions(spark, folder)
        before = read_manifest(spark, folder)["tables"] if known else {}
        new = {name: {"part": part, "rows": n, "schema": tables[name].schema.json()} for name, (part, n, _) in written.items()}
        version = commit(spark, folder, known[-1] + 1 if known else 1, {"tables": {**before, **new}})["version"]
    rows = [(name, check, n, failing.get(check, 0), version)
            for name, (_, n, failing) in written.items() for check in (list(failing) or [None])]
    return spark.createDataFrame(rows, REPORT)


def read_published(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    """A published table, by default of the last version."""
    entry = read_manifest(spark, folder, version)["tables"][name]
    return spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{folder}/{entry['part']}")
