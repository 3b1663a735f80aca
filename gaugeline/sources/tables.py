"""Readers and listings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_observations(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All partitions of a ``year=…`` Parquet layout; a year filter prunes files."""
    return spark.read.schema(schema).parquet(base)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a scan that has fewer splits than there are cores.

    For a large table, which has splits enough, this changes nothing. A small
    one is spread by a hash of ``key`` before work that is heavy on the
    processor.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, typed by ``schema``."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def list_files(df: DataFrame) -> DataFrame:
    """Files behind a DataFrame with size, modification time and row count."""
    meta = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )
    return meta.groupBy("file_path", "file_size", "modified_at").agg(F.count("*").alias("n_rows"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something to read at ``path``."""
    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return path


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]
