"""Session settings, the shared work folder and table materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the sizing: coalescing small shuffle partitions,
# splitting skewed join partitions, and switching to a broadcast join once the
# real size of a side is known.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # "The first k of every key" is cut in the map tasks up to this k.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on disk, so that it may outgrow the memory of the executors.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "gaugeline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create (or fetch) a session with the settings this package is tuned for.

    ``shuffle_partitions`` is left to the cluster unless given; local runs pass
    a multiple of their cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster an unset folder is an error, because a machine-local path would not
    survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeline-"))
    return context.getCheckpointDir()


def new_table_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in a subfolder of this application.

    The subfolder can be removed once the application is done.
    """
    application = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are materialised inside, once the block is left.

    What the block is for must have been written or collected by then, to a
    path that was made outside of it; a DataFrame that still reads such a table fails.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for name in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage is cut by a real table, so a lost executor costs a re-read, not
    a recomputation, and later joins plan with the true file size: Spark
    broadcasts the table if it is under ``autoBroadcastJoinThreshold`` and
    shuffles it (with skew splitting) if it is not.
    """
    spark = df.sparkSession
    path = new_table_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
