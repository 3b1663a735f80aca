"""Versions of stored data: a small manifest names the folders that make one up.

A writer puts new folders beside the old ones and then commits the manifest of
the next version by a rename that fails if that version is there. Until then
readers see the version before, and a writer that was overtaken is refused. Old
folders stay until ``drop_versions``.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"


class Overtaken(RuntimeError):
    """Another writer committed this version first."""


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, parent: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    files, path = _files(spark, parent), _path(spark, parent)
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def versions(spark: SparkSession, folder: str) -> list[int]:
    """All committed versions, ascending."""
    names = [name[: -len(".json")] for name in folders(spark, f"{folder}/{VERSIONS}") if name.endswith(".json")]
    return sorted(int(name) for name in names if name.isdigit())


def read_manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict:
    """The manifest of a version, by default the last."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{folder} has versions {known}, not {version}")
    name = f"{folder}/{VERSIONS}/{known[-1] if version is None else version:08d}.json"
    stream = _files(spark, folder).open(_path(spark, name))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, version: int, content: dict) -> dict:
    """Make ``content`` the manifest of ``version``; raises ``Overtaken`` if there is one."""
    manifest = {**content, "version": version}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft = _path(spark, f"{folder}/{VERSIONS}/.{uuid.uuid4().hex}")
    stream = _files(spark, folder).create(draft)
    try:
        stream.write(json.dumps(manifest).encode())
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    target = _path(spark, f"{folder}/{VERSIONS}/{version:08d}.json")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, target, options)
    except Py4JJavaError as error:
        _files(spark, folder).delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise Overtaken(f"version {version} of {folder} is there already") from error
        raise
    return manifest


def new_part(folder: str) -> str:
    """A folder name, relative to ``folder``, that no other write uses."""
    return f"data/{uuid.uuid4().hex}"


def write_part(rows: DataFrame, folder: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write rows to a fresh folder and return its relative name."""
    part = new_part(folder)
    rows.write.partitionBy(*partition_by).parquet(f"{folder}/{part}")
    return part


def named_parts(manifest: dict) -> set[str]:
    """The relative names of all folders that a manifest mentions, at any depth."""
    found: set[str] = set()
    waiting: list = [manifest]
    while waiting:
        item = waiting.pop()
        if isinstance(item, dict):
            waiting.extend(item.values())
        elif isinstance(item, list):
            waiting.extend(item)
        elif isinstance(item, str) and item.startswith("data/"):
            found.add(item.split("/")[1])
    return found


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Forget all but the last ``keep`` versions; returns how many folders that freed.

    Only folders that a forgotten version names and no kept one does are
    removed, so the folders of a write that has yet to commit are left alone.
    """
    known = versions(spark, folder)
    old, kept = known[:-keep], known[-keep:]
    used = set().union(*[named_parts(read_manifest(spark, folder, version)) for version in kept]) if kept else set()
    unused = set().union(*[named_parts(read_manifest(spark, folder, version)) for version in old]) - used if old else set()
    files = _files(spark, folder)
    for version in old:
        files.delete(_path(spark, f"{folder}/{VERSIONS}/{version:08d}.json"), False)
    for name in sorted(unused):
        files.delete(_path(spark, f"{folder}/data/{name}"), True)
    return len(unused)
