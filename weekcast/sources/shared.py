"""Shared folder for tables written between stages."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from weekcast.sources.files import write_table

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one named by ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; on a cluster
    it is an error, because executors could not see a folder of one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="weekcast-")
        root = _local_folders[app]
    return f"{root.rstrip('/')}/weekcast-{uuid.uuid4().hex}"


def write_stage(
    df: DataFrame,
    folder: str,
    name: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    cluster_by: Column | None = None,
) -> DataFrame:
    """Write a stage as a parquet table and return a scan of it.

    This ends the lineage: later stages read only the columns they need, and a
    lost executor costs a re-read instead of a recomputation from the sources.
    Every attempt writes to a path of its own, so a failed one blocks nothing.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    write_table(df, path, "errorifexists", partition_by, sort_by, cluster_by)
    scan = df.sparkSession.read.schema(df.schema).parquet(path)
    return scan.select(*df.columns) if partition_by else scan


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a writer here made, through the file system it lies in."""
    found, system = _path(spark, path)
    system.delete(found, True)


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file, such as a commit."""
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def commit_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole, or not at all where the name is taken; returns whether it was written.

    A local name is taken by a hard link, others by a rename, which a distributed file system
    refuses for an existing target.
    """
    folder, name = path.rsplit("/", 1)
    target, system = _path(spark, path)
    parent = target.getParent()
    system.mkdirs(parent)
    if system.exists(target):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    real = system.resolvePath(parent).toUri()
    if real.getScheme() != "file":
        return bool(system.rename(draft, target))
    try:
        os.link(f"{real.getPath()}/{draft.getName()}", f"{real.getPath()}/{name}")
        return True
    except FileExistsError:
        return False
    finally:
        system.delete(draft, False)


def identity(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the tables in a folder: changes when one of them is written anew."""
    found, system = _path(spark, folder)
    entries = []
    for table in system.listStatus(found):
        parts = system.listStatus(table.getPath()) if table.isDirectory() else [table]
        entries += [(p.getPath().toString(), p.getLen(), p.getModificationTime()) for p in parts]
    return hashlib.sha256(repr(sorted(entries)).encode()).hexdigest()


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it does not exist."""
    found, system = _path(spark, folder)
    return [e.getPath().getName() for e in system.listStatus(found)] if system.exists(found) else []
