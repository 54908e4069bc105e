"""Small JSON notes beside data, in any store Spark reaches: they say which folders count."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_note(spark: SparkSession, path: str) -> dict | None:
    fs, p = _store(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """Written under another name, then renamed over the old note: readers see one or the other."""
    fs, p = _store(spark, path)
    temp = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(temp, True)
    try:
        stream.write(json.dumps(note).encode())
    finally:
        stream.close()
    jvm = spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(temp), fs.makeQualified(p), over)


def remove(spark: SparkSession, path: str) -> None:
    """A folder of the writer's own that no reader is told of any more."""
    fs, p = _store(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, p = _store(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def has_data(spark: SparkSession, path: str) -> bool:
    fs, p = _store(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


# The note that names the published run of a folder of tables.
COMMITTED = "_publicado"


def committed_run(spark: SparkSession, root: str) -> str | None:
    return (read_note(spark, f"{root.rstrip('/')}/{COMMITTED}") or {}).get("run")


def committed_path(spark: SparkSession, path: str) -> str:
    """Where ``<root>/<table>`` stands: in the published run, if ``root`` has one with that table."""
    root, _, name = path.rstrip("/").rpartition("/")
    run = committed_run(spark, root) if root else None
    return f"{root}/{run}/{name}" if run and has_data(spark, f"{root}/{run}/{name}") else path
