"""Raw tables landed in buckets of their record id, so that deduplicating them needs no exchange.

Rows of one id are in one bucket, also of rows that are appended later, so the window of Q1-Q3 runs
inside buckets; joins on the id don't move the rows either. Worth it for tables that are
deduplicated again and again: the shuffle is paid once, when rows land. The layout stands in a note
beside the data, so any session can read it, whatever its catalog knows.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flotilla.notes import read_note, write_note

NOTE = "_cubos"


class LayoutError(ValueError):
    pass


def _table(spark: SparkSession, path: str, note: dict) -> str:
    """The catalog's name for the folder; registered if the catalog doesn't have it."""
    name = f"flotilla_cubos_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        columns = StructType.fromJson(note["schema"])
        spark.sql(f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns)}) USING parquet "
                  f"CLUSTERED BY (`{note['key']}`) SORTED BY (`{note['key']}`) INTO {note['buckets']} BUCKETS LOCATION '{path}'")
    return name


def land(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Append ``df`` to the folder ``path``, bucketed by ``key`` (null ids are one bucket). The first
    landing fixes columns, key and number of buckets; another layout is refused."""
    spark, path = df.sparkSession, path.rstrip("/")
    mine = {"key": key, "buckets": buckets, "schema": json.loads(df.select(*df.columns).schema.json())}
    there = read_note(spark, f"{path}/{NOTE}")
    if there is None:
        write_note(spark, f"{path}/{NOTE}", mine)
    elif (there["key"], there["buckets"]) != (key, buckets) or \
            [(f["name"], f["type"]) for f in there["schema"]["fields"]] != [(f["name"], f["type"]) for f in mine["schema"]["fields"]]:
        raise LayoutError(f"{path} is landed with another layout: key {there['key']}, {there['buckets']} buckets, other columns or types")
    name = _table(spark, path, there or mine)
    # one task for each bucket, so that a landing adds one file to each
    df.repartition(buckets, key).write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The rows landed at ``path``, with their buckets known to the planner."""
    path = path.rstrip("/")
    note = read_note(spark, f"{path}/{NOTE}")
    if note is None:
        raise FileNotFoundError(f"nothing is landed at {path}")
    name = _table(spark, path, note)
    spark.catalog.refreshTable(name)
    return spark.table(name)
