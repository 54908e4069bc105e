"""Streaming sources that yield topic-shaped records ``(key, value, timestamp)``.

The broker connector is only a format name away: ``kafka_records`` needs the Kafka package
on the class path (it is not bundled with PySpark). Files with the same three columns, or any
table projected to them, drive the very same pipeline in tests and backfills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flotilla import schemas as S


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """The source's options. Offsets that expired unread stop the query, unless
    ``fail_on_data_loss`` is false: then it goes on without those records."""
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets,
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out


def kafka_records(spark: SparkSession, bootstrap: str, topic: str, **options) -> DataFrame:
    """Subscribe to one topic (``options`` as for ``kafka_options``). Offsets live in the query
    checkpoint, so a restart resumes where it stopped."""
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **options))
    return reader.load().select("key", "value", "timestamp")


def file_records(spark: SparkSession, path: str, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    """A folder of record files (``key``, ``value``, ``timestamp``) as a stream."""
    reader = spark.readStream.schema(S.KEYED_RECORD).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def table_stream(spark: SparkSession, path_glob: str, schema: StructType,
                 max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Any file table as a stream (a glob may name single files)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path_glob)
