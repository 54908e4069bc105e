"""Batch sinks. Each write replaces the whole table (O1) and is atomic per job commit.

``publish_counted`` attaches a row count to the write itself (``df.observe``), so a
data-quality number costs no second job over the data (A6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def publish(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
            partition_by: Sequence[str] | None = None, **options) -> None:
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def publish_observed(df: DataFrame, path: str, name: str, metrics: dict[str, Column], **kw) -> dict[str, int]:
    """Write ``df`` and return ``rows``, the number of rows written, and other aggregates over them,
    all computed during the write."""
    obs = Observation(name)
    publish(df.observe(obs, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]), path, **kw)
    return {k: int(v or 0) for k, v in obs.get.items()}


def publish_counted(df: DataFrame, path: str, name: str, **kw) -> int:
    """Write ``df`` and return how many rows were written, counted during the write."""
    return publish_observed(df, path, name, {}, **kw)["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    """O2: CSV with a header row."""
    publish(df, path, fmt="csv", header=True)


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines."""
    publish(df, path, fmt="json")


def write_topic(records: DataFrame, bootstrap: str, topic: str) -> None:
    """O8 in batch: publish ``key``/``value`` records (``operators.events.encode_events``).

    Needs the Kafka package on the class path; the records are the same as the stream form's.
    """
    from flotilla.sinks.stream import topic_options
    records.select("key", "value").write.format("kafka").options(**topic_options(bootstrap, topic)).save()
