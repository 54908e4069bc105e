"""Streaming sinks, each a named query with its own checkpoint.

A name and an explicit ``checkpointLocation`` per query mean a restart resumes from its own
offsets and state. What a folder holds is tied to the checkpoint that wrote it: file sinks skip
batch numbers they have committed, so another checkpoint on the same folder would lose data
without an error. ``claim`` refuses that, and a change of layout, before a query starts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flotilla.notes import children, has_data, read_note, remove, write_note

# Folders of a day that ``upsert_table`` keeps apart before it merges them into one.
MERGE_EVERY = 20


class FolderInUseError(RuntimeError):
    pass


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that a checkpoint folder keeps for life."""
    note = read_note(spark, f"{checkpoint}/_flotilla_id")
    if note is None:
        note = {"id": uuid.uuid4().hex}
        write_note(spark, f"{checkpoint}/_flotilla_id", note)
    return note["id"]


def claim(spark: SparkSession, path: str, checkpoint: str, layout: str) -> None:
    """Tie ``path`` to a checkpoint and a layout, or fail if it is tied to others."""
    mine = {"checkpoint": checkpoint_id(spark, checkpoint), "layout": layout}
    there = read_note(spark, f"{path}/_owner")
    if there is None and has_data(spark, path):
        raise FolderInUseError(f"{path} holds data of an unknown writer; name another folder")
    if there is not None and there != mine:
        what = "layout" if there["layout"] != layout else "checkpoint"
        raise FolderInUseError(f"{path} was written with another {what} ({there}); go on with that one or name another folder")
    if there is None:
        write_note(spark, f"{path}/_owner", mine)


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


# --- feeds --------------------------------------------------------------------------------

def append_feed(df: DataFrame, name: str, path: str, checkpoint: str,
                trigger: str | None = "10 seconds", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> StreamingQuery:
    """Append each micro-batch (stateless rows, or closed windows after a watermark)."""
    claim(df.sparkSession, path, checkpoint, "file sink")
    w = (df.writeStream.queryName(name).format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start(path)


def shared_feed(events: DataFrame, name: str, events_path: str, alerts_path: str, checkpoint: str,
                trigger: str | None = "10 seconds", processed_at=True) -> StreamingQuery:
    """O4/W6/W7 from one scan: decoded events and their alerts, written per micro-batch.

    The batch is persisted for its two writes (decode once), then released. Each write goes to
    ``batch_id=N`` with overwrite, so a batch retried after a failure replaces its own output.
    Events are also partitioned by event day, so readers prune by date.
    """
    from pyspark import StorageLevel

    from flotilla.operators.events import alerts as alert_rules

    for path in (events_path, alerts_path):
        claim(events.sparkSession, path, checkpoint, "folder per batch")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (batch.withColumn("dia", F.to_date("kafka_timestamp"))
                  .write.mode("overwrite").partitionBy("dia")
                  .parquet(f"{events_path}/batch_id={batch_id}"))
            (alert_rules(batch, processed_at=processed_at)
                  .write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    w = (events.writeStream.queryName(name).outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


# --- tables that a stream keeps current ---------------------------------------------------

def replace_table(df: DataFrame, name: str, path: str, checkpoint: str,
                  trigger: str | None = "30 seconds", mode: str = "complete",
                  transform=None) -> StreamingQuery:
    """The full result table per micro-batch; ``read_latest`` reads the committed one.

    A batch writes a folder of its own, then the note ``_current`` names it: a reader sees a
    whole snapshot, and after a restart, with the same checkpoint or another, the one written
    last. Then older folders go. ``transform`` is a batch function applied before the write.
    Complete mode keeps all state; for an endless stream use ``upsert_table``.
    """
    spark = df.sparkSession
    run = checkpoint_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        before = read_note(own, f"{path}/_current")
        folder = f"run={run}/batch={batch_id}"
        (transform(batch) if transform else batch).write.mode("overwrite").parquet(f"{path}/{folder}")
        write_note(own, f"{path}/_current", {"folders": [folder]})
        for old in (before or {}).get("folders", []):
            if old != folder:
                remove(own, f"{path}/{old}")

    w = (df.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def upsert_table(df: DataFrame, name: str, path: str, checkpoint: str, keys: list[str],
                 trigger: str | None = "30 seconds", merge_every: int = MERGE_EVERY,
                 watch=None, day_of: str | None = None, delay: str | None = None) -> StreamingQuery:
    """W8 for an endless stream: each micro-batch writes only the rows it changed (update mode),
    and with a watermark the state of closed windows is dropped.

    ``day_of``: a time column, one of ``keys``, by whose day the table is kept. A batch writes one
    folder for each day that it touched. A day of more than ``merge_every`` folders is merged into
    one; other days' folders stay as they are. With ``delay``, the stream's watermark delay, a day
    that the watermark has passed is merged for the last time and sealed: no batch can change it
    any more, so it is read as it stands and never written again. The work of a batch and of a
    merge then depends on the open days, not on the history. Without ``day_of`` the table is one day.

    The note ``_current`` names the folders that count, by day, and the last batch in them: a batch
    that is repeated finds itself there. Another checkpoint starts a table of its own, which
    replaces the old one with its first batch. ``watch`` is called with the open days' rows after
    each batch (O6).
    """
    spark = df.sparkSession
    run = checkpoint_id(spark, checkpoint)
    lag = _seconds(delay) if delay else None

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        before = read_note(own, f"{path}/_current") or {}
        mine = before.get("run") == run
        now = before if mine else {"run": run, "keys": keys, "batch": -1, "high": None, "days": {}}
        if batch_id > now["batch"]:
            gone = _take(own, batch, batch_id, now)
            write_note(own, f"{path}/_current", now)
            for old in gone if mine else _folders(before):
                remove(own, f"{path}/{old}")
        if watch is not None and now["days"]:
            watch(read_latest(own, path, open_only=True), batch_id)

    def _take(own: SparkSession, batch: DataFrame, batch_id: int, now: dict) -> list[str]:
        """Add a batch to the note's days; the folders that count no more."""
        folder = f"run={run}/batch={batch_id:012d}"
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        if day_of:
            rows.withColumn("dia", F.to_date(day_of)).write.mode("overwrite").partitionBy("dia").parquet(f"{path}/{folder}")
            touched = {x.removeprefix("dia="): f"{folder}/{x}" for x in children(own, f"{path}/{folder}") if x.startswith("dia=")}
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{folder}")
            touched = {"": folder}
        now["batch"], days = batch_id, now["days"]
        for day, added in touched.items():
            entry = days.setdefault(day, {"folders": [], "sealed": False})
            entry["folders"].append(added)
            entry["sealed"] = False
        if touched and day_of and lag is not None:
            newest = own.read.parquet(f"{path}/{touched[max(touched)]}").agg(F.unix_micros(F.max(F.col(day_of).cast("timestamp")))).first()[0]
            now["high"] = max(newest / 1e6, now["high"] or 0)
        gone = []
        for day, entry in days.items():
            # the watermark is at least this far: windows start no later than their rows
            closes = bool(day) and now["high"] is not None and not entry["sealed"] and _day_end(own, day) <= now["high"] - lag
            if len(entry["folders"]) > (1 if closes else merge_every):
                whole = f"run={run}/merged={batch_id:012d}" + (f"/dia={day}" if day else "")
                _newest(own.read.parquet(*[f"{path}/{f}" for f in entry["folders"]]), keys).write.mode("overwrite").parquet(f"{path}/{whole}")
                gone += entry["folders"]
                entry["folders"] = [whole]
            entry["sealed"] = entry["sealed"] or closes
        return gone

    w = (df.writeStream.queryName(name).outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(delay: str) -> float:
    """A delay as ``withWatermark`` takes it: "2 minutes"."""
    number, unit = delay.split()
    return float(number) * UNITS[unit.lower().rstrip("s")]


def _day_end(spark: SparkSession, day: str) -> float:
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return (dt.datetime.fromisoformat(day) + dt.timedelta(days=1)).replace(tzinfo=zone).timestamp()


def _folders(note: dict) -> list[str]:
    return [f for entry in note.get("days", {}).values() for f in entry["folders"]]


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), "_batch").alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def read_latest(spark: SparkSession, path: str, since: str | None = None, open_only: bool = False) -> DataFrame:
    """The table that ``replace_table`` or ``upsert_table`` committed last. Of a table by days:
    those from the day ``since`` on, or the open ones only. Days of one folder (all sealed ones)
    are read as they stand; only the others' rows are grouped by key."""
    now = read_note(spark, f"{path}/_current")
    if now is None:
        raise FileNotFoundError(f"{path} has no committed table yet")
    if "days" not in now:
        return spark.read.parquet(*[f"{path}/{f}" for f in now["folders"]])
    every = [e["folders"] for e in now["days"].values()]
    taken = [e["folders"] for day, e in now["days"].items() if day >= (since or "") and not (open_only and e["sealed"])]
    plain = [f"{path}/{x[0]}" for x in taken if len(x) == 1]
    several = [f"{path}/{f}" for x in taken if len(x) > 1 for f in x]
    if not taken:           # the columns, without rows
        if not every:
            raise FileNotFoundError(f"{path} has no committed rows yet")
        return spark.read.parquet(f"{path}/{every[0][0]}").drop("_batch").limit(0)
    parts = [spark.read.parquet(*plain)] if plain else []
    if several:
        parts.append(_newest(spark.read.parquet(*several), now["keys"]))
    return reduce(DataFrame.unionByName, parts).drop("_batch")


def console_feed(df: DataFrame, name: str, checkpoint: str | None = None, mode: str = "update",
                 trigger: str | None = "30 seconds", transform=None, rows: int = 20,
                 order: list | None = None) -> StreamingQuery:
    """Print each micro-batch's result untruncated, for watching a job.

    Only the first ``rows`` rows (in ``order``) reach the driver: the full table stays on the
    executors, unlike the console sink, which gathers the whole result to print it.
    """
    def show(batch: DataFrame, batch_id: int) -> None:
        print_rows(transform(batch) if transform else batch, name, batch_id, rows, order)

    w = df.writeStream.queryName(name).outputMode(mode).foreachBatch(show)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def print_rows(table: DataFrame, name: str, batch_id: int, rows: int = 20, order: list | None = None) -> None:
    print(f"-- {name} batch {batch_id}")
    (table.orderBy(*order) if order else table).show(rows, truncate=False)


def topic_options(bootstrap: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def topic_feed(records: DataFrame, name: str, bootstrap: str, topic: str, checkpoint: str,
               trigger: str | None = "10 seconds") -> StreamingQuery:
    """Publish ``key``/``value`` records (``operators.events.encode_events``) to a topic.

    Needs the Kafka package on the class path; the record shape is the same as the file form.
    """
    w = (records.select("key", "value").writeStream.queryName(name).format("kafka")
         .options(**topic_options(bootstrap, topic)).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()
