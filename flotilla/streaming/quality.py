"""What a stream read, what didn't fit and what came too late (A6), by query and batch.

The numbers ride on the queries: ``observe`` counts decoded rows and malformed payloads as they
pass, Spark's progress has the rows that stateful steps dropped behind the watermark. A listener
keeps them in one note for each query, with totals since its first batch and the last batches
one by one. A batch that is repeated after a failure counts once.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flotilla.notes import children, read_note, write_note

OBSERVED = "calidad"
BAD_PAYLOAD = "_malformado"
STAGES = ("leidas", "decodificadas", "malformadas", "tardias")
# Batches that a note keeps one by one.
KEPT = 200


def observed(events: DataFrame) -> DataFrame:
    """Decoded events without their mark of malformed payloads, counted as they pass."""
    return events.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.count(BAD_PAYLOAD).alias("bad")).drop(BAD_PAYLOAD)


def batch_counts(progress) -> dict[str, int]:
    """The counts of one batch. Late rows are counted as the stateful step sees them: rows of one
    group that a task has already put together are one."""
    seen = (progress["observedMetrics"] or {}).get(OBSERVED)
    late = sum(int(op["numRowsDroppedByWatermark"]) for op in progress["stateOperators"] or [])
    return {"leidas": int(progress["numInputRows"]), "tardias": late} | (
        {"decodificadas": int(seen["rows"] or 0), "malformadas": int(seen["bad"] or 0)} if seen is not None else {})


class StreamQuality(StreamingQueryListener):
    """Keeps the counts of ``queries`` in notes under ``path``, one by the name of each."""

    def __init__(self, spark: SparkSession, path: str, queries: list[StreamingQuery]):
        self.spark, self.path = spark, path.rstrip("/")
        self.names = {str(q.id): q.name for q in queries}       # other queries may have had the same names
        self.notes = {n: read_note(spark, self._note(n)) or {"totals": {}, "batches": []} for n in self.names.values()}
        self.lock = threading.Lock()

    def _note(self, name: str) -> str:
        return f"{self.path}/{name}.json"

    def record(self, progress) -> None:
        name, batch = self.names.get(str(progress["id"])), progress["batchId"]
        if name is None:
            return
        with self.lock:
            note = self.notes[name]
            known = [b["lote"] for b in note["batches"]]        # ascending; they needn't come in order
            if batch in known or (len(known) == KEPT and batch < known[0]):
                return
            counts = batch_counts(progress)
            if known and not any(counts.values()):
                return                  # an idle trigger
            for stage, n in counts.items():
                note["totals"][stage] = note["totals"].get(stage, 0) + n
            note["batches"] = sorted([*note["batches"], {"lote": batch} | counts], key=lambda b: b["lote"])[-KEPT:]
            write_note(self.spark, self._note(name), note)

    def catch_up(self, queries: list[StreamingQuery]) -> None:
        """Progress that hasn't come yet when queries have ended."""
        for q in queries:
            for p in q.recentProgress:
                self.record(p)

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_counts(spark: SparkSession, path: str, by_batch: bool = False) -> DataFrame:
    """``tabla`` (the query), ``etapa``, ``filas``: totals, or with ``lote`` the last batches."""
    rows = []
    for file in children(spark, path):
        if file.endswith(".json") and not file.startswith("."):
            note, name = read_note(spark, f"{path.rstrip('/')}/{file}"), file.removesuffix(".json")
            parts = note["batches"] if by_batch else [note["totals"] | {"lote": None}]
            rows += [(name, b["lote"], stage, b[stage]) for b in parts for stage in STAGES if stage in b]
    out = spark.createDataFrame(rows, "tabla string, lote long, etapa string, filas long")
    return out if by_batch else out.drop("lote")
