"""Helpers shared by the operators: shared-folder tables and text columns as flat bytes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.session import scratch_path

# A task works on this many text bytes at a time (or on one longer text).
SLICE_BYTES = 8 << 20
# Rows without an id come after all others.
LAST_ID = (1 << 63) - 1

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="flotilla-ship-"), "flotilla_modules.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, executors may go."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_or_last(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_back(column: Column) -> Column:
    """The inverse of ``id_or_last``."""
    return F.when(column != F.lit(LAST_ID), column)


def digest(column: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(column.cast("binary")))


# Copies of earlier texts are marked by a broadcast up to this many rows (24 bytes each).
BROADCAST_COPIES = 300_000


def later_copies(base: DataFrame) -> DataFrame:
    """``id, digest, copy`` (true) of the rows of ``base`` whose text (``digest``) a smaller id has."""
    ids = base.select("digest", "id")
    copies = stored(ids.join(ids.groupBy("digest").agg(F.min("id").alias("least")), "digest")
                    .where(F.col("id") > F.col("least")).select("id", "digest").distinct()
                    .withColumn("copy", F.lit(True)), "copies")
    return F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies


# --- Arrow text columns as flat bytes ---------------------------------------------------

def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, n + 1 offsets); null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], name: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        _, off = flat(column_of(batch, name))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def trimmed(body):
    """A ``mapInArrow`` function that gives freed memory back to the system when its partition is
    done: workers are used again and again, and what they keep is lost to their executor."""
    def run(batches):
        try:
            yield from body(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:          # a C library without it
                pass
    return run


def binary_array(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """Bytes and n + 1 offsets as a large binary array, without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def byte_table(separators: bytes | None = None, keep: bytes | None = None) -> np.ndarray:
    """Which byte values belong to words: all but ``separators``, or ``keep`` and non-ASCII."""
    table = np.ones(256, bool)
    if keep is not None:
        table[:128] = False
        table[list(keep)] = True
    else:
        table[list(separators)] = False
    return table


WHITE = b"\t\n\x0b\x0c\r "
NOT_WHITE = byte_table(separators=WHITE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of a slice of texts: ``array`` (lower-cased bytes), ``starts`` and ``ends`` in
    the slice's bytes, and ``off``, the first word of each text (n + 1 entries)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
        inside = is_word[data]
        n = len(data)
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        before[off] = False                     # words end where texts end
        self.starts = np.flatnonzero(inside & ~before[:n])
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        after[off] = False
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        bounds = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=bounds[1:])
        self.array = binary_array(LOWER[data[inside]], bounds)
        self.off = np.searchsorted(self.starts, off)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the runs ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - first, lengths)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals as sorted runs with gaps between them."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(starts, kind="stable")
    s, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(s), bool)
    first[1:] = s[1:] > reach[:-1]
    at = np.flatnonzero(first)
    return s[at], reach[np.append(at[1:], len(s)) - 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
