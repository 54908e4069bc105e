"""Operator 3: best-fit packing by exact-complement hashing.

Packing only depends on how many pieces there are of each length, at most ``capacity``
numbers. From them the driver makes a plan of patterns: from the longest length down, the
gap a piece leaves is looked up among single lengths, sums of two and sums of three; a
combination that fills it exactly is consumed as often as the counts allow. What has no
exact complement is packed by best fit. The plan says which ranks of a length go where, so
each piece finds its place from its length and its rank among equal lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flotilla.llm import tokens
from flotilla.llm.common import column_of, documents, flat, ship, slices, stored, trimmed

CAPACITY = 2048


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32 bit): each text's ids and
    ``end_id``, cut every ``capacity`` ids. Null text is empty: one piece with the end id.
    Repeated rows give their pieces again; null ids stay null; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokens.read_tokenizer(tokenizer_path))

    def pieces(batches):
        enc = tokens.encoder(sent.value)
        for part in slices(batches, limit=tokens.SLICE):
            ids, off = enc.encode(*flat(column_of(part, "text")))
            n = len(off) - 1
            ids = np.insert(ids, off[1:], end_id).astype("<u4")
            off = off + np.arange(n + 1)
            per_doc = -(-np.diff(off) // capacity)
            doc = np.repeat(np.arange(n), per_doc)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            start = piece * capacity
            length = np.minimum(capacity, np.diff(off)[doc] - start)
            first = off[doc] + start
            raw = pa.Array.from_buffers(pa.large_binary(), len(doc), [
                None, pa.py_buffer(4 * np.append(first, off[-1]).astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([
                column_of(part, "doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                pa.array(length), raw.cast(pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(trimmed(pieces), "doc_id long, piece int, start long, length long, ids binary")


class Plan:
    """Patterns and how often each is used, from the number of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.patterns = capacity, []
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.left[0] = 0
        for length in range(capacity, 0, -1):
            while self.left[length]:
                rest = self._complement(length)
                if rest is None:
                    break
                self._use([length, *rest])
        self._best_fit()

    def _use(self, lengths: list[int]) -> None:
        distinct, need = np.unique(lengths, return_counts=True)
        times = int((self.left[distinct] // need).min())
        self.left[distinct] -= need * times
        self.patterns.append((lengths, times))

    def _pair(self, total: int, have: np.ndarray) -> list[int] | None:
        """Two available lengths with this sum, the larger one as long as can be."""
        if total < 2:
            return None
        large = np.arange(total - 1, (total - 1) // 2, -1)
        small = total - large
        ok = (have[large] > 0) & (have[small] > 0) & ((large != small) | (have[large] > 1))
        at = int(ok.argmax())
        return [int(large[at]), int(small[at])] if ok[at] else None

    def _complement(self, length: int) -> list[int] | None:
        """One, two or three available lengths that fill the gap exactly."""
        gap, have = self.capacity - length, self.left.copy()
        have[length] -= 1
        if gap == 0:
            return []
        if have[gap] > 0:
            return [gap]
        pair = self._pair(gap, have)
        if pair:
            return pair
        for largest in np.flatnonzero(have[:gap])[::-1]:
            if 3 * largest < gap:
                break
            have[largest] -= 1
            pair = self._pair(gap - int(largest), have)
            have[largest] += 1
            if pair:
                return [int(largest), *pair]
        return None

    def _best_fit(self) -> None:
        """Longest first; each gap takes the longest length that fits, until none does."""
        while self.left.any():
            lengths, gap, have = [], self.capacity, self.left.copy()
            while True:
                fits = np.flatnonzero(have[:gap + 1])
                if not len(fits):
                    break
                lengths.append(int(fits[-1]))
                have[fits[-1]] -= 1
                gap -= lengths[-1]
            self._use(lengths)

    def places(self) -> dict[str, np.ndarray]:
        """For each length, runs of ranks: (length, first rank, first sequence, offset)."""
        used = np.zeros(self.capacity + 1, np.int64)
        rows, sequence = [], 0
        for lengths, times in self.patterns:
            offset = 0
            for length in lengths:
                rows.append((length, used[length], sequence, offset))
                used[length] += times
                offset += length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, one of them ``length``, 1 to ``capacity``) with ``sequence_id``
    and ``offset``: into sequences of at most ``capacity``, as few as the method finds.

    Ranks within a length come from two levels, the writing task and the row in it, so pieces
    of one length that are a third of all rows are numbered by many tasks. Repeated rows are
    pieces of their own. Columns named like the results are replaced; an empty table stays
    empty. A null or other length is an error.
    """
    spark = pieces.sparkSession
    ship(spark)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_part", "_row")]
    # the written table fixes which task and row a piece has
    held = stored(pieces.select(*kept, F.spark_partition_id().alias("_part"),
                                F.monotonically_increasing_id().alias("_row")), "pieces")
    by_part = held.groupBy("length", "_part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(length is None or not 0 < length <= capacity for length in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    place = Plan(counts, capacity).places()     # rows: patterns, a few for each length
    sent = spark.sparkContext.broadcast(place)
    before = by_part.select("length", "_part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("_part")) - F.col("n")).alias("_base"))
    ranked = held.withColumn("_at", F.row_number().over(Window.partitionBy("length", "_part").orderBy("_row"))) \
        .join(before, ["length", "_part"]).withColumn("_rank", F.col("_base") + F.col("_at") - 1)
    schema = ranked.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def put(batches):
        p = sent.value
        # one ordered key for (length, rank)
        widest = int(p["rank"].max(initial=0)) + 1
        for b in batches:
            length, rank = column_of(b, "length").to_numpy(), column_of(b, "_rank").to_numpy()
            key = p["length"] * (widest + 1) + p["rank"]
            at = np.searchsorted(key, length * (widest + 1) + np.minimum(rank, widest), "right") - 1
            yield pa.RecordBatch.from_arrays(
                [column_of(b, c) for c in kept]
                + [pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])],
                [*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(trimmed(put), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Where each document's pieces stand, with a checksum of their ids instead of the ids."""
    pieces = token_pieces(docs, tokenizer_path, capacity)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)


def op3_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers
    return pack_documents(documents(spark, sf_dir), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
