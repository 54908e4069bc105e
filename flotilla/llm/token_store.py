"""Operator 4: token ids on disk as directly addressable codes.

An id is split into 8-bit chunks. Level k holds chunk k of the ids that have one, a bitmap
that tells whether the id goes on in level k + 1, and a rank directory: the number of set
bits before every 512th position. Token i is read by walking the levels: chunk, bit, rank,
next level. Nothing but the bytes it touches is decoded.

A shard is one row of a Parquet table: its documents' ids and offsets and the code as one
binary value. Spark's committer writes it, so lost executors and repeated tasks leave no
torn files, and any store Spark reaches will do. A manifest has each shard's first position.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flotilla.llm import tokens
from flotilla.llm.common import column_of, documents, flat, id_back, id_or_last, ship, slices
from flotilla.session import scratch_path

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_STEP = 512
# A shard is closed by the document that brings it to this many ids.
SHARD_TOKENS = 1 << 20
SHARDS = "part int, seq int, n_tokens long, doc_ids binary, doc_offsets binary, payload binary"


def encode_dac(ids: np.ndarray) -> bytes:
    """Layout: magic, number of levels; for each level its length, its chunk bytes, and, but for
    the last level, bitmap words (64 bit) and rank directory (32 bit), all little-endian."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> CHUNK_BITS
        more = rest != 0
        goes_on = bool(more.any())
        body = [struct.pack("<QB", len(chunk), goes_on), chunk.tobytes()]
        if goes_on:
            padded = np.zeros(-(-len(more) // RANK_STEP) * RANK_STEP, bool)
            padded[:len(more)] = more
            per_step = padded.reshape(-1, RANK_STEP).sum(1)
            body += [np.packbits(padded, bitorder="little").tobytes(),
                     (np.cumsum(per_step) - per_step).astype("<u4").tobytes()]
        levels.append(b"".join(body))
        if not goes_on:
            return MAGIC + struct.pack("<B", len(levels)) + b"".join(levels)
        rest = rest[more]


class Dac:
    """Reads codes: all of them with ``decode``, or single ones with ``[i]``."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.levels, at = [], 5
        for _ in range(payload[4]):
            n, goes_on = struct.unpack_from("<QB", payload, at)
            at += 9
            chunk = np.frombuffer(payload, np.uint8, n, at)
            at += n
            bits = rank = None
            if goes_on:
                steps = -(-n // RANK_STEP)
                bits = np.frombuffer(payload, np.uint8, steps * RANK_STEP // 8, at)
                at += len(bits)
                rank = np.frombuffer(payload, "<u4", steps, at)
                at += rank.nbytes
            self.levels.append((chunk, bits, rank))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        value = 0
        for k, (chunk, bits, rank) in enumerate(self.levels):
            value |= int(chunk[i]) << (CHUNK_BITS * k)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            step, first = i // RANK_STEP, i // RANK_STEP * RANK_STEP // 8
            low = bits[first: i >> 3].tobytes() + bytes([int(bits[i >> 3]) & ((1 << (i & 7)) - 1)])
            i = int(rank[step]) + int.from_bytes(low, "little").bit_count()
        return value

    def decode(self) -> np.ndarray:
        ids = self.levels[0][0].astype(np.uint32)
        where = None
        for k, (_, bits, _) in enumerate(self.levels[:-1]):
            more = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
            where = more if where is None else where[more]
            ids[where] |= self.levels[k + 1][0].astype(np.uint32) << np.uint32(CHUNK_BITS * (k + 1))
        return ids


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every text of ``docs`` (``doc_id``, ``text``), append ``end_id`` to each, and write
    shards under ``path`` in ascending ``doc_id`` order, then the manifest.

    Null text is empty: its document is the end id alone. Rows with a null id come last; rows
    that repeat an id stand together, ordered by text. An empty table gives no shards. Other
    columns are ignored. A very long text makes its shard longer; nothing is cut.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokens.read_tokenizer(tokenizer_path))
    ordered = docs.select(id_or_last().alias("id"), F.coalesce("text", F.lit("")).alias("text")) \
        .repartitionByRange("id").sortWithinPartitions("id", "text")

    def shards(batches):
        from pyspark import TaskContext
        part, seq, held, sizes, names = TaskContext.get().partitionId(), 0, [], [], []
        enc = tokens.encoder(sent.value)

        def close():
            off = np.zeros(len(sizes) + 1, "<i8")
            np.cumsum(sizes, out=off[1:])
            ids = np.concatenate(held)
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "n_tokens": len(ids), "doc_ids": np.array(names, "<i8").tobytes(),
                "doc_offsets": off.tobytes(), "payload": encode_dac(ids)}], schema=SHARD_ARROW)

        for piece in slices(batches, limit=tokens.SLICE):
            ids, off = enc.encode(*flat(column_of(piece, "text")))
            n = len(off) - 1
            ids = np.insert(ids, off[1:], end_id)
            off = off + np.arange(n + 1)
            keys, lo = column_of(piece, "id").to_numpy(), 0
            while lo < n:
                room = shard_tokens - sum(map(len, held))
                hi = min(n, int(np.searchsorted(off, off[lo] + max(room, 1), "left")))
                held.append(ids[off[lo]:off[hi]])
                sizes += np.diff(off[lo:hi + 1]).tolist()
                names += keys[lo:hi].tolist()
                lo = hi
                if sum(map(len, held)) >= shard_tokens:
                    yield close()
                    seq, held, sizes, names = seq + 1, [], [], []
        if sizes:
            yield close()

    ordered.mapInArrow(shards, SHARDS).write.option("compression", "none").parquet(f"{path}/shards")
    _write_manifest(spark, path)


SHARD_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()),
                         ("doc_ids", pa.binary()), ("doc_offsets", pa.binary()), ("payload", pa.binary())])


def _write_manifest(spark: SparkSession, path: str) -> None:
    """(part, seq, n_tokens, start). The driver sums one number for each range partition."""
    sizes = spark.read.schema(SHARDS).parquet(f"{path}/shards").select("part", "seq", "n_tokens")
    totals = {r["part"]: r["n"] for r in sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    first, at = [], 0
    for part in sorted(totals):
        first.append((part, at))
        at += totals[part]
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    sizes.join(spark.createDataFrame(first, "part int, base long"), "part") \
        .withColumn("start", F.col("base") + before).select("part", "seq", "n_tokens", "start") \
        .write.parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32 bit) of each document."""
    ship(spark)

    def rows(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                ids = Dac(shard["payload"]).decode().astype("<u4")
                off = np.frombuffer(shard["doc_offsets"], "<i8")
                names = np.frombuffer(shard["doc_ids"], "<i8")
                for lo in range(0, len(names), 4096):
                    hi = min(len(names), lo + 4096)
                    cut = off[lo:hi + 1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[lo:hi]), pa.array(np.full(hi - lo, shard["part"], np.int32)),
                        pa.array(np.full(hi - lo, shard["seq"], np.int32)), pa.array(cut[:-1]), pa.array(np.diff(cut)),
                        pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ], ["id", "part", "seq", "local", "n_tokens", "ids"])

    found = spark.read.schema(SHARDS).parquet(f"{path}/shards") \
        .mapInArrow(rows, "id long, part int, seq int, local long, n_tokens long, ids binary")
    manifest = spark.read.schema("part int, seq int, n_tokens long, start long").parquet(f"{path}/manifest")
    return _placed(found, manifest).select("doc_id", "start", "n_tokens", "ids")


def _placed(found: DataFrame, manifest: DataFrame) -> DataFrame:
    return found.join(manifest.select("part", "seq", F.col("start").alias("base")), ["part", "seq"]) \
        .withColumn("start", F.col("base") + F.col("local")).withColumn("doc_id", id_back(F.col("id")))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read from the shards; the ids stay in their task."""
    ship(spark)

    def rows(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                raw = memoryview(Dac(shard["payload"]).decode().astype("<u4").tobytes())
                off = np.frombuffer(shard["doc_offsets"], "<i8")
                names = np.frombuffer(shard["doc_ids"], "<i8")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(off[:-1], off[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(names), pa.array(np.full(len(names), shard["part"], np.int32)),
                    pa.array(np.full(len(names), shard["seq"], np.int32)), pa.array(off[:-1]),
                    pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                    ["id", "part", "seq", "local", "n_tokens", "ids_crc32"])

    found = spark.read.schema(SHARDS).parquet(f"{path}/shards") \
        .mapInArrow(rows, "id long, part int, seq int, local long, n_tokens long, ids_crc32 long")
    manifest = spark.read.schema("part int, seq int, n_tokens long, start long").parquet(f"{path}/manifest")
    return _placed(found, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of the whole stream: one shard's row is read, one code is walked."""
    where = spark.read.parquet(f"{path}/manifest").where(
        (F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position)).first()
    if where is None:
        raise IndexError(position)
    shard = spark.read.schema(SHARDS).parquet(f"{path}/shards") \
        .where((F.col("part") == where["part"]) & (F.col("seq") == where["seq"])).select("payload").first()
    return Dac(bytes(shard["payload"]))[position - where["start"]]


def op4_token_store(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Whole ``documents`` written as shards in the shared folder and read back."""
    import public_tokenizers
    path = scratch_path(spark, "llm", "tokens")
    write_tokens(documents(spark, sf_dir), path, tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
    return document_digests(spark, path)
