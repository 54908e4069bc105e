"""Operator 13: vector compression by product codes, entries found by equal-average search.

A vector of whole numbers is cut into equal parts and each part is replaced by the index of its
nearest codebook entry. The nearest entry is sought from the part's component sum outwards in
entries sorted by theirs: the squared gap of two sums, over the dimension, is never more than
the squared distance, so a side is left as soon as that strictly exceeds the best distance (an
equal one may still be a tie of lower index). Codebooks are improved by whole-number rounds of
assignment and componentwise floor means: every figure is exact, on any partitioning.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flotilla.llm.common import column_of, ship

# Whole-number components stay below this, so squared distances and their sums fit 64 bits.
LARGEST = 1 << 26
# Vectors searched at a time in a task.
ROWS = 4096
# Label totals are broadcast up to this many (24 bytes each); beyond, joined with salted keys.
BROADCAST_LABELS = 300_000
SALTS = 16


@dataclass(frozen=True)
class Coding:
    """``parts`` codebooks of ``entries`` entries, improved in ``rounds`` rounds; components are
    multiplied by ``scale`` (a power of two, so that the product is exact) and floored."""
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def _whole(batch: pa.RecordBatch, coding: Coding) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch have a whole, finite vector, and those vectors as whole numbers."""
    vectors = column_of(batch, "vector")
    n = len(vectors)
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()                    # null lists have no values
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[start[1:]] == bad[start[:-1]])
    sizes = np.unique(lengths[good])
    if len(sizes) > 1:
        raise ValueError(f"vectors differ in length: {sizes.tolist()}")
    d = int(sizes[0]) if len(sizes) else 0
    if d % coding.parts:
        raise ValueError(f"vectors of {d} components don't cut into {coding.parts} equal parts")
    if not d:
        return good, np.zeros((int(good.sum()), 0), np.int64)
    inside = np.repeat(good, lengths) if n else np.zeros(0, bool)
    scaled = np.floor(values[inside] * coding.scale)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // coding.scale} and more are out of range")
    return good, scaled.astype(np.int64).reshape(-1, d)


class Search:
    """Nearest entries of one codebook (entries x dimension), ties to the lower index."""

    def __init__(self, book: np.ndarray):
        sums = book.sum(1)
        self.order = np.lexsort((np.arange(len(book)), sums))
        self.sums, self.book, self.d = sums[self.order], book[self.order], max(1, book.shape[1])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance for each row of ``x``."""
        k, n = len(self.book), len(x)
        total = x.sum(1)
        best = np.full(n, np.iinfo(np.int64).max)
        index = np.full(n, k, np.int64)
        above = np.searchsorted(self.sums, total)
        for at, step in ((above, 1), (above - 1, -1)):
            at, open_ = at.copy(), np.arange(n)
            while True:
                open_ = open_[(at[open_] >= 0) & (at[open_] < k)]
                gap = total[open_] - self.sums[at[open_]]
                # strictly beyond the best: nothing further on this side can be as near
                open_ = open_[gap * gap <= self.bound(best[open_])]
                if not len(open_):
                    break
                here = at[open_]
                diff = x[open_] - self.book[here]
                dist, entry = np.einsum("ij,ij->i", diff, diff), self.order[here]
                better = (dist < best[open_]) | ((dist == best[open_]) & (entry < index[open_]))
                hit = open_[better]
                best[hit], index[hit] = dist[better], entry[better]
                at[open_] += step
        return index, best

    def bound(self, best: np.ndarray) -> np.ndarray:
        """The largest squared gap of sums that a distance of ``best`` allows."""
        most = np.iinfo(np.int64).max // self.d
        return np.where(best > most, np.iinfo(np.int64).max, best * self.d if len(best) else best)


def _parts(x: np.ndarray, coding: Coding) -> list[np.ndarray]:
    return np.split(x, coding.parts, axis=1)


def _blocks(batches, coding: Coding):
    """Batches cut to ROWS rows, with the mask and whole vectors of each."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            good, x = _whole(part, coding)
            yield part, good, x


def first_entries(vectors: DataFrame, coding: Coding) -> np.ndarray:
    """The kept vectors with the smallest ids (nulls last, then by vector): the first codebooks.
    At most ``coding.entries`` rows come to the driver."""
    def kept(batches):
        for part, good, x in _blocks(batches, coding):
            if len(x):
                yield pa.RecordBatch.from_arrays([column_of(part, "vec_id").filter(pa.array(good)),
                                                  pa.array(list(x), pa.list_(pa.int64()))], ["vec_id", "x"])

    rows = vectors.mapInArrow(kept, "vec_id long, x array<long>") \
        .orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(coding.entries).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["x"]) if rows else 0)


def improved(vectors: DataFrame, books: np.ndarray, coding: Coding) -> np.ndarray:
    """One round: entries become the floor means of the parts that are nearest to them. Tasks
    add up their own parts; one row for each (part, entry) comes to the driver."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def add(batches):
        finders = [Search(b) for b in sent.value]
        sums, counts = np.zeros(sent.value.shape, np.int64), np.zeros(sent.value.shape[:2], np.int64)
        for _, _, x in _blocks(batches, coding):
            for p, piece in enumerate(_parts(x, coding)):
                index, _ = finders[p].nearest(piece)
                np.add.at(sums[p], index, piece)
                counts[p] += np.bincount(index, minlength=counts.shape[1])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]),
                                          pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "sums"])

    d = books.shape[2]
    # sums of tasks are added as decimals: they fit whatever the number of rows
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
    rows = vectors.mapInArrow(add, "p long, e long, n long, sums array<long>") \
        .groupBy("p", "e").agg(F.sum("n").alias("n"), *totals).collect()
    sent.unpersist()
    out = books.copy()
    for r in rows:
        out[r["p"], r["e"]] = [int(r[f"s{i}"]) // r["n"] for i in range(d)]
    return out


def codebooks(vectors: DataFrame, coding: Coding = Coding()) -> np.ndarray:
    """parts x entries x dimension: the codebooks after all rounds; no entries for no vectors."""
    first = first_entries(vectors, coding)
    if not len(first):
        return np.zeros((coding.parts, 0, 0), np.int64)
    books = np.stack(_parts(first, coding))
    for _ in range(coding.rounds):
        books = improved(vectors, books, coding)
    return books


def digest_of(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, coding: Coding = Coding()) -> DataFrame:
    """``vec_id, label, code, error`` for each row of ``vectors`` with a whole, finite vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    hexed = [f"{i:0{max(2, len(f'{coding.entries - 1:x}'))}x}" for i in range(coding.entries)]

    def codes(batches):
        finders = [Search(b) for b in sent.value]
        for part, good, x in _blocks(batches, coding):
            if not len(x):
                continue
            found = [f.nearest(piece) for f, piece in zip(finders, _parts(x, coding), strict=True)]
            code = ["".join(hexed[i] for i in row) for row in zip(*(i.tolist() for i, _ in found), strict=True)]
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "vec_id").filter(keep), column_of(part, "label").filter(keep), pa.array(code),
                 pa.array(np.sum([e for _, e in found], axis=0))], ["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType
    return vectors.mapInArrow(codes, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                                                   T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` (with ``code``) and ``approx``, the entries that its code names, one after another."""
    sent = codes.sparkSession.sparkContext.broadcast(books)
    width = max(2, len(f"{max(0, books.shape[1] - 1):x}"))

    def rebuild(batches):
        for b in batches:
            raw = column_of(b, "code").to_pylist()
            rows = [None if c is None else np.concatenate(
                [book[int(c[i * width:(i + 1) * width], 16)] for i, book in enumerate(sent.value)]).tolist() for c in raw]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.int64()))], [*b.schema.names, "approx"])

    kept = codes.drop("approx")
    return kept.mapInArrow(rebuild, T.StructType([*kept.schema.fields, T.StructField("approx", T.ArrayType(T.LongType()))]))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: ``error`` summed over rows of equal labels; null labels are one group."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    if totals.count() <= BROADCAST_LABELS:
        right = F.broadcast(totals.withColumnRenamed("label", "of"))
        return coded.join(right, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    # a label may have a third of all rows: its rows meet SALTS copies of its total
    left = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    right = totals.select(F.col("label").alias("of"), "label_error",
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return left.join(right, F.col("label").eqNullSafe(F.col("of")) & (left["salt"] == right["salt"])) \
        .select("vec_id", left["label"], "code", "error", "label_error")


def compress(vectors: DataFrame, coding: Coding = Coding()) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of each row of ``vectors``
    (``vec_id``, ``embedding``, ``label``) that has a whole vector.

    Rows whose vector is null or holds a null, a NaN or an infinity are dropped. Null ids come
    after all others when the first entries are chosen and stay null; rows of equal ids are taken
    by vector; repeated rows are coded like any other and count each time. Fewer rows than entries
    make smaller codebooks. Vectors of no components get code 0 in every part. Empty tables give
    no rows; other columns are ignored whatever their names. Vectors of different lengths, of a
    length that doesn't cut, or with components of LARGEST / scale and more raise ValueError.
    """
    spark = vectors.sparkSession
    ship(spark)
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    books = codebooks(held.select("vec_id", "vector"), coding)
    return with_label_errors(encode(held, books, coding)).withColumn("codebooks_sha256", F.lit(digest_of(books)))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")) \
        .select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_sql(coding: Coding = Coding()) -> str:
    """The same rows in SQL: all entries are tried; one pair of CTEs for each round."""
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * {coding.scale}) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pieces AS (
  SELECT r, p, list_slice(v, p * (len(v) // {coding.parts}) + 1, (p + 1) * (len(v) // {coding.parts})) AS x
  FROM kept, range({coding.parts}) t(p)
), book0 AS (
  SELECT p, r - 1 AS e, x AS c FROM pieces WHERE r <= {coding.entries}
)"""]
    for k in range(coding.rounds + 1):
        steps.append(f"""near{k} AS (
  SELECT r, p, x, min(row(list_sum([CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT) FOR z IN list_zip(x, c)]), e)) AS best
  FROM pieces JOIN book{k} USING (p) GROUP BY r, p, x
)""")
        if k < coding.rounds:
            steps.append(f"""means{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, best[2] AS e, i, CAST((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, best[2], i) GROUP BY p, e
), book{k + 1} AS (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)""")
    n = coding.rounds
    steps.append(f"""coded AS (
  SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near{n} GROUP BY r
), named AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{n}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), named""")
    return ", ".join(steps)
