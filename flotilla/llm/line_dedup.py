"""Operator 9: line dedup over levelled sorted runs of line hashes.

A run is a Parquet table (line hash, number of documents) sorted by hash. Each batch of
documents adds one run to level 0; when a level holds ``fanout`` runs they are merged into
one run of the next level. Before a batch is counted, its hashes are anti-joined with those
that some run already has at or above the limit: they are common whatever comes later.
Everything here is DataFrame functions.

Hashes have 64 bits: a line of N in all is taken for one of C common ones with probability
N * C / 2**64, about one in two for 10**12 lines and 10**7 common ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flotilla.llm.common import documents, id_or_last
from flotilla.session import scratch_path

MIN_DOCS = 10
FANOUT = 4
# Common hashes are broadcast up to this many (16 bytes each in memory at most a few times
# over); beyond it they are joined by a shuffle.
BROADCAST_HASHES = 500_000
RUN = "h long, n long"
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hash(line: Column) -> Column:
    """Hash of a line's key: stripped of white space, A-Z lower-cased; null if nothing is left."""
    bare = F.btrim(line, F.lit(_WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    key = F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))
    return F.when(F.octet_length(bare) > 0, F.xxhash64(key))


class LineRuns:
    """The levels of one store under ``path``, a shared folder."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.levels: list[list[str]] = []
        self._made = 0

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*paths)

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _write(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        target = f"{self.path}/run-{self._made:05d}-level-{level}"
        self._made += 1
        counts.select("h", "n").sortWithinPartitions("h").write.parquet(target)
        self.levels[level].append(target)

    def add(self, docs: DataFrame) -> None:
        """Count a batch of documents (column ``text``) into the store. A row is one document;
        repeated rows count again, null and empty texts have no line that counts."""
        own = docs.select(F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_hash))).alias("h")) \
            .where(F.col("h").isNotNull()).groupBy("h").agg(F.count("*").alias("n"))
        if self.runs():
            settled = self._read(self.runs()).where(F.col("n") >= self.min_docs).select("h")
            own = own.join(settled, "h", "left_anti")
        self._write(own, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """Merge a level's runs into one run of the next."""
        counts = self._read(self.levels[level]).groupBy("h").agg(F.sum("n").alias("n"))
        self.levels[level] = []
        self._write(counts, level + 1)

    def common(self) -> DataFrame:
        """Hashes (``h``) of the lines that at least ``min_docs`` documents have."""
        if not self.runs():
            return self.spark.createDataFrame([], "h long")
        counts = self._read(self.runs())
        if len(self.runs()) > 1:
            counts = counts.groupBy("h").agg(F.sum("n").alias("n"))
        return counts.where(F.col("n") >= self.min_docs).select("h")


def drop_lines(docs: DataFrame, common: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of all its columns, so no name can clash) with
    ``n_lines`` before, ``n_dropped`` and ``kept``, the text without the common lines.

    Null text is one empty line and its ``kept`` is empty. Rows that repeat an id and a text get
    the same result; null ids are treated alike. Empty tables give no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "llm", "common-lines")
    common.write.parquet(path)
    common = spark.read.schema("h long").parquet(path)
    if common.count() <= BROADCAST_HASHES:
        common = F.broadcast(common)
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(id_or_last().alias("id"), F.xxhash64(text).alias("th"),
                        F.posexplode(F.transform(lines_of(F.col("text")), line_hash)).alias("pos", "h")) \
        .where(F.col("h").isNotNull()).join(common, "h") \
        .groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_or_last().alias("id"),
                       F.xxhash64(text).alias("th"))
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    lines = lines_of(F.col("row.text"))
    # bound once, so that the text is split once
    left = F.transform(F.array(lines), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: x[i]), "\n"))[0]
    return rows.join(found, ["id", "th"], "left").select(
        "row", (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), whole).otherwise(left).alias("kept"))


def in_batches(docs: DataFrame, n: int) -> list[DataFrame]:
    """All rows as ``n`` batches of equal ranges of ids; rows without an id are in the first."""
    low, high = docs.agg(F.min("doc_id").cast("long"), F.max("doc_id").cast("long")).first()
    if low is None:
        return [docs]
    cuts = sorted({low + (high - low + 1) * k // n for k in range(1, n)} - {low})
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        rule = F.lit(True) if a is None else F.col("doc_id") >= a
        rule = rule if b is None else rule & (F.col("doc_id") < b)
        out.append(docs.where(F.col("doc_id").isNull() | rule if a is None else rule))
    return out


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = 4, fanout: int = FANOUT) -> DataFrame:
    """``drop_lines`` for the lines that at least ``min_docs`` of these documents have."""
    spark = docs.sparkSession
    runs = LineRuns(spark, scratch_path(spark, "llm", "line-runs"), min_docs, fanout)
    for batch in in_batches(docs, batches):
        runs.add(batch)
    return drop_lines(docs, runs.common())


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                                   F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (k)
GROUP BY doc_id
"""
