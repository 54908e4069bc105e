"""Operator 7: token counts through a digest cache.

The cache is a Parquet table (digest, tokenizer, n_tokens) in a shared folder. Counting joins
the digests of the normalised content and of the tokenizer file to it, encodes one text for
each digest it lacks, appends those counts, and joins the counts back to all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flotilla.llm import tokens
from flotilla.llm.common import column_of, digest, documents, flat, id_or_last, ship, slices
from flotilla.session import scratch_path

CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
                      T.StructField("tokenizer", T.StringType())])


def normalised(text: Column) -> Column:
    """The content a count stands for. The ids of byte-level BPE change with any other rewrite,
    so the only one that is safe for whole-text counts is null to empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row for each digest."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    table = spark.read.schema(CACHE).parquet(path) if there else spark.createDataFrame([], CACHE)
    return table.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache_path: str, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row of ``docs`` (columns ``doc_id``, ``text``).

    Null text counts as empty (0 tokens). Repeated rows each get their count; rows with a null
    id keep it. Empty tables give no rows, and the cache stays as it was. Other columns of
    ``docs`` are ignored. A lost executor costs the tasks it ran; a failed append leaves no
    partial rows, and a digest that two runs append at once is read as one.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = tokens.read_tokenizer(tokenizer_path)
    version, sent = tokens.version_of(spec), spark.sparkContext.broadcast(spec)

    content = docs.select(id_or_last().alias("id"), F.col("doc_id"), normalised(F.col("text")).alias("text")) \
        .withColumn("digest", digest(F.col("text")))
    # one row stands for each digest that the cache lacks
    misses = content.groupBy("digest").agg(F.min("id").alias("id")) \
        .join(read_cache(spark, cache_path, version), "digest", "left_anti")
    texts = content.select("id", "digest", "text").join(misses.hint("shuffle_hash"), ["id", "digest"]) \
        .select("digest", "text")

    def count(batches):
        enc = tokens.encoder(sent.value)
        for part in slices(batches, limit=tokens.SLICE):
            _, off = enc.encode(*flat(column_of(part, "text")))
            yield pa.RecordBatch.from_arrays([column_of(part, "digest").cast(pa.binary()), pa.array(np.diff(off))],
                                             ["digest", "n_tokens"])

    texts.mapInArrow(count, "digest binary, n_tokens long").withColumn("tokenizer", F.lit(version)) \
        .write.mode("append").parquet(cache_path)
    return content.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest") \
        .join(read_cache(spark, cache_path, version), "digest").select("doc_id", "n_bytes", "n_tokens")


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None,
                     limit: int = 1024) -> DataFrame:
    """Whole ``documents`` through a cache of its own, empty at first."""
    import public_tokenizers
    counts = token_counts(documents(spark, sf_dir), scratch_path(spark, "llm", "token-cache"),
                          tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
