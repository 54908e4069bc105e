"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flotilla.llm.common import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a``, ``b``, long, no nulls): the label
    is the smallest node that can be reached.

    Each round moves every node's larger neighbours, then its smaller ones, to its least
    neighbour; edges only change, their number doesn't grow. It ends when a round changes
    nothing: then every component is a star around its least node. Loops and repeated edges
    are dropped; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where(F.col("u") != F.col("v")).distinct()
    before = None
    while True:
        edges = stored(edges, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(large.where(F.col("u") != F.col("v")).distinct())
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(small.select("u", F.col("m").alias("v"))) \
            .where(F.col("u") != F.col("v")).distinct()
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
