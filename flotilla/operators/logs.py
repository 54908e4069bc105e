"""System log lines (P14, F5, F6, A4, A5, K3) with native string functions, no RDD or UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.functions import log_fields, log_parts


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines (``spark.read.text``) to ``timestamp, nivel, componente, mensaje``.

    Lines with fewer than four space-separated parts are dropped (F5). ``timestamp`` stays
    text, as written in the line. Each line is split once: the parts come out of a generator
    (``explode`` of a one-element array), so the length filter above it cannot be pushed down
    into a second split, and fields a consumer does not use are still pruned.
    """
    parts = lines.select(F.explode(F.array(log_parts(column))).alias("_p"))
    fields = log_fields(F.col("_p"))
    return parts.filter(F.size("_p") >= 4).select(*[fields[c].alias(c) for c in S.LOG_COLUMNS])


def level_counts(log: DataFrame) -> DataFrame:
    """A4: lines per level."""
    return log.groupBy("nivel").agg(F.count(F.lit(1)).alias("cantidad"))


def component_counts(log: DataFrame) -> DataFrame:
    """A5: lines per component."""
    return log.groupBy("componente").agg(F.count(F.lit(1)).alias("cantidad"))


def error_lines(log: DataFrame) -> DataFrame:
    """ERROR lines."""
    return log.filter(F.col("nivel") == F.lit(S.LOG_LEVEL_ERROR))


def first_errors(log: DataFrame, n: int = 10) -> DataFrame:
    """K3: the first ``n`` ERROR lines in (time, component, message) order — a top-k, no full sort."""
    return error_lines(log).orderBy("timestamp", "componente", "mensaje").limit(n)
