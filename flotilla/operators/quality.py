"""Row counts per table and stage (A6) as one small table ``(tabla, etapa, filas)``.

The batch job gets its counts from ``sinks.publish_counted`` during the writes; this form
computes them as a query (each branch is a partial + final count, unioned).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage_counts(stages: list[tuple[DataFrame, list[tuple[str, str, Column]]]]) -> DataFrame:
    """For each frame one aggregate, whatever the number of its (table, stage, count) entries."""
    parts = []
    for df, entries in stages:
        rows = [F.struct(F.lit(table).alias("tabla"), F.lit(stage).alias("etapa"),
                         F.coalesce(count, F.lit(0)).cast("long").alias("filas")) for table, stage, count in entries]
        parts.append(df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows")))
    return reduce(DataFrame.unionByName, parts)


def counts_table(spark, counts: list[tuple[str, str, int]]) -> DataFrame:
    """Counts already gathered on the driver (a handful of numbers) as a table."""
    return spark.createDataFrame(counts, "tabla string, etapa string, filas long")
