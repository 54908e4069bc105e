"""Dashboard data: headline KPIs and chart series.

Computed on executors from the published tables; only finished series (one row per
category, or a top 10) are meant to leave Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flotilla.functions import avg_round, pct_round, sum_round

# --- fixed values: headline KPI names and their display formats ---------------------------
KPI_DELIVERIES = "Total Entregas"
KPI_SUCCESS = "Tasa Éxito Promedio"
KPI_INCIDENTS = "Total Incidencias"
KPI_KM = "KM Totales Recorridos"
KPI_SPEED = "Velocidad Promedio"
KPI_FORMATS = {KPI_DELIVERIES: "%d", KPI_SUCCESS: "%.2f%%", KPI_INCIDENTS: "%d",
               KPI_KM: "%,.0f km", KPI_SPEED: "%.1f km/h"}
# --- end of fixed values ------------------------------------------------------------------


class MissingColumnError(KeyError):
    pass


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Fail with the missing names instead of silently producing an empty series."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnError(f"missing column(s): {', '.join(missing)}")
    return df


def _kv(name: str, value) -> F.Column:
    return F.struct(F.lit(name).alias("kpi"), value.cast("double").alias("valor"))


def headline_kpis(report: DataFrame, incidents: DataFrame) -> DataFrame:
    """A7-A10 as a long ``(kpi, valor)`` table.

    Every cleaned delivery is in one report row, so their number is the sum over the report.
    Success rate and speed are unweighted means over report rows (zeros filled for vehicles
    without GPS count), rounded like their display (2 and 1 decimals); km is the exact total.
    ``incidents`` has one row for each incident (vehicles without deliveries have some, too).
    Two single-row aggregates are unioned: no join, each a partial + final aggregation.
    """
    require_columns(report, "total_entregas", "tasa_exito_pct", "km_totales", "velocidad_promedio")
    rep = report.agg(F.array(
        _kv(KPI_DELIVERIES, F.coalesce(F.sum("total_entregas"), F.lit(0))),
        _kv(KPI_SUCCESS, avg_round("tasa_exito_pct", 2)),
        _kv(KPI_KM, sum_round("km_totales", 2)),
        _kv(KPI_SPEED, avg_round("velocidad_promedio", 1)),
    ).alias("_r"))
    inc = incidents.agg(F.array(_kv(KPI_INCIDENTS, F.count(F.lit(1)))).alias("_r"))
    return rep.unionByName(inc).select(F.inline("_r"))


def kpi_sheet(kpis: DataFrame) -> DataFrame:
    """The headline table with its display text (``name: value`` lines)."""
    name, value = F.col("kpi"), F.col("valor")
    text = F.coalesce(*[F.when(name == k, F.format_string(f, value.cast("long") if f == "%d" else value))
                        for k, f in KPI_FORMATS.items()])
    return kpis.withColumn("texto", text)


def value_counts(df: DataFrame, column: str, count_name: str = "cantidad", counted: str | None = None) -> DataFrame:
    """Rows per value (or the sum of ``counted``, of rows that are counts), nulls dropped; ``puesto`` is the place in the order of K5, most
    frequent first (ties by value), and the rows come in it.

    The order is one task's work over one row per category, not over the rows counted.
    """
    require_columns(df, column, *([counted] if counted else []))
    n = F.sum(counted) if counted else F.count(F.lit(1))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(n.alias(count_name))
    place = F.row_number().over(Window.orderBy(F.desc(count_name), F.asc(column))).cast("long")
    return counts.withColumn("puesto", place).orderBy("puesto")


def share_of_total(counts: DataFrame, count_name: str = "cantidad", digits: int = 1,
                   name: str = "porcentaje") -> DataFrame:
    """Percent of the total per category, half-up at ``digits``, in the order of ``puesto``.

    The window has no partition key, so it runs in one task — over the per-category
    counts, whose size is the number of categories, not the number of rows.
    """
    total = F.sum(count_name).over(Window.partitionBy())
    return (counts.withColumn("_total", total)
            .withColumn(name, pct_round(count_name, "_total", digits)).drop("_total").orderBy("puesto"))


def top_n(report: DataFrame, by: str, n: int = 10, key: str = "placa_vehiculo") -> DataFrame:
    """K1/K2: the ``n`` largest by ``by``, ties by ``key`` — planned as TakeOrderedAndProject."""
    require_columns(report, key, by)
    return report.select(key, by).orderBy(F.desc(by), F.asc(key)).limit(n)


def preview(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """A bounded preview in a stated order; series are computed on all rows."""
    return df.orderBy(*order).limit(n)
