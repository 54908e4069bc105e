"""Consolidated fleet report.

Facts are aggregated per vehicle before joining, so every join side is unique on the key
and nothing fans out. The report is driven by vehicles that have deliveries; a vehicle with
only GPS or incidents is left out, a delivery for an unknown plate stays with null master
text, and a null plate forms one row that matches nothing.

Join strategy: the KPI sides are one row per vehicle and grow with the fleet, so no hint is
forced on them; adaptive execution broadcasts them when their runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and sort-merge joins them otherwise. Each
KPI aggregate is already hash-partitioned on the vehicle by its own shuffle, so the
sort-merge joins reuse that partitioning and add no exchange of their own. The vehicle master
has no hint either: its size in bytes decides. A repeated plate in it would multiply report
rows; ``check_master`` is the job's one check of that, and building the report runs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla import schemas as S

VEHICLE = "placa_vehiculo"
# Numeric columns whose nulls become 0; the key may be numeric, too, and stays null.
MEASURES = [c for c in S.REPORT_COLUMNS if c not in (VEHICLE, "modelo", "conductor_id", "tipo_combustible", "fecha_reporte")]


class DuplicateKeyError(ValueError):
    pass


def check_master(master: DataFrame, key: str = "placa") -> int:
    """Rows in the master; raises if ``key`` repeats. One small aggregation job."""
    row = master.agg(F.count(F.lit(1)).alias("n"),
                     F.count_distinct(F.col(key)).alias("d"),
                     F.count(F.col(key)).alias("nn")).first()
    if row["d"] != row["nn"]:
        raise DuplicateKeyError(f"{key} repeats in the vehicle master: "
                                f"{row['nn']} keyed rows, {row['d']} distinct")
    return int(row["n"])


def fleet_report(deliveries_kpis: DataFrame, gps_kpis: DataFrame, incident_kpis: DataFrame,
                 vehicles: DataFrame, report_time=None) -> DataFrame:
    """Delivery KPIs ⟕ GPS KPIs ⟕ incident KPIs ⟕ master, 22 columns, nulls of measures → 0.

    ``report_time``: a fixed stamp for ``fecha_reporte`` (text or datetime); ``None`` stamps
    the query start. Write the result once and read it back for further outputs, so every
    output carries the same stamp.
    """
    master = vehicles.select("placa", "modelo", "capacidad_kg", "conductor_id", "tipo_combustible")
    gps = gps_kpis.select(VEHICLE, "total_registros_gps", "velocidad_promedio", "velocidad_maxima")
    inc = incident_kpis.select(VEHICLE, "total_incidencias", "incidencias_alta", "incidencias_media",
                               "incidencias_baja", "incidencias_resueltas", "costo_promedio_soles")
    stamp = F.current_timestamp() if report_time is None else F.lit(report_time).cast("timestamp")
    joined = (deliveries_kpis
              .join(gps, VEHICLE, "left")
              .join(inc, VEHICLE, "left")
              .join(master, F.col(VEHICLE) == F.col("placa"), "left"))
    out = joined.select(*[c for c in S.REPORT_COLUMNS if c != "fecha_reporte"],
                        stamp.alias("fecha_reporte"))
    return out.fillna(0, subset=MEASURES)


def report_summary(report: DataFrame) -> DataFrame:
    """O3: the seven-column KPI summary."""
    return report.select(*S.SUMMARY_COLUMNS)
