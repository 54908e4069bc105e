"""Per-vehicle KPIs (A1-A3).

Each is one ``groupBy(vehicle)``: Spark plans partial aggregation before the shuffle, so a
vehicle that owns a third of all rows is reduced map-side to one buffer per task. Null
vehicles form their own group, as SQL GROUP BY does. Sums and means are exact and run over long
columns (``functions.with_limbs``); ``misfits`` counts the values that they leave out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.functions import (
    avg_of_limbs, avg_of_limbs_sql, count_if, misfit, pct_round, pct_round_sql, sum_of_limbs, sum_of_limbs_sql,
    with_limbs, with_limbs_sql,
)

VEHICLE = "placa_vehiculo"
# Columns of each cleaned table that are summed.
SUMMED = {"entregas": ["duracion_min", "distancia_km", "peso_kg"], "rutas_gps": ["velocidad_kmh", "satelites"],
          "incidencias": ["costo_estimado_soles"]}


def misfits(df: DataFrame, table: str) -> Column:
    """An aggregate: how many values of a cleaned table's summed columns are NaN, infinite or too
    large, so that sums and means leave them out. Whole-number columns always fit."""
    double = [c for c in SUMMED[table] if dict(df.dtypes)[c] in ("double", "float")]
    return sum((count_if(misfit(c)) for c in double), F.lit(0)).cast("long")


def delivery_kpis(deliveries: DataFrame) -> DataFrame:
    """A1 on cleaned deliveries.

    total, completed, success % (2 dp), mean duration (2 dp, filled zeros included),
    km (2 dp), mean weight (2 dp, nulls ignored), distinct clients (null not counted).
    """
    done = count_if(F.col("estado") == F.lit(S.STATE_DONE))
    return (with_limbs(deliveries, *SUMMED["entregas"]).groupBy(VEHICLE).agg(
        F.count(F.lit(1)).alias("total_entregas"),
        done.alias("entregas_completadas"),
        avg_of_limbs("duracion_min", 2).alias("duracion_promedio_min"),
        sum_of_limbs("distancia_km", 2).alias("km_totales"),
        avg_of_limbs("peso_kg", 2).alias("peso_promedio_kg"),
        F.count_distinct("cliente_id").alias("clientes_atendidos"),
    ).withColumn("tasa_exito_pct", pct_round("entregas_completadas", "total_entregas", 2))
     .select(VEHICLE, "total_entregas", "entregas_completadas", "tasa_exito_pct",
             "duracion_promedio_min", "km_totales", "peso_promedio_kg", "clientes_atendidos"))


def gps_kpis(gps: DataFrame) -> DataFrame:
    """A2 on cleaned pings: count, mean/max speed, best (lowest) precision, mean satellites (1 dp)."""
    return with_limbs(gps, *SUMMED["rutas_gps"]).groupBy(VEHICLE).agg(
        F.count(F.lit(1)).alias("total_registros_gps"),
        avg_of_limbs("velocidad_kmh", 2).alias("velocidad_promedio"),
        F.round(F.max("velocidad_kmh"), 2).alias("velocidad_maxima"),
        F.round(F.min("precision_gps"), 2).alias("mejor_precision"),
        avg_of_limbs("satelites", 1).alias("satelites_promedio"),
    )


def incident_kpis(incidents: DataFrame) -> DataFrame:
    """A3 on cleaned incidents: count, by severity, resolved, mean cost (2 dp)."""
    sev = F.col("severidad")
    return with_limbs(incidents, *SUMMED["incidencias"]).groupBy(VEHICLE).agg(
        F.count(F.lit(1)).alias("total_incidencias"),
        count_if(sev == F.lit(S.SEVERITY_HIGH)).alias("incidencias_alta"),
        count_if(sev == F.lit(S.SEVERITY_MEDIUM)).alias("incidencias_media"),
        count_if(sev == F.lit(S.SEVERITY_LOW)).alias("incidencias_baja"),
        count_if(F.col("resuelta") == F.lit(True)).alias("incidencias_resueltas"),
        avg_of_limbs("costo_estimado_soles", 2).alias("costo_promedio_soles"),
    )


# The same three roll-ups as SQL text over temp views (X1): the application's own interface
# was SQL over registered views; this runs that form through ``spark.sql``.
DELIVERY_KPIS_SQL = f"""
SELECT placa_vehiculo,
       count(*) AS total_entregas,
       count_if(estado = 'Completado') AS entregas_completadas,
       {pct_round_sql("count_if(estado = 'Completado')", "count(*)", 2)} AS tasa_exito_pct,
       {avg_of_limbs_sql("duracion_min", 2)} AS duracion_promedio_min,
       {sum_of_limbs_sql("distancia_km", 2)} AS km_totales,
       {avg_of_limbs_sql("peso_kg", 2)} AS peso_promedio_kg,
       count(DISTINCT cliente_id) AS clientes_atendidos
FROM {with_limbs_sql('{view}', SUMMED['entregas'])}
GROUP BY placa_vehiculo
"""

GPS_KPIS_SQL = f"""
SELECT placa_vehiculo,
       count(*) AS total_registros_gps,
       {avg_of_limbs_sql("velocidad_kmh", 2)} AS velocidad_promedio,
       round(max(velocidad_kmh), 2) AS velocidad_maxima,
       round(min(precision_gps), 2) AS mejor_precision,
       {avg_of_limbs_sql("satelites", 1)} AS satelites_promedio
FROM {with_limbs_sql('{view}', SUMMED['rutas_gps'])}
GROUP BY placa_vehiculo
"""

INCIDENT_KPIS_SQL = f"""
SELECT placa_vehiculo,
       count(*) AS total_incidencias,
       count_if(severidad = 'Alta') AS incidencias_alta,
       count_if(severidad = 'Media') AS incidencias_media,
       count_if(severidad = 'Baja') AS incidencias_baja,
       count_if(resuelta = true) AS incidencias_resueltas,
       {avg_of_limbs_sql("costo_estimado_soles", 2)} AS costo_promedio_soles
FROM {with_limbs_sql('{view}', SUMMED['incidencias'])}
GROUP BY placa_vehiculo
"""


def kpis_sql(spark, df: DataFrame, text: str, view: str | None = None) -> DataFrame:
    """One of the KPI statements over ``df``, or over the temp view of that name, which the
    caller has registered. A frame is passed by itself, so no view of the session is replaced."""
    return spark.sql(text.format(view=view)) if view else spark.sql(text, view=df)
