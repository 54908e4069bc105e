"""Tumbling-window summaries (W1-W5, P13), the same code for batch and stream.

Distinct vehicles per window (W5) has three forms, the first two exact:

- ``"exact"`` (batch): ``count_distinct``; Spark pre-aggregates (window, kind, vehicle) before
  the shuffle, so the work spreads by vehicle even when one kind dominates.
- ``"chained"`` (stream, append): ``groupBy(window, kind, vehicle)`` then ``groupBy(window,
  kind)``. State is one small row per (window, kind, vehicle), hashed across partitions; it is
  evicted once the watermark passes the window end.
- ``"approx"`` (either): ``approx_count_distinct`` (HyperLogLog++, ~5% relative error), a
  fixed-size sketch per group whatever the fleet size; not exact, so not used for the
  published numbers.

Late rows: Spark drops a row whose event time is older than the watermark of the *previous*
micro-batch (the watermark computed from a batch takes effect in the next one). A window is
published in append mode once the current watermark passes its end, and from then on rows for
it are late and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.operators.events import stamp


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); TIMESTAMP_NTZ columns are cast in UTC."""
    if dict(df.dtypes).get(column) == "timestamp_ntz":
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def flatten_window(df: DataFrame, window: str = "window") -> DataFrame:
    """``ventana_inicio``, ``ventana_fin`` in place of the window struct."""
    return (df.withColumn("ventana_inicio", F.col(f"{window}.start"))
              .withColumn("ventana_fin", F.col(f"{window}.end"))
              .drop(window))


def events_by_type(events: DataFrame, ts: str = "kafka_timestamp", duration: str = S.EVENT_WINDOW,
                   watermark: str | None = None, distinct: str = "exact", rsd: float = 0.05,
                   processed_at=None) -> DataFrame:
    """Events and distinct vehicles per (window, event kind). ``processed_at``:
    add ``procesado_en`` (``True`` = now, or a fixed stamp)."""
    if distinct == "chained":
        return stamp(roll_up_vehicles(vehicle_counts(events, ts, duration, watermark)), processed_at)
    df = events
    if watermark:
        df = event_time(df, ts).withWatermark(ts, watermark)
    if distinct == "approx":
        vehicles = F.approx_count_distinct("placa_vehiculo", rsd)
    else:
        vehicles = F.count_distinct("placa_vehiculo")
    out = (df.groupBy(F.window(ts, duration).alias("window"), "tipo_evento")
             .agg(F.count(F.lit(1)).alias("cantidad_eventos"),
                  vehicles.cast("long").alias("vehiculos_afectados")))
    return stamp(flatten_window(out), processed_at)


def vehicle_counts(events: DataFrame, ts: str = "kafka_timestamp", duration: str = S.EVENT_WINDOW,
                   watermark: str | None = None) -> DataFrame:
    """First level of the exact distinct count: events per (window, kind, vehicle).

    As a stream this is the only stateful step (one small state row per key, spread by hash);
    in update mode the latest rows of all keys are rolled up by ``roll_up_latest``.
    """
    df = events
    if watermark:
        df = event_time(df, ts).withWatermark(ts, watermark)
    return (df.groupBy(F.window(ts, duration).alias("window"), "tipo_evento", "placa_vehiculo")
              .agg(F.count(F.lit(1)).alias("_n")))


def roll_up_vehicles(per_vehicle: DataFrame) -> DataFrame:
    """Second level: events and distinct vehicles per (window, kind), flattened."""
    out = (per_vehicle.groupBy("window", "tipo_evento")
           .agg(F.sum("_n").alias("cantidad_eventos"),
                F.count("placa_vehiculo").alias("vehiculos_afectados")))
    return flatten_window(out)


LATEST_KEYS = ["ventana_inicio", "ventana_fin", "tipo_evento", "placa_vehiculo"]


def roll_up_latest(per_vehicle: DataFrame) -> DataFrame:
    """``roll_up_vehicles`` of flattened rows, one for each of ``LATEST_KEYS``."""
    return (per_vehicle.groupBy("tipo_evento", "ventana_inicio", "ventana_fin")
            .agg(F.sum("_n").alias("cantidad_eventos"), F.count("placa_vehiculo").alias("vehiculos_afectados"))
            .select("tipo_evento", "cantidad_eventos", "vehiculos_afectados", "ventana_inicio", "ventana_fin"))


def alerts_by_vehicle(alerts: DataFrame, ts: str = "kafka_timestamp", duration: str = S.ALERT_WINDOW,
                      watermark: str | None = None, processed_at=None) -> DataFrame:
    """Alerts per (window, vehicle, alert kind).

    Windows on event time by default; pass ``ts="procesado_en"`` for processing time.
    """
    df = alerts
    if watermark:
        df = event_time(df, ts).withWatermark(ts, watermark)
    out = (df.groupBy(F.window(ts, duration).alias("window"), "placa_vehiculo", "alerta_tipo")
             .agg(F.count(F.lit(1)).alias("total_alertas")))
    return stamp(flatten_window(out), processed_at)


DAILY_KEYS = ["fecha", "tipo_evento"]


def daily_counts(events: DataFrame, ts: str = "kafka_timestamp") -> DataFrame:
    """A11/A13 kept by the stream: events per day and kind. As a stream its state is one row for
    each kind a day, so it needs no watermark and counts late rows, too."""
    return events.groupBy(F.to_date(ts).alias("fecha"), "tipo_evento").agg(F.count(F.lit(1)).alias("cantidad"))
