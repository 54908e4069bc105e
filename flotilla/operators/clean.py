"""Cleaners for deliveries, GPS pings and incidents.

Order is part of the semantics: deduplicate first, then convert and filter (a filter moved
below an arbitrary-pick dedup would change which row survives).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.functions import null_if, null_unless_true, parse_ts, text_to_int
from flotilla.operators.dedup import dedup_first


def clean_deliveries(raw: DataFrame, max_weight: float = S.MAX_WEIGHT_KG,
                     ts_format: str = S.DELIVERY_TS_FORMAT) -> DataFrame:
    """Q1, P7, P8, P9, P11.

    First row per ``orden_id``; delivery time parsed; duration text to int (blank/junk
    null); weight above ``max_weight`` nulled (the limit itself stays); missing state
    ``Desconocido`` and missing duration 0 (so it pulls the mean duration down).
    """
    df = dedup_first(raw, ["orden_id"])
    return df.withColumns({
        "fecha_entrega": parse_ts("fecha_entrega", ts_format),
        "duracion_min": F.coalesce(text_to_int("duracion_min"), F.lit(0)),
        "peso_kg": null_if("peso_kg", F.col("peso_kg") > F.lit(max_weight)),
        "estado": F.coalesce(F.col("estado"), F.lit(S.STATE_UNKNOWN)),
    })


def clean_gps(raw: DataFrame, min_speed: float = S.MIN_SPEED_KMH,
              max_speed: float = S.MAX_SPEED_KMH, min_satellites: int = S.MIN_SATELLITES,
              ts_format: str = S.ISO_TS_FORMAT) -> DataFrame:
    """First row per ``registro_id``; plausible speed; enough satellites.

    Null speed or satellite counts are dropped (a comparison with null is not true).
    """
    df = dedup_first(raw, ["registro_id"])
    keep = F.col("velocidad_kmh").between(min_speed, max_speed) & (F.col("satelites") >= F.lit(min_satellites))
    return df.filter(keep).withColumn("timestamp", parse_ts("timestamp", ts_format))


def clean_incidents(raw: DataFrame, ts_format: str = S.ISO_TS_FORMAT) -> DataFrame:
    """First row per ``incidencia_id``; unresolved → no resolution time."""
    df = dedup_first(raw, ["incidencia_id"])
    return df.withColumns({
        "fecha": parse_ts("fecha", ts_format),
        "tiempo_resolucion_min": null_unless_true("tiempo_resolucion_min", "resuelta"),
    })
