"""Keyed JSON events: encode, decode, alert rules.

All functions work unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flotilla import schemas as S
from flotilla.functions import alert_route_text, alert_speed_text


def encode_events(events: DataFrame, key: str = "placa_vehiculo",
                  event_time: str = "kafka_timestamp") -> DataFrame:
    """``key`` = plate, ``value`` = the event as one JSON object (UTF-8), ``timestamp``.

    Null fields are left out of the JSON, as a producer that omits absent fields does.
    The columns are what the Kafka sink expects.
    """
    fields = [c for c in S.EVENT_FIELDS if c in events.columns]
    return events.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.col(event_time).alias("timestamp"),
    )


def decode_records(records: DataFrame, fields: list[str] | None = None, bad_column: str | None = None) -> DataFrame:
    """P1 + P2: topic records to one flat event row.

    ``placa_vehiculo`` is one column: the payload's plate, else the record key. Malformed
    JSON yields a row with the key and null fields; unknown fields are ignored. ``fields``
    names the payload fields wanted (default: all); only they are parsed. With ``bad_column`` a
    text column of that name has the payload where it doesn't fit them (empty for none), else null.

    The payload is parsed once per record, whatever consumes the result: the decoded fields are
    emitted by a generator (``inline`` of a one-element array). A filter on decoded fields
    cannot be pushed below a generator's output, whereas over a plain projection Catalyst
    would inline ``from_json`` into every pushed-down predicate (and per field, with schema
    pruning): measured 1.8x slower for a filtered count, 3x for a per-field decode. The record's
    time goes beside the generator, so a filter on it reaches the scan.
    """
    wanted = [c for c in S.EVENT_FIELDS if fields is None or c in fields]
    schema = T.StructType([f for f in S.EVENT.fields if f.name in wanted or f.name == "placa_vehiculo"])
    options = {}
    if bad_column:
        schema.add(bad_column, T.StringType())
        options["columnNameOfCorruptRecord"] = bad_column
    raw = records.select(
        F.col("key").cast("string").alias("_key"),
        F.from_json(F.col("value").cast("string"), schema, options).alias("_d"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    d, rest = F.col("_d"), [c for c in wanted if c != "placa_vehiculo"]
    bad = [F.when(d.isNull(), F.lit("")).otherwise(d[bad_column]).alias(bad_column)] if bad_column else []
    row = F.struct(F.coalesce(d["placa_vehiculo"], F.col("_key")).alias("placa_vehiculo"),
                   *[d[c].alias(c) for c in rest], *bad)
    return raw.select("kafka_timestamp", F.inline(F.array(row))) \
        .select("placa_vehiculo", "kafka_timestamp", *rest, *([bad_column] if bad_column else []))


def speed_rule():
    """a speed alert, or a GPS update strictly above the limit."""
    kind, speed = F.col("tipo_evento"), F.col("velocidad_kmh")
    return (kind == F.lit(S.EVENT_SPEED)) | ((kind == F.lit(S.EVENT_GPS)) & (speed > F.lit(S.SPEED_ALERT_KMH)))


def route_rule():
    """a route deviation."""
    return F.col("tipo_evento") == F.lit(S.EVENT_ROUTE)


def _alert_columns(extra):
    return [*S.ALERT_COLUMNS, *extra]


def alerts(events: DataFrame, processed_at=None, keep=("kafka_timestamp",)) -> DataFrame:
    """F3, F4, P4, P5 in one pass: each event is matched against the rule table once.

    ``explode(array_compact([rule1 ? alert1 : null, rule2 ? alert2 : null]))`` reads the
    input a single time (a stream is not scanned twice) and would also allow rules that
    overlap. ``processed_at``: add ``procesado_en`` (``True`` = now, or a fixed stamp).
    """
    speed = F.when(speed_rule(), F.struct(
        F.lit(S.ALERT_SPEED).alias("alerta_tipo"),
        alert_speed_text("placa_vehiculo", "velocidad_kmh").alias("alerta_descripcion")))
    route = F.when(route_rule(), F.struct(
        F.lit(S.ALERT_ROUTE).alias("alerta_tipo"),
        alert_route_text("desviacion_km").alias("alerta_descripcion")))
    extra = [c for c in keep if c in events.columns]
    base = [c for c in S.ALERT_COLUMNS if c not in ("alerta_tipo", "alerta_descripcion")]
    # No separate filter: a filter would be pushed below the decode projection and re-evaluate
    # the JSON parse inside its condition. The generator emits nothing for non-matching events.
    out = (events
           .select(*base, *extra, F.explode(F.array_compact(F.array(speed, route))).alias("_a"))
           .select(*base, *extra, "_a.alerta_tipo", "_a.alerta_descripcion")
           .select(*_alert_columns(extra)))
    return stamp(out, processed_at)


def alerts_union(events: DataFrame, processed_at=None, keep=("kafka_timestamp",)) -> DataFrame:
    """The same alerts as two filtered branches unioned by name (missing -> null)."""
    extra = [c for c in keep if c in events.columns]
    speed = (events.filter(speed_rule())
             .withColumn("alerta_tipo", F.lit(S.ALERT_SPEED))
             .withColumn("alerta_descripcion", alert_speed_text("placa_vehiculo", "velocidad_kmh")))
    route = (events.filter(route_rule())
             .withColumn("alerta_tipo", F.lit(S.ALERT_ROUTE))
             .withColumn("alerta_descripcion", alert_route_text("desviacion_km")))
    out = speed.unionByName(route, allowMissingColumns=True).select(*_alert_columns(extra))
    return stamp(out, processed_at)


def stamp(df: DataFrame, processed_at) -> DataFrame:
    """``procesado_en``, now (``True``) or a fixed stamp; nothing for ``None``."""
    if processed_at is None or processed_at is False:
        return df
    at = F.current_timestamp() if processed_at is True else F.lit(processed_at).cast("timestamp")
    return df.withColumn("procesado_en", at)
