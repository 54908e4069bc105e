"""Registered queries: the fleet operators run over the driver tables (via ``standins``).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables. Column
names equal the oracle SQL's (``flotilla.plans.oracles``). Timestamps are presented as UTC
wall-clock (TIMESTAMP_NTZ), the type DuckDB's TIMESTAMP has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.operators import bitmaps, clean, dashboard, events, kpis, logs, quality, report, windows
from flotilla.plans import standins as T
from flotilla.session import apply_runtime_defaults, scratch_path
from flotilla.sinks import Publication, publish, read_latest, write_csv, write_json
from flotilla.sinks.stream import append_feed, upsert_table
from flotilla.sources import (
    BAD, land, read_deliveries, read_gps, read_incidents, read_landed, read_log, read_table, read_vehicles, table_stream,
)
from flotilla.streaming import build_plan

# Fixed report stamp for reproducible results (the job stamps its own run time).
REPORT_TIME = "2024-02-01 00:00:00"


def as_wall_clock(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as UTC wall-clock TIMESTAMP_NTZ (session zone is UTC)."""
    dtypes = df.dtypes
    if not any(t == "timestamp" for _, t in dtypes):
        return df
    return df.selectExpr(*[f"CAST(`{c}` AS TIMESTAMP_NTZ) AS `{c}`" if t == "timestamp" else f"`{c}`"
                           for c, t in dtypes])


def _once(method):
    """Build a frame once per ``Inputs`` (one query call): shared by every use in that query."""
    name = f"_memo_{method.__name__}"

    def wrapper(self):
        if name not in self.__dict__:
            self.__dict__[name] = method(self)
        return self.__dict__[name]
    wrapper.__name__, wrapper.__doc__ = method.__name__, method.__doc__
    return wrapper


class Inputs:
    """Stand-in fleet inputs over one scale-factor folder; frames are built lazily, once each."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        apply_runtime_defaults(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name):
        return T.table(self.spark, self.sf_dir, name)

    @_once
    def deliveries_raw(self):
        return T.deliveries_raw(self.t("lineitem"))

    @_once
    def gps_raw(self):
        return T.gps_raw(self.t("events"))

    @_once
    def incidents_raw(self):
        return T.incidents_raw(self.t("events"))

    @_once
    def vehicles(self):
        return T.vehicles(self.t("supplier"))

    @_once
    def deliveries(self):
        return clean.clean_deliveries(self.deliveries_raw())

    @_once
    def gps(self):
        return clean.clean_gps(self.gps_raw())

    @_once
    def incidents(self):
        return clean.clean_incidents(self.incidents_raw())

    @_once
    def report(self):
        return report.fleet_report(kpis.delivery_kpis(self.deliveries()), kpis.gps_kpis(self.gps()),
                                   kpis.incident_kpis(self.incidents()), self.vehicles(),
                                   report_time=REPORT_TIME)

    @_once
    def log(self):
        return logs.parse_log(T.log_lines(self.t("events")))

    @_once
    def stream_events(self):
        return T.stream_events(self.t("events"))

    @_once
    def incident_ids(self):
        """One row for each incident: cleaning keeps one row per id, whichever it is."""
        return self.incidents_raw().select("incidencia_id").distinct()

    @_once
    def records(self):
        return T.keyed_records(self.t("events"))

    @_once
    def decoded(self):
        return events.decode_records(self.records())


# --- batch ----------------------------------------------------------------------------------

def q_fleet_report(spark, sf_dir):
    return as_wall_clock(Inputs(spark, sf_dir).report())


def q_delivery_kpis(spark, sf_dir):
    return kpis.delivery_kpis(Inputs(spark, sf_dir).deliveries())


def q_delivery_kpis_sql(spark, sf_dir):
    return kpis.kpis_sql(spark, Inputs(spark, sf_dir).deliveries(), kpis.DELIVERY_KPIS_SQL)


def q_gps_kpis_sql(spark, sf_dir):
    return kpis.kpis_sql(spark, Inputs(spark, sf_dir).gps(), kpis.GPS_KPIS_SQL)


def q_incident_kpis_sql(spark, sf_dir):
    return kpis.kpis_sql(spark, Inputs(spark, sf_dir).incidents(), kpis.INCIDENT_KPIS_SQL)


def q_gps_kpis(spark, sf_dir):
    return kpis.gps_kpis(Inputs(spark, sf_dir).gps())


def q_incident_kpis(spark, sf_dir):
    return kpis.incident_kpis(Inputs(spark, sf_dir).incidents())


def q_clean_deliveries(spark, sf_dir):
    return as_wall_clock(Inputs(spark, sf_dir).deliveries())


def q_clean_gps(spark, sf_dir):
    return as_wall_clock(Inputs(spark, sf_dir).gps())


def q_clean_incidents(spark, sf_dir):
    return as_wall_clock(Inputs(spark, sf_dir).incidents())


def q_cast_fill(spark, sf_dir):
    """P8, P9, P11, P12 on the raw deliveries: text to int, implausible weight to null, the
    per-column defaults, then every remaining numeric null to 0."""
    from flotilla.functions import null_if, text_to_int
    raw = Inputs(spark, sf_dir).deliveries_raw()
    typed = raw.select(
        "orden_id", "placa_vehiculo", "estado",
        text_to_int("duracion_min").alias("duracion_min"),
        null_if("peso_kg", F.col("peso_kg") > F.lit(S.MAX_WEIGHT_KG)).alias("peso_kg"),
    )
    return typed.fillna({"estado": S.STATE_UNKNOWN}).fillna(0)


def q_parse_timestamps(spark, sf_dir):
    """Order dates printed in both input formats (and one junk suffix), parsed back."""
    from flotilla.functions import parse_ts
    o = Inputs(spark, sf_dir).t("orders")
    plain = F.date_format("o_orderdate", S.DELIVERY_TS_FORMAT)
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return as_wall_clock(o.select(
        "o_orderkey",
        parse_ts(plain, S.DELIVERY_TS_FORMAT).alias("fecha"),
        parse_ts(iso, S.ISO_TS_FORMAT).alias("fecha_iso"),
        parse_ts(F.concat(plain, F.lit("?")), S.DELIVERY_TS_FORMAT).alias("fecha_invalida"),
    ))


def q_log_parse(spark, sf_dir):
    return Inputs(spark, sf_dir).log()


def q_log_level_counts(spark, sf_dir):
    return logs.level_counts(Inputs(spark, sf_dir).log())


def q_log_component_counts(spark, sf_dir):
    return logs.component_counts(Inputs(spark, sf_dir).log())


def q_log_errors(spark, sf_dir):
    return logs.error_lines(Inputs(spark, sf_dir).log())


def q_log_first_errors(spark, sf_dir):
    return logs.first_errors(Inputs(spark, sf_dir).log())


def q_headline_kpis(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return dashboard.headline_kpis(i.report(), i.incident_ids())


def q_kpi_sheet(spark, sf_dir):
    """The headline KPIs with their display text."""
    return dashboard.kpi_sheet(q_headline_kpis(spark, sf_dir))


def q_status_counts(spark, sf_dir):
    return dashboard.value_counts(Inputs(spark, sf_dir).deliveries(), "estado")


def q_severity_share(spark, sf_dir):
    counts = dashboard.value_counts(Inputs(spark, sf_dir).incidents(), "severidad")
    return dashboard.share_of_total(counts)


def q_event_type_counts(spark, sf_dir):
    only = events.decode_records(Inputs(spark, sf_dir).records(), ["tipo_evento"])
    return dashboard.value_counts(only, "tipo_evento")


def q_top_km(spark, sf_dir):
    return dashboard.top_n(Inputs(spark, sf_dir).report(), "km_totales")


def q_top_success(spark, sf_dir):
    return dashboard.top_n(Inputs(spark, sf_dir).report(), "tasa_exito_pct")


def q_event_preview(spark, sf_dir):
    d = Inputs(spark, sf_dir).decoded()
    return as_wall_clock(dashboard.preview(d, ["kafka_timestamp", "evento_id"], 1000))


def q_event_codec(spark, sf_dir):
    return as_wall_clock(Inputs(spark, sf_dir).decoded())


def q_alerts(spark, sf_dir):
    return as_wall_clock(events.alerts(Inputs(spark, sf_dir).decoded()))


def q_alerts_union(spark, sf_dir):
    return as_wall_clock(events.alerts_union(Inputs(spark, sf_dir).decoded()))


def q_events_by_type_1m(spark, sf_dir):
    only = events.decode_records(Inputs(spark, sf_dir).records(), ["tipo_evento"])
    return as_wall_clock(windows.events_by_type(only))


def q_alerts_by_vehicle_2m(spark, sf_dir):
    al = events.alerts(Inputs(spark, sf_dir).decoded())
    return as_wall_clock(windows.alerts_by_vehicle(al))


BATCH = {
    "fleet_report": q_fleet_report,
    "delivery_kpis": q_delivery_kpis,
    "delivery_kpis_sql": q_delivery_kpis_sql,
    "gps_kpis": q_gps_kpis,
    "gps_kpis_sql": q_gps_kpis_sql,
    "incident_kpis": q_incident_kpis,
    "incident_kpis_sql": q_incident_kpis_sql,
    "clean_deliveries": q_clean_deliveries,
    "clean_gps": q_clean_gps,
    "clean_incidents": q_clean_incidents,
    "parse_timestamps": q_parse_timestamps,
    "cast_fill": q_cast_fill,
    "log_parse": q_log_parse,
    "log_level_counts": q_log_level_counts,
    "log_component_counts": q_log_component_counts,
    "log_errors": q_log_errors,
    "log_first_errors": q_log_first_errors,
    "headline_kpis": q_headline_kpis,
    "kpi_sheet": q_kpi_sheet,
    "status_counts": q_status_counts,
    "severity_share": q_severity_share,
    "event_type_counts": q_event_type_counts,
    "top_km": q_top_km,
    "top_success": q_top_success,
    "event_preview": q_event_preview,
    "event_codec": q_event_codec,
    "alerts": q_alerts,
    "alerts_union": q_alerts_union,
    "events_by_type_1m": q_events_by_type_1m,
    "alerts_by_vehicle_2m": q_alerts_by_vehicle_2m,
}


def q_stage_counts(spark, sf_dir):
    """A6 with one pass over each source's rows for each kind of count, and one dedup at most:
    a report row is a vehicle with deliveries, and a cleaned incident is an incident id."""
    i = Inputs(spark, sf_dir)
    one, n = F.count(F.lit(1)), F.sum("n")
    by_vehicle = i.deliveries().groupBy("placa_vehiculo").agg(one.alias("n"))
    incidents = i.incidents_raw().groupBy("incidencia_id").agg(one.alias("n"))
    return quality.stage_counts([
        (i.vehicles(), [("vehiculos", "leidas", one)]),
        (i.deliveries_raw(), [("entregas", "leidas", one)]),
        (by_vehicle, [("entregas", "limpias", n), ("reporte_flota", "generado", one)]),
        (i.gps_raw(), [("rutas_gps", "leidas", one)]),
        (i.gps(), [("rutas_gps", "limpias", one)]),
        (incidents, [("incidencias", "leidas", n), ("incidencias", "limpias", one)]),
        (i.log(), [("eventos_sistema", "parseadas", one),
                   ("eventos_sistema", "errores", F.count_if(F.col("nivel") == F.lit(S.LOG_LEVEL_ERROR)))]),
    ])


# --- files written and read back --------------------------------------------------------------

def _text_types(df, schema):
    """The columns with the types of an input file, in another order than the schema's."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in reversed(schema.fields)])


def q_read_vehicles_csv(spark, sf_dir):
    """Columns found by name."""
    out = scratch_path(spark, "queries", "vehiculos_csv")
    write_csv(_text_types(Inputs(spark, sf_dir).vehicles(), S.VEHICLES), out)
    return read_vehicles(spark, out)


def q_read_deliveries_csv(spark, sf_dir):
    """Columns found by name."""
    out = scratch_path(spark, "queries", "entregas_csv")
    write_csv(_text_types(Inputs(spark, sf_dir).deliveries_raw(), S.DELIVERIES_RAW), out)
    return read_deliveries(spark, out)


def q_read_gps_json(spark, sf_dir):
    """S3 as JSON Lines."""
    out = scratch_path(spark, "queries", "gps_json")
    write_json(_text_types(Inputs(spark, sf_dir).gps_raw(), S.GPS_RAW), out)
    return read_gps(spark, out)


def q_read_incidents_array(spark, sf_dir):
    """S4 as JSON arrays, one for each file; a file has about 5,000 incidents."""
    out = scratch_path(spark, "queries", "incidencias_json")
    rows = _text_types(Inputs(spark, sf_dir).incidents_raw(), S.INCIDENTS_RAW)
    files = max(1, rows.count() // 5000)
    arrays = (rows.groupBy(F.pmod(F.xxhash64("incidencia_id"), F.lit(files)).alias("archivo"))
              .agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")))
    arrays.write.partitionBy("archivo").text(out)
    return read_incidents(spark, f"{out}/*", multi_line=True)


def q_read_gps_pretty_array(spark, sf_dir):
    """S3 as pretty-printed arrays, an element's braces on lines of their own: read split."""
    out = scratch_path(spark, "queries", "gps_pretty")
    rows = _text_types(Inputs(spark, sf_dir).gps_raw(), S.GPS_RAW)
    files = max(1, rows.count() // 5000)
    element = F.regexp_replace(F.to_json(F.struct(*rows.columns), {"pretty": "true"}), "\n", "\n  ")
    arrays = (rows.select("registro_id", F.concat(F.lit("  "), element).alias("e"))
              .groupBy(F.pmod(F.xxhash64("registro_id"), F.lit(files)).alias("archivo"))
              .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("e"), ",\n"), F.lit("\n]")).alias("value")))
    arrays.write.partitionBy("archivo").text(out)
    return read_gps(spark, f"{out}/*", multi_line=True)


def q_misshapen_csv(spark, sf_dir):
    """Vehicle records some of which lost their tail or have two fields too many, told by the
    reader: read, malformed by shape, with a value that doesn't fit, and whole."""
    out = scratch_path(spark, "queries", "vehiculos_deformes")
    v = _text_types(Inputs(spark, sf_dir).vehicles(), S.VEHICLES)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in v.columns])
    kind = F.col("placa").cast("long") % 7
    shaped = F.when(kind == 0, F.substring_index(line, ",", 3)).when(kind == 1, F.concat(line, F.lit(",x,y"))) \
        .when(kind == 2, F.regexp_replace(line, "(?<=,)[0-9]+(?=,)", "muchos")).otherwise(line)
    files = max(1, v.count() // 5000)       # each with its header
    (v.select("placa", shaped.alias("line")).groupBy(F.pmod(F.xxhash64("placa"), F.lit(files)).alias("archivo"))
     .agg(F.concat(F.lit(",".join(v.columns) + "\n"), F.array_join(F.collect_list("line"), "\n")).alias("value"))
     .write.partitionBy("archivo").text(out))
    bad = F.col(BAD)
    return read_vehicles(spark, f"{out}/*", bad_column=BAD).agg(
        F.count(F.lit(1)).alias("leidas"), F.count_if(bad.contains(",x,y") | ~bad.contains("capacidad_kg")).alias("deformes"),
        F.count_if(bad.contains("capacidad_kg")).alias("valores"), F.count_if(bad.isNull()).alias("sanas"))


def q_clean_deliveries_landed(spark, sf_dir):
    """Q1 over a table landed in buckets of the record id: the dedup window has no exchange."""
    out = scratch_path(spark, "queries", "entregas_cubos")
    land(Inputs(spark, sf_dir).deliveries_raw(), out, "orden_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return as_wall_clock(clean.clean_deliveries(read_landed(spark, out)))


def q_read_log_text(spark, sf_dir):
    """Text lines."""
    out = scratch_path(spark, "queries", "eventos_log")
    T.log_lines(Inputs(spark, sf_dir).t("events")).write.text(out)
    return read_log(spark, out)


# --- publish and read back -------------------------------------------------------------------

def q_publish_report(spark, sf_dir):
    """O1 + S7: the report staged, committed and read back whole by way of the commit note."""
    root = scratch_path(spark, "queries", "publicado")
    with Publication(spark, root) as run:
        publish(Inputs(spark, sf_dir).report(), run.path("reporte_flota"))
    return as_wall_clock(read_table(spark, f"{root}/reporte_flota"))


def q_publish_report_csv(spark, sf_dir):
    """O2: the published report exported as CSV (from the Parquet copy) and read back."""
    i = Inputs(spark, sf_dir)
    base = scratch_path(spark, "queries", "reporte_csv")
    publish(i.report(), f"{base}/parquet")
    rep = read_table(spark, f"{base}/parquet")
    write_csv(rep, f"{base}/csv")
    back = spark.read.schema(rep.schema).option("header", True).csv(f"{base}/csv")
    return as_wall_clock(back)


def q_kpi_summary_json(spark, sf_dir):
    """O3: the seven-column KPI summary written as JSON Lines and read back."""
    rep = Inputs(spark, sf_dir).report()
    out = scratch_path(spark, "queries", "kpi_resumen")
    summary = report.report_summary(rep)
    write_json(summary, out)
    return spark.read.schema(summary.schema).json(out)


# --- stream ------------------------------------------------------------------------------------

def driver_records(spark, sf_dir, max_files=None):
    """The driver's events table read as a file stream, shaped as topic records."""
    apply_runtime_defaults(spark)
    schema = T.table(spark, sf_dir, "events").schema
    return T.keyed_records(table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet*", schema,
                                        max_files=max_files))


_records = driver_records


def _run_append(spark, df, name):
    base = scratch_path(spark, "queries", name)
    q = append_feed(df, f"{name}_{uuid.uuid4().hex[:8]}", f"{base}/data", f"{base}/checkpoint",
                    trigger="availableNow")
    q.awaitTermination()
    return read_table(spark, f"{base}/data")


def _sorted_parts(spark, sf_dir, parts=4):
    """The events table as files of ascending time, written one after the other: a stream that
    reads one file at a time takes as many micro-batches, and none of the rows comes late."""
    rows = T.table(spark, sf_dir, "events")
    out = scratch_path(spark, "queries", "events_by_time")
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    edges = [low + (high - low) * k / parts for k in range(1, parts)] if low is not None else []
    place = sum((F.coalesce(F.col("ts") >= F.lit(e), F.lit(False)).cast("int") for e in edges), F.lit(0))
    for k in range(len(edges) + 1):
        rows.where(place == k).write.mode("append").parquet(out)
    return out, rows.schema


def q_event_feed(spark, sf_dir):
    """Decoded events appended by a stream, read back."""
    plan = build_plan(_records(spark, sf_dir))
    return as_wall_clock(_run_append(spark, plan.events, "event_feed"))


def q_alert_feed(spark, sf_dir):
    """Alerts appended by a stream (processing stamp dropped for comparison)."""
    plan = build_plan(_records(spark, sf_dir))
    back = _run_append(spark, plan.alerts, "alert_feed")
    return as_wall_clock(back.drop("procesado_en"))


def _numbered(spark, values, name):
    """A dictionary of a column's values."""
    path = scratch_path(spark, "queries", name)
    bitmaps.extend_dictionary(spark, path, values)
    return bitmaps.dictionary(spark, path)


def q_events_by_type_1m_bitmap(spark, sf_dir):
    """Distinct vehicles by bitmaps over dense numbers, half of the vehicles numbered
    beforehand and the others counted by row."""
    only = events.decode_records(Inputs(spark, sf_dir).records(), ["tipo_evento"])
    known = only.where(F.pmod(F.xxhash64("placa_vehiculo"), F.lit(2)) == 0).select("placa_vehiculo")
    return as_wall_clock(bitmaps.events_by_type_bitmap(only, _numbered(spark, known, "vehiculos_dic")))


def q_events_by_type_1m_bitmap_closed(spark, sf_dir):
    """W5 as a stream: closed windows, state of one row for each (window, kind, 32,768 vehicles)."""
    apply_runtime_defaults(spark)
    only = events.decode_records(_records(spark, sf_dir), ["tipo_evento"])
    plates = events.decode_records(Inputs(spark, sf_dir).records(), ["tipo_evento"]).select("placa_vehiculo")
    counted = bitmaps.events_by_type_bitmap(only, _numbered(spark, plates, "vehiculos_dic"), watermark=S.EVENT_WATERMARK)
    return as_wall_clock(_run_append(spark, counted, "events_by_type_1m_bitmap_closed"))


def q_delivery_clients_bitmap(spark, sf_dir):
    """A1: deliveries and distinct clients of a vehicle, clients as bits."""
    d = Inputs(spark, sf_dir).deliveries().select("placa_vehiculo", "cliente_id")
    out = bitmaps.distinct_by_bitmap(d, [F.col("placa_vehiculo")], "cliente_id", _numbered(spark, d.select("cliente_id"), "clientes_dic"),
                                     "total_entregas", "clientes_atendidos")
    return out.withColumnRenamed("_k0", "placa_vehiculo")


def q_events_by_type_1m_closed(spark, sf_dir):
    """W1, W2, W5 (chained exact distinct): closed windows published in append mode. The stamp of
    P6 is replaced by whether it is there and not before the window's end."""
    plan = build_plan(_records(spark, sf_dir))
    return as_wall_clock(_stamp_checked(_run_append(spark, plan.events_by_type, "events_by_type_1m_closed")))


def q_alerts_by_vehicle_2m_closed(spark, sf_dir):
    """Closed alert windows on event time, append mode, 5-minute watermark; P6 as above."""
    plan = build_plan(_records(spark, sf_dir))
    return as_wall_clock(_stamp_checked(_run_append(spark, plan.alerts_by_vehicle, "alerts_by_vehicle_2m_closed")))


def _stamp_checked(df):
    return df.withColumn("procesado_despues", F.col("procesado_en") >= F.col("ventana_fin")).drop("procesado_en")


def q_events_by_type_1m_stream(spark, sf_dir):
    """The summary of all windows, open ones too, kept current over several micro-batches.

    Exact distinct vehicles without a per-window set in state: the stream keeps counts per
    (window, kind, vehicle), writes those that changed, by day, and drops the state of closed
    windows; days that the watermark has passed are merged and sealed."""
    apply_runtime_defaults(spark)
    path, schema = _sorted_parts(spark, sf_dir)
    plan = build_plan(T.keyed_records(table_stream(spark, path, schema, max_files=1)))
    name = "events_by_type_1m_stream"
    base = scratch_path(spark, "queries", name)
    q = upsert_table(plan.events_by_type_latest, f"{name}_{uuid.uuid4().hex[:8]}", f"{base}/data",
                     f"{base}/checkpoint", windows.LATEST_KEYS, trigger="availableNow", merge_every=2,
                     day_of="ventana_inicio", delay=S.EVENT_WATERMARK)
    q.awaitTermination()
    return as_wall_clock(windows.roll_up_latest(read_latest(spark, f"{base}/data")))


EXTRA = {
    "stage_counts": q_stage_counts,
    "read_vehicles_csv": q_read_vehicles_csv,
    "read_deliveries_csv": q_read_deliveries_csv,
    "read_gps_json": q_read_gps_json,
    "read_incidents_array": q_read_incidents_array,
    "read_gps_pretty_array": q_read_gps_pretty_array,
    "misshapen_csv": q_misshapen_csv,
    "events_by_type_1m_bitmap": q_events_by_type_1m_bitmap,
    "events_by_type_1m_bitmap_closed": q_events_by_type_1m_bitmap_closed,
    "delivery_clients_bitmap": q_delivery_clients_bitmap,
    "clean_deliveries_landed": q_clean_deliveries_landed,
    "read_log_text": q_read_log_text,
    "publish_report": q_publish_report,
    "publish_report_csv": q_publish_report_csv,
    "kpi_summary_json": q_kpi_summary_json,
}

STREAM = {
    "event_feed": q_event_feed,
    "alert_feed": q_alert_feed,
    "events_by_type_1m_closed": q_events_by_type_1m_closed,
    "alerts_by_vehicle_2m_closed": q_alerts_by_vehicle_2m_closed,
    "events_by_type_1m_stream": q_events_by_type_1m_stream,
}

ALL = {**BATCH, **EXTRA, **STREAM}
