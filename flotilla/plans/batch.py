"""The batch ETL and the dashboard data as runnable plans.

read → clean → KPIs → report → publish, with no action before the writes. Row counts per
stage ride on the writes (``df.observe``); the report is written once and every later output
(CSV, KPI summary, dashboard series) reads the written table, so all carry one report stamp
and nothing is recomputed. All tables of a run are staged and checked, then published as one.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.operators import clean, dashboard, kpis, logs, quality, report
from flotilla.sinks import Publication, Snapshot, publish, publish_counted, publish_observed, read_latest, write_csv, write_json
from flotilla.sources import (
    BAD, read_deliveries, read_gps, read_incidents, read_log, read_optional, read_table, read_vehicles,
    refuse_if_nothing_fits,
)
from flotilla.sources.arrays import element_border

# Published table names (fixed values: the collections the dashboard reads).
TABLES = ["vehiculos", "entregas", "rutas_gps", "incidencias", "reporte_flota", "eventos_sistema"]


@dataclass
class RawInputs:
    vehicles: DataFrame
    deliveries: DataFrame
    gps: DataFrame
    incidents: DataFrame
    log_lines: DataFrame


def read_inputs(spark: SparkSession, folder: str, multi_line_json: bool = False,
                landing: str | None = None) -> RawInputs:
    """S1-S5 from one folder. JSON arrays that can't be split between elements are read by one task
    each, so with ``multi_line_json`` they are landed once as Parquet under ``landing`` and read
    back split."""
    def read(reader, name: str) -> DataFrame:
        path = f"{folder}/{name}.json"
        rows = reader(spark, path, multi_line=multi_line_json, bad_column=BAD)
        if multi_line_json and landing and not element_border(spark, path):
            publish(rows, f"{landing}/{name}")
            return read_table(spark, f"{landing}/{name}")
        return rows

    gps, inc = read(read_gps, "gps_registros"), read(read_incidents, "incidencias")
    return RawInputs(
        vehicles=read_vehicles(spark, f"{folder}/vehiculos.csv", bad_column=BAD),
        deliveries=read_deliveries(spark, f"{folder}/entregas.csv", bad_column=BAD),
        gps=gps, incidents=inc,
        log_lines=read_log(spark, f"{folder}/eventos_sistema.log"),
    )


def read_driver_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    """The five inputs taken from the driver tables (see ``plans.standins``)."""
    from flotilla.plans import standins as T
    events = T.table(spark, sf_dir, "events")
    return RawInputs(
        vehicles=T.vehicles(T.table(spark, sf_dir, "supplier")),
        deliveries=T.deliveries_raw(T.table(spark, sf_dir, "lineitem")),
        gps=T.gps_raw(events),
        incidents=T.incidents_raw(events),
        log_lines=T.log_lines(events),
    )


def _concurrently(jobs: dict) -> dict:
    """Run independent Spark actions from a few driver threads; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` without its mark of malformed records; rows and marks are counted as they pass."""
    obs = Observation(name)
    counted = [F.count(F.lit(1)).alias("rows")] + ([F.count(BAD).alias("bad")] if BAD in df.columns else [])
    return df.observe(obs, *counted).drop(BAD), obs


# Event-time column of each cleaned fact table, for the optional day partitioning.
DAY_COLUMNS = {"entregas": "fecha_entrega", "rutas_gps": "timestamp", "incidencias": "fecha"}


def run_batch(spark: SparkSession, raw: RawInputs, out: str, report_time=None,
              partition_by_day: bool = False, most_bad: float = 1.0) -> DataFrame:
    """Publish the six tables, the report CSV, the KPI summary JSON and the stage counts.

    ``calidad`` has for each input the records read (``leidas``) and, where the reader marks
    them, those that don't fit its schema (``malformadas``); for each cleaned table, the values that
    its sums leave out (``sin_sumar``). The run is staged: an input none of
    whose records fits (or more than the share ``most_bad`` of which don't), a plate that repeats
    in the vehicle master or any other failure stops it, and what was published before stays.

    ``partition_by_day`` writes the cleaned deliveries, pings and incidents partitioned by their
    event day (column ``dia``), so date-bounded readers prune. It costs a sort by day in each
    write task and more files per task, so it is off by default.
    Returns the stage-count table (also published as ``calidad``).
    """
    with Publication(spark, out) as run:
        _stage(spark, raw, run.path, report_time, partition_by_day, most_bad)
    return read_table(spark, f"{out}/calidad")


def _stage(spark: SparkSession, raw: RawInputs, path: Callable[[str], str], report_time, partition_by_day: bool,
           most_bad: float) -> None:
    """All tables of a run, checked, at ``path(name)``."""
    counts: list[tuple[str, str, int]] = []
    read_obs = {}
    staged = {}
    sources = {"vehiculos": raw.vehicles, "entregas": raw.deliveries, "rutas_gps": raw.gps,
               "incidencias": raw.incidents, "eventos_sistema": raw.log_lines}
    for name, df in sources.items():
        staged[name], read_obs[name] = _observed(df, f"leidas_{name}")

    deliveries = clean.clean_deliveries(staged["entregas"])
    gps = clean.clean_gps(staged["rutas_gps"])
    incidents = clean.clean_incidents(staged["incidencias"])
    log = logs.parse_log(staged["eventos_sistema"])

    # The five writes are independent jobs: submitted together, the scheduler runs their
    # stages side by side instead of leaving the cluster idle behind the slowest one.
    tables = [("vehiculos", staged["vehiculos"]), ("entregas", deliveries), ("rutas_gps", gps),
              ("incidencias", incidents), ("eventos_sistema", log)]

    def write_one(name: str, df: DataFrame) -> dict[str, int]:
        left_out = {"misfits": kpis.misfits(df, name)} if name in kpis.SUMMED else {}
        if partition_by_day and name in DAY_COLUMNS:
            return publish_observed(df.withColumn("dia", F.to_date(DAY_COLUMNS[name])),
                                    path(name), f"pub_{name}", left_out, partition_by=["dia"])
        return publish_observed(df, path(name), f"pub_{name}", left_out)

    written = _concurrently({name: (lambda df=df, name=name: write_one(name, df))
                             for name, df in tables})
    for name, df in sources.items():
        rows, bad = int(read_obs[name].get["rows"]), read_obs[name].get.get("bad")
        counts += [(name, "leidas", rows), (name, "publicadas", written[name]["rows"])]
        if "misfits" in written[name]:
            counts.append((name, "sin_sumar", written[name]["misfits"]))
        if bad is not None:
            counts.append((name, "malformadas", int(bad)))
            refuse_if_nothing_fits(name, rows, int(bad), most_bad)
    report.check_master(read_table(spark, path("vehiculos")))

    # KPIs from the written, cleaned tables: the cleaning is not run twice. The report chain
    # (report, then its CSV and JSON) and the log series are independent: run them together.
    def report_chain() -> int:
        rep = report.fleet_report(
            kpis.delivery_kpis(read_table(spark, path("entregas"))),
            kpis.gps_kpis(read_table(spark, path("rutas_gps"))),
            kpis.incident_kpis(read_table(spark, path("incidencias"))),
            read_table(spark, path("vehiculos")), report_time=report_time)
        n = publish_counted(rep, path("reporte_flota"), "rep")
        rep_back = read_table(spark, path("reporte_flota"))
        _concurrently({
            "csv": lambda: write_csv(rep_back, path("reporte_flota_csv")),                     # O2
            "json": lambda: write_json(report.report_summary(rep_back), path("kpi_resumen")),  # O3
        })
        return n

    plog = read_table(spark, path("eventos_sistema"))
    done = _concurrently({
        "report": report_chain,
        "levels": lambda: publish(logs.level_counts(plog), path("eventos_por_nivel")),       # A4
        "components": lambda: publish(logs.component_counts(plog), path("eventos_por_componente")),
        "errors": lambda: publish_counted(logs.error_lines(plog), path("eventos_error"), "err"),  # F6
    })
    counts.append(("reporte_flota", "publicadas", done["report"]))
    counts.append(("eventos_sistema", "errores", done["errors"]))
    publish(quality.counts_table(spark, counts), path("calidad"))                            # A6


def event_series(spark: SparkSession, published: str) -> tuple[DataFrame, bool]:
    """Events by kind, and whether there are no events at all. From the counts per day that
    the stream keeps (``eventos_por_dia``); the feed is only read where it keeps none."""
    try:
        daily = read_latest(spark, f"{published.rstrip('/')}/eventos_por_dia")
        return dashboard.value_counts(daily, "tipo_evento", counted="cantidad"), False
    except FileNotFoundError:
        events = read_optional(spark, f"{published}/eventos_streaming", S.EVENT_ROW)
    absent = events is None
    if absent:
        events = spark.createDataFrame([], S.EVENT_ROW)
    return dashboard.value_counts(events, "tipo_evento"), absent


def run_dashboard(spark: SparkSession, published: str, out: str) -> None:
    """Headline KPI sheet (O7) and chart series (A11, A12, K1, K2), from the tables of one
    published run.

    Without an event table its series is empty, and ``calidad`` says ``eventos/ausente``.
    """
    now = Snapshot(spark, published)
    rep, deliveries, incidents = (now.table(n) for n in ("reporte_flota", "entregas", "incidencias"))
    series, absent = event_series(spark, published)
    publish(quality.counts_table(spark, [("eventos", "ausente", int(absent))]), f"{out}/calidad")
    sev = dashboard.value_counts(incidents, "severidad")
    _concurrently({
        "kpis": lambda: write_json(dashboard.kpi_sheet(dashboard.headline_kpis(rep, incidents)),
                                   f"{out}/kpis"),
        "estado": lambda: publish(dashboard.value_counts(deliveries, "estado"), f"{out}/entregas_por_estado"),
        "severidad": lambda: publish(dashboard.share_of_total(sev), f"{out}/incidencias_por_severidad"),
        "top_km": lambda: publish(dashboard.top_n(rep, "km_totales"), f"{out}/top_km"),
        "top_exito": lambda: publish(dashboard.top_n(rep, "tasa_exito_pct"), f"{out}/top_exito"),
        "eventos": lambda: publish(series, f"{out}/eventos_por_tipo"),
    })
