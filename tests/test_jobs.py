"""Batch, dashboard and stream jobs end to end on a small input folder of the fleet formats."""

import json
import os

import pytest

from flotilla import schemas as S
from flotilla.plans.batch import TABLES, event_series, read_inputs, run_batch, run_dashboard
from flotilla.sinks import Publication, Snapshot, publish
from flotilla.sources import UnreadableInputError, read_table


def _inputs(folder):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/vehiculos.csv", "w", newline="") as f:
        f.write("placa,modelo,capacidad_kg,conductor_id,ano_fabricacion,tipo_combustible,activo\r\n"
                "A,Volvo,8000,DRV-1,2021,Diesel,True\r\nB,Hino,3000,DRV-2,2020,GNV,False\r\n")
    with open(f"{folder}/entregas.csv", "w") as f:
        f.write(",".join(x.name for x in S.DELIVERIES_RAW.fields) + "\n")
        f.write("ORD-1,A,Lima,Callao,100.0,2025-01-01 10:00:00,Completado,30,10.0,CLI-1\n"
                "ORD-1,A,Lima,Callao,100.0,2025-01-01 10:00:00,Completado,30,10.0,CLI-1\n"
                "ORD-2,A,Lima,Ica,9000.0,2025-01-01 11:00:00,Pendiente,,20.5,CLI-2\n"
                "ORD-3,Z,Lima,Ica,50.0,2025-01-01 12:00:00,Fallido,45,7.25,CLI-3\n")
    gps = [{"registro_id": "G1", "placa_vehiculo": "A", "latitud": -12.0, "longitud": -77.0,
            "velocidad_kmh": 60.0, "timestamp": "2025-01-01T10:00:00Z", "satelites": 8,
            "precision_gps": 2.5},
           {"registro_id": "G2", "placa_vehiculo": "A", "velocidad_kmh": 250.0, "satelites": 8}]
    inc = [{"incidencia_id": "I1", "placa_vehiculo": "A", "tipo": "Choque", "severidad": "Alta",
            "fecha": "2025-01-01T10:00:00Z", "descripcion": "x", "costo_estimado_soles": 150.5,
            "resuelta": True, "tiempo_resolucion_min": 40}]
    for name, objs in [("gps_registros.json", gps), ("incidencias.json", inc)]:
        with open(f"{folder}/{name}", "w") as f:
            json.dump(objs, f, indent=2)
    with open(f"{folder}/eventos_sistema.log", "w") as f:
        f.write("2025-01-01 10:00:00 [INFO] [AUTH] ok\n2025-01-01 10:00:01 [ERROR] [DB_SYNC] fallo\n"
                "short\n")


def test_batch_and_dashboard_jobs(spark, tmp_dir):
    src, out, dash = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/dash"
    _inputs(src)
    raw = read_inputs(spark, src, multi_line_json=True, landing=f"{tmp_dir}/landing")
    counts = {(r.tabla, r.etapa): r.filas
              for r in run_batch(spark, raw, out, report_time="2025-02-01 00:00:00").collect()}
    assert counts[("entregas", "leidas")] == 4 and counts[("entregas", "publicadas")] == 3
    assert counts[("rutas_gps", "leidas")] == 2 and counts[("rutas_gps", "publicadas")] == 1
    assert counts[("entregas", "sin_sumar")] == counts[("rutas_gps", "sin_sumar")] == 0
    assert counts[("eventos_sistema", "publicadas")] == 2 and counts[("eventos_sistema", "errores")] == 1
    assert counts[("reporte_flota", "publicadas")] == 2
    rep = {r.placa_vehiculo: r for r in read_table(spark, f"{out}/reporte_flota").collect()}
    assert rep["A"].total_entregas == 2 and rep["A"].peso_promedio_kg == 100.0
    assert rep["A"].costo_promedio_soles == 150.5 and rep["Z"].modelo is None
    csv = read_table(spark, f"{out}/reporte_flota_csv", "csv", header=True)
    assert csv.count() == 2 and csv.columns == S.REPORT_COLUMNS
    assert read_table(spark, f"{out}/kpi_resumen", "json").count() == 2

    run_dashboard(spark, out, dash)
    kpis = {r.kpi: r for r in spark.read.json(f"{dash}/kpis").collect()}
    assert kpis["Total Entregas"].valor == 3 and kpis["Total Entregas"].texto == "3"
    assert kpis["Tasa Éxito Promedio"].texto == "25.00%"        # (50 + 0) / 2
    assert spark.read.parquet(f"{dash}/eventos_por_tipo").count() == 0   # no stream table yet
    assert spark.read.parquet(f"{dash}/calidad").first()[:] == ("eventos", "ausente", 1)


def test_batch_job_counts_what_does_not_fit_and_stops_if_nothing_does(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _inputs(src)
    # the arrays read line by line: no record fits, and the job says so
    with pytest.raises(UnreadableInputError, match="multi-line"):
        run_batch(spark, read_inputs(spark, src), f"{tmp_dir}/out")
    lines = [{"registro_id": "G1", "placa_vehiculo": "A", "velocidad_kmh": 60.0, "satelites": 8},
             {"registro_id": "G2", "placa_vehiculo": "A", "velocidad_kmh": "fast", "satelites": 8}]
    with open(f"{src}/gps_registros.json", "w") as f:
        f.write("\n".join(map(json.dumps, lines)))
    with open(f"{src}/incidencias.json", "w") as f:
        f.write(json.dumps({"incidencia_id": "I1", "costo_estimado_soles": 1.5}) + "\n")
    counts = {(r.tabla, r.etapa): r.filas for r in run_batch(spark, read_inputs(spark, src), f"{tmp_dir}/out").collect()}
    assert counts[("rutas_gps", "leidas")] == 2 and counts[("rutas_gps", "malformadas")] == 1
    assert counts[("vehiculos", "leidas")] == 2 and counts[("vehiculos", "malformadas")] == 0
    assert counts[("entregas", "malformadas")] == 0 and ("eventos_sistema", "malformadas") not in counts
    assert "_malformado" not in read_table(spark, f"{tmp_dir}/out/rutas_gps").columns


def test_stream_job_available_now(spark, tmp_dir):
    import jobs.stream_job as job
    src = f"{tmp_dir}/records"
    rows = [(b"A", json.dumps({"evento_id": "e1", "tipo_evento": "speed_alert",
                               "velocidad_kmh": 120.0}).encode(), None)]
    import datetime as dt
    rows = [(k, v, dt.datetime(2025, 1, 1, 10, 0)) for k, v, _ in rows]
    spark.createDataFrame(rows, S.KEYED_RECORD).write.parquet(src)
    job.main(["--records", src, "--output", f"{tmp_dir}/out", "--available-now",
              "--shuffle-partitions", "4"])
    assert spark.read.parquet(f"{tmp_dir}/out/eventos_streaming").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/out/alertas_streaming").count() == 1


def test_batch_job_on_driver_tables_equals_the_report_query(spark, tmp_dir):
    import __spark_entry__ as E
    from flotilla.plans.batch import read_driver_inputs
    from flotilla.plans.queries import REPORT_TIME, as_wall_clock
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = f"{tmp_dir}/out"
    counts = {(r.tabla, r.etapa): r.filas
              for r in run_batch(spark, read_driver_inputs(spark, sf), out, report_time=REPORT_TIME).collect()}
    published = as_wall_clock(read_table(spark, f"{out}/reporte_flota"))
    query = E.queries()["fleet_report"](spark, sf)
    assert sorted(map(tuple, published.collect()), key=str) == sorted(map(tuple, query.collect()), key=str)
    stage = {(r.tabla, r.etapa): r.filas for r in E.queries()["stage_counts"](spark, sf).collect()}
    assert counts[("entregas", "leidas")] == stage[("entregas", "leidas")]
    assert counts[("entregas", "publicadas")] == stage[("entregas", "limpias")]
    assert counts[("rutas_gps", "publicadas")] == stage[("rutas_gps", "limpias")]
    assert counts[("eventos_sistema", "errores")] == stage[("eventos_sistema", "errores")]


@pytest.mark.parametrize("shared", [False, True])
def test_stream_job_on_driver_events_equals_the_stream_queries(spark, tmp_dir, shared):
    import __spark_entry__ as E
    import jobs.stream_job as job
    from flotilla.plans.queries import as_wall_clock
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    job.main(["--driver-events", sf, "--output", f"{tmp_dir}/out", "--checkpoint", f"{tmp_dir}/ck",
              "--available-now", "--shuffle-partitions", "4"] + (["--shared-feeds"] if shared else []))
    alerts = as_wall_clock(read_table(spark, f"{tmp_dir}/out/alertas_streaming").drop("batch_id", "procesado_en"))
    alert_q = E.queries()["alert_feed"](spark, sf)
    assert sorted(map(tuple, alerts.select(*alert_q.columns).collect()), key=str) == \
        sorted(map(tuple, alert_q.collect()), key=str)

    def same(a, b):
        return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    feed = as_wall_clock(read_table(spark, f"{tmp_dir}/out/eventos_streaming").drop("dia", "batch_id"))
    assert same(feed.select(*E.queries()["event_feed"](spark, sf).columns), E.queries()["event_feed"](spark, sf))
    from flotilla.plans.queries import _stamp_checked
    summary = as_wall_clock(_stamp_checked(read_table(spark, f"{tmp_dir}/out/resumen_eventos")))
    closed = E.queries()["events_by_type_1m_closed"](spark, sf)
    assert same(summary.select(*closed.columns), closed)
    per_vehicle = as_wall_clock(_stamp_checked(read_table(spark, f"{tmp_dir}/out/resumen_alertas")))
    closed_alerts = E.queries()["alerts_by_vehicle_2m_closed"](spark, sf)
    assert same(per_vehicle.select(*closed_alerts.columns), closed_alerts)


def test_batch_stream_and_dashboard_jobs_end_to_end(spark, tmp_dir):
    """Batch job and stream job publish into one folder; the dashboard reads both."""
    import __spark_entry__ as E
    import jobs.stream_job as job
    from flotilla.plans.batch import read_driver_inputs
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out, dash = f"{tmp_dir}/published", f"{tmp_dir}/dash"
    run_batch(spark, read_driver_inputs(spark, sf), out, report_time="2024-02-01 00:00:00")
    job.main(["--driver-events", sf, "--output", out, "--available-now", "--shuffle-partitions", "4"])
    run_dashboard(spark, out, dash)
    kinds = {r.tipo_evento: r.cantidad for r in spark.read.parquet(f"{dash}/eventos_por_tipo").collect()}
    assert set(kinds) == {"gps_update", "speed_alert", "route_deviation", "delivery_status"}
    assert sum(kinds.values()) == spark.read.parquet(f"{sf}/events.parquet").count()
    # the series comes from the counts the stream keeps, and equals a scan of the events
    series, absent = event_series(spark, out)
    assert not absent and "eventos_streaming" not in "".join(series.inputFiles())
    counted = {r.tipo_evento: r.cantidad for r in E.queries()["event_type_counts"](spark, sf).collect()}
    assert kinds == counted
    feed_only = f"{tmp_dir}/feed_only"
    os.makedirs(feed_only)
    os.symlink(f"{out}/eventos_streaming", f"{feed_only}/eventos_streaming")
    assert {r.tipo_evento: r.cantidad for r in event_series(spark, feed_only)[0].collect()} == counted
    assert spark.read.parquet(f"{dash}/top_km").count() == min(10, read_table(spark, f"{out}/reporte_flota").count())


def test_job_command_lines(tmp_dir):
    """The batch and dashboard jobs as a user runs them: separate processes, own sessions."""
    import subprocess
    import sys
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root)
    out, dash = f"{tmp_dir}/out", f"{tmp_dir}/dash"
    for args in (["jobs/batch_job.py", "--driver-tables", sf, "--output", out, "--master", "local[2]",
                  "--report-time", "2024-02-01 00:00:00"],
                 ["jobs/dashboard_job.py", "--published", out, "--output", dash, "--master", "local[2]"]):
        done = subprocess.run([sys.executable, *args], cwd=root, env=env, capture_output=True,
                              text=True, timeout=600)
        assert done.returncode == 0, done.stderr[-3000:]
    for folder in ["vehiculos", "entregas", "rutas_gps", "incidencias", "reporte_flota",
                   "eventos_sistema", "reporte_flota_csv", "kpi_resumen", "calidad"]:
        assert os.path.isdir(f"{out}/{json.load(open(f'{out}/_publicado'))['run']}/{folder}"), folder
    for folder in ["kpis", "entregas_por_estado", "incidencias_por_severidad", "top_km", "top_exito"]:
        assert os.path.isdir(f"{dash}/{folder}"), folder


def test_batch_job_partitioned_by_day_gives_the_same_report(spark, tmp_dir):
    import __spark_entry__ as E
    from flotilla.plans.batch import read_driver_inputs
    from flotilla.plans.queries import REPORT_TIME, as_wall_clock
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = f"{tmp_dir}/out"
    run_batch(spark, read_driver_inputs(spark, sf), out, report_time=REPORT_TIME, partition_by_day=True)
    assert any(name.startswith("dia=") for name in os.listdir(Snapshot(spark, out).path("entregas")))
    published = as_wall_clock(read_table(spark, f"{out}/reporte_flota"))
    query = E.queries()["fleet_report"](spark, sf)
    assert sorted(map(tuple, published.collect()), key=str) == sorted(map(tuple, query.collect()), key=str)


def _runs(root):
    return sorted(x for x in os.listdir(root) if x.startswith("run="))


def test_failed_run_leaves_the_published_tables(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    _inputs(src)
    run_batch(spark, read_inputs(spark, src, multi_line_json=True), out, report_time="2025-02-01 00:00:00")
    before = {t: sorted(map(str, read_table(spark, f"{out}/{t}").collect())) for t in TABLES}
    kept = _runs(out)
    assert len(kept) == 1 and len(before["rutas_gps"]) == 1

    def unchanged():
        return _runs(out) == kept and before == {t: sorted(map(str, read_table(spark, f"{out}/{t}").collect())) for t in TABLES}
    with pytest.raises(UnreadableInputError, match="multi-line"):       # arrays read by lines
        run_batch(spark, read_inputs(spark, src), out)
    assert unchanged()
    with open(f"{src}/vehiculos.csv", "a") as f:                        # a plate twice in the master
        f.write("A,Volvo,1,DRV-9,2021,Diesel,True\r\n")
    with pytest.raises(ValueError):
        run_batch(spark, read_inputs(spark, src, multi_line_json=True), out)
    assert unchanged()
    _inputs(src)
    with open(f"{src}/entregas.csv", "a") as f:
        f.write("ORD-9,A,Lima,Callao,heavy,2025-01-01 10:00:00,Completado,30,far,CLI-1\n")
    with pytest.raises(UnreadableInputError, match="1 of 5"):
        run_batch(spark, read_inputs(spark, src, multi_line_json=True), out, most_bad=0.1)
    assert unchanged()
    run_batch(spark, read_inputs(spark, src, multi_line_json=True), out, most_bad=0.2)
    assert read_table(spark, f"{out}/entregas").count() == 4 and len(_runs(out)) == 2
    _inputs(src)
    with open(f"{src}/entregas.csv", "a") as f:     # a distance that no sum can hold is counted
        f.write("ORD-9,A,Lima,Callao,1.5,2025-01-01 10:00:00,Completado,30,1e19,CLI-1\n")
    run_batch(spark, read_inputs(spark, src, multi_line_json=True), out)
    assert ("entregas", "sin_sumar", 1) in [tuple(r) for r in read_table(spark, f"{out}/calidad").collect()]


def test_readers_see_one_run(spark, tmp_dir):
    def write(n):
        with Publication(spark, tmp_dir) as run:
            publish(spark.range(n), run.path("a"))
            # nobody sees a table of the run before all are there
            seen = Snapshot(spark, tmp_dir)
            assert not seen.run or seen.table("a").count() == seen.table("b").count() == n - 1
            publish(spark.range(n), run.path("b"))
    write(1)
    begun = Snapshot(spark, tmp_dir)
    late = begun.table("a")
    write(2)
    assert begun.table("b").count() == late.count() == 1 and read_table(spark, f"{tmp_dir}/a").count() == 2
    write(3)                                                            # now the first run goes
    assert len(_runs(tmp_dir)) == 2 and Snapshot(spark, tmp_dir).table("b").count() == 3
    # two runs at once: the last commit is what is published, neither loses a table
    with Publication(spark, tmp_dir) as outer:
        publish(spark.range(4), outer.path("a"))
        with Publication(spark, tmp_dir) as inner:
            publish(spark.range(5), inner.path("a"))
        publish(spark.range(4), outer.path("b"))
    assert Snapshot(spark, tmp_dir).table("a").count() == Snapshot(spark, tmp_dir).table("b").count() == 4


def test_plain_folders_are_tables_too(spark, tmp_dir):
    publish(spark.range(3), f"{tmp_dir}/plain")
    assert read_table(spark, f"{tmp_dir}/plain").count() == Snapshot(spark, tmp_dir).table("plain").count() == 3
    with Publication(spark, tmp_dir) as run:
        publish(spark.range(1), run.path("other"))
    assert read_table(spark, f"{tmp_dir}/plain").count() == 3           # not of the run: as it was
