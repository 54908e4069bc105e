"""Stream = batch on closed windows, late rows dropped, restart adds and loses nothing."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.operators import events, windows
from flotilla.sinks.stream import (
    FolderInUseError, append_feed, claim, console_feed, read_latest, replace_table, upsert_table,
)
from flotilla.sources import file_records
from flotilla.streaming import build_plan, start_plan


def _write_slice(spark, folder, rows, i):
    recs = [(k.encode(), json.dumps(v).encode(), ts) for k, v, ts in rows]
    spark.createDataFrame(recs, S.KEYED_RECORD).coalesce(1).write.mode("overwrite") \
        .parquet(os.path.join(folder, f"slice={i:03d}"))


def _ev(i, kind, plate, t, speed=None):
    return (plate, {"evento_id": f"e{i}", "tipo_evento": kind, "velocidad_kmh": speed}, t)


T0 = dt.datetime(2025, 1, 1, 10, 0, 0)


def _m(minutes, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def _run(spark, src, out, ck, plan_fn):
    recs = file_records(spark, src + "/*", max_files=1)
    q = append_feed(plan_fn(events.decode_records(recs)), "t_" + os.path.basename(out), out, ck,
                    trigger="availableNow")
    q.awaitTermination()
    return spark.read.parquet(out)


def test_stream_equals_batch_on_closed_windows_and_drops_late(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    # slices in time order, then one late row for the first window
    slices = [
        [_ev(1, "gps_update", "A", _m(0, 5)), _ev(2, "gps_update", "B", _m(0, 30)),
         _ev(3, "speed_alert", "A", _m(0, 40), 120.0)],
        [_ev(4, "gps_update", "A", _m(1, 10)), _ev(5, "gps_update", "A", _m(2, 10))],
        [_ev(6, "gps_update", "C", _m(6, 0))],
        [_ev(9, "gps_update", "C", _m(6, 30))],
        # late: Spark filters late rows against the watermark of the previous micro-batch, so
        # by this batch it is 10:06 - 2 min = 10:04 and the window [10:00, 10:01) is closed.
        [_ev(7, "gps_update", "D", _m(0, 50))],
    ]
    for i, s in enumerate(slices):
        _write_slice(spark, src, s, i)

    def plan(dec):
        return windows.events_by_type(dec, watermark=S.EVENT_WATERMARK, distinct="chained")

    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    got = {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
           for r in _run(spark, src, out, ck, plan).collect()}
    # watermark = 10:06:30 - 2 min: windows ending at or before 10:04:30 are published
    assert got == {(_m(0), "gps_update"): (2, 2), (_m(0), "speed_alert"): (1, 1),
                   (_m(1), "gps_update"): (1, 1), (_m(2), "gps_update"): (1, 1)}

    # batch over the on-time rows gives the same closed windows
    on_time = spark.read.parquet(*[os.path.join(src, f"slice={i:03d}") for i in range(4)])
    batch = windows.events_by_type(events.decode_records(on_time))
    closed = batch.filter(F.col("ventana_fin") <= F.lit(_m(4)))
    assert {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
            for r in closed.collect()} == got

    # restart on the same checkpoint with one new slice: old windows are not written again
    _write_slice(spark, src, [_ev(8, "gps_update", "E", _m(9, 0))], 5)
    again = _run(spark, src, out, ck, plan)
    keys = [(r.ventana_inicio, r.tipo_evento) for r in again.collect()]
    assert len(keys) == len(set(keys))
    assert (_m(6), "gps_update") in keys and len(keys) == 5


def test_alert_windows_and_latest_snapshot(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    _write_slice(spark, src, [_ev(1, "speed_alert", "A", _m(0, 5), 130.0),
                              _ev(2, "gps_update", "A", _m(1, 5), 101.0),
                              _ev(3, "gps_update", "A", _m(1, 6), 99.0),
                              _ev(4, "gps_update", "B", _m(20), 50.0)], 0)
    recs = file_records(spark, src + "/*")
    dec = events.decode_records(recs)
    # event time reaches 10:20 through a non-alert event; the watermark (10:15) closes A's window
    summary = build_plan(recs).alerts_by_vehicle
    out = os.path.join(tmp_dir, "alerts")
    q = append_feed(summary, "t_alert_windows", out, out + "_ck", trigger="availableNow")
    q.awaitTermination()
    rows = [(r.placa_vehiculo, r.alerta_tipo, r.total_alertas, r.ventana_inicio)
            for r in spark.read.parquet(out).collect()]
    assert rows == [("A", "VELOCIDAD_EXCEDIDA", 2, _m(0))]
    assert "procesado_en" in spark.read.parquet(out).columns                    # P6
    assert "procesado_en" in build_plan(recs).events_by_type.columns

    latest = os.path.join(tmp_dir, "latest")
    q = replace_table(windows.vehicle_counts(dec, watermark=S.EVENT_WATERMARK),
                      "t_latest", latest, latest + "_ck", trigger="availableNow",
                      transform=windows.roll_up_vehicles)
    q.awaitTermination()
    snap = read_latest(spark, latest)
    assert snap.count() == 3 and "batch_id" not in snap.columns


def _latest(spark, src, out, ck, merge_every=20, watch=None):
    dec = events.decode_records(file_records(spark, src + "/*", max_files=1))
    per_vehicle = windows.flatten_window(windows.vehicle_counts(dec, watermark=S.EVENT_WATERMARK))
    q = upsert_table(per_vehicle, "t_upsert", out, ck, windows.LATEST_KEYS, trigger="availableNow",
                     merge_every=merge_every, watch=watch)
    q.awaitTermination()
    return q, {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
               for r in windows.roll_up_latest(read_latest(spark, out)).collect()}


def test_upserts_equal_the_batch_over_restarts_and_merges(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    rows = [_ev(i, "gps_update" if i % 3 else "speed_alert", "ABC"[i % 3], _m(i // 4, i)) for i in range(24)]
    for k in range(4):
        _write_slice(spark, src, rows[6 * k:6 * k + 6], k)

    def batch():
        all_rows = events.decode_records(spark.read.parquet(src + "/*"))
        return {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
                for r in windows.events_by_type(all_rows).collect()}
    seen = []
    assert _latest(spark, src, out, ck, 2, lambda t, n: seen.append((n, t.count())))[1] == batch()
    assert [n for n, _ in seen][:4] == [0, 1, 2, 3] and seen[-1][1] >= seen[0][1]
    _write_slice(spark, src, [_ev(90, "gps_update", "Z", _m(8))], 4)
    assert _latest(spark, src, out, ck, 2)[1] == batch()            # restart
    assert _latest(spark, src, out, ck + "_new")[1] == batch()      # another checkpoint on the old folder
    runs = [x for x in os.listdir(out) if x.startswith("run=")]
    assert len([x for r in runs for x in os.listdir(os.path.join(out, r)) if not x.startswith(".")]) <= 20


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_current_table_by_day_leaves_closed_days_alone(spark, tmp_dir):
    """A merge writes the days that a batch touched, and sealed days stay as they are."""
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    ck = out + "_ck"

    def at(day, minute):
        return _m(0) + dt.timedelta(days=day, minutes=minute)

    def run():
        dec = events.decode_records(file_records(spark, src + "/*", max_files=1))
        per_vehicle = windows.flatten_window(windows.vehicle_counts(dec, watermark=S.EVENT_WATERMARK))
        upsert_table(per_vehicle, "t_by_day", out, ck, windows.LATEST_KEYS, trigger="availableNow", merge_every=2,
                     day_of="ventana_inicio", delay=S.EVENT_WATERMARK).awaitTermination()
        with open(f"{out}/_current") as f:
            return json.load(f)

    def table():
        return {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
                for r in windows.roll_up_latest(read_latest(spark, out)).collect()}

    def batch():
        return {(r.ventana_inicio, r.tipo_evento): (r.cantidad_eventos, r.vehiculos_afectados)
                for r in windows.events_by_type(events.decode_records(spark.read.parquet(src + "/*"))).collect()}
    for k in range(3):          # three batches of one day, the same window again and again
        _write_slice(spark, src, [_ev(10 * k + i, "gps_update", "ABC"[i % 3], at(0, 0)) for i in range(6)], k)
    note = run()
    day0, = note["days"]
    assert not note["days"][day0]["sealed"] and "merged" in note["days"][day0]["folders"][0] and table() == batch()
    _write_slice(spark, src, [_ev(50, "gps_update", "A", at(1, 0))], 3)
    note = run()
    assert note["days"][day0]["sealed"] and len(note["days"][day0]["folders"]) == 1
    sealed = _files(f"{out}/{note['days'][day0]['folders'][0]}")
    assert sealed
    for k in range(4, 9):       # merges of the second day
        _write_slice(spark, src, [_ev(10 * k + i, "speed_alert", "AB"[i % 2], at(1, k)) for i in range(4)], k)
    note = run()
    day1 = max(note["days"])
    assert day1 > day0 and any("merged" in f for f in note["days"][day1]["folders"])
    assert _files(f"{out}/{note['days'][day0]['folders'][0]}") == sealed and table() == batch()
    # readers of a range and of open days don't see the sealed one
    assert read_latest(spark, out, since=day1).select("ventana_inicio").distinct().count() == 6
    assert read_latest(spark, out, open_only=True).count() == read_latest(spark, out, since=day1).count()
    # a late row of the sealed day is dropped by the stream, so its folder needs no change
    _write_slice(spark, src, [_ev(99, "gps_update", "Z", at(0, 0))], 9)
    before = table()
    run()
    assert table() == before and _files(f"{out}/{note['days'][day0]['folders'][0]}") == sealed


def test_state_of_closed_windows_is_dropped(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    for k in range(5):      # a window of 20 vehicles each, ten minutes apart
        _write_slice(spark, src, [_ev(100 * k + i, "gps_update", f"P{i}", _m(10 * k, i)) for i in range(20)], k)
    q, got = _latest(spark, src, out, out + "_ck")
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert len(got) == 5 and max(state) < 100 and state[-1] <= 20


def test_a_folder_goes_on_with_its_own_checkpoint_only(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    _write_slice(spark, src, [_ev(i, "speed_alert", "A", _m(i)) for i in range(5)], 0)

    def start(ck, shared):
        return start_plan(build_plan(file_records(spark, src + "/*")), out, ck, "availableNow", "availableNow",
                          shared_feeds=shared, prefix="t" + str(len(spark.streams.active)))
    for q in start(out + "/_checkpoints", False):
        q.awaitTermination()
    _write_slice(spark, src, [_ev(10 + i, "speed_alert", "B", _m(i)) for i in range(7)], 1)
    for ck, shared, what in ((out + "_other", False, "checkpoint"), (out + "/_checkpoints", True, "layout")):
        with pytest.raises(FolderInUseError, match=what):
            start(ck, shared)
    for q in start(out + "/_checkpoints", False):
        q.awaitTermination()
    for name in ("eventos_streaming", "alertas_streaming"):
        assert spark.read.parquet(f"{out}/{name}").count() == 12
    foreign = os.path.join(tmp_dir, "foreign")
    spark.range(3).write.parquet(foreign)
    with pytest.raises(FolderInUseError, match="unknown"):
        claim(spark, foreign, out + "_third", "file sink")


def test_default_triggers_are_those_of_the_application():
    import inspect
    defaults = {k: p.default for k, p in inspect.signature(start_plan).parameters.items()}
    assert defaults["feed_trigger"] == "10 seconds" and defaults["summary_trigger"] == "30 seconds"


class _Writer:
    """Records the calls of a stream writer."""
    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = args or kwargs
            return self
        return call


def test_processing_time_trigger_is_set():
    from flotilla.sinks.stream import _trigger
    for given, want in (("10 seconds", {"processingTime": "10 seconds"}), ("availableNow", {"availableNow": True})):
        w = _Writer()
        _trigger(w, given)
        assert w.calls["trigger"] == want


def test_processing_time_stream_and_console(spark, tmp_dir, capsys):
    """A query on a timed trigger goes on with new files; the job ends when one stops."""
    import threading
    import time

    import jobs.stream_job as job
    src = os.path.join(tmp_dir, "src")
    _write_slice(spark, src, [_ev(1, "gps_update", "A", _m(0))], 0)
    dec = events.decode_records(file_records(spark, src + "/*"))
    spark.streams.resetTerminated()
    q = console_feed(dec.groupBy("tipo_evento").count(), "t_console", os.path.join(tmp_dir, "ck"),
                     trigger="1 second", order=[F.asc("tipo_evento")])
    q.processAllAvailable()
    _write_slice(spark, src, [_ev(2, "speed_alert", "A", _m(1), 120.0)], 1)
    q.processAllAvailable()
    waiting = threading.Thread(target=job.wait, args=(spark,))
    waiting.start()
    time.sleep(0.5)
    assert waiting.is_alive()
    q.stop()
    waiting.join(20)
    assert not waiting.is_alive()
    out = capsys.readouterr().out
    assert "t_console batch 0" in out and "t_console batch 1" in out and "speed_alert" in out


def test_snapshots_follow_the_commit_note(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    for i in range(3):
        _write_slice(spark, src, [_ev(i, "gps_update", "A", _m(i))], i)
    dec = events.decode_records(file_records(spark, src + "/*", max_files=1))
    latest = os.path.join(tmp_dir, "latest")
    q = replace_table(windows.vehicle_counts(dec, watermark=S.EVENT_WATERMARK),
                      "t_bounded", latest, latest + "_ck", trigger="availableNow",
                      transform=windows.roll_up_vehicles)
    q.awaitTermination()
    run, = [x for x in os.listdir(latest) if x.startswith("run=")]
    assert [x for x in os.listdir(f"{latest}/{run}") if not x.startswith(".")] == ["batch=2"]     # older ones are gone
    assert read_latest(spark, latest).count() == 3
    # a new checkpoint starts at batch 0 again, with more in the source: its result counts
    _write_slice(spark, src, [_ev(9, "gps_update", "B", _m(9))], 3)
    again = events.decode_records(file_records(spark, src + "/*"))
    replace_table(windows.vehicle_counts(again, watermark=S.EVENT_WATERMARK), "t_bounded_new", latest, latest + "_ck2",
                  trigger="availableNow", transform=windows.roll_up_vehicles).awaitTermination()
    assert read_latest(spark, latest).count() == 4
    with pytest.raises(FileNotFoundError):
        read_latest(spark, os.path.join(tmp_dir, "none"))


def test_approximate_distinct_vehicles_within_error(spark):
    """W5 approximate form: every window's estimate within 3 standard errors of the exact count."""
    from pyspark.sql import functions as F
    ev = spark.range(0, 60000).select(
        F.concat(F.lit("P"), (F.col("id") * 7919 % 5000).cast("string")).alias("placa_vehiculo"),
        F.when(F.col("id") % 3 == 0, F.lit("gps_update")).otherwise(F.lit("speed_alert")).alias("tipo_evento"),
        (F.lit(_m(0)).cast("timestamp") + F.make_interval(secs=(F.col("id") % 600).cast("int"))).alias("kafka_timestamp"))
    exact = {(r.ventana_inicio, r.tipo_evento): r.vehiculos_afectados
             for r in windows.events_by_type(ev).collect()}
    approx = {(r.ventana_inicio, r.tipo_evento): r.vehiculos_afectados
              for r in windows.events_by_type(ev, distinct="approx", rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= 0.06 * v + 1 for k, v in exact.items())


def test_alert_windows_on_processing_time(spark, tmp_dir):
    """W3/W4 as the application had them: alerts windowed on their processing stamp."""
    src = os.path.join(tmp_dir, "src")
    _write_slice(spark, src, [_ev(1, "speed_alert", "A", _m(0), 130.0),
                              _ev(2, "gps_update", "A", _m(1), 120.0),
                              _ev(3, "speed_alert", "B", _m(2), 110.0),
                              _ev(4, "gps_update", "B", _m(3), 50.0)], 0)
    al = events.alerts(events.decode_records(file_records(spark, src + "/*")), processed_at=True)
    per_vehicle = windows.alerts_by_vehicle(al, ts="procesado_en", watermark=S.ALERT_WATERMARK)
    out = os.path.join(tmp_dir, "pt")
    q = replace_table(per_vehicle, "t_processing_time", out, out + "_ck", trigger="availableNow")
    q.awaitTermination()
    got = {}
    for r in read_latest(spark, out).collect():
        got[r.placa_vehiculo] = got.get(r.placa_vehiculo, 0) + r.total_alertas
        assert r.ventana_fin - r.ventana_inicio == dt.timedelta(minutes=2)
    assert got == {"A": 2, "B": 1}      # all stamped in this run, whatever the event times


def test_late_and_malformed_records_are_counted(spark, tmp_dir):
    """The stream job's counts by query, over batches and a restart."""
    import jobs.stream_job as job
    from flotilla.streaming.quality import stream_counts
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")

    def run():
        job.main(["--records", src + "/*", "--output", out, "--available-now", "--max-files", "1", "--shuffle-partitions", "2"])
        return {(r.tabla, r.etapa): r.filas for r in stream_counts(spark, out + "/calidad_streaming").collect()}
    _write_slice(spark, src, [_ev(i, "gps_update", "A", _m(10)) for i in range(5)], 0)
    _write_slice(spark, src, [_ev(10, "gps_update", "A", _m(30))], 1)
    broken = [(b"A", b'{"evento_id": ', _m(31)), (b"A", b'{"velocidad_kmh": "fast"}', _m(31)), (b"A", None, _m(31))]
    spark.createDataFrame(broken, S.KEYED_RECORD).coalesce(1).write.parquet(f"{src}/slice=002")
    late = [_ev(20, "gps_update", "A", _m(1)), _ev(21, "speed_alert", "B", _m(2), 120.0)]
    _write_slice(spark, src, late, 3)
    got = run()
    feed, summary = "flota_eventos_streaming", "flota_resumen_eventos"
    assert got[(feed, "leidas")] == got[(feed, "decodificadas")] == 11 and got[(feed, "malformadas")] == 3
    assert got[(summary, "tardias")] == 2 and got[(feed, "tardias")] == 0
    _write_slice(spark, src, [_ev(30, "gps_update", "A", _m(1))], 4)
    again = run()
    assert again[(feed, "leidas")] == 12 and again[(feed, "malformadas")] == 3 and again[(summary, "tardias")] == 3
    by_batch = stream_counts(spark, out + "/calidad_streaming", by_batch=True).where(f"tabla = '{feed}' and etapa = 'malformadas'")
    assert sorted(r.filas for r in by_batch.collect())[-1] == 3 and by_batch.agg(F.sum("filas")).first()[0] == 3


def test_daily_counts_kept_by_the_stream(spark, tmp_dir):
    """Counts per day and kind over several batches and late rows equal a scan of all events."""
    from flotilla.operators.dashboard import value_counts
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    for k in range(6):      # three days, the first one again at the end
        day = dt.timedelta(days=[0, 0, 1, 2, 2, 0][k])
        _write_slice(spark, src, [_ev(10 * k + i, ["gps_update", "speed_alert"][i % 2], "AB"[i % 2], _m(k, i) + day)
                                  for i in range(5 + k)], k)
    dec = events.decode_records(file_records(spark, src + "/*", max_files=1), ["tipo_evento"])
    upsert_table(windows.daily_counts(dec), "t_daily", out, out + "_ck", windows.DAILY_KEYS, trigger="availableNow",
                 merge_every=1, day_of="fecha").awaitTermination()
    everything = events.decode_records(spark.read.parquet(src + "/*"))
    kept = read_latest(spark, out)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, windows.daily_counts(everything).collect()))
    assert value_counts(kept, "tipo_evento", counted="cantidad").collect() == value_counts(everything, "tipo_evento").collect()
