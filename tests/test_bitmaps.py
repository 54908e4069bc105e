"""Distinct counts by bitmaps over a dictionary: numbers, exactness, state."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from flotilla import schemas as S
from flotilla.notes import read_note, write_note
from flotilla.operators import bitmaps, events, windows
from flotilla.sinks.stream import append_feed
from flotilla.sources import file_records

T0 = dt.datetime(2025, 1, 1, 10, 0, 0)


def test_dictionary_numbers_are_dense_and_stay(spark, tmp_dir):
    def values(*v):
        return spark.createDataFrame([(x,) for x in v], "v string").repartition(3)
    assert bitmaps.dictionary(spark, tmp_dir).count() == 0
    assert bitmaps.extend_dictionary(spark, tmp_dir, values("a", "b", "b", None, "")) == 3
    first = {r.valor: r.id for r in bitmaps.dictionary(spark, tmp_dir).collect()}
    assert sorted(first.values()) == [0, 1, 2]
    assert bitmaps.extend_dictionary(spark, tmp_dir, values("a", "")) == 0
    assert bitmaps.extend_dictionary(spark, tmp_dir, values("c", "a", "d")) == 2
    second = {r.valor: r.id for r in bitmaps.dictionary(spark, tmp_dir).collect()}
    assert sorted(second.values()) == [0, 1, 2, 3, 4] and first.items() <= second.items()
    # an extension that failed after its write, before its commit, changes nothing and can be made again
    note = read_note(spark, f"{tmp_dir}/_current")
    bitmaps.extend_dictionary(spark, tmp_dir, values("e"))
    write_note(spark, f"{tmp_dir}/_current", note)
    assert bitmaps.dictionary(spark, tmp_dir).count() == 5
    assert bitmaps.extend_dictionary(spark, tmp_dir, values("f", "g")) == 2
    assert sorted(r.id for r in bitmaps.dictionary(spark, tmp_dir).collect()) == list(range(7))
    # a stream keeps the dictionary that it began with
    assert bitmaps.pinned_dictionary(spark, tmp_dir, tmp_dir + "/ck").count() == 7
    bitmaps.extend_dictionary(spark, tmp_dir, values("h"))
    assert bitmaps.pinned_dictionary(spark, tmp_dir, tmp_dir + "/ck").count() == 7


def test_counts_equal_count_distinct(spark, tmp_dir):
    rows = spark.range(0, 120_000).select(
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919 % 70_001).cast("string")).alias("v"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"))
    rows = rows.unionByName(spark.createDataFrame([(None, None), ("x", None), (None, "alone")], "v string, g string"))
    want = {r.g: (r.n, r.d) for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d")).collect()}
    for share, folder in ((0, "none"), (2, "half"), (1, "all")):        # of the values numbered beforehand
        path = f"{tmp_dir}/{folder}"
        if share:
            bitmaps.extend_dictionary(spark, path, rows.where(F.pmod(F.xxhash64("v"), F.lit(share)) == 0).select("v"))
        got = bitmaps.distinct_by_bitmap(rows, [F.col("g")], "v", bitmaps.dictionary(spark, path), "n", "d")
        assert {r._k0: (r.n, r.d) for r in got.collect()} == want


def test_stream_state_is_a_row_for_each_window_and_kind(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    for k in range(5):          # 50 vehicles in each window, ten minutes apart
        rows = [(f"P{i % 50}".encode(), json.dumps({"evento_id": f"{k}-{i}", "tipo_evento": "gps_update"}).encode(),
                 T0 + dt.timedelta(minutes=10 * k, seconds=i % 50)) for i in range(80)]
        spark.createDataFrame(rows, S.KEYED_RECORD).coalesce(1).write.parquet(f"{src}/slice={k}")
    everything = events.decode_records(spark.read.parquet(src + "/*"))
    bitmaps.extend_dictionary(spark, f"{tmp_dir}/dic", everything.where("placa_vehiculo != 'P7'").select("placa_vehiculo"))
    numbers = bitmaps.pinned_dictionary(spark, f"{tmp_dir}/dic", out + "_ck")
    dec = events.decode_records(file_records(spark, src + "/*", max_files=1), ["tipo_evento"])
    q = append_feed(bitmaps.events_by_type_bitmap(dec, numbers, watermark=S.EVENT_WATERMARK), "t_bitmap", out, out + "_ck",
                    trigger="availableNow")
    q.awaitTermination()
    got = {(r.ventana_inicio, r.cantidad_eventos, r.vehiculos_afectados) for r in spark.read.parquet(out).collect()}
    want = {(r.ventana_inicio, r.cantidad_eventos, r.vehiculos_afectados) for r in windows.events_by_type(everything).collect()}
    assert got < want and len(got) == 4 and all(v == 50 for _, _, v in got)
    # a bitmap and the one vehicle without a number, for each of at most two open windows; 50 rows each before
    state = [p["stateOperators"][-1]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    chained = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    assert max(state) <= 4 and max(chained) <= 8
