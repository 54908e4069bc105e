"""Cleaners, KPIs and the report on the hand-worked rows of FIXTURES.md §2."""

import datetime as dt

import pytest

from flotilla import schemas as S
from flotilla.operators import clean, kpis, report
from flotilla.operators.dedup import dedup_first


def _deliveries(spark):
    rows = [
        ("ORD-1", "A", "o", "d", 100.0, "2025-01-01 10:00:00", "Completado", "30", 10.0, "CLI-1"),
        ("ORD-1", "A", "o", "d", 100.0, "2025-01-01 10:00:00", "Completado", "30", 10.0, "CLI-1"),
        ("ORD-2", "A", "o", "d", 8000.0, "2025-01-01 11:00:00", "Fallido", None, 20.5, "CLI-1"),
        ("ORD-3", "A", "o", "d", 8000.01, "2025-01-01 12:00:00", None, "60", 5.25, "CLI-2"),
        ("ORD-4", "B", "o", "d", None, "not a date", "Completado", "x", None, None),
    ]
    return spark.createDataFrame(rows, S.DELIVERIES_RAW)


def test_clean_deliveries_rules(spark):
    out = {r.orden_id: r for r in clean.clean_deliveries(_deliveries(spark)).collect()}
    assert len(out) == 4                                    # duplicate dropped
    assert out["ORD-1"].fecha_entrega == dt.datetime(2025, 1, 1, 10, 0)
    assert out["ORD-2"].duracion_min == 0 and out["ORD-2"].peso_kg == 8000.0
    assert out["ORD-3"].peso_kg is None and out["ORD-3"].estado == "Desconocido"
    assert out["ORD-4"].duracion_min == 0 and out["ORD-4"].fecha_entrega is None


def test_delivery_kpis(spark):
    k = {r.placa_vehiculo: r for r in kpis.delivery_kpis(clean.clean_deliveries(_deliveries(spark))).collect()}
    a, b = k["A"], k["B"]
    assert (a.total_entregas, a.entregas_completadas, a.tasa_exito_pct) == (3, 1, 33.33)
    assert (a.duracion_promedio_min, a.km_totales, a.peso_promedio_kg, a.clientes_atendidos) == \
        (30.0, 35.75, 4050.0, 2)
    assert (b.total_entregas, b.entregas_completadas, b.tasa_exito_pct) == (1, 1, 100.0)
    assert (b.duracion_promedio_min, b.km_totales, b.peso_promedio_kg, b.clientes_atendidos) == \
        (0.0, None, None, 0)


def test_gps_filter(spark):
    rows = [(f"R{i}", "P", None, None, v, "2025-01-01T10:00:00Z", s, 1.0)
            for i, (v, s) in enumerate([(0.0, 3), (200.0, 3), (-0.1, 5), (200.1, 5), (None, 5),
                                        (50.0, 2), (50.0, None)])]
    out = clean.clean_gps(spark.createDataFrame(rows, S.GPS_RAW)).collect()
    assert sorted(r.velocidad_kmh for r in out) == [0.0, 200.0]
    # 'Z' is UTC, not a literal: 10:00Z stays 10:00 in the UTC session.
    assert out[0].timestamp == dt.datetime(2025, 1, 1, 10, 0)


def test_incidents_resolution(spark):
    rows = [("I1", "P", "t", "Alta", "2025-01-01T00:00:00Z", "", 10.0, True, 30),
            ("I2", "P", "t", "Media", "2025-01-01T00:00:00Z", "", 20.0, False, 30),
            ("I3", "P", "t", "Baja", "2025-01-01T00:00:00Z", "", 31.0, None, 30)]
    inc = clean.clean_incidents(spark.createDataFrame(rows, S.INCIDENTS_RAW))
    got = {r.incidencia_id: r.tiempo_resolucion_min for r in inc.collect()}
    assert got == {"I1": 30, "I2": None, "I3": 30}
    k = kpis.incident_kpis(inc).first()
    assert (k.total_incidencias, k.incidencias_alta, k.incidencias_media, k.incidencias_baja,
            k.incidencias_resueltas, k.costo_promedio_soles) == (3, 1, 1, 1, 1, 20.33)


def test_avg_round_half_up_exact(spark):
    from pyspark.sql import functions as F

    from flotilla.functions import avg_round
    # mean 2.675 exactly: half-up gives 2.68 (a double round-trip may give 2.67)
    df = spark.createDataFrame([(2.67,), (2.68,)], "x double")
    assert df.agg(avg_round("x", 2).alias("a")).first().a == 2.68
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (2.0,)], "x double")   # 1.75 -> 1.8
    assert df.agg(avg_round("x", 1).alias("a")).first().a == 1.8
    assert df.agg(F.count("x")).first()[0] == 4
    # negative ties round away from zero, as SQL ROUND does
    neg = spark.createDataFrame([(-2.67,), (-2.68,)], "x double")
    assert neg.agg(avg_round("x", 2).alias("a")).first().a == -2.68
    mixed = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    assert mixed.agg(avg_round("x", 2).alias("a")).first().a == 0.0


def test_values_are_rounded_once_at_the_end(spark):
    from flotilla.functions import avg_round, pct_round, sum_round
    small = spark.createDataFrame([(0.004,)] * 1000, "x double").repartition(7)
    assert small.agg(sum_round("x"), avg_round("x"), avg_round("x", 1)).first()[:] == (4.0, 0.0, 0.0)
    third = spark.createDataFrame([(1.004,), (1.004,), (1.007,)], "x double")     # 3.015 / 3 = 1.005
    assert third.agg(sum_round("x"), avg_round("x")).first()[:] == (3.02, 1.01)
    # what is no finite number is left out, of the count too
    odd = spark.createDataFrame([(100.0,), (50.0,), (float("nan"),), (None,), (float("inf"),)], "x double")
    assert odd.agg(sum_round("x"), avg_round("x")).first()[:] == (150.0, 75.0)
    large = spark.createDataFrame([(1e17,), (1e17,), (0.25,)], "x double")
    assert large.agg(sum_round("x")).first()[0] == 2e17
    assert large.agg(avg_round("x", 2)).first()[0] == pytest.approx(2e17 / 3)
    empty = spark.createDataFrame([], "x double")
    assert empty.agg(sum_round("x"), avg_round("x")).first()[:] == (None, None)
    counts = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (1, 0)], "n long, d long")
    assert [r[0] for r in counts.select(pct_round("n", "d", 2)).collect()] == [33.33, 66.67, 12.5, 0.0, None]


def test_duration_text_with_decimals_is_a_number(spark):
    from flotilla.functions import text_to_int
    df = spark.createDataFrame([("45",), ("45.0",), ("45.9",), ("-3.5",), ("",), ("x",), ("NaN",), ("1e20",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_int("t")).collect()] == [45, 45, 45, -3, None, None, None, None, None]


def _vehicles(spark):
    return spark.createDataFrame([("A", "M1", 5000, "DRV-1", 2020, "Diesel", True),
                                  ("C", "M2", 3000, "DRV-2", 2021, "GNV", False)], S.VEHICLES)


def test_report_membership(spark):
    raw = _deliveries(spark).unionByName(spark.createDataFrame(
        [("ORD-9", None, "o", "d", 10.0, "2025-01-01 10:00:00", "Completado", "5", 1.0, "CLI-9")],
        S.DELIVERIES_RAW))
    d = kpis.delivery_kpis(clean.clean_deliveries(raw))
    gps = spark.createDataFrame([("R1", "C", None, None, 50.0, "2025-01-01T10:00:00Z", 5, 1.0)], S.GPS_RAW)
    g = kpis.gps_kpis(clean.clean_gps(gps))
    i = kpis.incident_kpis(clean.clean_incidents(spark.createDataFrame([], S.INCIDENTS_RAW)))
    rep = report.fleet_report(d, g, i, _vehicles(spark), report_time="2025-02-01 00:00:00")
    assert rep.columns == S.REPORT_COLUMNS
    rows = {r.placa_vehiculo: r for r in rep.collect()}
    assert set(rows) == {"A", "B", None}                   # C has GPS only: not in the report
    assert rows["A"].modelo == "M1" and rows["A"].total_registros_gps == 0
    assert rows["B"].modelo is None and rows["B"].capacidad_kg == 0 and rows["B"].km_totales == 0.0
    assert rows[None].total_entregas == 1 and rows[None].modelo is None
    assert {r.fecha_reporte for r in rows.values()} == {dt.datetime(2025, 2, 1)}


def test_repeated_master_key_is_refused(spark):
    with pytest.raises(report.DuplicateKeyError):
        report.check_master(_vehicles(spark).unionByName(_vehicles(spark)))
    assert report.check_master(_vehicles(spark)) == 2


def test_a_null_numeric_plate_stays_null(spark):
    from pyspark.sql import functions as F
    def numeric(df):
        return df.withColumn("placa_vehiculo", F.lit(None).cast("long"))
    d = kpis.delivery_kpis(numeric(clean.clean_deliveries(_deliveries(spark))))
    g = kpis.gps_kpis(numeric(clean.clean_gps(spark.createDataFrame([], S.GPS_RAW))))
    i = kpis.incident_kpis(numeric(clean.clean_incidents(spark.createDataFrame([], S.INCIDENTS_RAW))))
    row = report.fleet_report(d, g, i, _vehicles(spark).withColumn("placa", F.lit(7).cast("long"))).first()
    assert row.placa_vehiculo is None and row.total_registros_gps == 0 and row.capacidad_kg == 0


def test_dedup_total_order_and_hot_key(spark):
    from pyspark.sql import functions as F
    # key 0 holds 6/7 of the rows; the kept row is the first in (b, c) order whatever the
    # partitioning; checked against a brute-force pick in Python.
    n = 20000
    df = spark.range(0, n).select((F.col("id") % 7 == 0).cast("int").alias("k"),
                                  (F.lit(1000) - F.col("id") % 1000).alias("b"),
                                  F.col("id").alias("c")).repartition(13)
    rows = [(int(i % 7 == 0), 1000 - i % 1000, i) for i in range(n)]
    first = {}
    for k, b, c in rows:
        first[k] = min(first.get(k, (b, c)), (b, c))
    assert {r.k: (r.b, r.c) for r in dedup_first(df, ["k"]).collect()} == first
    last = {}
    for k, _, c in rows:
        last[k] = max(last.get(k, c), c)
    assert {r.k: r.c for r in dedup_first(df, ["k"], order=["c"], keep="last").collect()} == last


def test_kpis_with_a_hot_vehicle_match_brute_force(spark):
    """One vehicle owns a third of the deliveries (and duplicates); KPIs equal a pandas pick."""
    import random

    import pandas as pd
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        plate = "HOT" if i % 3 == 0 else f"V{rnd.randint(1, 40)}"
        oid = f"ORD-{rnd.randint(1, 2500)}"                  # ids repeat: dedup matters
        rows.append((oid, plate, "o", "d", round(rnd.uniform(10, 9000), 2), "2025-01-01 10:00:00",
                     rnd.choice(["Completado", "Fallido", None]), rnd.choice(["10", "", "25"]),
                     round(rnd.uniform(1, 50), 2), f"CLI-{rnd.randint(1, 30)}"))
    df = spark.createDataFrame(rows, S.DELIVERIES_RAW).repartition(7)
    got = {r.placa_vehiculo: r for r in kpis.delivery_kpis(clean.clean_deliveries(df)).collect()}

    pdf = pd.DataFrame(rows, columns=[f.name for f in S.DELIVERIES_RAW.fields])
    rest = [c for c in pdf.columns if c != "orden_id"]
    first = (pdf.sort_values(["orden_id"] + rest, na_position="first", kind="mergesort")
                .groupby("orden_id", dropna=False).head(1))
    first = first.assign(
        peso_kg=first.peso_kg.where(first.peso_kg <= 8000),
        estado=first.estado.fillna("Desconocido"),
        duracion_min=pd.to_numeric(first.duracion_min, errors="coerce").fillna(0).astype(int))
    from decimal import ROUND_HALF_UP, Decimal

    def r2(x):
        return float(Decimal(x).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    for plate, g in first.groupby("placa_vehiculo"):
        k = got[plate]
        done = int((g.estado == "Completado").sum())
        w = [Decimal(str(v)) for v in g.peso_kg.dropna()]
        assert k.total_entregas == len(g) and k.entregas_completadas == done
        assert k.tasa_exito_pct == r2(Decimal(done * 100) / len(g))
        assert k.duracion_promedio_min == r2(Decimal(int(g.duracion_min.sum())) / len(g))
        assert k.peso_promedio_kg == r2(sum(w) / len(w))
        assert k.km_totales == float(sum(Decimal(str(v)) for v in g.distancia_km))
        assert k.clientes_atendidos == g.cliente_id.nunique()
    assert got["HOT"].total_entregas > 500


def test_avg_round_matches_decimal_half_up_on_random_groups(spark):
    """Exactness of the rounding rule: random cent values, many exact ties, both signs."""
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from flotilla.functions import avg_round
    rnd = random.Random(5)
    rows = []
    for g in range(3000):
        n = rnd.choice([2, 4, 8, 3])                     # even counts make half-cent ties
        for _ in range(n):
            rows.append((g, rnd.randint(-2_000_000, 2_000_000) / rnd.choice([100, 1000, 10_000])))
    df = spark.createDataFrame(rows, "g int, x double").repartition(6)
    got = {r.g: (r.a, r.c) for r in df.groupBy("g").agg(
        avg_round("x", 2).alias("a"), avg_round("x", 1).alias("c")).collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(Decimal(str(x)))
    for g, xs in groups.items():
        mean = sum(xs) / len(xs)
        want2 = float(mean.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        want1 = float(mean.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
        assert got[g] == (want2, want1), (g, xs, got[g])


def test_dedup_with_nulls_matches_brute_force(spark):
    """First row per key in (all other columns, ascending, nulls first), nulls in every column."""
    import random
    rnd = random.Random(9)

    def maybe(v):
        return None if rnd.random() < 0.2 else v
    rows = [(maybe(rnd.randint(0, 40)), maybe(rnd.choice(["a", "b", "c"])),
             maybe(rnd.randint(-3, 3) / 2), maybe(rnd.randint(0, 5))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k int, s string, x double, n int").repartition(5)
    got = {r.k: (r.s, r.x, r.n) for r in dedup_first(df, ["k"]).collect()}

    def key(v):                      # nulls first, then the value
        return (0, 0) if v is None else (1, v)
    want = {}
    for k, s, x, n in rows:
        cand = (s, x, n)
        if k not in want or tuple(map(key, cand)) < tuple(map(key, want[k])):
            want[k] = cand
    assert got == want


def test_sums_over_limbs_equal_decimal_sums(spark):
    """Values of all magnitudes and numbers of decimals, by group and one by one."""
    import random

    from flotilla.functions import avg_of_limbs, avg_round, misfit, sum_of_limbs, sum_round, with_limbs
    rng = random.Random(1)
    vals = [0.0, -0.0, 1.005, -1.005, 0.1, 1e17, -9.99e17, 1e18, -1e18, float("nan"), float("inf"), float("-inf"), None,
            1e-10, 4.9e-11, 5e-11, -5e-11, 123456789.12345, 1e11, 99999999999.9999, 2.0 ** 53]
    for _ in range(3000):
        size, digits = rng.choice([1, 100, 1e5, 1e9, 1e11, 1e14, 1e17]), rng.choice([0, 1, 2, 3, 4, 5, 8, 10, 12])
        vals.append(rng.choice([-1, 1]) * round(rng.random() * size, digits))
    df = spark.createDataFrame([(i % 40, i, v) for i, v in enumerate(vals)], "g int, i int, x double")
    for key in ("g", "i"):
        new = with_limbs(df, "x").groupBy(key).agg(avg_of_limbs("x").alias("a"), sum_of_limbs("x").alias("s"))
        old = df.groupBy(key).agg(avg_round("x").alias("a"), sum_round("x").alias("s"))
        assert {r[0]: r[1:] for r in new.collect()} == {r[0]: r[1:] for r in old.collect()}
    assert df.where(misfit("x")).count() == 5
    whole = spark.createDataFrame([(2 ** 62, 7), (-(2 ** 61), 8), (None, None)], "l long, n int")
    assert with_limbs(whole.where("abs(l) < 1000 or l is null"), "l").agg(sum_of_limbs("l"), avg_of_limbs("l")).first()[:] == (None, None)
    assert with_limbs(whole, "n").agg(sum_of_limbs("n"), avg_of_limbs("n")).first()[:] == (15.0, 7.5)


def test_many_large_values_do_not_overflow(spark):
    from flotilla.functions import sum_of_limbs, with_limbs
    df = spark.range(100_000).selectExpr("CASE WHEN id % 2 = 0 THEN 9e17D ELSE 0.01D END AS x")
    assert with_limbs(df, "x").agg(sum_of_limbs("x")).first()[0] == 9e17 * 50_000 + 500
    no_wide = with_limbs(df, "x").groupBy().agg(sum_of_limbs("x"))._jdf.queryExecution().executedPlan().toString()
    assert "sum(cast" not in no_wide.lower() and "partial_sum(_x_i1" in no_wide


def test_sql_form_replaces_no_view(spark):
    from flotilla.operators import kpis
    spark.range(3).createOrReplaceTempView("flotilla_gps")
    df = spark.createDataFrame([("A", 10.0, 5, 1.0)], "placa_vehiculo string, velocidad_kmh double, satelites long, precision_gps double")
    assert kpis.kpis_sql(spark, df, kpis.GPS_KPIS_SQL).first()[1] == 1
    assert spark.table("flotilla_gps").columns == ["id"]
    df.createOrReplaceTempView("pings")
    assert kpis.kpis_sql(spark, df, kpis.GPS_KPIS_SQL, "pings").first()[1] == 1
