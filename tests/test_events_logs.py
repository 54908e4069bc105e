"""Event codec, alert rules and log parsing on the edge rows of FIXTURES.md §2."""

import json
import re

from flotilla import schemas as S
from flotilla.operators import dashboard, events, logs


def _records(spark, items):
    rows = [(k.encode() if k else None, v.encode() if v is not None else None, None) for k, v in items]
    return spark.createDataFrame(rows, S.KEYED_RECORD)


EDGE = [
    ("P", json.dumps({"evento_id": "e1", "tipo_evento": "gps_update", "velocidad_kmh": 100.0})),
    ("P", json.dumps({"evento_id": "e2", "tipo_evento": "gps_update", "velocidad_kmh": 100.1,
                      "satelites": 7})),
    ("P", json.dumps({"evento_id": "e3", "tipo_evento": "speed_alert", "velocidad_kmh": 90.0,
                      "nivel_alerta": "MEDIA"})),
    ("P", json.dumps({"evento_id": "e4", "tipo_evento": "speed_alert"})),
    ("Q", json.dumps({"evento_id": "e5", "tipo_evento": "route_deviation", "desviacion_km": 2.5,
                      "placa_vehiculo": "R"})),
    ("P", json.dumps({"evento_id": "e6", "tipo_evento": "delivery_status", "orden_id": "ORD-1"})),
    ("P", "{not json"),
]


def test_decode_keeps_key_and_one_plate_column(spark):
    dec = events.decode_records(_records(spark, EDGE))
    assert dec.columns.count("placa_vehiculo") == 1
    rows = dec.collect()
    assert len(rows) == 7
    bad = [r for r in rows if r.evento_id is None]
    assert len(bad) == 1 and bad[0].placa_vehiculo == "P" and bad[0].tipo_evento is None
    assert {r.evento_id: r.placa_vehiculo for r in rows}["e5"] == "R"   # payload plate wins


def test_alert_rules_one_pass_and_union_agree(spark):
    dec = events.decode_records(_records(spark, EDGE))
    one = {r.evento_id: r for r in events.alerts(dec).collect()}
    two = {r.evento_id: r for r in events.alerts_union(dec).collect()}
    assert set(one) == set(two) == {"e2", "e3", "e4", "e5"}
    assert one["e2"].alerta_tipo == "VELOCIDAD_EXCEDIDA" and one["e2"].nivel_alerta is None
    assert one["e2"].alerta_descripcion == "Vehículo P a 100.1 km/h"
    assert one["e3"].alerta_descripcion == "Vehículo P a 90.0 km/h"
    assert one["e4"].alerta_descripcion is None
    assert one["e5"].alerta_tipo == "DESVIACION_RUTA"
    assert one["e5"].alerta_descripcion == "Desviación de 2.5 km detectada"
    assert [c for c in one["e2"].asDict()][:8] == S.ALERT_COLUMNS


def test_encode_decode_round_trip(spark):
    dec = events.decode_records(_records(spark, EDGE[:6]))
    back = events.decode_records(events.encode_events(dec))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, dec.collect()), key=str)


LOG = [
    "2025-01-01 10:00:00 [INFO] [AUTH] Usuario ok",
    "2025-01-01 10:00:00 [ERROR] nobracket msg",
    "2025-01-01 10:00:00 [DEBUG] [A]",
    "2025-01-01 10:00:00 [DEBUG] [A]\t tab \t",
    "short line",
    "",
]


_FOUR_PARTS = re.compile(r"([^ ]*) ([^ ]*) ([^ ]*) (.*)", re.S)


def _python_rule(line):
    """The stated line format, independently: four space-separated parts (the last takes the
    rest); level without brackets; component up to the first ']' without '['; message after
    that ']' with whitespace trimmed, or the whole last part when it has no ']'."""
    m = _FOUR_PARTS.fullmatch(line)
    if m is None:
        return None
    day, clock, level, rest = m.groups()
    component, bracket, after = rest.partition("]")
    message = after.strip() if bracket else rest
    return (f"{day} {clock}", level.strip("[]"), component.strip("["), message)


def test_log_parse_matches_line_rule(spark):
    lines = spark.createDataFrame([(x,) for x in LOG], "value string")
    got = [tuple(r) for r in logs.parse_log(lines).collect()]
    want = [p for p in map(_python_rule, LOG) if p]
    assert got == want
    assert got[1] == ("2025-01-01 10:00:00", "ERROR", "nobracket msg", "nobracket msg")
    assert got[3][3] == "tab"
    counts = {r.nivel: r.cantidad for r in logs.level_counts(logs.parse_log(lines)).collect()}
    assert counts == {"INFO": 1, "ERROR": 1, "DEBUG": 2}
    assert logs.first_errors(logs.parse_log(lines)).count() == 1


def test_value_counts_share_and_guard(spark):
    df = spark.createDataFrame([("Alta",), ("Media",), ("Media",), (None,)], "severidad string")
    vc = dashboard.value_counts(df, "severidad")
    assert [tuple(r) for r in vc.collect()] == [("Media", 2, 1), ("Alta", 1, 2)]
    share = {r.severidad: r.porcentaje for r in dashboard.share_of_total(vc).collect()}
    assert share == {"Media": 66.7, "Alta": 33.3}
    try:
        dashboard.value_counts(df, "estado")
        raise AssertionError("expected a missing-column error")
    except dashboard.MissingColumnError as e:
        assert "estado" in str(e)


def test_log_parse_property_random_lines(spark):
    """Random lines over a tricky alphabet: Spark's parse equals the line rule on every one."""
    import random
    rnd = random.Random(11)
    alphabet = ["a", "Z", "0", " ", " ", "[", "]", "\t", "é", "-", ":", "]]", "[["]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    lines += ["2025-01-01 10:00:00 [WARN] [GPS_TRACKER] señal débil ] extra",
              "a b c", "a b c ", "a  b c d", " a b c"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    from pyspark.sql import functions as F
    from flotilla.functions import log_fields, log_parts
    p = df.select("i", log_parts("value").alias("_p"))
    f = log_fields(F.col("_p"))
    got = {r.i: (r.timestamp, r.nivel, r.componente, r.mensaje)
           for r in p.filter(F.size("_p") >= 4).select("i", *[f[c].alias(c) for c in S.LOG_COLUMNS]).collect()}
    want = {i: _python_rule(x) for i, x in enumerate(lines) if _python_rule(x)}
    assert got == want
    assert logs.parse_log(df.select("value")).count() == len(want)
