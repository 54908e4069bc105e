"""Sources and sinks: CSV with CRLF, JSON arrays vs lines, optional tables, counted writes."""

import json
import os

import pytest

from flotilla import schemas as S
from flotilla.sinks import publish_counted
from flotilla.sources import (
    UnreadableInputError, kafka_options, read_deliveries, read_gps, read_optional, read_vehicles, refuse_if_nothing_fits,
)


def test_vehicle_csv_crlf_and_booleans(spark, tmp_dir):
    p = os.path.join(tmp_dir, "vehiculos.csv")
    with open(p, "w", newline="") as f:
        f.write("placa,modelo,capacidad_kg,conductor_id,ano_fabricacion,tipo_combustible,activo\r\n")
        f.write("ABC-001,Volvo FH,8000,DRV-001,2021,Diesel,True\r\n")
        f.write("ABC-002,Hino 300,3000,DRV-002,2019,Eléctrico,False\r\n")
    rows = read_vehicles(spark, p).collect()
    assert [(r.placa, r.capacidad_kg, r.activo, r.tipo_combustible) for r in rows] == \
        [("ABC-001", 8000, True, "Diesel"), ("ABC-002", 3000, False, "Eléctrico")]


def test_deliveries_csv_blank_duration_is_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "entregas.csv")
    with open(p, "w") as f:
        f.write(",".join(f.name for f in S.DELIVERIES_RAW.fields) + "\n")
        f.write("ORD-1,ABC-001,Lima,Callao,120.5,2025-01-01 10:00:00,Pendiente,,15.2,CLI-001\n")
    r = read_deliveries(spark, p).first()
    assert r.duracion_min is None and r.peso_kg == 120.5


def test_json_array_and_lines(spark, tmp_dir):
    objs = [{"registro_id": "G1", "placa_vehiculo": "A", "velocidad_kmh": 50.0,
             "timestamp": "2025-01-01T10:00:00Z", "satelites": 5, "extra": 1},
            {"registro_id": "G2", "placa_vehiculo": "B", "velocidad_kmh": "fast"}]
    arr, lines = os.path.join(tmp_dir, "a.json"), os.path.join(tmp_dir, "l.json")
    with open(arr, "w") as f:
        json.dump(objs, f, indent=2)
    with open(lines, "w") as f:
        f.write("\n".join(json.dumps(o) for o in objs))
    a = read_gps(spark, arr, multi_line=True).orderBy("registro_id").collect()
    b = read_gps(spark, lines).orderBy("registro_id").collect()
    assert a == b and len(a) == 2
    assert a[0].satelites == 5


def test_optional_table_missing_is_none_and_logged(spark, tmp_dir, caplog):
    assert read_optional(spark, os.path.join(tmp_dir, "nope"), S.EVENT) is None
    assert "nope" in caplog.text


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    names = [f.name for f in S.DELIVERIES_RAW.fields]
    swapped = [names[1], names[0], *names[2:]]
    p = os.path.join(tmp_dir, "entregas.csv")
    with open(p, "w") as f:
        f.write(",".join([*swapped, "otra"]) + "\nABC-001,ORD-1,Lima,Callao,1.5,2025-01-01 10:00:00,Completado,45.0,2.5,CLI-1,x\n")
    r = read_deliveries(spark, p).first()
    assert (r.orden_id, r.placa_vehiculo, r.duracion_min) == ("ORD-1", "ABC-001", "45.0")
    with open(p, "w") as f:
        f.write(",".join(names[1:]) + "\n")
    with pytest.raises(UnreadableInputError, match="orden_id"):
        read_deliveries(spark, p)


def test_malformed_records_are_marked(spark, tmp_dir):
    p = os.path.join(tmp_dir, "entregas.csv")
    with open(p, "w") as f:
        f.write(",".join(f.name for f in S.DELIVERIES_RAW.fields) + "\n")
        f.write("ORD-1,A,Lima,Callao,heavy,2025-01-01 10:00:00,Completado,15,far,CLI-1\n")
        f.write("ORD-2,A,Lima,Callao,,2025-01-01 10:00:00,Completado,15,2.5,CLI-1\n")
    got = {r.orden_id: r.malo for r in read_deliveries(spark, p, bad_column="malo").collect()}
    assert got == {"ORD-1": "peso_kg,distancia_km", "ORD-2": None}
    j = os.path.join(tmp_dir, "gps.json")
    with open(j, "w") as f:
        f.write('{"registro_id": "G1", "satelites": 5}\n{"registro_id": "G2", "satelites": "many"}\nnot json\n')
    rows = read_gps(spark, j, bad_column="malo").collect()
    assert [r.malo is None for r in rows] == [True, False, False] and rows[1].registro_id == "G2"


def test_nothing_that_fits_is_an_error():
    refuse_if_nothing_fits("gps", 0, 0)
    refuse_if_nothing_fits("gps", 5, 4)
    with pytest.raises(UnreadableInputError):
        refuse_if_nothing_fits("gps", 5, 5)


def test_kafka_options():
    from flotilla.sinks.stream import topic_options
    assert kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t",
                                         "startingOffsets": "earliest", "failOnDataLoss": "true"}
    more = kafka_options("h:1", "t", starting_offsets="latest", max_offsets=5, fail_on_data_loss=False)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"], more["failOnDataLoss"]) == ("latest", "5", "false")
    assert topic_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_counted_publish(spark, tmp_dir):
    n = publish_counted(spark.range(123), os.path.join(tmp_dir, "t"), "t")
    assert n == 123
    assert spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 123


def test_malformed_fields_become_null_not_failures(spark, tmp_dir):
    """Explicit schemas, permissive parsing: a bad number or flag is null, the row is kept."""
    p = os.path.join(tmp_dir, "entregas.csv")
    with open(p, "w") as f:
        f.write(",".join(f.name for f in S.DELIVERIES_RAW.fields) + "\n")
        f.write("ORD-1,ABC-001,Lima,Callao,heavy,2025-01-01 10:00:00,Completado,15,far,CLI-001\n")
    r = read_deliveries(spark, p).first()
    assert r.orden_id == "ORD-1" and r.peso_kg is None and r.distancia_km is None
    j = os.path.join(tmp_dir, "inc.json")
    with open(j, "w") as f:
        f.write(json.dumps({"incidencia_id": "I1", "resuelta": "maybe", "costo_estimado_soles": 12.5}) + "\n")
    from flotilla.sources import read_incidents
    row = read_incidents(spark, j).first()
    assert row.incidencia_id == "I1" and row.resuelta is None and row.costo_estimado_soles == 12.5


def _pretty(path, objs, newline="\n", indent=2):
    with open(path, "w", newline="") as f:
        f.write(json.dumps(objs, indent=indent, ensure_ascii=False).replace("\n", newline))


def _whole_file(spark, path, schema):
    """Spark's own reader of arrays, with what doesn't fit marked."""
    from pyspark.sql.types import StringType, StructField, StructType
    return spark.read.schema(StructType([*schema.fields, StructField("bad", StringType())])) \
        .option("multiLine", True).option("columnNameOfCorruptRecord", "bad").json(path)


@pytest.mark.parametrize("newline,indent", [("\n", 2), ("\r\n", 2), ("\n", 4), ("\n", "\t")])
def test_pretty_arrays_are_read_by_many_tasks(spark, tmp_dir, newline, indent):
    from flotilla.sources.arrays import element_border
    objs = [{"registro_id": f"G{i}", "placa_vehiculo": 'a\n  },"{[', "velocidad_kmh": i / 7, "satelites": i % 9,
             "extra": {"list": [{"x": [1, {}]}, {}], "text": "\n]"}} for i in range(3000)]
    objs[5]["satelites"] = None
    objs[6] = {"registro_id": "only"}
    p = os.path.join(tmp_dir, "gps.json")
    _pretty(p, objs, newline, indent)
    assert element_border(spark, p)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(p) // 10))
    try:
        got = read_gps(spark, p, multi_line=True, bad_column="bad")
        assert got.rdd.getNumPartitions() >= 10
        assert got.where("bad is not null").count() == 0
        rows = got.drop("bad").orderBy("registro_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == _whole_file(spark, p, S.GPS_RAW).drop("bad").orderBy("registro_id").collect() and len(rows) == 3000


def test_broken_elements_spoil_only_themselves(spark, tmp_dir):
    objs = [{"registro_id": f"G{i}", "satelites": i} for i in range(6)] + [{"registro_id": "typed", "satelites": "many"}]
    p = os.path.join(tmp_dir, "gps.json")
    _pretty(p, objs)
    text = open(p).read()
    with open(p, "w") as f:
        f.write(text.replace('"registro_id": "G2",', '"registro_id": "G2'))
    got = {(r.registro_id, r.satelites, r.bad is not None) for r in read_gps(spark, p, multi_line=True, bad_column="bad").collect()}
    assert got == {(f"G{i}", i, False) for i in (0, 1, 3, 4, 5)} | {(None, None, True), ("typed", None, True)}
    assert read_gps(spark, p, multi_line=True).count() == 7
    assert read_gps(spark, p, multi_line=True, bad_column="bad").where("bad is not null").select("registro_id").count() == 2


def test_elements_of_one_line_and_odd_arrays(spark, tmp_dir):
    from flotilla.sources.arrays import element_border
    p = os.path.join(tmp_dir, "a.json")
    _pretty(p, [{"registro_id": "G0"}, {}, {}, {"registro_id": "G1"}, {}])
    got = [(r.registro_id, r.bad) for r in read_gps(spark, p, multi_line=True, bad_column="bad").collect()]
    assert sorted(got, key=str) == sorted([("G0", None), ("G1", None), (None, None), (None, None), (None, None)], key=str)
    for name, objs, indent in (("none", [], 2), ("compact", [{"registro_id": "G0"}], None)):
        q = os.path.join(tmp_dir, f"{name}.json")
        _pretty(q, objs, indent=indent)
        assert element_border(spark, q) is None and read_gps(spark, q, multi_line=True).count() == len(objs)
    one = os.path.join(tmp_dir, "one.json")
    _pretty(one, [{"registro_id": "G0", "satelites": 3}])
    assert [tuple(r)[0] for r in read_gps(spark, one, multi_line=True).collect()] == ["G0"]
    # files of different layouts: whole files
    both = os.path.join(tmp_dir, "both")
    os.makedirs(both)
    _pretty(f"{both}/a.json", [{"registro_id": "A"}])
    _pretty(f"{both}/b.json", [{"registro_id": "B"}], indent=4)
    assert element_border(spark, both) is None and read_gps(spark, both, multi_line=True).count() == 2


def test_filters_do_not_parse_elements_again(spark, tmp_dir):
    p = os.path.join(tmp_dir, "gps.json")
    _pretty(p, [{"registro_id": f"G{i}", "satelites": i} for i in range(5)])
    df = read_gps(spark, p, multi_line=True).where("satelites > 2")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1 and df.count() == 2


def test_csv_records_of_another_shape_are_marked(spark, tmp_dir):
    p = os.path.join(tmp_dir, "vehiculos.csv")
    with open(p, "w") as f:
        f.write("placa,modelo,capacidad_kg,conductor_id,ano_fabricacion,tipo_combustible,activo,extra\n"
                "A,Volvo,8000,DRV-1,2021,Diesel,True,x\n"
                "ABC-001,M\n"                                              # its tail is lost
                "B,Volvo,8000,DRV-1,2021,Diesel,True,x,y,z\n"             # two fields too many
                "\n"
                "C,Volvo,heavy,DRV-1,2021,Diesel,True,x\n"
                'D,"Volvo, long",8000,DRV-1,2021,Diesel,True,\n')
    got = {r.placa: r.bad for r in read_vehicles(spark, p, bad_column="bad").collect()}
    assert got == {"A": None, "ABC-001": "ABC-001,M", "B": "B,Volvo,8000,DRV-1,2021,Diesel,True,x,y,z", "C": "capacidad_kg", "D": None}
    assert read_vehicles(spark, p, bad_column="bad").where("bad is not null").count() == 3
    assert read_vehicles(spark, p, bad_column="bad").select("bad").where("bad is not null").count() == 3
