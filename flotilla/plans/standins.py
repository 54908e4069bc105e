"""Driver tables presented as the fleet application's raw inputs.

The fleet operators only know the fleet schemas (``flotilla.schemas``). These projections
rename and derive driver-table columns into those schemas, so the very same cleaners, KPIs,
joins and stream functions run on the driver tables at any scale. They are plain
projections: Catalyst prunes the scans to the columns used and pushes filters through them.

Mapping (the oracle SQL in ``flotilla.plans.oracles`` builds the same views):

- deliveries <- lineitem: order id ``{l_orderkey}-{l_linenumber}`` (repeats: real duplicates),
  vehicle ``l_suppkey``, weight ``l_quantity * 200`` (so > 8000 kg occurs), state from the
  return flag / line status (one combination left null), duration text blank for pending and
  like ``90.0`` in even lines, distance ``l_extendedprice * (1 - l_discount)`` (more than two
  decimals), client ``l_partkey``, delivery time as text.
- GPS pings <- events: record id ``{user_id}-{yyyyMMddHH}`` (repeats within an hour),
  vehicle ``user_id``, speed ``value``, satellites ``props.k``, ISO text time.
- incidents <- events of type ``error``: severity bands on ``value``, cost ``value * 1.18``,
  resolved from ``props.k`` (null for k < 10), resolution minutes ``props.k``.
- vehicles <- supplier; log lines and keyed stream events <- events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flotilla import schemas as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Driver event type -> fleet event kind (fixed stand-in choice).
EVENT_KIND = {"view": S.EVENT_GPS, "signup": S.EVENT_GPS, "click": S.EVENT_SPEED,
              "error": S.EVENT_ROUTE, "purchase": S.EVENT_DELIVERY}


# Schemas of the driver tables the stand-ins read. Declaring them skips the schema-inference
# job Spark otherwise runs on every ``read.parquet`` (measured ~0.5 s per read locally).
DRIVER_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in DRIVER_SCHEMAS:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


# The projections are written as SQL expressions (``selectExpr``): the same Catalyst plan as
# the Column API, built with one call per projection instead of several per column.
K = "CAST(get_json_object(props, '$.k') AS INT)"
ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
STATE = ("CASE WHEN l_returnflag = 'R' THEN 'Fallido' WHEN l_returnflag = 'A' THEN 'Completado' "
         "WHEN l_linestatus = 'O' THEN 'Pendiente' END")


def _with_k(events: DataFrame) -> DataFrame:
    """``props.k`` extracted once (its own projection, so it is not re-parsed per use)."""
    return events.selectExpr("*", f"{K} AS _k")


def deliveries_raw(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS orden_id",
        "l_suppkey AS placa_vehiculo",
        "l_returnflag AS origen",
        "l_linestatus AS destino",
        "l_quantity * 200 AS peso_kg",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS fecha_entrega",
        f"{STATE} AS estado",
        f"CASE WHEN {STATE} = 'Pendiente' THEN '' "
        "WHEN l_linenumber % 2 = 0 THEN concat(CAST(CAST(l_quantity AS INT) * 2 AS STRING), '.0') "
        "ELSE CAST(CAST(l_quantity AS INT) * 2 AS STRING) END AS duracion_min",
        "l_extendedprice * (1 - l_discount) AS distancia_km",
        "l_partkey AS cliente_id",
    )


def gps_raw(events: DataFrame) -> DataFrame:
    return _with_k(events).selectExpr(
        "concat_ws('-', CAST(user_id AS STRING), date_format(ts, 'yyyyMMddHH')) AS registro_id",
        "user_id AS placa_vehiculo",
        "CAST(NULL AS DOUBLE) AS latitud",
        "CAST(NULL AS DOUBLE) AS longitud",
        "value AS velocidad_kmh",
        f"{ISO} AS timestamp",
        "CAST(_k AS BIGINT) AS satelites",
        "_k / 10.0D AS precision_gps",
    )


def incidents_raw(events: DataFrame) -> DataFrame:
    return _with_k(events.filter("event_type = 'error'")).selectExpr(
        "CAST(event_id AS STRING) AS incidencia_id",
        "user_id AS placa_vehiculo",
        "event_type AS tipo",
        f"CASE WHEN value > 100 THEN '{S.SEVERITY_HIGH}' WHEN value > 30 THEN '{S.SEVERITY_MEDIUM}' "
        f"ELSE '{S.SEVERITY_LOW}' END AS severidad",
        f"{ISO} AS fecha",
        "props AS descripcion",
        "value * 1.18D AS costo_estimado_soles",
        "CASE WHEN _k < 10 THEN CAST(NULL AS BOOLEAN) ELSE _k >= 50 END AS resuelta",
        "CAST(_k AS BIGINT) AS tiempo_resolucion_min",
    )


def vehicles(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "s_suppkey AS placa",
        "s_name AS modelo",
        "s_nationkey AS capacidad_kg",
        "concat('DRV-', CAST(s_nationkey AS STRING)) AS conductor_id",
        "s_nationkey + 2000 AS ano_fabricacion",
        "CASE WHEN s_acctbal < 0 THEN 'Diesel' ELSE 'GNV' END AS tipo_combustible",
        "s_acctbal >= 0 AS activo",
    )


def log_lines(events: DataFrame) -> DataFrame:
    """``value`` lines ``yyyy-MM-dd HH:mm:ss [LEVEL] [COMPONENT] message``.

    Level from the event type (error -> ERROR, click -> WARN, view -> DEBUG, else INFO),
    component ``U{user_id}``; events with ``value < 1`` have no component bracket and
    events with ``value > 300`` are cut to a short line that the parser drops.
    """
    level = ("CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'click' THEN 'WARN' "
             "WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END")
    stamp = "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
    return events.selectExpr(
        f"CASE WHEN value > 300 THEN concat('cut ', event_type) "
        f"WHEN value < 1 THEN concat({stamp}, ' [', {level}, '] ', props) "
        f"ELSE concat({stamp}, ' [', {level}, '] [U', CAST(user_id AS STRING), '] ', props) END AS value")


def stream_events(events: DataFrame) -> DataFrame:
    """Driver events as fleet stream events (one JSON object per event, wide schema)."""
    kind = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_KIND.items()) + " END"
    return _with_k(events).selectExpr("*", f"{kind} AS _kind").selectExpr(
        "concat('EV-', CAST(event_id AS STRING)) AS evento_id",
        "_kind AS tipo_evento",
        "CAST(user_id AS STRING) AS placa_vehiculo",
        f"CASE WHEN _kind <> '{S.EVENT_DELIVERY}' THEN _k / 100.0D - 12.0D END AS latitud",
        f"CASE WHEN _kind <> '{S.EVENT_DELIVERY}' THEN _k / 100.0D - 77.0D END AS longitud",
        f"CASE WHEN _kind IN ('{S.EVENT_GPS}', '{S.EVENT_SPEED}') THEN value END AS velocidad_kmh",
        f"{ISO} AS timestamp",
        f"CASE WHEN _kind = '{S.EVENT_SPEED}' THEN (CASE WHEN value > 150 THEN 'ALTA' ELSE 'MEDIA' END) "
        f"WHEN _kind = '{S.EVENT_ROUTE}' THEN 'ALTA' WHEN _kind = '{S.EVENT_DELIVERY}' THEN 'BAJA' END "
        "AS nivel_alerta",
        f"CASE WHEN _kind <> '{S.EVENT_GPS}' THEN props END AS mensaje",
        f"CASE WHEN _kind = '{S.EVENT_DELIVERY}' THEN concat('ORD-', CAST(_k AS STRING)) END AS orden_id",
        f"CASE WHEN _kind = '{S.EVENT_DELIVERY}' THEN (CASE WHEN _k >= 50 THEN 'Completado' "
        "ELSE 'Fallido' END) END AS estado_nuevo",
        f"CASE WHEN _kind = '{S.EVENT_ROUTE}' THEN value END AS desviacion_km",
        "CAST(ts AS TIMESTAMP) AS kafka_timestamp",
    )


def keyed_records(events: DataFrame) -> DataFrame:
    """Driver events as topic records: key = plate, value = JSON, timestamp = event time."""
    from flotilla.operators.events import encode_events
    return encode_events(stream_events(events))
