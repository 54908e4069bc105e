"""DuckDB SQL equal to each registered query, over the same driver tables.

The stand-in views are the SQL twins of ``flotilla.plans.standins``; the cleaning and KPI
CTEs state the fleet rules in plain SQL (dedup as ``row_number() = 1`` over the full column
order, KPIs as GROUP BY). The rounding formulas are this module's own: nothing is imported from
the code that they check.
"""

from __future__ import annotations


def _units(x: str) -> str:
    """A value as whole ten-billionths, from its shortest decimal text."""
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,10))"


def mean(x: str, digits: int) -> str:
    """The mean, half-up (away from zero) at ``digits``, by whole-number division."""
    total = f"CAST(sum({_units(x)}) * CAST(10000000000 AS DECIMAL(11,0)) AS HUGEINT)"
    n = f"CAST(count({_units(x)}) AS HUGEINT)"
    step = 10 ** (10 - digits)
    return (f"CASE WHEN count({_units(x)}) > 0 THEN (CASE WHEN {total} < 0 THEN -1e0 ELSE 1e0 END) "
            f"* CAST((2 * abs({total}) + {step} * {n}) // (2 * {step} * {n}) AS DOUBLE) / 1e{digits} END")


def total(x: str) -> str:
    return f"CAST(round(sum({_units(x)}), 2) AS DOUBLE)"


def share(part: str, whole: str, digits: int) -> str:
    """``part`` of ``whole`` in percent, half-up at ``digits``."""
    return (f"CAST((2 * {10 ** (digits + 2)} * CAST({part} AS HUGEINT) + CAST({whole} AS HUGEINT)) "
            f"// (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 1e{digits}")


def times(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
STATE = ("CASE WHEN l_returnflag = 'R' THEN 'Fallido' WHEN l_returnflag = 'A' THEN 'Completado' "
         "WHEN l_linestatus = 'O' THEN 'Pendiente' END")
KIND = ("CASE event_type WHEN 'view' THEN 'gps_update' WHEN 'signup' THEN 'gps_update' "
        "WHEN 'click' THEN 'speed_alert' WHEN 'error' THEN 'route_deviation' "
        "WHEN 'purchase' THEN 'delivery_status' END")
LEVEL = ("CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'click' THEN 'WARN' "
         "WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END")


def _first_by_all(view: str, key: str, rest: list[str]) -> str:
    order = ", ".join(f'"{c}" ASC NULLS FIRST' for c in rest)
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {view}) WHERE rn = 1)")


DELIVERY_COLS = ["orden_id", "placa_vehiculo", "origen", "destino", "peso_kg", "fecha_entrega",
                 "estado", "duracion_min", "distancia_km", "cliente_id"]
GPS_COLS = ["registro_id", "placa_vehiculo", "latitud", "longitud", "velocidad_kmh", "timestamp",
            "satelites", "precision_gps"]
INCIDENT_COLS = ["incidencia_id", "placa_vehiculo", "tipo", "severidad", "fecha", "descripcion",
                 "costo_estimado_soles", "resuelta", "tiempo_resolucion_min"]

CTE = {
    "deliveries_raw": f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS orden_id,
       l_suppkey AS placa_vehiculo, l_returnflag AS origen, l_linestatus AS destino,
       l_quantity * 200 AS peso_kg,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS fecha_entrega,
       {STATE} AS estado,
       CASE WHEN {STATE} = 'Pendiente' THEN ''
            ELSE CAST(CAST(l_quantity AS INTEGER) * 2 AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN '.0' ELSE '' END
            END AS duracion_min,
       l_extendedprice * (1 - l_discount) AS distancia_km, l_partkey AS cliente_id
FROM lineitem""",
    "deliveries": f"""
SELECT orden_id, placa_vehiculo, origen, destino,
       CASE WHEN peso_kg > 8000 THEN NULL ELSE peso_kg END AS peso_kg,
       try_strptime(fecha_entrega, '%Y-%m-%d %H:%M:%S') AS fecha_entrega,
       coalesce(estado, 'Desconocido') AS estado,
       coalesce(CAST(trunc(TRY_CAST(duracion_min AS DOUBLE)) AS INTEGER), 0) AS duracion_min,
       distancia_km, cliente_id
FROM {_first_by_all('deliveries_raw', 'orden_id', DELIVERY_COLS[1:])}""",
    "gps_raw": f"""
SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d%H') AS registro_id,
       user_id AS placa_vehiculo, CAST(NULL AS DOUBLE) AS latitud, CAST(NULL AS DOUBLE) AS longitud,
       value AS velocidad_kmh, {ISO} AS "timestamp",
       CAST({K} AS BIGINT) AS satelites, {K} / 10e0 AS precision_gps
FROM events""",
    "gps": f"""
SELECT registro_id, placa_vehiculo, latitud, longitud, velocidad_kmh,
       try_strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", satelites, precision_gps
FROM {_first_by_all('gps_raw', 'registro_id', GPS_COLS[1:])}
WHERE velocidad_kmh BETWEEN 0 AND 200 AND satelites >= 3""",
    "incidents_raw": f"""
SELECT CAST(event_id AS VARCHAR) AS incidencia_id, user_id AS placa_vehiculo, event_type AS tipo,
       CASE WHEN value > 100 THEN 'Alta' WHEN value > 30 THEN 'Media' ELSE 'Baja' END AS severidad,
       {ISO} AS fecha, props AS descripcion, value * 1.18e0 AS costo_estimado_soles,
       CASE WHEN {K} < 10 THEN NULL ELSE {K} >= 50 END AS resuelta,
       CAST({K} AS BIGINT) AS tiempo_resolucion_min
FROM events WHERE event_type = 'error'""",
    "incidents": f"""
SELECT incidencia_id, placa_vehiculo, tipo, severidad,
       try_strptime(fecha, '%Y-%m-%dT%H:%M:%SZ') AS fecha, descripcion, costo_estimado_soles, resuelta,
       CASE WHEN resuelta = false THEN NULL ELSE tiempo_resolucion_min END AS tiempo_resolucion_min
FROM {_first_by_all('incidents_raw', 'incidencia_id', INCIDENT_COLS[1:])}""",
    "vehicles": """
SELECT s_suppkey AS placa, s_name AS modelo, s_nationkey AS capacidad_kg,
       'DRV-' || CAST(s_nationkey AS VARCHAR) AS conductor_id, s_nationkey + 2000 AS ano_fabricacion,
       CASE WHEN s_acctbal < 0 THEN 'Diesel' ELSE 'GNV' END AS tipo_combustible,
       s_acctbal >= 0 AS activo
FROM supplier""",
    "delivery_kpis": f"""
SELECT placa_vehiculo, count(*) AS total_entregas,
       {times("estado = 'Completado'")} AS entregas_completadas,
       {share(times("estado = 'Completado'"), 'count(*)', 2)} AS tasa_exito_pct,
       {mean('duracion_min', 2)} AS duracion_promedio_min,
       {total('distancia_km')} AS km_totales,
       {mean('peso_kg', 2)} AS peso_promedio_kg,
       count(DISTINCT cliente_id) AS clientes_atendidos
FROM deliveries GROUP BY placa_vehiculo""",
    "gps_kpis": f"""
SELECT placa_vehiculo, count(*) AS total_registros_gps,
       {mean('velocidad_kmh', 2)} AS velocidad_promedio,
       round(max(velocidad_kmh), 2) AS velocidad_maxima,
       round(min(precision_gps), 2) AS mejor_precision,
       {mean('satelites', 1)} AS satelites_promedio
FROM gps GROUP BY placa_vehiculo""",
    "incident_kpis": f"""
SELECT placa_vehiculo, count(*) AS total_incidencias,
       {times("severidad = 'Alta'")} AS incidencias_alta,
       {times("severidad = 'Media'")} AS incidencias_media,
       {times("severidad = 'Baja'")} AS incidencias_baja,
       {times("resuelta = true")} AS incidencias_resueltas,
       {mean('costo_estimado_soles', 2)} AS costo_promedio_soles
FROM incidents GROUP BY placa_vehiculo""",
    "report": """
SELECT d.placa_vehiculo, v.modelo, coalesce(v.capacidad_kg, 0) AS capacidad_kg, v.conductor_id,
       v.tipo_combustible, d.total_entregas, d.entregas_completadas,
       coalesce(d.tasa_exito_pct, 0) AS tasa_exito_pct,
       coalesce(d.duracion_promedio_min, 0) AS duracion_promedio_min,
       coalesce(d.km_totales, 0) AS km_totales, coalesce(d.peso_promedio_kg, 0) AS peso_promedio_kg,
       d.clientes_atendidos,
       coalesce(g.total_registros_gps, 0) AS total_registros_gps,
       coalesce(g.velocidad_promedio, 0) AS velocidad_promedio,
       coalesce(g.velocidad_maxima, 0) AS velocidad_maxima,
       coalesce(i.total_incidencias, 0) AS total_incidencias,
       coalesce(i.incidencias_alta, 0) AS incidencias_alta,
       coalesce(i.incidencias_media, 0) AS incidencias_media,
       coalesce(i.incidencias_baja, 0) AS incidencias_baja,
       coalesce(i.incidencias_resueltas, 0) AS incidencias_resueltas,
       coalesce(i.costo_promedio_soles, 0) AS costo_promedio_soles,
       TIMESTAMP '2024-02-01 00:00:00' AS fecha_reporte
FROM delivery_kpis d
LEFT JOIN gps_kpis g ON d.placa_vehiculo = g.placa_vehiculo
LEFT JOIN incident_kpis i ON d.placa_vehiculo = i.placa_vehiculo
LEFT JOIN vehicles v ON d.placa_vehiculo = v.placa""",
    "log_lines": f"""
SELECT CASE WHEN value > 300 THEN 'cut ' || event_type
            WHEN value < 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' || {LEVEL} || '] ' || props
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' || {LEVEL} || '] [U'
                 || CAST(user_id AS VARCHAR) || '] ' || props END AS value
FROM events""",
    "log": r"""
SELECT p1 || ' ' || p2 AS "timestamp", trim(p3, '[]') AS nivel,
       trim(split_part(p4, ']', 1), '[') AS componente,
       CASE WHEN contains(p4, ']')
            THEN regexp_replace(substr(p4, strpos(p4, ']') + 1), '^\s+|\s+$', '', 'g')
            ELSE p4 END AS mensaje
FROM (SELECT regexp_extract(value, '^([^ ]*) ([^ ]*) ([^ ]*) (.*)$', 1) AS p1,
             regexp_extract(value, '^([^ ]*) ([^ ]*) ([^ ]*) (.*)$', 2) AS p2,
             regexp_extract(value, '^([^ ]*) ([^ ]*) ([^ ]*) (.*)$', 3) AS p3,
             regexp_extract(value, '^([^ ]*) ([^ ]*) ([^ ]*) (.*)$', 4) AS p4
      FROM log_lines WHERE regexp_matches(value, '^[^ ]* [^ ]* [^ ]* '))""",
    "decoded": f"""
SELECT CAST(user_id AS VARCHAR) AS placa_vehiculo, ts AS kafka_timestamp,
       'EV-' || CAST(event_id AS VARCHAR) AS evento_id, kind AS tipo_evento,
       CASE WHEN kind <> 'delivery_status' THEN CAST(k AS DOUBLE) / 100 - 12 END AS latitud,
       CASE WHEN kind <> 'delivery_status' THEN CAST(k AS DOUBLE) / 100 - 77 END AS longitud,
       CASE WHEN kind IN ('gps_update', 'speed_alert') THEN value END AS velocidad_kmh,
       {ISO} AS "timestamp",
       CASE WHEN kind = 'speed_alert' THEN (CASE WHEN value > 150 THEN 'ALTA' ELSE 'MEDIA' END)
            WHEN kind = 'route_deviation' THEN 'ALTA'
            WHEN kind = 'delivery_status' THEN 'BAJA' END AS nivel_alerta,
       CASE WHEN kind <> 'gps_update' THEN props END AS mensaje,
       CASE WHEN kind = 'delivery_status' THEN 'ORD-' || CAST(k AS VARCHAR) END AS orden_id,
       CASE WHEN kind = 'delivery_status' THEN (CASE WHEN k >= 50 THEN 'Completado' ELSE 'Fallido' END)
            END AS estado_nuevo,
       CASE WHEN kind = 'route_deviation' THEN value END AS desviacion_km
FROM (SELECT *, {KIND} AS kind, {K} AS k FROM events)""",
    "alerts": """
SELECT evento_id, placa_vehiculo, 'VELOCIDAD_EXCEDIDA' AS alerta_tipo,
       'Vehículo ' || placa_vehiculo || ' a ' || CAST(velocidad_kmh AS VARCHAR) || ' km/h'
           AS alerta_descripcion,
       latitud, longitud, "timestamp", nivel_alerta, kafka_timestamp
FROM decoded
WHERE tipo_evento = 'speed_alert' OR (tipo_evento = 'gps_update' AND velocidad_kmh > 100)
UNION ALL
SELECT evento_id, placa_vehiculo, 'DESVIACION_RUTA' AS alerta_tipo,
       'Desviación de ' || CAST(desviacion_km AS VARCHAR) || ' km detectada' AS alerta_descripcion,
       latitud, longitud, "timestamp", nivel_alerta, kafka_timestamp
FROM decoded WHERE tipo_evento = 'route_deviation'""",
}

# Dependencies between CTEs, so each query carries only what it reads.
DEPS = {
    "deliveries": ["deliveries_raw"], "gps": ["gps_raw"], "incidents": ["incidents_raw"],
    "delivery_kpis": ["deliveries"], "gps_kpis": ["gps"], "incident_kpis": ["incidents"],
    "report": ["delivery_kpis", "gps_kpis", "incident_kpis", "vehicles"],
    "log": ["log_lines"], "alerts": ["decoded"],
}


def _with(*names: str) -> str:
    seen: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in seen) + "\n"


def _sel(body: str, *needs: str) -> str:
    return _with(*needs) + body


def _ranked(view: str, column: str) -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY cantidad DESC, {column}) AS puesto FROM "
            f"(SELECT {column}, count(*) AS cantidad FROM {view} WHERE {column} IS NOT NULL GROUP BY {column})")


def build() -> dict[str, str]:
    q = {}
    q["fleet_report"] = _sel("SELECT * FROM report", "report")
    q["delivery_kpis"] = _sel("SELECT * FROM delivery_kpis", "delivery_kpis")
    q["delivery_kpis_sql"] = q["delivery_kpis"]
    q["gps_kpis_sql"] = _sel("SELECT * FROM gps_kpis", "gps_kpis")
    q["incident_kpis_sql"] = _sel("SELECT * FROM incident_kpis", "incident_kpis")
    q["gps_kpis"] = _sel("SELECT * FROM gps_kpis", "gps_kpis")
    q["incident_kpis"] = _sel("SELECT * FROM incident_kpis", "incident_kpis")
    q["clean_deliveries"] = _sel("SELECT * FROM deliveries", "deliveries")
    q["clean_gps"] = _sel("SELECT * FROM gps", "gps")
    q["clean_incidents"] = _sel("SELECT * FROM incidents", "incidents")
    q["cast_fill"] = _sel("""
SELECT orden_id, placa_vehiculo, coalesce(estado, 'Desconocido') AS estado,
       coalesce(CAST(trunc(TRY_CAST(duracion_min AS DOUBLE)) AS INTEGER), 0) AS duracion_min,
       coalesce(CASE WHEN peso_kg > 8000 THEN NULL ELSE peso_kg END, 0) AS peso_kg
FROM deliveries_raw""", "deliveries_raw")
    q["parse_timestamps"] = """
SELECT o_orderkey,
       try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS fecha,
       try_strptime(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS fecha_iso,
       try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '?', '%Y-%m-%d %H:%M:%S')
           AS fecha_invalida
FROM orders"""
    q["log_parse"] = _sel("SELECT * FROM log", "log")
    q["log_level_counts"] = _sel("SELECT nivel, count(*) AS cantidad FROM log GROUP BY nivel", "log")
    q["log_component_counts"] = _sel(
        "SELECT componente, count(*) AS cantidad FROM log GROUP BY componente", "log")
    q["log_errors"] = _sel("SELECT * FROM log WHERE nivel = 'ERROR'", "log")
    q["log_first_errors"] = _sel(
        "SELECT * FROM log WHERE nivel = 'ERROR' ORDER BY \"timestamp\", componente, mensaje LIMIT 10",
        "log")
    q["headline_kpis"] = _sel(f"""
SELECT 'Total Entregas' AS kpi, CAST(count(*) AS DOUBLE) AS valor FROM deliveries
UNION ALL SELECT 'Tasa Éxito Promedio', {mean('tasa_exito_pct', 2)} FROM report
UNION ALL SELECT 'KM Totales Recorridos', {total('km_totales')} FROM report
UNION ALL SELECT 'Velocidad Promedio', {mean('velocidad_promedio', 1)} FROM report
UNION ALL SELECT 'Total Incidencias', CAST(count(*) AS DOUBLE) FROM incidents""",
                              "report", "deliveries", "incidents")
    q["status_counts"] = _sel(_ranked("deliveries", "estado"), "deliveries")
    q["severity_share"] = _sel(f"SELECT *, {share('cantidad', 'sum(cantidad) OVER ()', 1)} AS porcentaje "
                               f"FROM ({_ranked('incidents', 'severidad')})", "incidents")
    q["event_type_counts"] = _sel(_ranked("decoded", "tipo_evento"), "decoded")
    q["top_km"] = _sel("SELECT placa_vehiculo, km_totales FROM report "
                       "ORDER BY km_totales DESC, placa_vehiculo LIMIT 10", "report")
    q["top_success"] = _sel("SELECT placa_vehiculo, tasa_exito_pct FROM report "
                            "ORDER BY tasa_exito_pct DESC, placa_vehiculo LIMIT 10", "report")
    q["event_preview"] = _sel("SELECT * FROM decoded ORDER BY kafka_timestamp, evento_id LIMIT 1000",
                              "decoded")
    q["event_codec"] = _sel("SELECT * FROM decoded", "decoded")
    q["alerts"] = _sel("SELECT * FROM alerts", "alerts")
    q["alerts_union"] = q["alerts"]
    q["events_by_type_1m"] = _sel("""
SELECT tipo_evento, count(*) AS cantidad_eventos,
       count(DISTINCT placa_vehiculo) AS vehiculos_afectados,
       date_trunc('minute', kafka_timestamp) AS ventana_inicio,
       date_trunc('minute', kafka_timestamp) + INTERVAL 1 MINUTE AS ventana_fin
FROM decoded GROUP BY tipo_evento, date_trunc('minute', kafka_timestamp)""", "decoded")
    q["alerts_by_vehicle_2m"] = _sel("""
SELECT placa_vehiculo, alerta_tipo, count(*) AS total_alertas,
       time_bucket(INTERVAL 2 MINUTE, kafka_timestamp) AS ventana_inicio,
       time_bucket(INTERVAL 2 MINUTE, kafka_timestamp) + INTERVAL 2 MINUTE AS ventana_fin
FROM alerts GROUP BY placa_vehiculo, alerta_tipo, time_bucket(INTERVAL 2 MINUTE, kafka_timestamp)""",
                                     "alerts")
    q["stage_counts"] = _sel("""
SELECT 'vehiculos' AS tabla, 'leidas' AS etapa, count(*) AS filas FROM vehicles
UNION ALL SELECT 'entregas', 'leidas', count(*) FROM deliveries_raw
UNION ALL SELECT 'entregas', 'limpias', count(*) FROM deliveries
UNION ALL SELECT 'rutas_gps', 'leidas', count(*) FROM gps_raw
UNION ALL SELECT 'rutas_gps', 'limpias', count(*) FROM gps
UNION ALL SELECT 'incidencias', 'leidas', count(*) FROM incidents_raw
UNION ALL SELECT 'incidencias', 'limpias', count(*) FROM incidents
UNION ALL SELECT 'reporte_flota', 'generado', count(*) FROM report
UNION ALL SELECT 'eventos_sistema', 'parseadas', count(*) FROM log
UNION ALL SELECT 'eventos_sistema', 'errores', count(*) FROM log WHERE nivel = 'ERROR'""",
                             "vehicles", "deliveries", "gps", "incidents", "report", "log")
    q["kpi_sheet"] = f"""
SELECT kpi, valor, CASE kpi
  WHEN 'Total Entregas' THEN CAST(CAST(valor AS BIGINT) AS VARCHAR)
  WHEN 'Total Incidencias' THEN CAST(CAST(valor AS BIGINT) AS VARCHAR)
  WHEN 'Tasa Éxito Promedio' THEN printf('%.2f', valor) || '%'
  WHEN 'KM Totales Recorridos' THEN format('{{:,}}', CAST(round(valor) AS BIGINT)) || ' km'
  ELSE printf('%.1f', valor) || ' km/h' END AS texto
FROM ({q["headline_kpis"]})"""
    q["read_vehicles_csv"] = _sel("""
SELECT CAST(placa AS VARCHAR) AS placa, modelo, CAST(capacidad_kg AS INTEGER) AS capacidad_kg, conductor_id,
       CAST(ano_fabricacion AS INTEGER) AS ano_fabricacion, tipo_combustible, activo FROM vehicles""", "vehicles")
    q["read_deliveries_csv"] = _sel("""
SELECT * REPLACE (CAST(placa_vehiculo AS VARCHAR) AS placa_vehiculo, CAST(cliente_id AS VARCHAR) AS cliente_id,
                  nullif(duracion_min, '') AS duracion_min)
FROM deliveries_raw""", "deliveries_raw")
    q["read_gps_json"] = _sel(
        "SELECT * REPLACE (CAST(placa_vehiculo AS VARCHAR) AS placa_vehiculo) FROM gps_raw", "gps_raw")
    q["clean_deliveries_landed"] = q["clean_deliveries"]
    q["read_gps_pretty_array"] = q["read_gps_json"]
    q["misshapen_csv"] = _sel("""
SELECT count(*) AS leidas, count(*) FILTER (WHERE placa % 7 IN (0, 1)) AS deformes,
       count(*) FILTER (WHERE placa % 7 = 2) AS valores, count(*) FILTER (WHERE placa % 7 > 2) AS sanas FROM vehicles""", "vehicles")
    q["read_incidents_array"] = _sel(
        "SELECT * REPLACE (CAST(placa_vehiculo AS VARCHAR) AS placa_vehiculo) FROM incidents_raw", "incidents_raw")
    q["read_log_text"] = _sel("SELECT * FROM log_lines", "log_lines")
    q["publish_report"] = q["fleet_report"]
    q["publish_report_csv"] = q["fleet_report"]
    q["kpi_summary_json"] = _sel("""
SELECT placa_vehiculo, modelo, total_entregas, tasa_exito_pct, km_totales, velocidad_promedio,
       total_incidencias FROM report""", "report")
    q["event_feed"] = q["event_codec"]
    q["alert_feed"] = q["alerts"]
    q["events_by_type_1m_stream"] = q["events_by_type_1m"]
    q["events_by_type_1m_bitmap"] = q["events_by_type_1m"]
    q["events_by_type_1m_bitmap_closed"] = (q["events_by_type_1m"].rstrip()
        + "\nHAVING date_trunc('minute', kafka_timestamp) + INTERVAL 1 MINUTE"
          " <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE")
    q["delivery_clients_bitmap"] = _sel("SELECT placa_vehiculo, total_entregas, clientes_atendidos FROM delivery_kpis", "delivery_kpis")
    stamped = lambda sql: sql.replace("_fin\nFROM", "_fin, true AS procesado_despues\nFROM").rstrip()
    q["events_by_type_1m_closed"] = (stamped(q["events_by_type_1m"])
        + "\nHAVING date_trunc('minute', kafka_timestamp) + INTERVAL 1 MINUTE"
          " <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE")
    q["alerts_by_vehicle_2m_closed"] = (stamped(q["alerts_by_vehicle_2m"])
        + "\nHAVING time_bucket(INTERVAL 2 MINUTE, kafka_timestamp) + INTERVAL 2 MINUTE"
          " <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE")
    return q
