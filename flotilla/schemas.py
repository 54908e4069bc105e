"""Explicit schemas: one name per logical column, no inference passes.

Column names, literal codes and formats below are fixed values: they must equal the
application's own so that published tables and alert texts read the same.
"""

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------
# Delivery states, incident severities, event kinds, alert kinds and text formats.
STATE_DONE = "Completado"
STATE_UNKNOWN = "Desconocido"
DELIVERY_STATES = ["Completado", "En tránsito", "Fallido", "Pendiente"]
SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_LOW = "Alta", "Media", "Baja"
EVENT_GPS = "gps_update"
EVENT_SPEED = "speed_alert"
EVENT_ROUTE = "route_deviation"
EVENT_DELIVERY = "delivery_status"
ALERT_SPEED = "VELOCIDAD_EXCEDIDA"
ALERT_ROUTE = "DESVIACION_RUTA"
SPEED_TEXT = ("Vehículo ", " a ", " km/h")           # Vehículo {plate} a {speed} km/h
ROUTE_TEXT = ("Desviación de ", " km detectada")     # Desviación de {km} km detectada
DELIVERY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"             # 'Z' read as UTC, not as a literal
LOG_LEVEL_ERROR = "ERROR"
# Limits of the cleaning rules.
MAX_WEIGHT_KG = 8000
MIN_SPEED_KMH, MAX_SPEED_KMH = 0, 200
MIN_SATELLITES = 3
SPEED_ALERT_KMH = 100
# Stream windows.
EVENT_WINDOW, EVENT_WATERMARK = "1 minute", "2 minutes"
ALERT_WINDOW, ALERT_WATERMARK = "2 minutes", "5 minutes"
# --- end of fixed values ------------------------------------------------------------


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: input and event schemas (field names, order and types) ----------------
VEHICLES = _s(
    ("placa", T.StringType()),
    ("modelo", T.StringType()),
    ("capacidad_kg", T.IntegerType()),
    ("conductor_id", T.StringType()),
    ("ano_fabricacion", T.IntegerType()),
    ("tipo_combustible", T.StringType()),
    ("activo", T.BooleanType()),
)

# duracion_min stays text on read: blanks and junk become null through try_cast.
DELIVERIES_RAW = _s(
    ("orden_id", T.StringType()),
    ("placa_vehiculo", T.StringType()),
    ("origen", T.StringType()),
    ("destino", T.StringType()),
    ("peso_kg", T.DoubleType()),
    ("fecha_entrega", T.StringType()),
    ("estado", T.StringType()),
    ("duracion_min", T.StringType()),
    ("distancia_km", T.DoubleType()),
    ("cliente_id", T.StringType()),
)

GPS_RAW = _s(
    ("registro_id", T.StringType()),
    ("placa_vehiculo", T.StringType()),
    ("latitud", T.DoubleType()),
    ("longitud", T.DoubleType()),
    ("velocidad_kmh", T.DoubleType()),
    ("timestamp", T.StringType()),
    ("satelites", T.LongType()),
    ("precision_gps", T.DoubleType()),
)

INCIDENTS_RAW = _s(
    ("incidencia_id", T.StringType()),
    ("placa_vehiculo", T.StringType()),
    ("tipo", T.StringType()),
    ("severidad", T.StringType()),
    ("fecha", T.StringType()),
    ("descripcion", T.StringType()),
    ("costo_estimado_soles", T.DoubleType()),
    ("resuelta", T.BooleanType()),
    ("tiempo_resolucion_min", T.LongType()),
)

# The wide event struct four event kinds share (fields a kind lacks decode as null).
EVENT = _s(
    ("evento_id", T.StringType()),
    ("tipo_evento", T.StringType()),
    ("placa_vehiculo", T.StringType()),
    ("latitud", T.DoubleType()),
    ("longitud", T.DoubleType()),
    ("velocidad_kmh", T.DoubleType()),
    ("timestamp", T.StringType()),
    ("nivel_alerta", T.StringType()),
    ("mensaje", T.StringType()),
    ("orden_id", T.StringType()),
    ("estado_nuevo", T.StringType()),
    ("desviacion_km", T.DoubleType()),
)
# --- end of fixed values: schemas -------------------------------------------------------
EVENT_FIELDS = [f.name for f in EVENT.fields]
# A decoded event row as the feeds store it: the event fields plus the record time.
EVENT_ROW = T.StructType(list(EVENT.fields) + [T.StructField("kafka_timestamp", T.TimestampType(), True)])

# What a topic (or its file stand-in) delivers: key, value, broker time.
KEYED_RECORD = _s(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("timestamp", T.TimestampType()),
)

# --- fixed values: published column names and order -------------------------------------
# Report column order (22 columns).
REPORT_COLUMNS = [
    "placa_vehiculo", "modelo", "capacidad_kg", "conductor_id", "tipo_combustible",
    "total_entregas", "entregas_completadas", "tasa_exito_pct", "duracion_promedio_min",
    "km_totales", "peso_promedio_kg", "clientes_atendidos",
    "total_registros_gps", "velocidad_promedio", "velocidad_maxima",
    "total_incidencias", "incidencias_alta", "incidencias_media", "incidencias_baja",
    "incidencias_resueltas", "costo_promedio_soles", "fecha_reporte",
]
SUMMARY_COLUMNS = [
    "placa_vehiculo", "modelo", "total_entregas", "tasa_exito_pct",
    "km_totales", "velocidad_promedio", "total_incidencias",
]
ALERT_COLUMNS = [
    "evento_id", "placa_vehiculo", "alerta_tipo", "alerta_descripcion",
    "latitud", "longitud", "timestamp", "nivel_alerta",
]
LOG_COLUMNS = ["timestamp", "nivel", "componente", "mensaje"]
# --- end of fixed values: published columns ----------------------------------------------
