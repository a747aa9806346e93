"""Fixed values of the visit pipeline: names, column lists, schemas, event tags.

These are data contracts, so they are stated plainly and in one place.
"""

from pyspark.sql import types as T

# --- fixed values: raw visits -------------------------------------------------

PLACEHOLDER = "not available in demo dataset"

KEY_COLUMNS = ["fullVisitorId", "visitId"]

IGNORED_COLUMNS = ["device", "geoNetwork", "trafficSource"]

RAW_KPI_COLUMNS = [
    "fullVisitorId", "visitId", "visitNumber", "date", "visitStartTime",
    "channelGrouping", "socialEngagementType", "totals", "hits",
]

# --- fixed values: visit KPI table --------------------------------------------

METRIC_TYPES = {
    "visits": "int",
    "pageviews": "int",
    "transactions": "int",
    "transactionRevenue": "double",
}

HIT_COLUMNS = ["hitType", "pagePath", "isInteraction", "referer"]

KPI_COLUMNS = [
    "fullVisitorId", "date", "visitId", "visitNumber", "visitStartTime",
    "channelGrouping", "socialEngagementType",
    "visits", "pageviews", "transactions", "transactionRevenue",
    "hitType", "pagePath", "isInteraction", "referer",
]

# --- fixed values: star schema ------------------------------------------------

FACT_COLUMNS = [
    "visitId", "fullVisitorId", "date", "visitNumber", "visitStartTime",
    "visits", "pageviews", "transactions", "transactionRevenue",
    "channelGrouping", "hitType",
]

LOT_TABLES = ["kpi_lote_01", "kpi_lote_02"]
UNIFIED_TABLE = "kpi_total_unificado"
FACT_TABLE = "hechos_visitas"
DATE_TABLE = "dim_tiempo"
VISITOR_TABLE = "dim_visitante"
CHANNEL_TABLE = "dim_canal"
PAGE_TABLE = "dim_pagina"

# --- fixed values: progress events --------------------------------------------

EVENT_TOPIC = "procesamiento_kpi"
EVENT_GROUP = "grupo_web"

RUN_STARTED = "inicio_proceso"
BATCH_STARTED = "inicio_lote"
BATCH_PROFILE = "stats_dataframe"
BATCH_RESULT = "resultado_limpieza"
BATCH_FINISHED = "fin_lote"
BATCH_FAILED = "error"

# --- schemas ------------------------------------------------------------------

DEVICE_SCHEMA = T.MapType(T.StringType(), T.StringType())
CUSTOM_DIMENSIONS_SCHEMA = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

TOTALS_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in METRIC_TYPES])

HIT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in HIT_COLUMNS])

# The field names of the events.  One nullable column per field of any event;
# each event fills only its own.  The timestamp is UTC.
EVENT_SCHEMA = T.StructType([
    T.StructField("evento", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("lote_id", T.IntegerType()),
    T.StructField("total_archivos", T.IntegerType()),
    T.StructField("tamaño_lote", T.IntegerType()),
    T.StructField("archivos", T.ArrayType(T.StringType())),
    T.StructField("filas_originales", T.LongType()),
    T.StructField("columnas", T.ArrayType(T.StringType())),
    T.StructField("campos_nulos", T.MapType(T.StringType(), T.LongType())),
    T.StructField("filas_finales", T.LongType()),
    T.StructField("columnas_finales", T.ArrayType(T.StringType())),
    T.StructField("duracion_segundos", T.DoubleType()),
    T.StructField("detalle", T.StringType()),
    T.StructField("stacktrace", T.StringType()),
])
