"""Column names and types of every stage (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
         "long": T.LongType(), "timestamp": T.TimestampType(), "date": T.DateType()}


def _struct(spec: str) -> T.StructType:
    """All columns nullable; usable before there is a session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


RAW = _struct(
    "station_id string, station_name string, latitude double, longitude double, aqi int, "
    "co double, no2 double, o3 double, pm25 double, pm10 double, timestamp string"
)

CLEAN = _struct(
    "station_id string, station_name string, latitude double, longitude double, aqi int, "
    "aqi_category string, co double, no2 double, o3 double, pm25 double, pm10 double, "
    "timestamp_parsed timestamp, curated_date date, year string, month string, day string"
)

FEATURES = _struct(
    "station_id string, station_name string, latitude double, longitude double, "
    "timestamp_parsed timestamp, curated_date date, aqi int, aqi_category string, "
    "pm25 double, pm10 double, co double, no2 double, o3 double, "
    "pm25_prom_24h double, pm25_prom_6h double, aqi_prom_24h double, aqi_max_24h int, "
    "aqi_prom_1h double, tendencia_aqi int, hora_dia int, dia_semana int, "
    "es_fin_semana int, contaminacion_alta int"
)

PREDICTIONS = _struct(
    "station_id string, station_name string, timestamp_parsed timestamp, aqi int, pm25 double, "
    "aqi_prom_24h double, pm25_prom_6h double, tendencia_aqi double, hora_dia double, "
    "dia_semana double, contaminacion_alta_real double, contaminacion_alta_pred double, "
    "probabilidad_alerta double, estado_predicho string, prediction_timestamp string"
)

EXTRACT = _struct(
    "station_name string, latitude double, longitude double, timestamp_parsed timestamp, "
    "aqi int, aqi_category string, pm25 double, pm10 double, o3 double"
)

HOURLY = _struct("timestamp_parsed timestamp, station_name string, aqi double, curated_date date")

STATION_DAY = _struct("station_id string, curated_date date")

# Key filter of the clean table: minutes of an hour that have a reading, as bits.
KEYS = _struct("station_id string, hour int, bits long, curated_date date")

# First and last day of each station.
FRONTIER = _struct("station_id string, first date, last date")

# Raw files that a batch has taken in.
LEDGER = _struct("path string, modified timestamp, size long")

# Mergeable hours: the mean is ``total / readings``; ``batch`` is the last one merged.
HOURS = _struct("timestamp_parsed timestamp, station_name string, total long, readings long, batch long, curated_date date")

STAGES = _struct("stage string, n long")

CLEAN_PARTITIONS = ["year", "month", "day"]
FEATURE_PARTITIONS = ["curated_date"]
PREDICTION_PARTITIONS = ["station_id"]
CORRUPT = "_corrupt_record"


def columns(schema: T.StructType) -> list[str]:
    return schema.fieldNames()
