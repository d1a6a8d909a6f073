"""Declared schemas: wire messages, archive tables and dead letters. Never inferred."""

from pyspark.sql import types as T

# ---- fixed values: topic names of the original deployment --------------------------------
READINGS_TOPIC = "weather-readings"
ALERTS_TOPIC = "rain-alerts"
# --------------------------------------------------------------------------------------------

# Reading message on the wire: {"station_id", "s_no", "battery_status", "status_timestamp", "weather": {...}}
WEATHER = T.StructType([
    T.StructField("humidity", T.IntegerType()),
    T.StructField("temperature", T.IntegerType()),
    T.StructField("wind_speed", T.IntegerType()),
])

READING_MESSAGE = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("s_no", T.LongType()),
    T.StructField("battery_status", T.StringType()),
    T.StructField("status_timestamp", T.LongType()),
    T.StructField("weather", WEATHER),
])

# Wire schema used for decoding: numbers are read as text first so that Jackson-style
# coercions ("7" -> 7, 70.9 -> 70) can be applied and rejects explained.
READING_WIRE = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("s_no", T.StringType()),
    T.StructField("battery_status", T.StringType()),
    T.StructField("status_timestamp", T.StringType()),
    T.StructField("weather", T.StructType([
        T.StructField("humidity", T.StringType()),
        T.StructField("temperature", T.StringType()),
        T.StructField("wind_speed", T.StringType()),
    ])),
    T.StructField("_corrupt", T.StringType()),
])

ALERT_MESSAGE = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("s_no", T.LongType()),
    T.StructField("status_timestamp", T.LongType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("alert_count", T.LongType()),
    T.StructField("message", T.StringType()),
])

ALERT_WIRE = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("s_no", T.StringType()),
    T.StructField("status_timestamp", T.StringType()),
    T.StructField("humidity", T.StringType()),
    T.StructField("alert_count", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

# Archive table of readings; natural key (station_id, sequence_number).
READINGS_TABLE = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("sequence_number", T.LongType(), False),
    T.StructField("battery_status", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("temperature", T.IntegerType()),
    T.StructField("wind_speed", T.IntegerType()),
    T.StructField("ingested_at", T.TimestampType()),
])

# Archive table of alerts; keeps alert_count, which the original table dropped.
ALERTS_TABLE = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("sequence_number", T.LongType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("humidity", T.IntegerType(), False),
    T.StructField("alert_count", T.LongType()),
    T.StructField("detected_at", T.TimestampType()),
])

DEAD_LETTERS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))

# Kafka-shaped record, also used for file-backed topics.
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", HEADERS),
])

READING_COLUMNS = [f.name for f in READINGS_TABLE.fields]
ALERT_COLUMNS = [f.name for f in ALERTS_TABLE.fields]
KEY = ["station_id", "sequence_number"]
