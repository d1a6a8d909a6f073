"""Topic records (key, value, partition, offset, timestamp) built from the ``ev`` readings.

The value is the reading's JSON message. A deterministic share of records is damaged so
that decode, dead letters and contract checks run over the whole table:
``fault = (station_id * 31 + sequence_number) % 97`` picks one of the cases below
(about 12% of records); every other record is sent intact.

The damage is written as SQL text so the same rule produces the oracle's expectation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.functions.codec import encode_reading_value
from telemetry.functions.exprs import evaluate_once
from telemetry.sources.adapters import readings_ev

TOPIC_PARTITIONS = 10

# ---- fixed values: fault cases (fault number -> what the record carries) ------------------
FAULT_MODULUS = 97
FAULT_TRUNCATED = 0          # JSON cut short                      -> dead letter, malformed
FAULT_HUMIDITY_TEXT = 1      # "humidity":"wet"                    -> dead letter, bad number
FAULT_BATTERY_NULL = 2       # "battery_status":null               -> decodes; contract rejects
FAULT_NUMERIC_STRING = 3     # "humidity":"71"                     -> reading, humidity 71
FAULT_OUT_OF_RANGE = 4       # "humidity":3000000000               -> dead letter, bad number
FAULT_NULL_VALUE = 5         # record value NULL                   -> dropped
FAULT_JSON_NULL = 6          # the literal null                    -> dead letter, malformed
FAULT_WEATHER_TEXT = 7       # "weather":"wet"                     -> dead letter, malformed
FAULT_FRACTION = 8           # "humidity":71.9                     -> reading, humidity 71
FAULT_UNKNOWN_FIELD = 9      # extra "firmware" field              -> reading
FAULT_NO_WEATHER = 10        # no "weather" field                  -> reading, three NULLs
FAULT_EMPTY_OBJECT = 11      # {}                                  -> decodes to zeros; contract rejects
# --------------------------------------------------------------------------------------------


def fault_sql(json: str, h: str, b: str, f: str, text_type: str = "STRING") -> str:
    """SQL expression of the damaged value (``json`` the intact text, ``h`` humidity,
    ``b`` battery status, ``f`` the fault number). Valid in Spark SQL and DuckDB."""
    hs = f"CAST({h} AS {text_type})"
    hum = f"'\"humidity\":' || {hs} || ','"
    return f"""CASE {f}
  WHEN {FAULT_TRUNCATED} THEN substring({json}, 1, length({json}) - 7)
  WHEN {FAULT_HUMIDITY_TEXT} THEN replace({json}, {hum}, '"humidity":"wet",')
  WHEN {FAULT_BATTERY_NULL} THEN replace({json}, '"battery_status":"' || {b} || '"', '"battery_status":null')
  WHEN {FAULT_NUMERIC_STRING} THEN replace({json}, {hum}, '"humidity":"' || {hs} || '",')
  WHEN {FAULT_OUT_OF_RANGE} THEN replace({json}, {hum}, '"humidity":3000000000,')
  WHEN {FAULT_NULL_VALUE} THEN NULL
  WHEN {FAULT_JSON_NULL} THEN 'null'
  WHEN {FAULT_WEATHER_TEXT} THEN replace({json}, '"weather":{{', '"weather":"wet","w":{{')
  WHEN {FAULT_FRACTION} THEN replace({json}, {hum}, '"humidity":' || {hs} || '.9,')
  WHEN {FAULT_UNKNOWN_FIELD} THEN replace({json}, '{{"station_id"', '{{"firmware":"v2","station_id"')
  WHEN {FAULT_NO_WEATHER} THEN replace({json}, ',"weather":{{', ',"w":{{')
  WHEN {FAULT_EMPTY_OBJECT} THEN '{{}}'
  ELSE {json} END"""


def fault_number_sql(station: str = "station_id", seq: str = "sequence_number") -> str:
    return f"(({station} * 31 + {seq}) % {FAULT_MODULUS})"


def offset_sql(ts: str = "timestamp", station: str = "station_id") -> str:
    """Offsets grow with time inside a partition (a partition holds whole stations)."""
    return f"({ts} * 1000 + {station} % 1000)"


def records_from_readings(readings: DataFrame, faults: bool = True, ids: bool = False) -> DataFrame:
    """Topic records keyed by station; partition = station % 10 keeps a station's order."""
    enc = readings.select("*", evaluate_once(encode_reading_value(), "_json"))
    # Damaged through an array function: the cases written into the projection make a method too large to be compiled.
    damaged = f"transform(array({fault_number_sql()}), f -> {fault_sql('_json', 'humidity', 'battery_status', 'f')})[0]"
    value = F.expr(f"CASE WHEN {fault_number_sql()} <= {FAULT_EMPTY_OBJECT} THEN {damaged} ELSE _json END") if faults else F.col("_json")
    return enc.select(
        F.col("station_id").cast("string").alias("key"),
        evaluate_once(value, "value"),
        (F.col("station_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.expr(offset_sql()).cast("long").alias("offset"),
        F.col("ingested_at").cast("timestamp").alias("timestamp"),
        *(["station_id", "sequence_number"] if ids else []),
    )


# ---- fixed values: producer retries (at-least-once duplicates) -----------------------------
RESEND_SQL = "(station_id * 7 + sequence_number) % 11 = 0"
RESEND_DELAY = 1_000_000     # offsets later than the original (1000 s of the offset clock)
# --------------------------------------------------------------------------------------------


def with_resends(records: DataFrame) -> DataFrame:
    """Add a second copy of about 9% of the records, sent later (a producer retry).
    ``records`` must carry station_id and sequence_number; ``send_at`` orders sending."""
    copies = F.explode(F.when(F.expr(RESEND_SQL), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    sent = records.select("*", copies.alias("_copy"))
    return (sent.withColumn("offset", F.col("offset") + F.col("_copy") * F.lit(RESEND_DELAY))
            .withColumn("send_at", F.col("offset")).drop("_copy"))


def alert_records(alerts: DataFrame) -> DataFrame:
    """Alert messages as topic records, ordered like the readings they came from."""
    from telemetry.functions.codec import encode_alert_value
    return alerts.select(
        F.col("station_id").cast("string").alias("key"),
        encode_alert_value().alias("value"),
        (F.col("station_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.expr(offset_sql("status_timestamp")).cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "station_id", F.col("s_no").alias("sequence_number"),
    )


def wire_ev(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    return records_from_readings(readings_ev(spark, sf_dir), faults)
