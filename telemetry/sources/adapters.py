"""Readings and alerts derived from the driver tables (rules in FIXTURES.md section 5).

``ev``  -- from ``events``: one station per user, sequence numbers assigned in time order
           *before* about 10% of readings are thinned out, so drop and gap queries see
           real losses.
``li``  -- from ``lineitem``: many stations with short histories and duplicated keys,
           used for first-write-wins and for scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.functions.exprs import epoch_micros, epoch_seconds, epoch_seconds_sql, seconds_to_ntz
from telemetry.operators.alerts import alerts_to_table, rain_alerts
from telemetry.operators.dedupe import first_write_wins
from telemetry.operators.scan import blocked_row_number
from telemetry.schemas import KEY, READING_COLUMNS
from telemetry.sources.tables import table

# ---- fixed values of the adapters (FIXTURES.md section 5) ----------------------------
EV_THIN_DIGIT = 7          # drop readings whose (event_id div 10) % 10 equals this digit
EV_MISSING_ALERT_EVERY = 13  # stored ev alerts skip sequence numbers divisible by this
LI_RAIN_THRESHOLD = 35
LI_FLAG_TO_BATTERY = {"A": "low", "N": "medium", "R": "high"}
LI_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_linestatus", "l_returnflag"]
# ----------------------------------------------------------------------------------------


def readings_ev(spark: SparkSession, sf_dir: str, station: int | None = None) -> DataFrame:
    """Readings from ``events`` (station = user_id + 1), or those of one ``station`` (a filter of the scan).

    Sequence numbers are assigned per station in (ts, event_id) order by a prefix scan over
    blocks of time, so a hot station is numbered by many tasks.
    """
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value", "props")
    if station is not None:
        ev = ev.where(F.col("user_id") == F.lit(station - 1))
    numbered = blocked_row_number(ev, ["user_id"], ["ts", "event_id"], epoch_micros("ts"), out="sequence_number")
    kept = numbered.where(F.expr(f"(event_id div 10) % 10 != {EV_THIN_DIGIT}"))
    digit = F.col("event_id") % 10
    return kept.select(
        (F.col("user_id") + 1).cast("long").alias("station_id"),
        "sequence_number",
        F.when(digit < 3, "low").when(digit < 7, "medium").otherwise("high").alias("battery_status"),
        epoch_seconds("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("humidity"),
        (F.lit(20) + F.col("event_id") % 101).cast("int").alias("temperature"),
        (F.floor("value") % 51).cast("int").alias("wind_speed"),
        seconds_to_ntz(epoch_seconds_sql("ts")).alias("ingested_at"),
    )


def readings_li_raw(spark: SparkSession, sf_dir: str, keep_arrival: bool = True) -> DataFrame:
    """Every lineitem row as a reading message, duplicates of (station, sequence) included.

    Arrival order is the lexicographic order of ``LI_ARRIVAL`` (prefixed ``arr_``).
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *LI_ARRIVAL)
    flag = F.col("l_returnflag")
    battery = F.when(flag == "A", "low").when(flag == "N", "medium").when(flag == "R", "high")
    secs = epoch_seconds("l_shipdate")
    cols = [
        F.col("l_orderkey").cast("long").alias("station_id"),
        F.col("l_linenumber").cast("long").alias("sequence_number"),
        battery.alias("battery_status"),
        secs.alias("timestamp"),
        F.col("l_quantity").cast("int").alias("humidity"),
        (F.lit(20) + F.col("l_suppkey") % 101).cast("int").alias("temperature"),
        (F.col("l_partkey") % 51).cast("int").alias("wind_speed"),
        seconds_to_ntz(epoch_seconds_sql("l_shipdate")).alias("ingested_at"),
    ]
    if keep_arrival:
        cols += [F.col(c).alias(f"arr_{c}") for c in LI_ARRIVAL]
    return li.select(*cols)


LI_ARRIVAL_COLS = [f"arr_{c}" for c in LI_ARRIVAL]


def readings_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``li`` archive: first arrival per (station, sequence) kept."""
    raw = readings_li_raw(spark, sf_dir)
    return first_write_wins(raw, KEY, LI_ARRIVAL_COLS).select(*READING_COLUMNS)


def alerts_ev(spark: SparkSession, sf_dir: str, readings: DataFrame | None = None) -> DataFrame:
    """Stored alerts for ``ev``: the processor's alerts minus a planted set of losses."""
    readings = readings_ev(spark, sf_dir) if readings is None else readings
    alerts = alerts_to_table(rain_alerts(readings, carry=["ingested_at"]), F.col("ingested_at"))
    return alerts.where(F.col("sequence_number") % EV_MISSING_ALERT_EVERY != 0)


def alerts_li(spark: SparkSession, sf_dir: str, archive: DataFrame | None = None) -> DataFrame:
    """Stored alerts for ``li``: archived readings above 35 on even stations."""
    archive = readings_li(spark, sf_dir) if archive is None else archive
    alerts = rain_alerts(archive.select(*READING_COLUMNS), threshold=LI_RAIN_THRESHOLD,
                         carry=["ingested_at"])
    return (alerts_to_table(alerts, F.col("ingested_at"))
            .where(F.col("station_id") % 2 == 0))
