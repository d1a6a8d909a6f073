"""The analysis queries over the readings and alerts archives.

Each function takes archive DataFrames and returns the answer DataFrame, unsorted unless
the order is part of the answer (top-k). ``ordered`` gives the presentation order of the
original report for callers that display results.

Plans, at scale:
* per-station aggregates are hash aggregates with map-side partial aggregation, so a hot
  station costs one partial row per task in the exchange;
* windows only ever run over aggregated rows (at most a few per station);
* joins between per-station aggregates are co-partitioned by ``station_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry.functions.exprs import (RAIN_THRESHOLD, battery_rank, minute_of, pct,
                                       round_ratio)
from telemetry.operators.gaps import expand_gaps, first_missing, gap_ranges
from telemetry.operators.latest import latest_per_key


def _n() -> Column:
    return F.count(F.lit(1))


# A1 -- battery distribution per station, percentage within the station
def battery_distribution(readings: DataFrame) -> DataFrame:
    counts = readings.groupBy("station_id", "battery_status").agg(_n().alias("messages"))
    station_total = F.sum("messages").over(Window.partitionBy("station_id"))
    return (counts.withColumn("_total", station_total)
            .select("station_id", "battery_status", "messages",
                    pct("messages", "_total").alias("percentage")))


def battery_distribution_ordered(readings: DataFrame) -> DataFrame:
    return battery_distribution(readings).orderBy("station_id", battery_rank("battery_status"))


# A2 -- one row per station, three shares in one pass (conditional counts, no pivot)
def battery_pivot(readings: DataFrame) -> DataFrame:
    def share(level: str) -> Column:
        return F.count(F.when(F.col("battery_status") == level, 1)).alias(f"_{level}")

    agg = readings.groupBy("station_id").agg(_n().alias("total"), share("low"), share("medium"), share("high"))
    return agg.select("station_id", "total",
                      pct("_low", "total").alias("low_pct"),
                      pct("_medium", "total").alias("medium_pct"),
                      pct("_high", "total").alias("high_pct"))


# A3 -- global distribution; the window runs over the handful of aggregated rows
def battery_global(readings: DataFrame) -> DataFrame:
    counts = readings.groupBy("battery_status").agg(_n().alias("messages"))
    return (counts.withColumn("_total", F.sum("messages").over(Window.partitionBy()))
            .select("battery_status", "messages", pct("messages", "_total").alias("percentage")))


def battery_global_ordered(readings: DataFrame) -> DataFrame:
    return battery_global(readings).orderBy(F.desc("percentage"))


# A4 -- drop rate per station: highest sequence number is what the station generated
def _expected_received(readings: DataFrame) -> DataFrame:
    return readings.groupBy("station_id").agg(F.max("sequence_number").alias("expected_messages"),
                                              _n().alias("received_messages"))


def drop_rate(readings: DataFrame) -> DataFrame:
    return (_expected_received(readings)
            .withColumn("dropped_messages", F.col("expected_messages") - F.col("received_messages"))
            .withColumn("drop_rate_pct", pct("dropped_messages", "expected_messages")))


# A5 -- cluster drop rate: aggregate of the per-station aggregate
def drop_rate_cluster(readings: DataFrame) -> DataFrame:
    per = _expected_received(readings)
    tot = per.agg(F.sum("expected_messages").cast("long").alias("expected_total"),
                  F.sum("received_messages").cast("long").alias("received_total"),
                  F.sum(F.col("expected_messages") - F.col("received_messages")).cast("long").alias("dropped_total"))
    return tot.withColumn("drop_rate_pct", pct("dropped_total", "expected_total"))


# A6 -- first 50 missing sequence numbers of one station
def missing_for_station(readings: DataFrame, station_id: int = 1, limit: int = 50) -> DataFrame:
    return first_missing(readings, station_id, limit)


def missing_all(readings: DataFrame) -> DataFrame:
    return expand_gaps(gap_ranges(readings))


def gaps(readings: DataFrame) -> DataFrame:
    return gap_ranges(readings)


# A7 -- alerts validation, driven by readings (stations with alerts only do not appear)
def rain_validation(readings: DataFrame, alerts: DataFrame, threshold: int = RAIN_THRESHOLD) -> DataFrame:
    above = readings.groupBy("station_id").agg(
        F.count(F.when(F.col("humidity") > threshold, 1)).alias("readings_above_70"))
    stored = alerts.groupBy("station_id").agg(_n().alias("_stored"))
    return (above.join(stored, "station_id", "left")
            .select("station_id", "readings_above_70",
                    F.coalesce(F.col("_stored"), F.lit(0)).cast("long").alias("alerts_stored")))


# A8 -- latest status per station (the view)
def latest_status(readings: DataFrame) -> DataFrame:
    return latest_per_key(readings, ["station_id"], "sequence_number")


# A9 -- weather statistics; AVG rounded exactly from SUM and COUNT
def weather_stats(readings: DataFrame) -> DataFrame:
    agg = readings.groupBy("station_id").agg(
        F.sum("temperature").alias("_st"), F.count("temperature").alias("_ct"),
        F.min("temperature").alias("min_temp_f"), F.max("temperature").alias("max_temp_f"),
        F.sum("humidity").alias("_sh"), F.count("humidity").alias("_ch"),
        F.sum("wind_speed").alias("_sw"), F.count("wind_speed").alias("_cw"),
        _n().alias("samples"))
    return agg.select("station_id",
                      round_ratio("_st", "_ct", 1).alias("avg_temp_f"), "min_temp_f", "max_temp_f",
                      round_ratio("_sh", "_ch", 1).alias("avg_humidity"),
                      round_ratio("_sw", "_cw", 1).alias("avg_wind_kmh"), "samples")


# A10 -- readings per minute, newest 20 minutes (a top-k report)
def readings_per_minute(readings: DataFrame, limit: int = 20) -> DataFrame:
    return (readings.groupBy(minute_of("timestamp").alias("minute")).agg(_n().alias("readings"))
            .orderBy(F.desc("minute")).limit(limit))


# A11 -- row-level cross-check of aged raining readings against stored alerts
def rain_crosscheck(readings: DataFrame, alerts: DataFrame, as_of: str | None = None,
                    threshold: int = RAIN_THRESHOLD, min_age_seconds: int = 30) -> DataFrame:
    """``as_of`` is an instant written in UTC ('YYYY-MM-DD hh:mm:ss'); None means now. Give it
    explicitly for repeatable runs. Archives store instants; a zone-free insert time is
    taken as UTC. The session zone plays no part."""
    now = F.expr(f"TIMESTAMP'{as_of} UTC'" if as_of else "current_timestamp()")
    inserted = F.col("ingested_at")
    if dict(readings.dtypes)["ingested_at"] == "timestamp_ntz":
        inserted = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ingested_at)"))
    cutoff = now - F.expr(f"INTERVAL {min_age_seconds} SECONDS")
    eligible = readings.where((F.col("humidity") > threshold) & (inserted < cutoff)) \
        .select("station_id", "sequence_number")
    stored = alerts.select("station_id", F.col("sequence_number").alias("_alert_seq"))
    joined = eligible.join(stored, (eligible.station_id == stored.station_id)
                           & (eligible.sequence_number == stored._alert_seq), "left") \
        .select(eligible.station_id, "_alert_seq")
    return joined.groupBy("station_id").agg(
        _n().alias("qualifying_readings"),
        F.count("_alert_seq").alias("matching_alerts"),
        F.count(F.when(F.col("_alert_seq").isNull(), 1)).alias("missing_alerts"))


# A12 -- row counts per station and per table
def station_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("station_id").agg(_n().alias("readings"))


def table_counts(readings: DataFrame, alerts: DataFrame) -> DataFrame:
    r = readings.agg(_n().alias("row_count")).select(F.lit("weather_readings").alias("table_name"), "row_count")
    a = alerts.agg(_n().alias("row_count")).select(F.lit("rain_alerts").alias("table_name"), "row_count")
    return r.unionByName(a)
