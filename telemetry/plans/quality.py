"""Quality checks: the reference's stated expectations turned into queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry.functions.codec import contract_reason
from telemetry.functions.exprs import (BATTERY_EXPECTED_PCT, BATTERY_LEVELS, EXPECTED_DROP_PCT,
                                       EXPECTED_RAIN_PCT, RAIN_THRESHOLD, pct)
from telemetry.operators.dedupe import key_conflicts
from telemetry.plans.analysis import battery_global, drop_rate_cluster

TOLERANCE_PCT = 2.0


def _deviation(observed: str, expected: str) -> list:
    dev = F.col(observed) - F.col(expected)
    return [dev.alias("deviation"), (F.abs(dev) <= F.lit(TOLERANCE_PCT)).alias("within_tolerance")]


def battery_deviation(readings: DataFrame) -> DataFrame:
    """Q1: global battery shares against 30/40/30. The expected table has three rows."""
    spark = readings.sparkSession
    expected = spark.createDataFrame(list(BATTERY_EXPECTED_PCT.items()), "battery_status string, expected_pct double")
    observed = battery_global(readings)
    joined = observed.join(F.broadcast(expected), "battery_status", "left")
    return joined.select("battery_status", "percentage", "expected_pct", *_deviation("percentage", "expected_pct"))


def drop_deviation(readings: DataFrame) -> DataFrame:
    base = drop_rate_cluster(readings).select("drop_rate_pct", F.lit(EXPECTED_DROP_PCT).alias("expected_pct"))
    return base.select("drop_rate_pct", "expected_pct", *_deviation("drop_rate_pct", "expected_pct"))


def rain_share(readings: DataFrame, threshold: int = RAIN_THRESHOLD) -> DataFrame:
    """Q3: share of readings that raise an alert, against 29.7%."""
    agg = readings.agg(F.count(F.lit(1)).alias("readings"),
                       F.count(F.when(F.col("humidity") > threshold, 1)).alias("raining"))
    base = agg.select("readings", "raining", pct("raining", "readings").alias("rain_pct"),
                      F.lit(EXPECTED_RAIN_PCT).alias("expected_pct"))
    return base.select("*", *_deviation("rain_pct", "expected_pct"))


def key_conflicts_report(raw: DataFrame) -> DataFrame:
    """Q4: same (station, sequence) arriving with different payloads (station restarts)."""
    payload = ["battery_status", "timestamp", "humidity", "temperature", "wind_speed"]
    return key_conflicts(raw, ["station_id", "sequence_number"], payload)


def contract_violations(readings: DataFrame) -> DataFrame:
    """Q5: rows the archive contract rejects, plus unknown levels and humidity range."""
    reason = contract_reason(levels=BATTERY_LEVELS)
    return (readings.select("station_id", "sequence_number", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))
