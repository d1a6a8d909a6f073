"""Rain alerts: filter raining readings and number them per station in arrival order.

Batch form of the stateful processor: ``humidity > threshold`` (NULL humidity or NULL
weather never alerts), then a running count per station (see ``keyed``), then the alert
message with its constant text. ``base_counts`` carries counts from earlier micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.functions.exprs import RAIN_MESSAGE, RAIN_THRESHOLD
from telemetry.operators.keyed import keyed_row_number, sequence_bucket

ALERT_FIELDS = ["station_id", "s_no", "status_timestamp", "humidity", "alert_count", "message"]


def raining(readings: DataFrame, threshold: int = RAIN_THRESHOLD) -> DataFrame:
    return readings.where(F.col("humidity") > F.lit(threshold))


def rain_alerts(readings: DataFrame, threshold: int = RAIN_THRESHOLD,
                order: Sequence = ("sequence_number",), bucket: Column | None = None,
                base_counts: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Alert messages from flat readings (station_id, sequence_number, timestamp, humidity).

    ``order`` is the arrival order inside a station; ``bucket`` a non-decreasing split of
    it (defaults to blocks of 2^20 sequence numbers). ``base_counts`` (station_id,
    base_count) is added to the running number. ``carry`` keeps extra input columns.
    """
    bucket = sequence_bucket("sequence_number") if bucket is None else bucket
    numbered = keyed_row_number(raining(readings, threshold), ["station_id"], list(order), bucket, out="_n")
    count = F.col("_n")
    if base_counts is not None:
        numbered = numbered.join(base_counts, "station_id", "left")
        count = count + F.coalesce(F.col("base_count"), F.lit(0))
    return numbered.select(
        "station_id",
        F.col("sequence_number").alias("s_no"),
        F.col("timestamp").alias("status_timestamp"),
        "humidity",
        count.cast("long").alias("alert_count"),
        F.lit(RAIN_MESSAGE).alias("message"),
        *carry,
    )


def stateless_alerts(readings: DataFrame, threshold: int = RAIN_THRESHOLD,
                     carry: Sequence[str] = ()) -> DataFrame:
    """The map/filter/map variant: same alerts, ``alert_count`` always 0, no state."""
    return raining(readings, threshold).select(
        "station_id",
        F.col("sequence_number").alias("s_no"),
        F.col("timestamp").alias("status_timestamp"),
        "humidity",
        F.lit(0).cast("long").alias("alert_count"),
        F.lit(RAIN_MESSAGE).alias("message"),
        *carry,
    )


def alerts_to_table(alerts: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """Alert message -> archive row: rename, keep alert_count, drop the message text."""
    return alerts.select(
        "station_id",
        F.col("s_no").alias("sequence_number"),
        F.col("status_timestamp").alias("timestamp"),
        "humidity",
        "alert_count",
        (detected_at if detected_at is not None else F.lit(None).cast("timestamp_ntz")).alias("detected_at"),
    )
