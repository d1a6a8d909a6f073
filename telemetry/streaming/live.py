"""Live reports: windows, aggregates and joins of the topics themselves, in event time.

* ``start_minute_counts``: readings per minute of event time, appended once a minute is over
  (watermark); readings that come later than that are dropped and counted by the query's
  progress (``metrics.ProgressLog``, ``late``).
* ``start_drop_rate``: highest and received sequence numbers per station, changed rows only
  (update mode), upserted by station into a merged table.
* ``start_rain_check``: raining readings with their alert, or without one when none came within
  ``wait``: a left outer join of two streams whose state is bounded by both watermarks.
* ``once_within``: first arrival per key among arrivals whose event times lie within ``delay`` of
  it: bounded state instead of the archive's index. Unlike the archive, a copy that
  comes after the watermark passed its first arrival counts as new.

Event time is the station's own timestamp. A query at the end of its input holds back what
the watermark has not passed; a later record (``closing_reading``) releases it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry.functions.codec import archivable, encode_alert_value, encode_reading_value, tag_alerts, tag_readings
from telemetry.functions.exprs import RAIN_MESSAGE, RAIN_THRESHOLD, pct
from telemetry.schemas import KEY
from telemetry.streaming.jobs import StreamPaths, trigger
from telemetry.streaming.merged import MergedTable

DELAY = "30 seconds"      # how far event times may lie behind the newest one
WAIT = "30 seconds"       # how long an alert may take; the report's age limit
CLOSING_STATION = 0       # stations count from 1


def readings_in_time(records: DataFrame, delay: str = DELAY) -> DataFrame:
    """Archivable readings with ``event_time`` and its watermark."""
    return archivable(tag_readings(records)).withColumn("event_time", F.timestamp_seconds("timestamp")) \
        .withWatermark("event_time", delay)


def alerts_in_time(records: DataFrame, delay: str = DELAY) -> DataFrame:
    """Alerts (station_id, s_no) with ``alert_time`` and its watermark."""
    return archivable(tag_alerts(records)).withColumn("alert_time", F.timestamp_seconds("status_timestamp")) \
        .withWatermark("alert_time", delay)


def once_within(readings: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row per key among arrivals that the watermark holds together (a stream with a watermark)."""
    return readings.dropDuplicatesWithinWatermark(keys)


def closing_reading(readings: DataFrame, seconds: int = 86400) -> DataFrame:
    """A topic record of no station, later than all ``readings``, that lets a finished input's last rows out."""
    last = readings.agg((F.max("timestamp") + seconds).alias("timestamp")).select(
        F.lit(CLOSING_STATION).cast("long").alias("station_id"), F.lit(0).cast("long").alias("sequence_number"), F.lit("low").alias("battery_status"),
        "timestamp", F.lit(100).alias("humidity"), F.lit(20).alias("temperature"), F.lit(0).alias("wind_speed"))
    return _record(last, encode_reading_value())


def closing_alert(readings: DataFrame, seconds: int = 86400) -> DataFrame:
    """The same for the alert topic."""
    last = readings.agg((F.max("timestamp") + seconds).alias("status_timestamp")).select(
        F.lit(CLOSING_STATION).cast("long").alias("station_id"), F.lit(0).cast("long").alias("s_no"), "status_timestamp",
        F.lit(100).alias("humidity"), F.lit(0).cast("long").alias("alert_count"), F.lit(RAIN_MESSAGE).alias("message"))
    return _record(last, encode_alert_value())


def _record(rows: DataFrame, value) -> DataFrame:
    return rows.select(F.lit(str(CLOSING_STATION)).alias("key"), value.alias("value"), F.lit(0).alias("partition"),
                       F.lit((1 << 62)).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))


def _append(df: DataFrame, paths: StreamPaths, available_now: bool, interval: str | None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", paths.sink).option("checkpointLocation", paths.checkpoint).outputMode("append")
    return trigger(writer, available_now, interval).start()


def start_minute_counts(records: DataFrame, paths: StreamPaths, delay: str = DELAY, available_now: bool = True,
                        interval: str | None = None) -> StreamingQuery:
    """(minute, readings) of every minute that is over; a retried reading counts again."""
    counts = readings_in_time(records, delay).groupBy(F.window("event_time", "1 minute").alias("w")) \
        .agg(F.count(F.lit(1)).alias("readings"))
    return _append(counts.select(F.col("w.start").alias("minute"), "readings"), paths, available_now, interval)


def start_rain_check(readings: DataFrame, alerts: DataFrame, paths: StreamPaths, threshold: int = RAIN_THRESHOLD, delay: str = DELAY,
                     wait: str = WAIT, available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """(station_id, sequence_number, event_time, alert_time) of raining readings; alert_time NULL: no alert within ``wait``.

    Copies of a reading or an alert count once (``once_within``).
    """
    rain = once_within(readings_in_time(readings, delay).where(F.col("humidity") > threshold)) \
        .select("station_id", "sequence_number", "event_time")
    raised = once_within(alerts_in_time(alerts, delay), ["station_id", "s_no"]) \
        .select(F.col("station_id").alias("_station"), F.col("s_no").alias("_number"), "alert_time")
    met = rain.join(raised, (F.col("station_id") == F.col("_station")) & (F.col("sequence_number") == F.col("_number"))
                    & (F.col("alert_time") >= F.col("event_time")) & (F.col("alert_time") <= F.col("event_time") + F.expr(f"INTERVAL {wait}")),
                    "left_outer")
    return _append(met.where(F.col("station_id") != CLOSING_STATION).drop("_station", "_number"), paths, available_now, interval)


def rain_check_report(checked: DataFrame) -> DataFrame:
    """Qualifying, matching and missing alerts per station."""
    return checked.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("qualifying_readings"), F.count("alert_time").alias("matching_alerts"),
        F.count(F.when(F.col("alert_time").isNull(), 1)).alias("missing_alerts"))


class DropRates:
    """Upserted drop rates: the newest values of every station, by batch."""

    SCHEMA = "station_id long, expected_messages long, received_messages long, batch long"

    def __init__(self, folder: str):
        self.table = MergedTable(folder, self.SCHEMA, self._newest, ("station_id",))

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        values = F.max(F.struct("batch", "expected_messages", "received_messages")).alias("v")
        return rows.groupBy("station_id").agg(values).select("station_id", "v.expected_messages", "v.received_messages", "v.batch")

    def __call__(self, changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        self.table.create(spark, batch_id=batch_id)
        self.table.write(spark, batch_id, changed.withColumn("batch", F.lit(batch_id).cast("long")))

    def report(self, spark) -> DataFrame:
        return self.table.now(spark).drop("batch") \
            .withColumn("dropped_messages", F.col("expected_messages") - F.col("received_messages")) \
            .withColumn("drop_rate_pct", pct("dropped_messages", "expected_messages"))

    def report_cluster(self, spark) -> DataFrame:
        return self.report(spark).agg(*[F.sum(f"{c}_messages").cast("long").alias(f"{c}_total") for c in ("expected", "received", "dropped")]) \
            .withColumn("drop_rate_pct", pct("dropped_total", "expected_total"))


def start_drop_rate(records: DataFrame, paths: StreamPaths, available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Drop rates per station, kept in ``DropRates(paths.sink)``. The state is one row per station; a retried
    reading counts again (the views over the archive count it once)."""
    counts = archivable(tag_readings(records)).groupBy("station_id").agg(
        F.max("sequence_number").alias("expected_messages"), F.count(F.lit(1)).alias("received_messages"))
    writer = counts.writeStream.outputMode("update").foreachBatch(DropRates(paths.sink)).option("checkpointLocation", paths.checkpoint)
    return trigger(writer, available_now, interval).start()
