"""Reports over the readings archive kept up to date batch by batch.

Each new archived row goes into three tables of partial aggregates that merge by addition,
minimum, maximum and newest row (``merged.MergedTable``), and the reports are read from these,
never from the archive: their cost follows stations and minutes, not readings.

| Table | Key | Partial values | Reports |
|---|---|---|---|
| ``levels`` | station, battery status | rows | battery distribution (per station, pivot, overall) |
| ``stations`` | station | rows, sums, counts, minima, maxima, newest row | drop rates, latest status, weather statistics, counts |
| ``minutes`` | minute of event time | rows | readings per minute |

A replayed batch replaces what it added before. The results equal the batch functions of
``plans.analysis`` over the whole archive, names and types included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry.functions.exprs import minute_of, pct, round_ratio
from telemetry.streaming.merged import MergedTable

_NEWEST = "struct<sequence_number:bigint,battery_status:string,timestamp:bigint,humidity:int,temperature:int,wind_speed:int,ingested_at:timestamp>"
_SUMS = ("n", "st", "ct", "sh", "ch", "sw", "cw")


def _add(*names: str) -> list[Column]:
    return [F.sum(c).cast("long").alias(c) for c in names]


def _levels(rows: DataFrame) -> DataFrame:
    return rows.groupBy("station_id", "battery_status").agg(*_add("n"))


def _stations(rows: DataFrame) -> DataFrame:
    return rows.groupBy("station_id").agg(*_add(*_SUMS), F.min("min_t").alias("min_t"), F.max("max_t").alias("max_t"),
                                          F.max("newest").alias("newest"))


def _minutes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("minute").agg(*_add("n"))


class ArchiveViews:
    """The tables of one readings archive, below ``folder``."""

    def __init__(self, folder: str):
        self.levels = MergedTable(f"{folder}/levels", "station_id long, battery_status string, n long", _levels, ("station_id",))
        self.stations = MergedTable(
            f"{folder}/stations", "station_id long, " + ", ".join(f"{c} long" for c in _SUMS) + f", min_t int, max_t int, newest {_NEWEST}",
            _stations, ("station_id",))
        self.minutes = MergedTable(f"{folder}/minutes", "minute timestamp_ntz, n long", _minutes, ("minute",))

    def _rows(self, readings: DataFrame) -> list[tuple[MergedTable, DataFrame]]:
        """The partial rows of each table: one per reading, combined on the map side by the merge."""
        one = F.lit(1).cast("long").alias("n")

        def measured(c: str, short: str) -> list[Column]:
            return [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(f"s{short}"), F.col(c).isNotNull().cast("long").alias(f"c{short}")]
        newest = F.struct("sequence_number", "battery_status", "timestamp", "humidity", "temperature", "wind_speed", "ingested_at")
        return [(self.levels, readings.select("station_id", "battery_status", one)),
                (self.stations, readings.select("station_id", one, *measured("temperature", "t"), *measured("humidity", "h"),
                                                *measured("wind_speed", "w"), F.col("temperature").alias("min_t"),
                                                F.col("temperature").alias("max_t"), newest.alias("newest"))),
                (self.minutes, readings.select(minute_of("timestamp").alias("minute"), one))]

    def create(self, spark: SparkSession, archive: DataFrame, batch_id: int = 0) -> None:
        """Start from what the archive holds before ``batch_id``."""
        for table, rows in self._rows(archive):
            table.create(spark, rows, batch_id)

    def write(self, spark: SparkSession, batch_id: int, new: DataFrame) -> None:
        """Add the rows that the batch archived."""
        for table, rows in self._rows(new):
            table.write(spark, batch_id, rows)

    # ---- reports ------------------------------------------------------------------------------

    def battery_distribution(self, spark: SparkSession) -> DataFrame:
        counts = self.levels.now(spark).withColumnRenamed("n", "messages")
        return counts.withColumn("_total", F.sum("messages").over(Window.partitionBy("station_id"))) \
            .select("station_id", "battery_status", "messages", pct("messages", "_total").alias("percentage"))

    def battery_pivot(self, spark: SparkSession) -> DataFrame:
        def share(level: str) -> Column:
            return F.sum(F.when(F.col("battery_status") == level, F.col("n")).otherwise(0)).alias(f"_{level}")
        total = self.levels.now(spark).groupBy("station_id").agg(F.sum("n").alias("total"), *map(share, ("low", "medium", "high")))
        return total.select("station_id", "total", *[pct(f"_{x}", "total").alias(f"{x}_pct") for x in ("low", "medium", "high")])

    def battery_global(self, spark: SparkSession) -> DataFrame:
        counts = self.levels.now(spark).groupBy("battery_status").agg(F.sum("n").alias("messages"))
        return counts.withColumn("_total", F.sum("messages").over(Window.partitionBy())) \
            .select("battery_status", "messages", pct("messages", "_total").alias("percentage"))

    def drop_rate(self, spark: SparkSession) -> DataFrame:
        return self.stations.now(spark).select("station_id", F.col("newest.sequence_number").alias("expected_messages"),
                                               F.col("n").alias("received_messages")) \
            .withColumn("dropped_messages", F.col("expected_messages") - F.col("received_messages")) \
            .withColumn("drop_rate_pct", pct("dropped_messages", "expected_messages"))

    def drop_rate_cluster(self, spark: SparkSession) -> DataFrame:
        return self.drop_rate(spark).agg(*[F.sum(f"{c}_messages").cast("long").alias(f"{c}_total") for c in ("expected", "received", "dropped")]) \
            .withColumn("drop_rate_pct", pct("dropped_total", "expected_total"))

    def latest_status(self, spark: SparkSession) -> DataFrame:
        return self.stations.now(spark).select("station_id", "newest.*")

    def weather_stats(self, spark: SparkSession) -> DataFrame:
        return self.stations.now(spark).select(
            "station_id", round_ratio("st", "ct", 1).alias("avg_temp_f"), F.col("min_t").alias("min_temp_f"), F.col("max_t").alias("max_temp_f"),
            round_ratio("sh", "ch", 1).alias("avg_humidity"), round_ratio("sw", "cw", 1).alias("avg_wind_kmh"), F.col("n").alias("samples"))

    def station_counts(self, spark: SparkSession) -> DataFrame:
        return self.stations.now(spark).select("station_id", F.col("n").alias("readings"))

    def readings_per_minute(self, spark: SparkSession, limit: int = 20) -> DataFrame:
        return self.minutes.now(spark).withColumnRenamed("n", "readings").orderBy(F.desc("minute")).limit(limit)
