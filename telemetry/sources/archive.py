"""Archive tables: DDL, the latest-status view, and insert-if-absent into a JDBC table.

The Parquet archive written by the streaming jobs is the primary store. This module adds
the table definitions (``CREATE TABLE IF NOT EXISTS ... USING parquet`` with an explicit
schema), the ``latest_station_status`` view, and the JDBC variant of the first-write-wins
insert for deployments that keep the tables in a relational database.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.operators.dedupe import insert_if_absent
from telemetry.operators.latest import latest_per_key
from telemetry.schemas import KEY

READINGS_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  station_id BIGINT NOT NULL, sequence_number BIGINT NOT NULL, battery_status STRING NOT NULL,
  timestamp BIGINT NOT NULL, humidity INT, temperature INT, wind_speed INT, ingested_at TIMESTAMP)
USING parquet LOCATION '{location}'"""

ALERTS_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  station_id BIGINT NOT NULL, sequence_number BIGINT NOT NULL, timestamp BIGINT NOT NULL,
  humidity INT NOT NULL, alert_count BIGINT, detected_at TIMESTAMP)
USING parquet LOCATION '{location}'"""


def create_tables(spark: SparkSession, root: str, readings: str = "weather_readings",
                  alerts: str = "rain_alerts") -> None:
    """Create both archive tables below ``root`` if they do not exist yet."""
    spark.sql(READINGS_DDL.format(name=readings, location=f"{root}/{readings}"))
    spark.sql(ALERTS_DDL.format(name=alerts, location=f"{root}/{alerts}"))


def register_latest_view(readings: DataFrame, name: str = "latest_station_status") -> DataFrame:
    """``CREATE OR REPLACE VIEW latest_station_status`` over the newest row per station."""
    latest = latest_per_key(readings, ["station_id"], "sequence_number")
    latest.createOrReplaceTempView(name)
    return latest


def register_views(readings: DataFrame, alerts: DataFrame | None = None) -> None:
    """Expose the archives to SQL under their table names: ``weather_readings``,
    ``rain_alerts`` and the ``latest_station_status`` view (Spark SQL; ``COUNT(*) FILTER``,
    ``date_trunc`` and windows work as written)."""
    readings.createOrReplaceTempView("weather_readings")
    if alerts is not None:
        alerts.createOrReplaceTempView("rain_alerts")
    register_latest_view(readings)


def jdbc_insert_if_absent(batch: DataFrame, url: str, table: str, arrival: list[str],
                          properties: dict[str, str] | None = None, num_partitions: int = 8) -> int:
    """Append the rows of ``batch`` whose key the JDBC table does not hold yet.

    Existing keys are read with a station-id range predicate, which the JDBC source pushes
    into the database, and in ``num_partitions`` parallel range reads. A replay finds its
    own earlier inserts and appends nothing; a unique constraint on the table turns a
    concurrent writer's duplicate into a failed (and retried) batch, never a duplicate row.
    Returns the number of rows appended.
    """
    props = dict(properties or {})
    bounds = batch.agg(F.min("station_id").alias("lo"), F.max("station_id").alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return 0
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    spark = batch.sparkSession
    existing = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
                .option("partitionColumn", "station_id").option("lowerBound", str(lo))
                .option("upperBound", str(hi + 1)).option("numPartitions", str(num_partitions))
                .options(**props).load()
                .where((F.col("station_id") >= lo) & (F.col("station_id") <= hi))
                .select(*KEY))
    new = insert_if_absent(batch, existing, KEY, arrival).drop(*arrival).persist()
    n = new.count()
    if n:
        new.write.format("jdbc").option("url", url).option("dbtable", table) \
            .option("batchsize", "5000").options(**props).mode("append").save()
    new.unpersist()
    return n


def insert_statement(table: str, staging: str, columns: list[str], keys: list[str] = KEY) -> str:
    """One set-based insert of the staged rows whose key the table does not hold."""
    cols = ", ".join(columns)
    return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON CONFLICT ({', '.join(keys)}) DO NOTHING"


@dataclass(frozen=True)
class DatabaseTable:
    """A database table with a unique key as the sink of an archive stream.

    A batch replaces the staging table in parallel; one statement, hence one transaction,
    then moves what is new. No key is read back into Spark, and a replayed batch inserts nothing.
    """
    url: str
    table: str
    staging: str
    properties: dict[str, str] = field(default_factory=dict)

    def insert(self, batch: DataFrame) -> None:
        batch.write.format("jdbc").option("url", self.url).option("dbtable", self.staging) \
            .option("truncate", "true").option("batchsize", "5000").options(**self.properties).mode("overwrite").save()
        jvm = batch.sparkSession._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            connection.createStatement().executeUpdate(insert_statement(self.table, self.staging, batch.columns))
        finally:
            connection.close()
