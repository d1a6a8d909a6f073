"""Archive tables (DDL with explicit schema) and the latest-status view."""

from sorted_rows import rows

from telemetry.schemas import ALERTS_TABLE, READINGS_TABLE
from telemetry.session import scratch_path
from telemetry.sources.archive import create_tables, register_latest_view


def test_archive_schema(spark):
    root = scratch_path(spark, "test-ddl")
    create_tables(spark, root, "t_readings", "t_alerts")
    create_tables(spark, root, "t_readings", "t_alerts")   # IF NOT EXISTS: second call is a no-op
    r = spark.table("t_readings").schema
    a = spark.table("t_alerts").schema
    assert [(f.name, f.dataType) for f in r] == [(f.name, f.dataType) for f in READINGS_TABLE]
    assert [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in ALERTS_TABLE]
    spark.sql("DROP TABLE t_readings")
    spark.sql("DROP TABLE t_alerts")


def test_latest_view(spark, golden):
    r, _ = golden
    register_latest_view(r)
    got = rows(spark.sql("SELECT station_id, sequence_number FROM latest_station_status ORDER BY station_id"))
    assert got == [(1, 5), (2, 6), (3, 1), (4, 4)]


def test_sql_over_registered_views(spark, golden):
    from telemetry.sources.archive import register_views
    r, a = golden
    register_views(r, a)
    got = rows(spark.sql("""
        SELECT r.station_id, COUNT(*) FILTER (WHERE r.humidity > 70) AS above,
               COALESCE(MAX(s.n), 0) AS stored
        FROM weather_readings r
        LEFT JOIN (SELECT station_id, COUNT(*) AS n FROM rain_alerts GROUP BY station_id) s
               ON s.station_id = r.station_id
        GROUP BY r.station_id"""))
    assert got == [(1, 2, 2), (2, 2, 1), (3, 0, 0), (4, 2, 2)]
    minutes = spark.sql("""SELECT date_trunc('minute', timestamp_seconds(timestamp)) AS m, COUNT(*) AS n
                           FROM weather_readings GROUP BY 1 ORDER BY 1 DESC LIMIT 1""").first()
    assert minutes["n"] == 1
    assert spark.sql("SELECT COUNT(*) FROM latest_station_status").first()[0] == 4


def test_insert_statement():
    from telemetry.sources.archive import insert_statement
    assert insert_statement("rain_alerts", "staging", ["station_id", "sequence_number", "humidity"]) == (
        "INSERT INTO rain_alerts (station_id, sequence_number, humidity) "
        "SELECT station_id, sequence_number, humidity FROM staging "
        "ON CONFLICT (station_id, sequence_number) DO NOTHING")
