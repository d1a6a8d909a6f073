"""Golden answers for the 12-row table (FIXTURES.md section 2)."""

import datetime

from sorted_rows import rows

from telemetry.operators.alerts import rain_alerts
from telemetry.plans import analysis as A
from telemetry.session import scratch_path


def test_battery_distribution(golden):
    r, _ = golden
    got = rows(A.battery_distribution(r), "station_id", "battery_status", "percentage")
    assert got == [(1, "high", 25.0), (1, "low", 25.0), (1, "medium", 50.0),
                   (2, "high", 33.33), (2, "low", 66.67), (3, "medium", 100.0),
                   (4, "high", 50.0), (4, "low", 25.0), (4, "medium", 25.0)]


def test_battery_global(golden):
    r, _ = golden
    assert rows(A.battery_global(r)) == [("high", 4, 33.33), ("low", 4, 33.33), ("medium", 4, 33.33)]


def test_battery_pivot(golden):
    r, _ = golden
    assert rows(A.battery_pivot(r))[0] == (1, 4, 25.0, 50.0, 25.0)


def test_drop_rate(golden):
    r, _ = golden
    got = rows(A.drop_rate(r), "station_id", "expected_messages", "received_messages",
               "dropped_messages", "drop_rate_pct")
    assert got == [(1, 5, 4, 1, 20.0), (2, 6, 3, 3, 50.0), (3, 1, 1, 0, 0.0), (4, 4, 4, 0, 0.0)]


def test_drop_rate_cluster(golden):
    r, _ = golden
    assert rows(A.drop_rate_cluster(r)) == [(16, 12, 4, 25.0)]


def test_missing(golden):
    r, _ = golden
    assert rows(A.missing_all(r)) == [(1, 3), (2, 1), (2, 4), (2, 5)]
    assert [x[0] for x in A.missing_for_station(r, 2).collect()] == [1, 4, 5]
    assert rows(A.gaps(r)) == [(1, 3, 3, 1), (2, 1, 1, 1), (2, 4, 5, 2)]


def test_rain_validation(golden):
    r, a = golden
    assert rows(A.rain_validation(r, a)) == [(1, 2, 2), (2, 2, 1), (3, 0, 0), (4, 2, 2)]


def test_latest_status(golden):
    r, _ = golden
    got = rows(A.latest_status(r), "station_id", "sequence_number", "humidity")
    assert got == [(1, 5, 10), (2, 6, 71), (3, 1, None), (4, 4, 30)]


def test_weather_stats(golden):
    r, _ = golden
    got = rows(A.weather_stats(r))
    assert got == [(1, 65.0, 50, 80, 60.3, 15.0, 4), (2, 70.3, 20, 120, 57.0, 18.3, 3),
                   (3, None, None, None, None, None, 1), (4, 42.3, 40, 45, 52.8, 9.5, 4)]


def test_readings_per_minute(golden):
    r, _ = golden
    got = [(x["minute"], x["readings"]) for x in A.readings_per_minute(r).collect()]
    m = datetime.datetime(1970, 1, 1)
    assert got == [(m.replace(minute=3), 1), (m.replace(minute=2), 2), (m.replace(minute=1), 9)]


def test_rain_crosscheck(golden):
    r, a = golden
    got = rows(A.rain_crosscheck(r, a, "2100-01-01 00:00:00"))
    assert got == [(1, 2, 2, 0), (2, 2, 1, 1), (4, 2, 2, 0)]


def test_running_alert_count(golden):
    r, _ = golden
    got = rows(rain_alerts(r), "station_id", "s_no", "alert_count")
    assert got == [(1, 1, 1), (1, 4, 2), (2, 2, 1), (2, 6, 2), (4, 1, 1), (4, 2, 2)]
    assert {x["message"] for x in rain_alerts(r).collect()} == {"It is raining"}


def test_table_counts(golden):
    r, a = golden
    assert rows(A.table_counts(r, a)) == [("rain_alerts", 6), ("weather_readings", 12)]


def test_rain_crosscheck_now(golden):
    r, a = golden
    # readings from 1970 are older than now - 30 s: same answer as a far-future as_of
    assert rows(A.rain_crosscheck(r, a)) == rows(A.rain_crosscheck(r, a, "2100-01-01 00:00:00"))


def test_crosscheck_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    path = scratch_path(spark, "test-zone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.sql("SELECT 1L AS station_id, 1L AS sequence_number, 80 AS humidity, "
                  "current_timestamp() - INTERVAL 60 SECONDS AS ingested_at").write.parquet(path)
        none = spark.createDataFrame([], "station_id long, sequence_number long")
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            stored = spark.read.parquet(path)
            assert rows(A.rain_crosscheck(stored, none)) == [(1, 1, 0, 1)]
            assert A.rain_crosscheck(stored, none, as_of="2000-01-01 00:00:00").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
