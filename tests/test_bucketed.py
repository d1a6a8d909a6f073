"""Bucketed archives: same answers, and neither side of a join by key is exchanged."""

import re

from sorted_rows import rows

from telemetry.operators.alerts import alerts_to_table, rain_alerts
from telemetry.plans import analysis as A
from telemetry.session import scratch_path
from telemetry.sources.bucketed import buckets_for, save_bucketed


def _tables(spark, buckets=4):
    readings = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 1, 1 + id % 40) as station_id", "id as sequence_number", "'low' as battery_status", "id as timestamp",
        "int(id % 101) as humidity", "20 as temperature", "1 as wind_speed", "timestamp'2024-01-01 00:00:00 UTC' as ingested_at")
    alerts = alerts_to_table(rain_alerts(readings)).where("sequence_number % 13 <> 0")
    root = scratch_path(spark, "test-bucketed")
    return (readings, alerts, save_bucketed(readings, "t_readings_b", f"{root}/r", buckets),
            save_bucketed(alerts, "t_alerts_b", f"{root}/a", buckets))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cross_check_over_buckets(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readings, alerts, r, a = _tables(spark)
        plan = _plan(A.rain_crosscheck(r, a, as_of="2024-01-02 00:00:00"))
        join = re.search(r"SortMergeJoin.*", plan, re.S).group(0)
        assert "Exchange" not in join  # both sides come as stored
        assert plan.count("Exchange") == 1  # partial rows per station only
        assert rows(A.rain_crosscheck(r, a, as_of="2024-01-02 00:00:00")) == \
            rows(A.rain_crosscheck(readings, alerts, as_of="2024-01-02 00:00:00"))
        valid = A.rain_validation(r, a)
        # only aggregated rows are exchanged
        assert all(re.search(r"partial_count", x) for x in _plan(valid).split("Exchange")[1:])
        assert rows(A.rain_validation(r, a)) == rows(A.rain_validation(readings, alerts))
        absent = r.join(a, ["station_id", "sequence_number"], "left_anti")
        assert "Exchange" not in _plan(absent)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS t_readings_b")
        spark.sql("DROP TABLE IF EXISTS t_alerts_b")


def test_hot_station_fills_all_buckets(spark):
    try:
        _, _, r, _ = _tables(spark, 8)
        hot = r.where("station_id = 1").selectExpr("input_file_name() as f").groupBy("f").count().collect()
        assert len(hot) == 8 and max(x["count"] for x in hot) < 2 * min(x["count"] for x in hot)
    finally:
        spark.sql("DROP TABLE IF EXISTS t_readings_b")
        spark.sql("DROP TABLE IF EXISTS t_alerts_b")


def test_number_of_buckets():
    assert [buckets_for(x, 100) for x in (0, 1, 100, 101, 300, 1000)] == [1, 1, 1, 2, 4, 16]
