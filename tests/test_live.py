"""Live reports: windows, update mode, stream-stream join, bounded dedupe, maintained views."""

import time

import pytest
from sorted_rows import rows
from pyspark.sql import functions as F

from telemetry.operators.alerts import rain_alerts
from telemetry.plans import analysis as A
from telemetry.session import scratch_path
from telemetry.sources.wire import alert_records, records_from_readings
from telemetry.streaming import jobs as J
from telemetry.streaming import live as L
from telemetry.streaming.metrics import watch
from telemetry.streaming.topics import read_topic, write_topic_batch, write_topic_in_slices
from telemetry.streaming.views import ArchiveViews


def _readings(spark, n=240):
    """Two stations, a reading a second from 1000 on, some humid, some numbers missing."""
    return spark.range(n).selectExpr(
        "1 + id % 2 as station_id", "1 + id div 2 as sequence_number", "element_at(array('low', 'medium', 'high'), int(1 + id % 3)) as battery_status",
        "1000 + id as timestamp", "int((id * 37) % 101) as humidity", "int(20 + id % 7) as temperature", "int(id % 11) as wind_speed",
        "timestamp_ntz'2024-01-01 00:00:00' as ingested_at").where("sequence_number % 9 <> 4")


def _topic(spark, name, records, slices):
    paths = J.StreamPaths(scratch_path(spark, name))
    write_topic_in_slices(records, f"{paths.root}/topic", slices)
    return paths, lambda: read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=2)


def _minutes(df):
    return {int(r["s"]): r["readings"] for r in df.selectExpr("unix_seconds(minute) as s", "readings").collect()}


def test_minutes_equal_the_batch_report_and_survive_a_restart(spark):
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths, source = _topic(spark, "test-minutes", recs.where("offset < 1120000"), 2)
    L.start_minute_counts(source(), paths).awaitTermination()
    assert set(_minutes(J.read_sink(spark, paths.sink))) == {960, 1020}  # 1080 is open: the newest reading is of 1119
    write_topic_in_slices(recs.where("offset >= 1120000"), f"{paths.root}/topic", 1)
    write_topic_batch(L.closing_reading(readings), "parquet", f"{paths.root}/topic")
    L.start_minute_counts(source(), paths).awaitTermination()
    want = {int(r["m"]): r["n"] for r in readings.groupBy(F.expr("timestamp - timestamp % 60").alias("m")).agg(F.count("*").alias("n")).collect()}
    assert _minutes(J.read_sink(spark, paths.sink)) == want


def test_late_readings_are_dropped_and_counted(spark):
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths, source = _topic(spark, "test-late", recs, 1)
    late = recs.where("offset < 1010000").withColumn("offset", F.col("offset") + 10 ** 9)
    log = watch(spark)
    try:
        L.start_minute_counts(source(), paths).awaitTermination()
        write_topic_in_slices(late, f"{paths.root}/topic", 1)  # minutes of long ago
        q = L.start_minute_counts(source(), paths)
        q.awaitTermination()
        for _ in range(100):
            if str(q.runId) in log.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert sum(p["late"] for p in log.of(q.runId)) > 0
    got = _minutes(J.read_sink(spark, paths.sink))
    assert got[960] == readings.where("timestamp < 1020").count()  # not counted again


def test_drop_rate_after_restart_and_replay(spark):
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths, source = _topic(spark, "test-drop", recs.where("offset < 1100000"), 3)
    L.start_drop_rate(source(), paths).awaitTermination()
    write_topic_in_slices(recs.where("offset >= 1100000"), f"{paths.root}/topic", 2)
    L.start_drop_rate(source(), paths).awaitTermination()
    rates = L.DropRates(paths.sink)
    want = rows(A.drop_rate(readings))
    assert rows(rates.report(spark), *A.drop_rate(readings).columns) == want
    # the newest batch runs again with the same changed rows
    last = rates.table.newest(spark) - 1
    again = rates.table.now(spark).where(F.col("batch") == last).drop("batch")
    rates(again, last)
    assert rows(rates.report(spark), *A.drop_rate(readings).columns) == want
    assert rows(rates.report_cluster(spark)) == rows(A.drop_rate_cluster(readings))


def test_rain_check_equals_the_batch_cross_check(spark):
    readings = _readings(spark)
    alerts = rain_alerts(readings).where("s_no % 5 <> 0")
    paths, source = _topic(spark, "test-rain-check", records_from_readings(readings, faults=False), 2)
    topic = f"{paths.root}/alerts"
    write_topic_in_slices(alert_records(alerts), topic, 2)
    write_topic_in_slices(alert_records(alerts), topic, 1)  # every alert again
    L.start_rain_check(source(), read_topic(spark, "parquet", topic, max_per_trigger=2), paths).awaitTermination()
    early = J.read_sink(spark, paths.sink)
    assert early.where("alert_time is null and event_time > timestamp_seconds(1200)").isEmpty()  # still waiting
    write_topic_batch(L.closing_reading(readings), "parquet", f"{paths.root}/topic")
    write_topic_batch(L.closing_alert(readings), "parquet", topic)
    L.start_rain_check(source(), read_topic(spark, "parquet", topic, max_per_trigger=2), paths).awaitTermination()
    got = L.rain_check_report(J.read_sink(spark, paths.sink))
    stored = alerts.select("station_id", F.col("s_no").alias("sequence_number"))
    want = A.rain_crosscheck(readings, stored, min_age_seconds=0)
    assert rows(got) == rows(want) and sum(r[3] for r in rows(got)) > 0


def test_bounded_dedupe_differs_from_the_archive_beyond_its_delay(spark):
    """A copy within the watermark goes; one that comes after it counts as new, which the archive never lets in."""
    readings = _readings(spark, 300)
    recs = records_from_readings(readings, faults=False)
    paths, source = _topic(spark, "test-once", recs.where("offset < 1050000"), 1)
    topic = f"{paths.root}/topic"
    write_topic_in_slices(recs.where("offset between 1040000 and 1299999"), topic, 1)   # 1040-1049 again: within the delay
    copies = L.readings_in_time(source())
    L._append(L.once_within(copies).select("station_id", "sequence_number"), paths, True, None).awaitTermination()
    assert len(rows(J.read_sink(spark, paths.sink))) == readings.count()
    write_topic_in_slices(recs.where("offset between 1290000 and 1299999"), topic, 1)   # again, the state still holds them
    L._append(L.once_within(L.readings_in_time(source())).select("station_id", "sequence_number"), paths, True, None).awaitTermination()
    assert len(rows(J.read_sink(spark, paths.sink))) == readings.count()
    # a copy with a later event time than its state lives: new to the stream, old to the archive
    write_topic_batch(L.closing_reading(readings, 1000), "parquet", topic)
    retimed = records_from_readings(readings.where("timestamp < 1010").withColumn("timestamp", F.col("timestamp") + 2000), faults=False)
    write_topic_in_slices(retimed, topic, 1)
    L._append(L.once_within(L.readings_in_time(source())).select("station_id", "sequence_number"), paths, True, None).awaitTermination()
    stream = [r for r in rows(J.read_sink(spark, paths.sink)) if r[0] != L.CLOSING_STATION]
    assert len(stream) == readings.count() + readings.where("timestamp < 1010").count()
    archive = J.StreamPaths(scratch_path(spark, "test-once-archive"))
    J.start_archive_stream(read_topic(spark, "parquet", topic), archive).awaitTermination()
    stored = [r for r in rows(J.read_sink(spark, archive.sink), "station_id", "sequence_number") if r[0] != L.CLOSING_STATION]
    assert stored == sorted(set(stream))


REPORTS = ("battery_distribution", "battery_pivot", "battery_global", "drop_rate", "drop_rate_cluster", "latest_status", "weather_stats",
           "station_counts", "readings_per_minute")


def _equal_reports(spark, paths):
    views, archive = ArchiveViews(paths.views), J.read_sink(spark, paths.sink)
    for name in REPORTS:
        want = getattr(A, name)(archive)
        got = getattr(views, name)(spark)
        assert got.dtypes == [(c, dict(want.dtypes)[c]) for c in got.columns] and sorted(got.columns) == sorted(want.columns), name
        assert rows(got, *want.columns) == rows(want), name


def test_views_equal_recomputation_after_each_batch(spark):
    readings = _readings(spark, 120)
    recs = records_from_readings(readings, faults=True)
    paths = J.StreamPaths(scratch_path(spark, "test-views"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    fn = J.ArchiveReadings(paths, views=True)
    parts = [recs.where(F.col("offset").between(lo * 1000, lo * 1000 + 49_999)) for lo in (1000, 1030, 1070)]  # they overlap
    for batch, part in enumerate(parts):
        fn(part, batch)
        _equal_reports(spark, paths)
    fn(parts[-1], 2)  # runs again
    _equal_reports(spark, paths)


def test_views_of_an_archive_that_is_there(spark):
    readings = _readings(spark, 80)
    recs = records_from_readings(readings, faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-views-late"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    J.ArchiveReadings(paths)(recs.where("offset < 1030000"), 0)
    J.ArchiveReadings(paths, views=True)(recs, 1)
    _equal_reports(spark, paths)
    with pytest.raises(ValueError):
        J.start_archive_stream(None, paths, alerts=True, views=True)
