"""Streams: restart continues the running count; a replayed batch changes nothing."""

from sorted_rows import rows
from pyspark.sql import functions as F

from telemetry.operators.alerts import rain_alerts
from telemetry.session import scratch_path
from telemetry.sources.wire import records_from_readings, with_resends
from telemetry.streaming import jobs as J
from telemetry.streaming.topics import TopicSink, read_topic, write_topic_in_slices


def _readings(spark):
    # station 1 rains on every reading, station 2 on every other; 40 readings each
    data = [(s, q, "low", 1000 + q, 80 if (s == 1 or q % 2) else 10, 50, 5)
            for s in (1, 2) for q in range(1, 41)]
    return spark.createDataFrame(data, "station_id long, sequence_number long, battery_status string, "
                                       "timestamp long, humidity int, temperature int, wind_speed int") \
        .withColumn("ingested_at", F.expr("timestampadd(SECOND, timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')"))


import pytest


@pytest.mark.parametrize("start", [
    lambda src, paths: J.start_alert_stream(src, paths, compact_every=2),
    J.start_alert_stream_keyed_state,
], ids=["carried-counts", "keyed-state"])
def test_restart_continues_counts(spark, start):
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-restart"))
    topic = f"{paths.root}/topic"
    write_topic_in_slices(recs.where("sequence_number <= 20"), topic, 2)
    q = start(read_topic(spark, "parquet", topic, max_per_trigger=1), paths)
    q.awaitTermination()
    first = J.read_sink(spark, paths.sink).count()
    # more input arrives; the query restarts from its checkpoint
    write_topic_in_slices(recs.where("sequence_number > 20"), topic, 2)
    q = start(read_topic(spark, "parquet", topic, max_per_trigger=1), paths)
    q.awaitTermination()
    got = J.read_sink(spark, paths.sink)
    want = rain_alerts(readings)
    assert first < got.count()
    assert rows(got, "station_id", "s_no", "alert_count") == rows(want, "station_id", "s_no", "alert_count")


def test_replayed_batch_is_idempotent(spark):
    readings = _readings(spark)
    recs = with_resends(records_from_readings(readings, faults=False, ids=True)).drop("send_at")
    paths = J.StreamPaths(scratch_path(spark, "test-replay"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    fn = J.ArchiveReadings(paths)
    first, second = recs.where("sequence_number <= 25"), recs.where("sequence_number > 15")
    fn(first, 0)
    fn(second, 1)
    before = rows(J.read_sink(spark, paths.sink).drop("ingested_at"))
    fn(second, 1)   # crash after write, before the checkpoint commit: the batch runs again
    fn(first, 2)    # only keys archived before: nothing new, no empty-folder failure
    assert fn.counters.history[-1]["written"] == 0
    after = rows(J.read_sink(spark, paths.sink).drop("ingested_at"))
    assert before == after and len(after) == 80
    keys = [(r[0], r[1]) for r in after]
    assert len(keys) == len(set(keys))
    # insert time: stamped once per micro-batch (one value per batch folder)
    stamps = spark.read.parquet(paths.sink).groupBy("batch_id").agg(
        F.countDistinct("ingested_at").alias("n"), F.count(F.when(F.col("ingested_at").isNull(), 1)).alias("nulls"))
    assert all(r["n"] == 1 and r["nulls"] == 0 for r in stamps.where("batch_id >= 0").collect())


def test_counted_alert_batch_replay(spark):
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-alert-replay"))
    fn = J.CountedAlerts(paths, compact_every=100)
    fn(recs.where("sequence_number <= 10"), 0)
    fn(recs.where("sequence_number > 10"), 1)
    sink = J.read_sink(spark, paths.sink)
    assert "record_timestamp" in sink.columns and sink.where("record_timestamp IS NULL").count() == 0
    once = rows(sink, "station_id", "s_no", "alert_count")
    assert sum(c["alerts"] for c in fn.counters.history) == len(once)
    fn(recs.where("sequence_number > 10"), 1)
    assert rows(J.read_sink(spark, paths.sink), "station_id", "s_no", "alert_count") == once
    assert max(r[2] for r in once if r[0] == 1) == 40


def test_stream_metrics(spark):
    readings = _readings(spark)
    paths = J.StreamPaths(scratch_path(spark, "test-metrics"))
    topic = f"{paths.root}/topic"
    write_topic_in_slices(records_from_readings(readings, faults=True), topic, 1)
    src = read_topic(spark, "parquet", topic).observe(
        "wire", F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("value").isNull(), 1)).alias("null_values"))
    q = J.start_stateless_alert_stream(src, paths)
    q.awaitTermination()
    metrics = q.lastProgress["observedMetrics"]["wire"]
    assert int(metrics["records"]) == 80
    assert all(r["alert_count"] == 0 for r in J.read_sink(spark, paths.sink).collect())


def test_two_consumers_run_side_by_side(spark):
    """Readings and alerts archives as two concurrent queries with their own checkpoints."""
    from telemetry.sources.wire import alert_records
    readings = _readings(spark)
    r_paths = J.StreamPaths(scratch_path(spark, "test-two-r"))
    a_paths = J.StreamPaths(scratch_path(spark, "test-two-a"))
    write_topic_in_slices(records_from_readings(readings, faults=False), f"{r_paths.root}/topic", 2)
    write_topic_in_slices(alert_records(rain_alerts(readings)), f"{a_paths.root}/topic", 2)
    q1 = J.start_archive_stream(read_topic(spark, "parquet", f"{r_paths.root}/topic", 1), r_paths)
    q2 = J.start_archive_stream(read_topic(spark, "parquet", f"{a_paths.root}/topic", 1), a_paths, alerts=True)
    assert {q.id for q in spark.streams.active} >= {q1.id, q2.id} or not (q1.isActive and q2.isActive)
    q1.awaitTermination()
    q2.awaitTermination()
    assert J.read_sink(spark, r_paths.sink).count() == 80
    assert J.read_sink(spark, a_paths.sink).count() == 60


def test_processing_time_trigger(spark):
    """Continuous mode: a timed trigger with a per-trigger cap; stopped after the input drains."""
    readings = _readings(spark)
    paths = J.StreamPaths(scratch_path(spark, "test-timed"))
    topic = f"{paths.root}/topic"
    write_topic_in_slices(records_from_readings(readings, faults=False), topic, 2)
    q = J.start_archive_stream(read_topic(spark, "parquet", topic, max_per_trigger=4), paths,
                               available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert J.read_sink(spark, paths.sink).count() == 80


def test_archive_batch_counters(spark):
    readings = _readings(spark)
    recs = with_resends(records_from_readings(readings, faults=True, ids=True)).drop("send_at")
    paths = J.StreamPaths(scratch_path(spark, "test-counters"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    fn = J.ArchiveReadings(paths)
    fn(recs, 0)
    c = fn.counters.history[-1]
    total = recs.where("value IS NOT NULL").count()
    dead = J.read_sink(spark, paths.dead).count()
    assert c["records"] == total and c["dead_letters"] == dead
    assert c["written"] == J.read_sink(spark, paths.sink).count()


def test_compact_every_may_change_on_restart(spark):
    recs = records_from_readings(_readings(spark), faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-compact"))
    for batch in range(8):
        fn = J.CountedAlerts(paths, compact_every=100 if batch < 4 else 2)
        fn(recs.where(F.col("sequence_number").between(batch * 5 + 1, batch * 5 + 5)), batch)
    got = rows(J.read_sink(spark, paths.sink), "station_id", "s_no", "alert_count")
    assert got == rows(rain_alerts(_readings(spark)), "station_id", "s_no", "alert_count")
    # snapshots at 4 and 6: the folders before the one preceding the last are gone
    assert [b for b in range(8) if J._exists(spark, f"{paths.state}/batch_id={b}")] == [4, 5, 6, 7]


def test_archive_keeps_its_bucket_count_and_spreads_a_hot_station(spark):
    readings = spark.range(1, 60001).selectExpr(
        "1L AS station_id", "id AS sequence_number", "'low' AS battery_status", "id AS timestamp",
        "80 AS humidity", "1 AS temperature", "1 AS wind_speed", "timestamp_ntz'2024-01-01 00:00:00' AS ingested_at")
    recs = records_from_readings(readings, faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-buckets"))
    for buckets, upto in ((8, 40000), (64, 60000)):   # the second run sends 40000 again
        write_topic_in_slices(recs.where(F.col("offset") <= upto * 1000 + 1), f"{paths.root}/topic", 1)
        J.start_archive_stream(read_topic(spark, "parquet", f"{paths.root}/topic"), paths, buckets=buckets).awaitTermination()
    stored = spark.read.parquet(paths.sink)
    assert stored.count() == stored.select("sequence_number").distinct().count() == 60000
    used = stored.select("bucket").distinct().count()
    assert 4 <= used <= 8
    target = scratch_path(spark, "test-compacted")
    J.compact_archive(spark, paths.sink, target, buckets=8)
    assert rows(J.read_sink(spark, target)) == rows(J.read_sink(spark, paths.sink))


def test_stateless_alerts_to_topic(spark):
    recs = records_from_readings(_readings(spark), faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-stateless-topic"))
    write_topic_in_slices(recs, f"{paths.root}/topic", 1)
    sink = TopicSink("parquet", f"{paths.root}/out")
    J.start_stateless_alert_stream(read_topic(spark, "parquet", f"{paths.root}/topic"), paths, topic=sink).awaitTermination()
    out = spark.read.option("recursiveFileLookup", "true").parquet(sink.topic)
    assert out.count() == 60 and out.columns == ["key", "value", "partition", "offset", "timestamp", "headers"]
    assert out.where("key <> get_json_object(value, '$.station_id')").count() == 0


def test_failure_between_write_and_commit(spark, monkeypatch):
    """The batch is written, the query dies before its commit, a restart runs the batch again."""
    recs = with_resends(records_from_readings(_readings(spark), faults=False, ids=True)).drop("send_at")
    paths = J.StreamPaths(scratch_path(spark, "test-crash"))
    write_topic_in_slices(recs, f"{paths.root}/topic", 1)
    source = read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=1)

    def die(self, *a, **b):
        raise RuntimeError("before the commit")

    with monkeypatch.context() as m:
        m.setattr(J.BatchCounters, "record", die)
        with pytest.raises(Exception, match="before the commit"):
            J.start_archive_stream(source, paths).awaitTermination()
    assert J.read_sink(spark, paths.sink).count() > 0
    J.start_archive_stream(source, paths).awaitTermination()
    keys = rows(J.read_sink(spark, paths.sink), "station_id", "sequence_number")
    assert len(keys) == len(set(keys)) == 80


def _archived(spark, paths):
    return rows(J.read_sink(spark, paths.sink).drop("ingested_at"))


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_compaction_then_restart_and_retry(spark, buckets):
    """Compact, restart with new readings and a retry of old ones: all readings once, twice over."""
    recs = records_from_readings(_readings(spark), faults=False)
    paths = J.StreamPaths(scratch_path(spark, f"test-compact-restart-{buckets}"))
    topic, seen = f"{paths.root}/topic", []
    for upto in (15, 30, 40):
        write_topic_in_slices(recs.where(F.col("sequence_number").between(upto - 20, upto)), topic, 1)  # overlaps what was sent
        J.start_archive_stream(read_topic(spark, "parquet", topic), paths, buckets=buckets).awaitTermination()
        before = _archived(spark, paths)
        assert [(r[0], r[1]) for r in before] == [(s, q) for s in (1, 2) for q in range(1, upto + 1)]
        folder = J.compact_archive(spark, paths.sink)
        seen.append(folder)
        assert _archived(spark, paths) == before and J.current_sink(spark, paths.sink) == folder
        assert spark.read.parquet(folder).where("batch_id >= 0").isEmpty()
    assert len(set(seen)) == 3 and not J._exists(spark, paths.sink) and J._exists(spark, seen[1])


def test_unfinished_compaction_counts_for_nothing(spark, monkeypatch):
    recs = records_from_readings(_readings(spark), faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-compact-crash"))
    write_topic_in_slices(recs, f"{paths.root}/topic", 1)
    J.start_archive_stream(read_topic(spark, "parquet", f"{paths.root}/topic"), paths).awaitTermination()
    before = _archived(spark, paths)

    def die(*a):
        raise RuntimeError("while compacting")
    with monkeypatch.context() as m:
        m.setattr(J, "_write_archive", die)
        with pytest.raises(RuntimeError):
            J.compact_archive(spark, paths.sink)
    assert _archived(spark, paths) == before and J.current_sink(spark, paths.sink) == paths.sink
    J.compact_archive(spark, paths.sink)
    assert _archived(spark, paths) == before


def test_empty_archive_compacts(spark):
    paths = J.StreamPaths(scratch_path(spark, "test-compact-empty"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    J.compact_archive(spark, paths.sink)
    assert J.read_sink(spark, paths.sink).count() == 0


def test_retry_batch_reads_the_index_only(spark, monkeypatch):
    """The archive's files are gone, yet every retry is told from new readings."""
    recs = records_from_readings(_readings(spark), faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-index-only"))
    J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
    fn = J.ArchiveReadings(paths)
    fn(recs.where("sequence_number <= 20"), 0)
    fn(recs.where("sequence_number between 26 and 30"), 1)
    before = J.read_sink(spark, paths.sink).count()
    J._remove(spark, paths.sink)
    restarted = J.ArchiveReadings(paths)
    restarted.sink = paths.sink  # as a running stream: the index is there
    restarted(recs, 2)  # 21 to 25 and 31 to 40 are new; 21 to 25 lie below the high-water mark
    assert before == 50 and restarted.counters.history[-1]["written"] == 30
    keys = rows(J.read_sink(spark, paths.sink), "sequence_number", "station_id")
    assert keys == [(q, s) for q in [*range(21, 26), *range(31, 41)] for s in (1, 2)]


def test_index_of_an_older_archive(spark):
    """An archive without an index gets one from its rows when its stream starts."""
    readings = _readings(spark)
    recs = records_from_readings(readings, faults=False)
    paths = J.StreamPaths(scratch_path(spark, "test-index-base"))
    write_topic_in_slices(recs.where("sequence_number <= 20"), f"{paths.root}/topic", 1)
    J.start_archive_stream(read_topic(spark, "parquet", f"{paths.root}/topic"), paths).awaitTermination()
    J._remove(spark, paths.keys)
    write_topic_in_slices(recs, f"{paths.root}/topic", 1)
    J.start_archive_stream(read_topic(spark, "parquet", f"{paths.root}/topic"), paths).awaitTermination()
    assert len(_archived(spark, paths)) == 80


def test_progress_log_agrees_with_the_counters(spark):
    from telemetry.streaming.metrics import watch
    recs = records_from_readings(_readings(spark), faults=True)
    paths = J.StreamPaths(scratch_path(spark, "test-progress"))
    write_topic_in_slices(recs, f"{paths.root}/topic", 2)
    src = read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=2).observe(
        "wire", F.count(F.lit(1)).alias("records"), F.count("value").alias("known"))
    log = watch(spark)
    try:
        archive = J.ArchiveReadings(paths, buckets=4)
        J._seed(spark, paths.sink, J.READINGS_ARCHIVE_SCHEMA, bucketed=True)
        q = src.writeStream.foreachBatch(archive).option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        q.stop()
        import time
        for _ in range(100):  # progress arrives after the query's end
            if str(q.runId) in log.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    batches = [p for p in log.of(q.runId) if p["rows"]]
    assert [p["batch_id"] for p in batches] == [c["batch_id"] for c in archive.counters.history]
    assert [int(p["observed"]["wire"]["known"]) for p in batches] == [c["records"] for c in archive.counters.history]
    assert sum(int(p["observed"]["wire"]["records"]) for p in batches) == sum(p["rows"] for p in batches) == 80


@pytest.mark.parametrize("start", [J.start_alert_stream, J.start_stateless_alert_stream], ids=["counted", "stateless"])
def test_alerts_carry_the_headers_of_their_reading(spark, start):
    recs = records_from_readings(_readings(spark), faults=False)
    mark = F.when(F.col("offset") % 3 > 0, F.array(F.struct(F.lit("trace").alias("key"), F.col("offset").cast("string").cast("binary").alias("value")),
                                                   F.struct(F.lit("k").alias("key"), F.lit(None).cast("binary").alias("value"))))
    paths = J.StreamPaths(scratch_path(spark, "test-headers"))
    write_topic_in_slices(recs.withColumn("headers", mark), f"{paths.root}/topic", 2)
    sink = TopicSink("parquet", f"{paths.root}/out")
    start(read_topic(spark, "parquet", f"{paths.root}/topic"), paths, topic=sink).awaitTermination()
    out = spark.read.option("recursiveFileLookup", "true").parquet(sink.topic)
    want = {r["offset"] * 10 + r["partition"]: r["headers"] for r in recs.withColumn("headers", mark).collect()}
    got = out.collect()
    assert len(got) == 60 and all(r["headers"] == want[r["offset"] * 10 + r["partition"]] for r in got)
    assert {r["headers"] is None for r in got} == {True, False}


def test_producer_writes_a_file_topic(spark):
    """The producer's batch write, read back as a topic: nothing lost, keys and headers kept, a second write appends."""
    from telemetry.functions.codec import encode_readings
    from telemetry.streaming.topics import write_topic_batch
    readings = _readings(spark)
    topic = scratch_path(spark, "test-producer")
    write_topic_batch(encode_readings(readings), "parquet", topic)
    write_topic_batch(encode_readings(readings).withColumn("headers", F.array(F.struct(F.lit("a").alias("key"), F.lit(b"b").alias("value")))), "parquet", topic)
    paths = J.StreamPaths(scratch_path(spark, "test-producer-job"))
    seen = read_topic(spark, "parquet", topic).writeStream.format("parquet").option("path", paths.sink) \
        .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    seen.awaitTermination()
    got = spark.read.parquet(paths.sink)
    assert got.count() == 160 and got.where("key = get_json_object(value, '$.station_id')").count() == 160
    assert got.where("size(headers) = 1 and headers[0].key = 'a'").count() == 80
