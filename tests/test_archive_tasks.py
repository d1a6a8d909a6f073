"""Upkeep of an archive: tasks follow the rows of a batch; batches that bring nothing new."""

from pyspark.sql import functions as F

from telemetry.operators.intervals import from_keys
from telemetry.session import scratch_path
from telemetry.sources.wire import records_from_readings, with_resends
from telemetry.streaming import index, jobs as J
from telemetry.streaming.topics import read_topic, write_topic_in_slices


def _readings(spark, n):
    return spark.range(n).selectExpr(
        "id % 7 + 1 AS station_id", "id div 7 + 1 AS sequence_number", "'low' AS battery_status", "1000 + id AS timestamp",
        "CAST(id % 100 AS INT) AS humidity", "50 AS temperature", "5 AS wind_speed",
        "timestampadd(SECOND, 1000 + id, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS ingested_at")


def test_index_and_marks_take_few_tasks(spark, monkeypatch):
    """Shuffle partitions of the session do not set how many tasks the upkeep of an archive takes."""
    seen = []

    def write(self, spark, batch_id, rows, of=index.ArchivedKeys.write):
        seen.append(rows.rdd.getNumPartitions())
        of(self, spark, batch_id, rows)
    monkeypatch.setattr(index.ArchivedKeys, "write", write)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "90")
    try:
        paths = J.StreamPaths(scratch_path(spark, "test-few-tasks"))
        records = with_resends(records_from_readings(_readings(spark, 2000), faults=False, ids=True))
        write_topic_in_slices(records, f"{paths.root}/topic", 2, order="send_at")
        files = len([f for f in spark.read.parquet(f"{paths.root}/topic").inputFiles()])
        source = read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=-(-files // 2))
        J.start_archive_stream(source, paths, buckets=4).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 2 and max(seen) <= 2 * spark.sparkContext.defaultParallelism
    stored = J.read_sink(spark, paths.sink)
    assert stored.count() == stored.select("station_id", "sequence_number").distinct().count() == 2000
    keys = index.ArchivedKeys(paths.keys).now(spark)
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, from_keys(stored).collect()))


def test_batch_without_new_rows(spark):
    """A batch of retries alone leaves the archive and its index as they were."""
    paths = J.StreamPaths(scratch_path(spark, "test-no-new"))
    records = records_from_readings(_readings(spark, 50), faults=False).coalesce(1)
    for _ in range(2):
        records.select("key", "value", "partition", "offset", "timestamp").write.mode("append").parquet(f"{paths.root}/topic")
    J.start_archive_stream(read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=1), paths, buckets=4).awaitTermination()
    assert J.read_sink(spark, paths.sink).count() == 50
    assert index.ArchivedKeys(paths.keys).newest(spark) == 2
    assert index.ArchivedKeys(paths.keys).now(spark).agg(F.sum(F.expr("hi - lo + 1"))).first()[0] == 50
