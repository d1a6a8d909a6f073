"""Streaming jobs: rain alerts with a running per-station count, and the two archives.

All sinks are folders ``<sink>/batch_id=<n>`` written with overwrite from
``foreachBatch``. Spark commits a micro-batch to the checkpoint only after the function
returns, and a replayed batch reads the same input and overwrites the same folder, so a
crash between write and commit leaves no duplicate (write first, acknowledge after).

Running count (``CountedAlerts``). Each batch numbers its raining readings per station in
arrival order (partition, offset) with bounded (station, bucket) windows and adds the
station's count from earlier batches, carried by ``StationMax``: per batch the stations it
touched with their new value, every ``compact_every`` batches a full snapshot, so a batch
reads at most ``compact_every`` small deltas plus one snapshot -- never the alert archive.
Everything stays in the JVM; only batch ids pass through the driver. The alternative
``start_alert_stream_keyed_state`` keeps the count in Spark's state store instead.
Given a ``TopicSink``, both alert streams also send every alert as a topic record.

Archives (``ArchiveReadings``, ``ArchiveAlerts``). First write wins per key inside the batch,
then a per-station high-water mark (another ``StationMax``) separates certainly-new readings
from the few that are looked up in the interval index of archived keys (``index``). Of the archive
itself a batch reads back its own files only, from which the index, the mark and the views are
kept; ``compact_archive`` rewrites it between runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry.functions.codec import (alert_topic_records, archivable, dead_letters_of, decode_readings,
                                       flatten_readings, tag_alerts, tag_readings)
from telemetry.functions.exprs import RAIN_MESSAGE, RAIN_THRESHOLD
from telemetry.operators.alerts import rain_alerts, stateless_alerts
from telemetry.operators.dedupe import first_write_wins
from telemetry.operators.keyed import sequence_bucket
from telemetry.schemas import ALERTS_TOPIC, KEY, READINGS_TOPIC
from telemetry.sources.archive import DatabaseTable
from telemetry.streaming.folders import exists as _exists
from telemetry.streaming.folders import matches as _matches
from telemetry.streaming.folders import read_batch as _batch
from telemetry.streaming.folders import remove as _remove
from telemetry.streaming.folders import write_batch as _write
from telemetry.streaming.index import ArchivedKeys
from telemetry.streaming.metrics import BatchCounters, Counted
from telemetry.streaming.topics import TopicSink, read_topic
from telemetry.streaming.views import ArchiveViews

ARRIVAL = ["partition", "offset"]

# ---- fixed values: batching of the original consumers ---------------------------------------
READINGS_TRIGGER = "10 seconds"       # flush interval of the readings consumer
READINGS_MAX_PER_TRIGGER = 5000       # batch size threshold of the readings consumer
ALERTS_TRIGGER = None                 # alerts: flush on any non-empty poll (default trigger)
# -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class StreamPaths:
    """Folders of one streaming job below a shared root."""
    root: str

    @property
    def sink(self) -> str:
        return f"{self.root}/sink"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def dead(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def views(self) -> str:
        return f"{self.root}/views"

    @property
    def keys(self) -> str:
        return f"{self.root}/archived_keys"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    @property
    def high_water(self) -> str:
        return f"{self.root}/high_water"


#: Folders an archive is split into when it is created (an argument of the archive streams).
ARCHIVE_BUCKETS = 64
#: Consecutive sequence numbers of a station that share a bucket: a hot station's batch spreads
#: over many buckets, a retry touches only the bucket of its block.
SEQUENCE_BLOCK = 1 << 12


def _seed(spark: SparkSession, folder: str, schema: str, bucketed: bool = False) -> None:
    """An empty partition so the table can be read before batch 0; a folder that is there stays as it is."""
    if not _exists(spark, folder):
        path = f"{folder}/bucket=0/batch_id=-1" if bucketed else f"{folder}/batch_id=-1"
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def _bucket(buckets: int):
    block = F.floor(F.col("sequence_number") / F.lit(SEQUENCE_BLOCK))
    return F.pmod(F.xxhash64("station_id", block), F.lit(buckets)).cast("int")


def _write_archive(df: DataFrame, folder: str, batch_id: int, buckets: int) -> None:
    """Archive layout ``bucket=<hash of station and sequence block>/batch_id=<n>``.

    The batch is shuffled by bucket first, so each touched bucket gets one file per batch
    instead of one per task. Dynamic partition overwrite replaces exactly this batch's
    folders, which makes a replay idempotent.
    """
    out = df.withColumn("bucket", _bucket(buckets)).withColumn("batch_id", F.lit(batch_id))
    # Sorted inside each file, so Parquet min/max statistics skip row groups on station reads.
    (out.repartition("bucket").sortWithinPartitions("station_id", "sequence_number").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "batch_id").parquet(folder))


def _archived_in(spark: SparkSession, folder: str, batch_id: int, rows: DataFrame) -> DataFrame:
    """What a batch wrote to its folders of the archive; ``rows`` has the schema. As many tasks as
    its bytes need, and only the columns asked for, where the rows kept in memory would come in
    one task for every shuffle partition, each shuffled again into as many."""
    written = f"{folder}/bucket=*/batch_id={batch_id}"
    if not _matches(spark, written):
        return spark.createDataFrame([], rows.schema)
    return spark.read.schema(rows.schema).parquet(written)


def _stored_layout(spark: SparkSession, root: str) -> int | None:
    folder = f"{root}/layout"
    return spark.read.schema("buckets int").parquet(folder).first()["buckets"] if _exists(spark, f"{folder}/_SUCCESS") else None


def _layout(spark: SparkSession, paths: StreamPaths, buckets: int) -> int:
    """Buckets of an archive: those it was created with, whatever a restart asks for."""
    stored = _stored_layout(spark, paths.root)
    if stored is None:
        spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{paths.root}/layout")
    return stored or buckets


def _versions(folder: str) -> str:
    return f"{folder}-versions"


def current_sink(spark: SparkSession, folder: str) -> str:
    """Where the archive named ``folder`` stands: the last finished compaction, or ``folder`` itself."""
    n = 0
    while _exists(spark, f"{_versions(folder)}/{n + 1}/finished/_SUCCESS"):
        n += 1
    return f"{_versions(folder)}/{n}/data" if n else folder


def compact_archive(spark: SparkSession, folder: str, target: str | None = None, buckets: int | None = None) -> str:
    """Rewrite an archive with one batch folder per bucket, while its stream is stopped.

    Without ``target`` the new version takes the place of the old one: it is written beside it
    and counts from the moment its marker is there, so a crash leaves the old one in force. The
    version before the replaced one is removed. ``buckets`` defaults to those the archive was created with.
    Returns the folder written.
    """
    now = current_sink(spark, folder)
    versions = _versions(folder)
    n = int(now.split("/")[-2]) + 1 if now != folder else 1
    if buckets is None:
        buckets = _stored_layout(spark, folder.rsplit("/", 1)[0]) or ARCHIVE_BUCKETS
    data = target or f"{versions}/{n}/data"
    rows = read_sink(spark, folder)
    rows.limit(0).write.mode("overwrite").parquet(f"{data}/bucket=0/batch_id=-1")  # readable when empty
    _write_archive(rows, data, -1, buckets)
    if target is None:
        spark.range(1).write.mode("overwrite").parquet(f"{versions}/{n}/finished")
        if n > 1:
            _remove(spark, folder if n == 2 else f"{versions}/{n - 2}/data")
    return data


def trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


# ---- alerts with a running count --------------------------------------------------------------

class StationMax:
    """A per-station maximum carried across micro-batches (alert counts, highest archived
    sequence number).

    Batch ``n`` writes ``<folder>/batch_id=<n>``: the stations it touched with their new
    maximum, or a full snapshot once ``compact_every`` batches passed since the last one. Every
    folder also holds one marker row (station NULL) naming the newest snapshot and the one
    before it, so a reader follows the data and ``compact_every`` may change on a restart.
    Folders are named one by one, and a snapshot removes those older than the snapshot
    before it, so the cost of a batch does not grow with the batches that passed. A replayed
    batch reads only batches before it and overwrites its own folder.
    """

    def __init__(self, folder: str, column: str, compact_every: int = 20):
        self.folder, self.column, self.compact_every = folder, column, compact_every
        self._known: tuple[int, tuple[int, int]] | None = None  # marker of the batch written last

    def _marker(self, spark: SparkSession, batch_id: int) -> tuple[int, int]:
        """(newest snapshot, snapshot before it) as of the end of ``batch_id``."""
        if self._known is None or self._known[0] != batch_id:
            row = _batch(spark, self.folder, batch_id).where(F.col("snapshot").isNotNull()).first()
            self._known = batch_id, (row["snapshot"], row["previous"])
        return self._known[1]

    def _rows(self, spark: SparkSession, first: int, last: int) -> DataFrame:
        folders = [f"{self.folder}/batch_id={i}" for i in range(first, last + 1)]
        return spark.read.parquet(*folders).where(F.col("snapshot").isNull()).select("station_id", self.column)

    def before(self, spark: SparkSession, batch_id: int, stations: DataFrame | None = None) -> DataFrame:
        """(station_id, column): the maximum over all batches before ``batch_id``."""
        if batch_id <= 0:
            # A range, whose size Spark knows: a join with it does not shuffle the batch.
            return spark.range(0).select(F.col("id").alias("station_id"), F.col("id").alias(self.column))
        rows = self._rows(spark, self._marker(spark, batch_id - 1)[0], batch_id - 1)
        if stations is not None:
            rows = rows.join(stations, "station_id", "left_semi")
        return rows.groupBy("station_id").agg(F.max(self.column).alias(self.column))

    def write(self, spark: SparkSession, batch_id: int, updates: DataFrame) -> None:
        """Record this batch's per-station values, or a full snapshot when one is due."""
        rows = updates.select("station_id", F.col(self.column).cast("long").alias(self.column))
        snapshot, previous = self._marker(spark, batch_id - 1) if batch_id > 0 else (0, 0)
        due = batch_id > 0 and batch_id - snapshot >= self.compact_every
        if due:
            rows = self._rows(spark, snapshot, batch_id - 1).unionByName(rows)
        old = range(previous, snapshot) if due else range(0)
        marker = (batch_id, snapshot) if due else (snapshot, previous)
        rows = rows.groupBy("station_id").agg(F.max(self.column).alias(self.column)) \
            .withColumns({"snapshot": F.lit(None).cast("int"), "previous": F.lit(None).cast("int")})
        mark = spark.createDataFrame([(None, None, *marker)], f"station_id long, {self.column} long, snapshot int, previous int")
        _write(rows.unionByName(mark), self.folder, batch_id)
        self._known = batch_id, marker
        for i in old:  # not needed by any replay: this batch starts from ``snapshot``
            _remove(spark, f"{self.folder}/batch_id={i}")


class CountedAlerts:
    """``foreachBatch`` function: decode -> raining -> numbered per station -> alerts, and their
    records to ``topic`` if given (at least once: a replayed batch sends them again)."""

    def __init__(self, paths: StreamPaths, threshold: int = RAIN_THRESHOLD, compact_every: int = 20,
                 topic: TopicSink | None = None):
        self.paths, self.threshold, self.topic = paths, threshold, topic
        self.counts = StationMax(paths.state, "alert_count", compact_every)
        self.counters = BatchCounters()

    def base_counts(self, spark: SparkSession, batch_id: int, stations: DataFrame) -> DataFrame:
        return self.counts.before(spark, batch_id, stations).withColumnRenamed("alert_count", "base_count")

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        # The alert keeps the input record's headers and stream timestamp (renamed: `timestamp` is the
        # reading's epoch seconds).
        carry = ("record_timestamp",) if "timestamp" in records.columns else ()
        if carry:
            records = records.withColumnRenamed("timestamp", "record_timestamp")
        carry += ("headers",) if "headers" in records.columns else ()
        tagged = tag_readings(records, keep=carry, contract=False).persist()
        seen = Counted(tagged, dead=F.col("reason").isNotNull())
        _write(dead_letters_of(seen.df), self.paths.dead, batch_id)
        readings = archivable(tagged)
        stations = readings.where(F.col("humidity") > self.threshold).select("station_id").distinct()
        base = self.base_counts(spark, batch_id, stations)
        alerts = rain_alerts(readings, self.threshold, order=ARRIVAL,
                             bucket=F.struct("partition", sequence_bucket("offset").alias("block")),
                             base_counts=base, carry=(*ARRIVAL, *carry))
        raised = Counted(alerts)
        _write(raised.df, self.paths.sink, batch_id)
        written = _batch(spark, self.paths.sink, batch_id)
        self.counts.write(spark, batch_id, written)
        if self.topic:
            self.topic.write(alert_topic_records(written), batch_id)
        self.counters.record("rain_alerts", batch_id, alerts=raised["rows"], records=seen["rows"], dead_letters=seen["dead"])
        tagged.unpersist()


def start_alert_stream(records: DataFrame, paths: StreamPaths, threshold: int = RAIN_THRESHOLD,
                       available_now: bool = True, interval: str | None = None,
                       compact_every: int = 20, topic: TopicSink | None = None) -> StreamingQuery:
    writer = records.writeStream.foreachBatch(CountedAlerts(paths, threshold, compact_every, topic)) \
        .option("checkpointLocation", paths.checkpoint)
    return trigger(writer, available_now, interval).start()


def start_stateless_alert_stream(records: DataFrame, paths: StreamPaths, threshold: int = RAIN_THRESHOLD,
                                 available_now: bool = True, topic: TopicSink | None = None) -> StreamingQuery:
    """Map/filter/map pipeline, no state: ``alert_count`` is 0, the input key is kept.
    Bad records are skipped by the same decode guard. With ``topic`` the alerts go there as
    records, else to the Parquet sink as rows."""
    extra = ("key", *(c for c in ("headers",) if topic and c in records.columns))
    good, _ = decode_readings(records, keep=extra)
    if topic:
        alerts = stateless_alerts(flatten_readings(good, keep=(*extra, *ARRIVAL)), threshold, carry=[*extra, *ARRIVAL])
        writer = alerts.writeStream.option("checkpointLocation", paths.checkpoint) \
            .foreachBatch(lambda batch, batch_id: topic.write(alert_topic_records(batch), batch_id))
        return trigger(writer, available_now, None).start()
    alerts = stateless_alerts(flatten_readings(good, keep=("key",)), threshold, carry=["key"])
    writer = (alerts.writeStream.format("parquet").option("path", paths.sink)
              .option("checkpointLocation", paths.checkpoint).outputMode("append"))
    return trigger(writer, available_now, None).start()


# ---- archives (first write wins) ---------------------------------------------------------------

def _insert_new(spark: SparkSession, batch: DataFrame, stations: DataFrame, batch_id: int, high_water: StationMax,
                keys: ArchivedKeys) -> DataFrame:
    """Rows of ``batch`` (first arrival per key already chosen, of these ``stations``) whose key is not archived.

    Sequence numbers grow per station, so a reading above its station's highest archived
    sequence number is new for certain. Only readings at or below it (producer retries,
    replays, station restarts) are looked up, in the interval index of archived keys; the
    archive itself is never read or listed. Exact either way.
    """
    marks = high_water.before(spark, batch_id, stations).withColumnRenamed("sequence_number", "_high")
    flagged = batch.join(marks, "station_id", "left")
    maybe_seen = flagged.where(F.col("_high").isNotNull() & (F.col("sequence_number") <= F.col("_high"))).select(*KEY)
    seen = keys.archived(spark, batch_id, maybe_seen)
    return batch if seen is None else batch.join(seen, KEY, "left_anti")


class _Archive:
    """``foreachBatch`` function: decode -> contract -> insert-if-absent into the archive."""

    name: str
    stamp: str
    topic: str

    def __init__(self, paths: StreamPaths, compact_every: int = 20, buckets: int = ARCHIVE_BUCKETS, views: bool = False):
        self.paths, self.buckets = paths, buckets
        self.high_water = StationMax(paths.high_water, "sequence_number", compact_every)
        self.keys = ArchivedKeys(paths.keys)
        self.views = ArchiveViews(paths.views) if views else None
        self.counters = BatchCounters()
        self.sink: str | None = None

    def tagged(self, records: DataFrame) -> DataFrame:
        """The records with their columns and a ``reason`` not to archive them."""
        raise NotImplementedError

    def rows(self, tagged: DataFrame) -> DataFrame:
        return archivable(tagged)

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        if self.sink is None:
            self.sink = current_sink(spark, self.paths.sink)
            for held in filter(None, (self.keys, self.views)):
                held.create(spark, read_sink(spark, self.paths.sink), batch_id)
        tagged = self.tagged(records).persist()
        seen = Counted(tagged, dead=F.col("reason").isNotNull())
        _write(dead_letters_of(seen.df, self.topic), self.paths.dead, batch_id)
        rows = self.rows(tagged)
        first = first_write_wins(rows, KEY, ARRIVAL).persist()
        stations = rows.select("station_id").distinct()
        new = _insert_new(spark, first, stations, batch_id, self.high_water, self.keys) \
            .withColumn(self.stamp, F.current_timestamp())
        _write_archive(new, self.sink, batch_id, self.buckets)
        new = _archived_in(spark, self.sink, batch_id, new)
        self.keys.write(spark, batch_id, new.select(*KEY))
        self.high_water.write(spark, batch_id, new)
        if self.views:
            self.views.write(spark, batch_id, new)
        self.counters.record(self.name, batch_id, written=new.count(), records=seen["rows"], dead_letters=seen["dead"])
        for df in (first, tagged):
            df.unpersist()


class ArchiveReadings(_Archive):
    """The readings archive."""

    name, stamp, topic = "archive_readings", "ingested_at", READINGS_TOPIC

    def tagged(self, records: DataFrame) -> DataFrame:
        return tag_readings(records)


class ArchiveAlerts(_Archive):
    """The archive of the alert topic."""

    name, stamp, topic = "archive_alerts", "detected_at", ALERTS_TOPIC

    def tagged(self, records: DataFrame) -> DataFrame:
        return tag_alerts(records)

    def rows(self, tagged: DataFrame) -> DataFrame:
        return _alert_rows(archivable(tagged))


def _alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "station_id", F.col("s_no").alias("sequence_number"), F.col("status_timestamp").alias("timestamp"),
        "humidity", "alert_count", *ARRIVAL)


def _to_database(database: DatabaseTable, paths: StreamPaths, archive: _Archive):
    def run(records: DataFrame, batch_id: int) -> None:
        tagged = archive.tagged(records).persist()
        _write(dead_letters_of(tagged, archive.topic), paths.dead, batch_id)
        database.insert(first_write_wins(archive.rows(tagged), KEY, ARRIVAL).withColumn(archive.stamp, F.current_timestamp()))
        tagged.unpersist()
    return run


def readings_consumer(spark: SparkSession, servers: str, topic: str = READINGS_TOPIC,
                      options: dict[str, str] | None = None) -> DataFrame:
    """The readings topic from its start, at most ``READINGS_MAX_PER_TRIGGER`` records a batch."""
    return read_topic(spark, "kafka", topic, max_per_trigger=READINGS_MAX_PER_TRIGGER,
                      options={"kafka.bootstrap.servers": servers, **(options or {})})


READINGS_ARCHIVE_SCHEMA = ("station_id long, sequence_number long, battery_status string, timestamp long, "
                           "humidity int, temperature int, wind_speed int, ingested_at timestamp")
ALERTS_ARCHIVE_SCHEMA = ("station_id long, sequence_number long, timestamp long, humidity int, "
                         "alert_count long, detected_at timestamp")


def start_archive_stream(records: DataFrame, paths: StreamPaths, alerts: bool = False,
                         available_now: bool = True, interval: str | None = None,
                         buckets: int = ARCHIVE_BUCKETS, database: DatabaseTable | None = None, views: bool = False) -> StreamingQuery:
    """Archive readings (or alerts with ``alerts=True``); ``buckets`` counts when the archive is new.
    ``views`` keeps the reports over a readings archive up to date (``ArchiveViews(paths.views)``).
    With ``database`` the rows go to that table instead of the Parquet sink.

    ``available_now`` drains the input and stops (tests, backfills). Otherwise the trigger is
    ``interval`` or, by default, the original consumers' cadence: readings every
    ``READINGS_TRIGGER`` (cap the source at ``READINGS_MAX_PER_TRIGGER`` per trigger with
    ``read_topic(..., max_per_trigger=...)``), alerts as soon as anything arrives.
    """
    if views and (alerts or database):
        raise ValueError("views are kept over a readings archive")
    if not available_now and interval is None:
        interval = ALERTS_TRIGGER if alerts else READINGS_TRIGGER
    spark = records.sparkSession
    _seed(spark, current_sink(spark, paths.sink), ALERTS_ARCHIVE_SCHEMA if alerts else READINGS_ARCHIVE_SCHEMA, bucketed=True)
    archive = (ArchiveAlerts if alerts else ArchiveReadings)(paths, buckets=_layout(spark, paths, buckets), views=views)
    fn = _to_database(database, paths, archive) if database else archive
    writer = records.writeStream.foreachBatch(fn).option("checkpointLocation", paths.checkpoint)
    return trigger(writer, available_now, interval).start()


def read_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The archive/sink as a batch DataFrame (without the batch folder column), as last compacted."""
    df = spark.read.parquet(current_sink(spark, folder))
    return df.drop(*[c for c in ("batch_id", "bucket") if c in df.columns])


# ---- running count in Spark's keyed state store ----------------------------------------------------

ALERT_OUTPUT_SCHEMA = ("station_id long, s_no long, status_timestamp long, humidity int, "
                       "alert_count long, message string")


def _station_numbering(message: str):
    """The per-station state function. Built as a closure with no package imports, so it is
    pickled by value and Python workers need only pandas and numpy (not this package).

    A group holds one station's raining readings of one micro-batch (bounded by the
    per-trigger cap); the count carried between batches lives in the state store.
    """
    def number(key, batches, state):
        import numpy as np
        import pandas as pd

        pdf = pd.concat(list(batches), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(["partition", "offset"], kind="stable")
        base = state.get[0] if state.exists else 0
        counts = base + np.arange(1, len(pdf) + 1, dtype="int64")
        state.update((int(counts[-1]),))
        yield pd.DataFrame({
            "station_id": pdf["station_id"].to_numpy(), "s_no": pdf["s_no"].to_numpy(),
            "status_timestamp": pdf["status_timestamp"].to_numpy(), "humidity": pdf["humidity"].to_numpy(),
            "alert_count": counts, "message": message,
        })

    return number


def start_alert_stream_keyed_state(records: DataFrame, paths: StreamPaths, threshold: int = RAIN_THRESHOLD,
                                   available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Same alerts as ``start_alert_stream``, with the per-station count in the state store.

    Only stations present in a micro-batch touch their state, so the cost per batch follows
    the batch, whatever the number of stations. Rows pass through Python in Arrow batches,
    grouped per station; the sink is the exactly-once file sink.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    good, _ = decode_readings(records)
    readings = flatten_readings(good, keep=tuple(ARRIVAL))
    raining = readings.where(F.col("humidity") > F.lit(threshold)).select(
        "station_id", F.col("sequence_number").alias("s_no"), F.col("timestamp").alias("status_timestamp"),
        "humidity", *ARRIVAL)
    alerts = raining.groupBy("station_id").applyInPandasWithState(
        _station_numbering(RAIN_MESSAGE), ALERT_OUTPUT_SCHEMA, "alert_count long", "append", GroupStateTimeout.NoTimeout)
    writer = (alerts.writeStream.format("parquet").option("path", paths.sink)
              .option("checkpointLocation", paths.checkpoint).outputMode("append"))
    return trigger(writer, available_now, interval).start()
