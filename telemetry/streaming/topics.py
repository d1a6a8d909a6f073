"""Topic sources and sinks chosen by format name.

``kafka`` uses Spark's Kafka connector (``subscribe``, ``startingOffsets``,
``maxOffsetsPerTrigger``); the connector jar is not part of this repository. ``parquet``
(or ``json``) reads a folder of Kafka-shaped records (key, value, partition, offset,
timestamp, headers), which is how the tests and the registered queries drive the streams.
Headers are ``array<struct<key, value>>``, as the connector has them; NULL where a record has none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.schemas import TOPIC_RECORD

_RECORD_COLS = ["CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "partition", "offset",
                "timestamp", "headers"]


def read_topic(spark: SparkSession, fmt: str, topic: str, max_per_trigger: int | None = None,
               options: dict[str, str] | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of topic records, earliest first.

    For ``kafka`` ``topic`` is the topic name and ``options`` carry
    ``kafka.bootstrap.servers`` and friends; otherwise ``topic`` is a folder.
    ``max_per_trigger`` caps records (kafka) or files (folders) per micro-batch;
    ``max_bytes_per_trigger`` caps bytes read per micro-batch from a folder (whole files, one
    at least); only one of the two may be given.
    """
    if max_per_trigger and max_bytes_per_trigger:
        raise ValueError("give max_per_trigger or max_bytes_per_trigger, not both")
    options = dict(options or {})
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", topic).option("includeHeaders", "true")
                  .option("startingOffsets", options.pop("startingOffsets", "earliest")))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.options(**options).load().selectExpr(*_RECORD_COLS)
    reader = spark.readStream.format(fmt).schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    elif max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.options(**options).load(topic)


def write_topic_batch(records: DataFrame, fmt: str, topic: str,
                      options: dict[str, str] | None = None) -> None:
    """Batch write of records (the producer): key = station id text, value = JSON, and headers if there are any."""
    if fmt == "kafka":
        opts = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.retries": "3",
                "kafka.linger.ms": "20", "kafka.compression.type": "gzip", **(options or {})}
        records.select("key", "value", *[c for c in records.columns if c == "headers"]).write.format("kafka").option("topic", topic).options(**opts).save()
        return
    records.write.mode("append").format(fmt).options(**(options or {})).save(topic)


@dataclass(frozen=True)
class TopicSink:
    """Where a stream sends its records: a topic (``kafka``) or a folder of a file format.

    Delivery is at least once: a replayed micro-batch sends its records to a topic again; in
    a folder it replaces its own subfolder.
    """
    fmt: str
    topic: str
    options: dict[str, str] = field(default_factory=dict)

    def write(self, records: DataFrame, batch_id: int) -> None:
        if self.fmt == "kafka":
            write_topic_batch(records, self.fmt, self.topic, self.options)
        else:
            records.write.mode("overwrite").format(self.fmt).options(**self.options).save(f"{self.topic}/batch-{batch_id}")


def write_topic_in_slices(records: DataFrame, folder: str, slices: int, order: str = "offset") -> None:
    """Append records to a file topic in ``slices`` time-ordered writes, oldest first.

    The slice of a record is its position in the ``order`` range (min/max is one small
    aggregate). Each slice is written in parallel with one file per topic partition, so a
    station's records of one slice sit in one file and files are read in write order: a
    file stream sees every station's records in arrival order across micro-batches, as
    with a Kafka partition. Read it with ``max_per_trigger = TOPIC_PARTITIONS`` for about
    one slice per micro-batch.
    """
    records = records.persist()
    bounds = records.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        records.unpersist()
        return
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    width = (hi - lo) // slices + 1
    pos = F.floor((F.col(order) - F.lit(lo)) / F.lit(width)).cast("int")
    sliced = records.withColumn("_slice", F.least(pos, F.lit(slices - 1)))
    topic_cols = [c for c in records.columns if c in TOPIC_RECORD.fieldNames()]
    for k in range(slices):
        part = sliced.where(F.col("_slice") == k).select(*topic_cols)
        part.repartition("partition").write.mode("append").format("parquet").save(folder)
    records.unpersist()
