"""Interval index of the keys of an archive, carried across micro-batches (``merged``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.operators.intervals import INTERVALS, as_intervals, contained, merged
from telemetry.streaming.merged import MergedTable


class ArchivedKeys(MergedTable):
    """The keys archived by the batches so far, as intervals of sequence numbers."""

    def __init__(self, folder: str):
        super().__init__(folder, INTERVALS, merged, ("station_id", "lo"))

    def create(self, spark: SparkSession, rows: DataFrame | None = None, batch_id: int = 0) -> None:
        """Index the keys of ``rows``, what the archive holds before ``batch_id``; does nothing if the index is there."""
        super().create(spark, None if rows is None else as_intervals(rows), batch_id)

    def write(self, spark: SparkSession, batch_id: int, rows: DataFrame) -> None:
        """Add the keys that this batch archived."""
        super().write(spark, batch_id, as_intervals(rows))

    def archived(self, spark: SparkSession, batch_id: int, keys: DataFrame) -> DataFrame | None:
        """The keys of ``keys`` that earlier batches archived; None if ``keys`` is empty.

        One row of bounds passes the driver; it prunes the files of the index.
        """
        bounds = keys.agg(*[f(c).alias(f"{name}_{c}") for name, f in (("lo", F.min), ("hi", F.max))
                            for c in ("station_id", "sequence_number")]).first()
        if bounds["lo_station_id"] is None:
            return None
        near = self.before(spark, batch_id).where(
            F.col("station_id").between(bounds["lo_station_id"], bounds["hi_station_id"])
            & (F.col("hi") >= bounds["lo_sequence_number"]) & (F.col("lo") <= bounds["hi_sequence_number"]))
        return contained(keys, near)
