"""Sequence gaps: which sequence numbers between 1 and a station's maximum never arrived.

The SQL form (``generate_series(1, max)`` anti-joined to the readings) costs the maximum
sequence number per station. Here consecutive stored numbers give gap ranges
``[previous + 1, current - 1]``, so the cost follows the readings and what is missing.
Gaps after the last stored reading are invisible, as in the SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.operators.keyed import keyed_lag, sequence_bucket


def gap_ranges(readings: DataFrame, station: str = "station_id", seq: str = "sequence_number",
               bucket: Column | None = None) -> DataFrame:
    """(station, gap_start, gap_end, missing_count) for every non-empty gap."""
    bucket = sequence_bucket(seq) if bucket is None else bucket
    with_prev = keyed_lag(readings.select(station, seq), [station], seq, bucket, out="_prev")
    start = (F.greatest(F.coalesce(F.col("_prev"), F.lit(0)), F.lit(0)) + 1).cast("long")
    return (with_prev
            .select(station, start.alias("gap_start"), (F.col(seq) - 1).cast("long").alias("gap_end"))
            .where(F.col("gap_start") <= F.col("gap_end"))
            .withColumn("missing_count", F.col("gap_end") - F.col("gap_start") + 1))


def expand_gaps(gaps: DataFrame, station: str = "station_id", out: str = "missing_sequence",
                chunk: int = 1 << 16) -> DataFrame:
    """One row per missing number. Long gaps are cut into chunks that are spread over tasks
    before they are expanded, so one enormous gap is not generated by a single task."""
    lo = F.explode(F.sequence("gap_start", "gap_end", F.lit(chunk).cast("long"))).alias("_lo")
    chunks = (gaps.select(station, "gap_end", lo)
              .repartition(station, "_lo"))
    hi = F.least(F.col("_lo") + F.lit(chunk - 1), F.col("gap_end"))
    return chunks.select(station, F.explode(F.sequence(F.col("_lo"), hi)).alias(out))


def first_missing(readings: DataFrame, station_id: int, limit: int = 50,
                  station: str = "station_id", seq: str = "sequence_number") -> DataFrame:
    """The first ``limit`` missing numbers of one station, ascending (a top-k report)."""
    one = readings.where(F.col(station) == F.lit(station_id))
    gaps = gap_ranges(one, station, seq)
    # Every gap holds at least one missing number, so the first `limit` missing numbers lie in
    # the first `limit` gaps, and within the first `limit` numbers of each: a distributed
    # top-k on the gaps, then at most limit * limit rows are expanded.
    first_gaps = gaps.orderBy("gap_start").limit(limit)
    hi = F.least(F.col("gap_end"), F.col("gap_start") + F.lit(limit - 1))
    return (first_gaps.select(F.explode(F.sequence("gap_start", hi)).alias("missing_sequence"))
            .orderBy("missing_sequence").limit(limit))
