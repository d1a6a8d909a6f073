"""Sets of sequence numbers per station, held as intervals.

A set is a table (station_id, block, lo, hi) of disjoint intervals. Intervals are cut at
multiples of ``BLOCK``, so all work is per (station, block): a hot station spreads over many
tasks and no window holds more than ``BLOCK`` rows of a set. Its size follows the gaps in the
numbers, and one row a block at least, not the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sequence numbers of a station whose intervals lie in one block.
BLOCK = 1 << 12
INTERVALS = "station_id long, block long, lo long, hi long"


def block_of(sequence: str = "sequence_number") -> Column:
    return F.floor(F.col(sequence) / F.lit(BLOCK)).cast("long")


def as_intervals(keys: DataFrame) -> DataFrame:
    """Rows (station_id, sequence_number) as intervals of one number each; NULL ones are left out."""
    known = keys.where("station_id is not null and sequence_number is not null")
    points = known.select("station_id", block_of().alias("block"), F.col("sequence_number").cast("long").alias("lo"))
    return points.withColumn("hi", F.col("lo"))


def from_keys(keys: DataFrame) -> DataFrame:
    """Intervals of rows (station_id, sequence_number); repeated keys do no harm."""
    return merged(as_intervals(keys))


def merged(intervals: DataFrame) -> DataFrame:
    """Any intervals as disjoint ones that do not touch within a block."""
    block = Window.partitionBy("station_id", "block")
    before = F.max("hi").over(block.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    opens = intervals.withColumn("_opens", (before.isNull() | (F.col("lo") > before + 1)).cast("long"))
    run = F.sum("_opens").over(block.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0))
    return opens.withColumn("_run", run).groupBy("station_id", "block", "_run") \
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("station_id", "block", "lo", "hi")


def contained(keys: DataFrame, intervals: DataFrame) -> DataFrame:
    """The rows (station_id, sequence_number) of ``keys`` that some interval holds.

    Keys and interval starts are sorted together per (station, block); a key is held if the
    farthest end so far reaches it. No key is paired with an interval.
    """
    asked = keys.select("station_id", block_of().alias("block"), F.col("sequence_number").alias("lo"),
                        F.lit(None).cast("long").alias("hi"), F.lit(1).alias("_asked"))
    both = asked.unionByName(intervals.select("station_id", "block", "lo", "hi", F.lit(0).alias("_asked")))
    reach = F.max("hi").over(Window.partitionBy("station_id", "block").orderBy("lo", "_asked")
                             .rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_reach", reach).where("_asked = 1 and _reach >= lo") \
        .select("station_id", F.col("lo").alias("sequence_number"))
