"""Newest row per key (``DISTINCT ON (station_id) ... ORDER BY station_id, sequence_number DESC``).

``row_number() = 1`` by descending sequence number; Spark adds a partial
``WindowGroupLimit`` before the shuffle, so a hot station ships one row per task instead of
all of its readings. Ties are impossible under the unique key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("station_id",),
                   order: str = "sequence_number") -> DataFrame:
    keys = list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_newest", rank).where(F.col("_newest") == 1).drop("_newest")
