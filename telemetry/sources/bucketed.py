"""Archives as bucketed tables: joins by reading without moving either side.

Readings and alerts are stored in the same number of buckets by (station_id, sequence_number),
the natural key, sorted inside. A join on the key then reads bucket by bucket with no
exchange (Spark sorts each bucket again, which finds it in order); since both columns make the bucket, a station with a third of all rows
fills all buckets alike. Reports per station aggregate inside each bucket first, so that only
one row per station and bucket is exchanged.

The number of buckets is fixed when a table is created; tables that are to be joined must
share it. ``buckets_for`` gives one for a size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry.schemas import KEY

BUCKETS = 64
BUCKET_BYTES = 256 << 20


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Power of two that keeps buckets at ``bucket_bytes`` at most."""
    need = max(1, -(-table_bytes // bucket_bytes))
    return 1 << (need - 1).bit_length()


def save_bucketed(rows: DataFrame, name: str, location: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``rows`` (an archive, each key once) as the bucketed table ``name`` at ``location`` and return the table.

    The rows are dealt to the buckets first, so a bucket is one file.
    """
    spark = rows.sparkSession
    rows.repartition(buckets, *KEY).write.format("parquet").mode("overwrite").option("path", location) \
        .bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(name)
    return spark.table(name)
