"""Driver tables (one Parquet file each below an ``sf`` folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; naming ``columns`` keeps the scan pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
