"""Folders of streaming jobs: written whole per batch, named one by one; ``matches`` alone lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, fs = hadoop(spark, folder)
    return fs.exists(path)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether some folder fits the pattern."""
    path, fs = hadoop(spark, pattern)
    return len(fs.globStatus(path) or []) > 0


def remove(spark: SparkSession, folder: str) -> None:
    path, fs = hadoop(spark, folder)
    fs.delete(path, True)


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Overwrite the batch's folder (a replayed batch replaces its own output only)."""
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def read_batch(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/batch_id={batch_id}")
