"""Small DataFrame helpers of the operators: tables, scratch tables, bounded lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry.session import scratch_path
from telemetry.sources.tables import table

#: Rows and bytes of a lookup side that may be broadcast; above either the join is a shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

__all__ = ["BROADCAST_BYTES", "BROADCAST_ROWS", "attach", "fits", "materialise", "semi", "small", "table", "fresh"]


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a new table below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def _value_bytes(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
        size = 8 * F.size(column)
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        size = 8 * F.octet_length(F.to_json(F.struct(column)))  # no value takes more than eight times its text
    else:
        return F.lit(8)
    return 8 + F.coalesce(size, F.lit(0))


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether one aggregate over ``df`` shows at most ``rows`` rows of at most ``size`` bytes together."""
    each = sum((_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(each.cast("long")).alias("size")).first()
    return found["rows"] <= rows and (found["size"] or 0) <= size


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, hinted for broadcast only if it is counted and measured small."""
    return F.broadcast(df) if fits(df, rows) else df


def attach(df: DataFrame, stats: DataFrame, on: str, salts: int = 32,
           rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join a table with one row per key to rows whose keys may be very uneven.

    A ``stats`` side of at most ``rows`` rows and ``BROADCAST_BYTES`` is broadcast. A larger one is joined by
    (key, salt): the rows of a hot key are dealt over ``salts`` tasks and ``stats`` is
    repeated that often. Null keys match a null key of ``stats``.
    """
    key = fresh("key")
    others = [c for c in stats.columns if c != on]
    right = stats.select(F.col(on).alias(key), *others)
    if fits(stats, rows):
        return df.join(F.broadcast(right), df[on].eqNullSafe(right[key]), "left").drop(key)
    salt = fresh("salt")
    left = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    right = right.withColumn(salt + "r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, left[on].eqNullSafe(right[key]) & (left[salt] == right[salt + "r"]), "left") \
        .drop(key, salt, salt + "r")


def semi(df: DataFrame, ids: DataFrame, column: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``ids`` (nulls match nulls); broadcast if measured small."""
    key = fresh("id")
    right = small(ids.select(F.col(column).alias(key)).distinct(), rows)
    return df.join(right, df[column].eqNullSafe(right[key]), "left_semi")


def unit_hash(*parts: Column, seed: int) -> Column:
    """Uniform number in [0, 1) from md5 of the seed and the parts (52 bits; nulls count as empty)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
