"""Per-key running numbering and lag that stay bounded when one key is hot.

``row_number() OVER (PARTITION BY station ORDER BY ...)`` puts every row of a station in
one task; a station holding a third of the data would run in one task. Here the rows of
a key are split into sub-ranges by a ``bucket`` expression that is non-decreasing in the
sort order (for example ``sequence_number div 2^20`` or the day of a timestamp):

1. the window runs per ``(key, bucket)``, so no window group exceeds one bucket;
2. a partial aggregate counts rows (or takes the last value) per ``(key, bucket)``;
3. a window over that small table carries the count (last value) of earlier buckets;
4. a left join on ``(key, bucket)`` adds the carry. The big side is already hash-partitioned
   on ``(key, bucket)`` by step 1, so only the small table moves.

Key and bucket travel as one struct: a struct equals itself even with NULL fields, so rows
with a NULL key or a NULL order value keep their number, as in the plain window; and where
the number is not read, Spark drops the left join.

The bucket is computed from data, never from physical partition ids, so recomputation
after a lost executor gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_kbucket"


def _cols(xs) -> list:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def keyed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence, bucket: Column | None,
                     out: str = "row_number") -> DataFrame:
    """Add ``out`` = ``row_number() OVER (PARTITION BY keys ORDER BY order)`` as BIGINT.

    ``order`` must be a total order within a key for a deterministic answer. With
    ``bucket=None`` the plain window is used (for inputs known to be small per key).
    """
    keys, order = _cols(keys), _cols(order)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("long"))

    b = df.withColumn(_B, F.struct(F.struct(*keys).alias("key"), bucket.alias("bucket")))
    local = b.withColumn("_klocal", F.row_number().over(Window.partitionBy(_B).orderBy(*order)))
    # Counted from the input with map-side partial aggregation: a cheap second branch.
    counts = b.groupBy(_B).agg(F.count(F.lit(1)).alias("_kn"))
    before = Window.partitionBy(f"{_B}.key").orderBy(f"{_B}.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_B, F.coalesce(F.sum("_kn").over(before), F.lit(0)).alias("_koff"))
    return (local.join(offsets, _B, "left")
            .withColumn(out, (F.col("_klocal") + F.col("_koff")).cast("long"))
            .drop(_B, "_klocal", "_koff"))


def keyed_lag(df: DataFrame, keys: Sequence[str], order_col: str, bucket: Column | None,
              out: str = "previous") -> DataFrame:
    """Add ``out`` = ``lag(order_col) OVER (PARTITION BY keys ORDER BY order_col)``.

    ``order_col`` must be non-null and unique within a key (a sequence number).
    """
    keys = _cols(keys)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(order_col)
        return df.withColumn(out, F.lag(order_col).over(w))

    b = df.withColumn(_B, F.struct(F.struct(*keys).alias("key"), bucket.alias("bucket")))
    local = b.withColumn("_klag", F.lag(order_col).over(Window.partitionBy(_B).orderBy(order_col)))
    last = b.groupBy(_B).agg(F.max(order_col).alias("_klast"))
    before = Window.partitionBy(f"{_B}.key").orderBy(f"{_B}.bucket")
    carried = last.select(_B, F.lag("_klast").over(before).alias("_kprev"))
    return (local.join(carried, _B, "left")
            .withColumn(out, F.coalesce(F.col("_klag"), F.col("_kprev")))
            .drop(_B, "_klag", "_kprev"))


def sequence_bucket(col: str = "sequence_number", width: int = 1 << 20) -> Column:
    """Bucket of a per-key sequence number: at most ``width`` rows per (key, bucket)."""
    return F.floor(F.col(col) / F.lit(width)).cast("long")


def time_bucket(ts_col: str, seconds: int = 86400) -> Column:
    """Bucket of a TIMESTAMP_NTZ column by whole ``seconds`` since the epoch."""
    return F.floor(F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")
                   / F.lit(seconds)).cast("long")
