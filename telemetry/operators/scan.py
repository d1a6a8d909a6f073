"""Running numbers and lags per key as a prefix scan over blocks of rows.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` puts every row of a key in one task.
Here only keys of many rows are split, and into as few blocks as their rows need:

1. one aggregate counts the rows of every key and the range of a numeric ``position`` that
   does not decrease along the order (event time, sequence number, offset);
2. keys above ``block_rows`` rows are cut into blocks of equal position range, about half as
   many rows each; ``rounds`` repeats that inside blocks that are still larger, for
   positions that cluster. All other keys are one block;
3. the window runs per (key, block);
4. one total per block of the split keys (rows, or last value) is scanned in two levels: inside
   groups of ``FAN`` blocks, then over the groups. The totals are joined back by block.

Bounds. A key is split only above 1 / ``MAX_KEYS`` of all rows, too, so fewer than that many
keys and a few times as many blocks exist, whatever the input: both lookups are broadcast, and
the rows are shuffled once, by (key, block). The totals are at most a few rows for every
``block_rows`` rows of the input. Rows of one key at one position stay together.

Key and block travel as structs, which equal themselves even with NULL fields; NULL positions
come first, as in an ascending window. Blocks follow from the data alone, so a recomputed task
gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 18
MAX_KEYS = 100_000
FAN = 1024

_BLOCK, _SPLIT, _KEY, _CELL, _POS = "_sblock", "_ssplit", "_skey", "_scell", "_spos"


def _split(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` with ``_scell`` extended by one number: the place of the row in its block, 0 for blocks that stay."""
    sizes = rows.groupBy(_KEY, _CELL).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_lo"), F.max(_POS).alias("_hi"))
    limit = F.greatest(F.lit(float(block_rows)), rows.agg(F.count(F.lit(1)).cast("double") / MAX_KEYS).scalar())
    large = sizes.where(F.col("_n") > limit).select(
        F.struct(_KEY, _CELL).alias("_large"), "_lo",
        ((F.col("_hi") - F.col("_lo") + 1) / F.ceil(2 * F.col("_n") / limit)).cast("double").alias("_width"))
    met = rows.join(F.broadcast(large), F.struct(_KEY, _CELL) == F.col("_large"), "left")
    place = F.coalesce(F.floor((F.col(_POS) - F.col("_lo")) / F.col("_width")), F.lit(-1))
    number = F.when(F.col("_large").isNull(), F.lit(0)).otherwise(place).cast("long")
    split = F.coalesce(_SPLIT, "_large") if _SPLIT in rows.columns else F.col("_large")
    return met.withColumns({_CELL: F.concat(_CELL, F.array(number)), _SPLIT: split}).drop("_large", "_lo", "_width")


def with_blocks(df: DataFrame, keys: Sequence[str], position: Column, block_rows: int = BLOCK_ROWS, rounds: int = 1) -> DataFrame:
    """``df`` with ``_sblock``, a struct of the key and the block (numbers that ascend with the position), and
    ``_ssplit``, which is set where the key has several."""
    rows = df.withColumns({_KEY: F.struct(*keys), _POS: position, _CELL: F.array().cast("array<bigint>")})
    for _ in range(rounds):
        rows = _split(rows, block_rows)
    return rows.withColumn(_BLOCK, F.struct(F.col(_KEY).alias("key"), F.col(_CELL).alias("cell"))).drop(_KEY, _POS, _CELL)


def carried(blocked: DataFrame, total: Column, combine) -> DataFrame:
    """(block, carry): ``combine`` of the ``total`` of all earlier blocks of the key, for keys of several blocks.

    The scan goes in two levels, so no window holds more than ``FAN`` blocks and one row for
    every ``FAN`` of them. Where no key is split, the input is not read for it.
    """
    key, cell = f"{_BLOCK}.key", f"{_BLOCK}.cell"
    totals = blocked.where(F.col(_SPLIT).isNotNull()).groupBy(_BLOCK).agg(total.alias("_total"))
    ranked = totals.withColumn("_group", F.transform(cell, lambda c, i: F.when(i < F.size(cell) - 1, c).otherwise(F.floor(c / FAN))))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = ranked.withColumn("_inside", combine("_total").over(earlier.partitionBy(key, "_group").orderBy(cell)))
    groups = ranked.groupBy(F.col(key).alias("_gkey"), F.col("_group").alias("_ggroup")).agg(combine("_total").alias("_all")) \
        .withColumn("_before", combine("_all").over(earlier.partitionBy("_gkey").orderBy("_ggroup")))
    return inside.join(F.broadcast(groups), (F.col(key) == F.col("_gkey")) & (F.col("_group") == F.col("_ggroup"))) \
        .select(F.col(_BLOCK).alias("_cblock"), "_before", "_inside")


def blocked_row_number(df: DataFrame, keys: Sequence[str], order: Sequence, position: Column, out: str = "row_number",
                       block_rows: int = BLOCK_ROWS, rounds: int = 1) -> DataFrame:
    """Add ``out`` = ``row_number() OVER (PARTITION BY keys ORDER BY order)`` as BIGINT.

    ``order`` must be total within a key for a repeatable answer; ``position`` is a number that
    does not decrease along it.
    """
    blocked = with_blocks(df, keys, position, block_rows, rounds)
    local = blocked.withColumn("_local", F.row_number().over(Window.partitionBy(_BLOCK).orderBy(*order)))
    carry = carried(blocked, F.count(F.lit(1)), F.sum)
    number = F.col("_local") + F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return local.join(F.broadcast(carry), F.col(_BLOCK) == F.col("_cblock"), "left") \
        .withColumn(out, number.cast("long")).drop(_BLOCK, _SPLIT, "_local", "_cblock", "_before", "_inside")


def blocked_lag(df: DataFrame, keys: Sequence[str], order_col: str, out: str = "previous",
                block_rows: int = BLOCK_ROWS, rounds: int = 1) -> DataFrame:
    """Add ``out`` = ``lag(order_col) OVER (PARTITION BY keys ORDER BY order_col)`` for a number unique within a key."""
    blocked = with_blocks(df, keys, F.col(order_col), block_rows, rounds)
    local = blocked.withColumn("_local", F.lag(order_col).over(Window.partitionBy(_BLOCK).orderBy(order_col)))
    carry = carried(blocked, F.max(order_col), F.max)
    return local.join(F.broadcast(carry), F.col(_BLOCK) == F.col("_cblock"), "left") \
        .withColumn(out, F.coalesce("_local", F.greatest("_before", "_inside"))).drop(_BLOCK, _SPLIT, "_local", "_cblock", "_before", "_inside")
