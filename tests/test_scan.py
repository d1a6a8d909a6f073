"""Prefix scan over blocks against the plain window: hot keys, NULLs, clustered positions, several levels."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetry.operators import scan


def _data(spark, seed, clustered=False):
    r = random.Random(seed)
    rows, used = [], set()
    for i in range(4000):
        k = 0 if r.random() < 0.4 else r.choice([None, *range(1, 30)])
        at = r.choice([None, *range(400)]) if r.random() < 0.05 else (r.randrange(5) if clustered and r.random() < 0.9 else r.randrange(10 ** 6))
        rows.append((k, at, i))
    return spark.createDataFrame(rows, "k long, at long, id long").repartition(5)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("clustered,rounds,fan", [(False, 1, 1024), (True, 1, 2), (True, 2, 3)])
def test_row_number_as_the_plain_window(spark, monkeypatch, clustered, rounds, fan):
    monkeypatch.setattr(scan, "FAN", fan)
    df = _data(spark, 3, clustered)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("at", "id")).cast("long"))
    got = scan.blocked_row_number(df, ["k"], ["at", "id"], F.col("at"), out="n", block_rows=100, rounds=rounds)
    assert _rows(got.select("k", "at", "id", "n")) == _rows(want)
    assert got.columns == want.columns


@pytest.mark.parametrize("fan", [1024, 2])
def test_lag_as_the_plain_window(spark, monkeypatch, fan):
    monkeypatch.setattr(scan, "FAN", fan)
    r = random.Random(5)
    rows = [(k, q) for k in (0, 1, None) for q in r.sample(range(-500, 3000), 900 if k == 0 else 50)] + [(0, None)]
    df = spark.createDataFrame(rows, "k long, q long").repartition(4)
    want = df.withColumn("p", F.lag("q").over(Window.partitionBy("k").orderBy("q")))
    assert _rows(scan.blocked_lag(df, ["k"], "q", out="p", block_rows=64)) == _rows(want)


def test_hot_key_is_split_and_the_carry_is_small(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 0, id % 50) as k", "id as at")
    blocked = scan.with_blocks(df, ["k"], F.col("at"), block_rows=500)
    sizes = [r["count"] for r in blocked.groupBy("_sblock").count().collect()]
    assert max(sizes) <= 500
    carry = scan.carried(blocked, F.count(F.lit(1)), F.sum)
    assert 0 < carry.count() <= 200  # at most 1 % of the rows
    one = scan.carried(scan.with_blocks(df, ["k"], F.col("at")), F.count(F.lit(1)), F.sum)
    assert one.count() == 0  # no key is large: nothing is carried


def test_single_position_and_empty(spark):
    df = spark.range(300).selectExpr("1L as k", "7L as at", "id")
    got = scan.blocked_row_number(df, ["k"], ["at", "id"], F.col("at"), block_rows=10, rounds=2)
    assert sorted(r["row_number"] for r in got.collect()) == list(range(1, 301))
    assert scan.blocked_row_number(df.limit(0), ["k"], ["at", "id"], F.col("at"), block_rows=10).count() == 0
    nulls = spark.createDataFrame([(None, None, i) for i in range(30)], "k long, at long, id long")
    got = scan.blocked_row_number(nulls, ["k"], ["id"], F.col("at"), block_rows=10)
    assert sorted(r["row_number"] for r in got.collect()) == list(range(1, 31))
