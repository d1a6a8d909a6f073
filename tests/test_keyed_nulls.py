"""Keyed numbering and lag keep rows with NULL keys or NULL order values, as the plain window does."""

import random

from pyspark.sql import functions as F

from telemetry.functions.codec import coerce_number
from telemetry.operators.keyed import keyed_lag, keyed_row_number, sequence_bucket


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_and_orders(spark):
    rng = random.Random(1)
    data = [(rng.choice([1, 2, None]), o, p) for p in (0, 1) for o in [*rng.sample(range(60), 30), None]]
    df = spark.createDataFrame(data, "station_id long, offset long, partition int")
    order = ["partition", "offset"]
    bucket = F.struct("partition", sequence_bucket("offset", 8).alias("block"))
    want = _rows(keyed_row_number(df, "station_id", order, None))
    assert _rows(keyed_row_number(df, "station_id", order, bucket)) == want and len(want) == len(data)
    one = df.filter("partition = 0").select("station_id", "offset")
    assert _rows(keyed_lag(one, "station_id", "offset", sequence_bucket("offset", 8))) == _rows(keyed_lag(one, "station_id", "offset", None))


def test_fractions_truncate(spark):
    texts = ["70.9999999", "-70.9999999", "70", " 71.5 ", "1e2", ".5", "x", "7.9.1", None, "99999999999999999999.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(coerce_number(F.col("t"), "int")).collect()]
    assert got == [70, -70, 70, 71, 100, 0, None, None, None, None]
