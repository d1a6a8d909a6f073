"""Keyed operators against brute force, with one hot key and tiny buckets."""

import random

from sorted_rows import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetry.functions.exprs import pct_sql, round_ratio_sql
from telemetry.operators.dedupe import first_write_wins, insert_if_absent, key_conflicts
from telemetry.operators.gaps import expand_gaps, gap_ranges
from telemetry.operators.keyed import keyed_lag, keyed_row_number, sequence_bucket
from telemetry.operators.latest import latest_per_key


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data, seqs = [], {}
    for i in range(n):
        k = 0 if rnd.random() < 0.4 else rnd.randint(1, 40)   # key 0 holds ~40% of rows
        seqs[k] = seqs.get(k, 0) + rnd.randint(1, 3)            # gaps of 0..2
        data.append((k, seqs[k], rnd.random()))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k long, seq long, v double").repartition(5)


def test_keyed_row_number_matches_window(spark):
    df = _skewed(spark)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")).cast("long"))
    got = keyed_row_number(df, ["k"], ["seq"], sequence_bucket("seq", 16), out="rn")
    assert rows(got, "k", "seq", "rn") == rows(want, "k", "seq", "rn")


def test_keyed_lag_matches_window(spark):
    df = _skewed(spark)
    want = df.withColumn("p", F.lag("seq").over(Window.partitionBy("k").orderBy("seq")))
    got = keyed_lag(df, ["k"], "seq", sequence_bucket("seq", 8), out="p")
    assert rows(got, "k", "seq", "p") == rows(want, "k", "seq", "p")


def test_gaps_brute_force(spark):
    df = _skewed(spark).withColumnRenamed("k", "station_id").withColumnRenamed("seq", "sequence_number")
    present = {(r[0], r[1]) for r in df.select("station_id", "sequence_number").collect()}
    top = {}
    for s, q in present:
        top[s] = max(top.get(s, 0), q)
    want = sorted((s, q) for s, m in top.items() for q in range(1, m + 1) if (s, q) not in present)
    gaps = gap_ranges(df, bucket=sequence_bucket("sequence_number", 32))
    assert rows(expand_gaps(gaps, chunk=2)) == want
    # received + missing = highest sequence number, per station
    assert sum(top.values()) == len(present) + len(want)
    # first 50 missing numbers of the hot station (it has far more than 50 gaps)
    from telemetry.operators.gaps import first_missing
    hot = [q for s, q in want if s == 0]
    assert len(hot) > 100
    assert [r[0] for r in first_missing(df, 0, 50).collect()] == hot[:50]


def test_first_write_wins(spark):
    batch = spark.createDataFrame(
        [(1, 1, "a", 3), (1, 1, "b", 1), (1, 2, "c", 2), (2, 1, "d", 5), (2, 1, "d", 4)],
        "station_id long, sequence_number long, payload string, arrival int")
    first = first_write_wins(batch, ["station_id", "sequence_number"], ["arrival"])
    assert rows(first, "station_id", "sequence_number", "payload") == [(1, 1, "b"), (1, 2, "c"), (2, 1, "d")]
    later = spark.createDataFrame([(1, 1, "z", 9), (3, 1, "y", 9)], batch.schema)
    new = insert_if_absent(later, first, ["station_id", "sequence_number"], ["arrival"])
    assert rows(new, "station_id", "payload") == [(3, "y")]
    # archiving the same rows again changes nothing
    assert insert_if_absent(batch, first, ["station_id", "sequence_number"], ["arrival"]).count() == 0
    assert "arrival" not in first.columns
    conflicts = key_conflicts(batch, ["station_id", "sequence_number"], ["payload"])
    assert rows(conflicts) == [(1, 1, 2)]


def test_latest_per_key(spark):
    df = _skewed(spark)
    got = rows(latest_per_key(df, ["k"], "seq"), "k", "seq")
    want = rows(df.groupBy("k").agg(F.max("seq").alias("seq")), "k", "seq")
    assert got == want


def test_exact_rounding_both_dialects(spark):
    import decimal

    import duckdb
    rnd = random.Random(3)
    pairs = [(rnd.randint(-10**6, 10**6), rnd.randint(1, 2000)) for _ in range(400)]
    pairs += [(1, 8), (5, 200), (1, 2000), (241, 4), (1207, 20), (-1207, 20), (0, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [(r[0], r[1], r[2], r[3]) for r in df.select(
        "n", "d", F.expr(round_ratio_sql("n", "d", 1)), F.expr(pct_sql("n", "d"))).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(n BIGINT, d BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    duck = dict(((n, d), (a, b)) for n, d, a, b in con.execute(
        f"SELECT n, d, {round_ratio_sql('n', 'd', 1, 'duckdb')}, {pct_sql('n', 'd', 2, 'duckdb')} FROM t").fetchall())
    q = decimal.Decimal
    for n, d, r1, p2 in got:
        exact1 = (q(n) / q(d)).quantize(q("0.1"), rounding=decimal.ROUND_HALF_UP)
        exact2 = (q(100 * n) / q(d)).quantize(q("0.01"), rounding=decimal.ROUND_HALF_UP)
        assert r1 == float(exact1) and p2 == float(exact2), (n, d)
        assert duck[(n, d)] == (r1, p2)
    assert spark.createDataFrame([(1, 0)], "n long, d long").select(F.expr(pct_sql("n", "d"))).first()[0] is None


def test_keyed_row_number_struct_bucket(spark):
    """A hot key whose rows share the first order column, split by the second."""
    df = _skewed(spark).withColumn("day", (F.col("seq") % 3).cast("long"))
    order = ["day", "v", "seq"]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    bucket = F.struct(F.col("day"), F.floor(F.col("v") * 8).alias("vb"))
    got = keyed_row_number(df, ["k"], order, bucket, out="rn")
    assert rows(got, "k", "seq", "rn") == rows(want, "k", "seq", "rn")
