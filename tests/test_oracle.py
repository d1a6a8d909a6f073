"""Every registered query against its DuckDB oracle, like the driver's check (sf0.001)."""

import collections
import datetime
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from telemetry.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _bag(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rs)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(REGISTRY) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = df.collect()
    cur = duck.execute(oracle_sql()[name])
    want = cur.fetchall()
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, got) == _bag(dcols, want)


@pytest.mark.parametrize("name", ["readings_ev", "readings_per_minute", "rain_crosscheck", "readings_li"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = queries()[name](spark, SF)
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    cur = duck.execute(oracle_sql()[name])
    assert _bag(df.columns, got) == _bag([c[0] for c in cur.description], cur.fetchall())
