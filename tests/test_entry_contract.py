"""The driver contract: callables take (spark, sf_dir), return DataFrames with stable schemas."""

import inspect

from pyspark.sql import DataFrame

import __spark_entry__ as E
from telemetry.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def test_entry_schema_is_stable(spark):
    assert E.entry(spark).schema == E.entry(spark).schema


def test_query_signatures_and_schemas(spark):
    qs = E.queries()
    assert len(qs) >= 44
    assert set(REGISTRY) <= set(qs)
    for name in REGISTRY:  # the optional operators have contract tests of their own
        fn = qs[name]
        assert len(inspect.signature(fn).parameters) == 2, name
        if name.startswith("stream_"):
            continue      # these run their stream when called; covered by the oracle tests
        a, b = fn(spark, SF), fn(spark, SF)
        assert isinstance(a, DataFrame), name
        assert a.schema == b.schema, name


def test_oracle_keys_match_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert all(isinstance(v, str) and v.strip() for v in E.oracle_sql().values())
