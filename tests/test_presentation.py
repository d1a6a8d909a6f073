"""Presentation order of the reports, and what a one-station report reads."""

import re

import pytest

from telemetry.plans import analysis as A
from telemetry.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["drop_rate", "battery_pivot", "weather_stats", "station_counts", "latest_status", "rain_validation"])
def test_station_reports_sort_ascending(spark, golden, name):
    """O3: one row per station, ascending, once the caller orders them; nothing is lost by it."""
    readings, alerts = golden
    report = A.rain_validation(readings, alerts) if name == "rain_validation" else getattr(A, name)(readings)
    stations = [r["station_id"] for r in report.orderBy("station_id").collect()]
    assert stations == [1, 2, 3, 4]


def test_missing_numbers_sort_ascending(spark, golden):
    rows = [tuple(r) for r in A.missing_all(golden[0]).orderBy("station_id", "missing_sequence").collect()]
    assert rows == [(1, 3), (2, 1), (2, 4), (2, 5)]


def test_one_station_is_filtered_at_the_scan(spark):
    """the report of one station reads that station's events only."""
    plan = REGISTRY["missing_for_station"].fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert scans and all("EqualTo(user_id,0)" in s for s in scans)
