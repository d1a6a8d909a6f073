"""Records are coded and decoded by code that the JVM compiles; texts of numbers that take the short way or the long one."""

import re

import pytest

from telemetry.functions import codec as C
from telemetry.sources.wire import records_from_readings

HUGE = 8000  # bytes of a method above which the JVM interprets it


def _readings(spark, n):
    return spark.range(n).selectExpr(
        "id % 7 + 1 AS station_id", "id div 7 + 1 AS sequence_number", "'low' AS battery_status", "1000 + id AS timestamp",
        "CAST(id % 100 AS INT) AS humidity", "50 AS temperature", "5 AS wind_speed",
        "timestampadd(SECOND, 1000 + id, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS ingested_at")


def _largest_method(spark, df):
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes
    return max(sizes)


@pytest.mark.parametrize("tagged", [lambda r: C.tag_readings(r), lambda r: C.tag_alerts(r)], ids=["readings", "alerts"])
def test_decode_is_compiled(spark, tagged):
    records = spark.range(1).selectExpr("CAST(id AS STRING) AS value", "0 AS partition", "id AS offset")
    assert _largest_method(spark, tagged(records)) < HUGE


def test_records_are_compiled(spark):
    assert _largest_method(spark, records_from_readings(_readings(spark, 10))) < HUGE


@pytest.mark.parametrize("field", ["station_id", "s_no", "status_timestamp", "humidity", "alert_count"])
@pytest.mark.parametrize("text,value", [
    ("7", 7), ("-7", -7), ("007", None), ('"007"', 7), ('" 7 "', 7), ('"+7"', 7), ("70.9", 70), ('"70.9"', None), ("1e2", 100), ("-0", 0),
    ('"7\\n"', 7), ('""', None), ("true", None), ("null", 0), ("2147483648", 2147483648), ("9223372036854775808", None),
    ("999999999999999999999999999999999999999999", None), ('"١٢"', 12)])
def test_number_texts(spark, field, text, value):
    json = "{" + ", ".join(f'"{f}": {text if f == field else 1}' for f in ("station_id", "s_no", "status_timestamp", "humidity", "alert_count")) + "}"
    row = C.tag_alerts(spark.createDataFrame([(json,)], "value string")).first()
    if field == "humidity" and value == 2147483648:
        value = None
    assert row["reason"] == (None if value is not None else C.MALFORMED if text == "007" else C.BAD_NUMBER + field)
    if value is not None:
        assert row[field] == value
