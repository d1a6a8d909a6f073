import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from telemetry.session import checkpoint_root, local_session
    s = local_session(4, shuffle_partitions=4, app="telemetry-tests")
    checkpoint_root(s)  # registers a local folder only when the session has none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The 12-row table of FIXTURES.md section 2 and its stored alerts."""
    from telemetry.schemas import ALERTS_TABLE, READINGS_TABLE
    from pyspark.sql import functions as F
    rows = [
        (1, 1, "low", 60, 71, 50, 10), (1, 2, "medium", 61, 70, 60, 20), (1, 4, "high", 119, 90, 70, 30),
        (1, 5, "medium", 120, 10, 80, 0), (2, 2, "low", 60, 100, 20, 50), (2, 3, "low", 61, 0, 120, 0),
        (2, 6, "high", 180, 71, 71, 5), (3, 1, "medium", 60, None, None, None), (4, 1, "high", 61, 75, 40, 8),
        (4, 2, "medium", 62, 76, 41, 9), (4, 3, "low", 63, 30, 43, 10), (4, 4, "high", 121, 30, 45, 11),
    ]
    schema = "station_id long, sequence_number long, battery_status string, timestamp long, " \
             "humidity int, temperature int, wind_speed int"
    readings = spark.createDataFrame(rows, schema).withColumn(
        "ingested_at", F.expr("timestampadd(SECOND, timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')"))
    assert [f.name for f in readings.schema] == [f.name for f in READINGS_TABLE]
    alerts = spark.createDataFrame([(1, 1), (1, 4), (2, 2), (4, 1), (4, 2), (9, 1)],
                                   "station_id long, sequence_number long") \
        .selectExpr("station_id", "sequence_number", "0L AS timestamp", "80 AS humidity",
                    "CAST(NULL AS BIGINT) AS alert_count", "CAST(NULL AS TIMESTAMP_NTZ) AS detected_at")
    assert [f.name for f in alerts.schema] == [f.name for f in ALERTS_TABLE]
    return readings, alerts
