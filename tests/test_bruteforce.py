"""Analysis answers against plain Python on random readings (hot station, gaps, NULL weather).

Rounding follows exact numerics, half away from zero, as the original database computes
``ROUND(100.0 * a / b, 2)`` and ``ROUND(AVG(x), 1)``.
"""

import collections
import decimal
import random

import pytest
from sorted_rows import rows
from pyspark.sql import functions as F

from telemetry.operators.alerts import rain_alerts
from telemetry.plans import analysis as A

D = decimal.Decimal


def rnd(num, den, places):
    if den == 0:
        return None
    q = D(1).scaleb(-places)
    return float((D(num) / D(den)).quantize(q, rounding=decimal.ROUND_HALF_UP))


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(11)
    out, alerts = [], []
    for station in range(1, 30):
        n = 400 if station == 1 else r.randint(1, 25)        # station 1 is hot
        seqs = sorted(r.sample(range(1, n * 2 + 1), n))        # about half of the numbers missing
        for q in seqs:
            weather = None if r.random() < 0.05 else (r.randint(0, 100), r.randint(20, 120), r.randint(0, 50))
            ts = 1_700_000_000 + q * r.randint(1, 3)
            out.append((station, q, r.choice(["low", "medium", "high"]), ts,
                        *(weather or (None, None, None)), ts - 60))
            if weather and weather[0] > 70 and r.random() < 0.9:
                alerts.append((station, q))
    alerts.append((99, 1))                                      # alerts-only station
    schema = ("station_id long, sequence_number long, battery_status string, timestamp long, humidity int, "
              "temperature int, wind_speed int, ing long")
    readings = spark.createDataFrame(out, schema).withColumn(
        "ingested_at", F.expr("timestampadd(SECOND, ing, TIMESTAMP_NTZ'1970-01-01 00:00:00')")).drop("ing")
    stored = spark.createDataFrame(alerts, "station_id long, sequence_number long")
    return out, alerts, readings.repartition(7), stored


def test_battery_distribution(data):
    out, _, readings, _ = data
    per = collections.Counter((s, b) for s, _, b, *_ in out)
    tot = collections.Counter(s for s, *_ in out)
    want = sorted((s, b, n, rnd(100 * n, tot[s], 2)) for (s, b), n in per.items())
    assert rows(A.battery_distribution(readings)) == want


def test_drop_rate_and_cluster(data):
    out, _, readings, _ = data
    mx, n = collections.defaultdict(int), collections.Counter()
    for s, q, *_ in out:
        mx[s] = max(mx[s], q)
        n[s] += 1
    want = sorted((s, mx[s], n[s], mx[s] - n[s], rnd(100 * (mx[s] - n[s]), mx[s], 2)) for s in mx)
    assert rows(A.drop_rate(readings)) == want
    e, g = sum(mx.values()), sum(n.values())
    assert rows(A.drop_rate_cluster(readings)) == [(e, g, e - g, rnd(100 * (e - g), e, 2))]


def test_weather_stats(data):
    out, _, readings, _ = data
    by = collections.defaultdict(list)
    for s, _, _, _, h, t, w, _ in out:
        by[s].append((h, t, w))

    def avg(xs):
        xs = [x for x in xs if x is not None]
        return rnd(sum(xs), len(xs), 1) if xs else None

    want = []
    for s, v in by.items():
        ts = [t for _, t, _ in v if t is not None]
        want.append((s, avg([t for _, t, _ in v]), min(ts) if ts else None, max(ts) if ts else None,
                     avg([h for h, _, _ in v]), avg([w for _, _, w in v]), len(v)))
    assert rows(A.weather_stats(readings)) == sorted(want, key=lambda x: x[0])


def test_validation_and_crosscheck(data):
    out, alerts, readings, stored = data
    above = collections.Counter(s for s, _, _, _, h, *_ in out if h is not None and h > 70)
    per_alert = collections.Counter(s for s, _ in alerts)
    want = sorted((s, above[s], per_alert[s]) for s in {r[0] for r in out})
    assert rows(A.rain_validation(readings, stored)) == want
    keys = set(alerts)
    elig = [(s, q) for s, q, _, _, h, *_ in out if h is not None and h > 70]
    q_, m_ = collections.Counter(s for s, _ in elig), collections.Counter(s for s, q in elig if (s, q) in keys)
    want = sorted((s, q_[s], m_[s], q_[s] - m_[s]) for s in q_)
    assert rows(A.rain_crosscheck(readings, stored, "2100-01-01 00:00:00")) == want


def test_latest_gaps_and_alerts(data):
    out, _, readings, _ = data
    latest = {}
    for rec in out:
        if rec[0] not in latest or rec[1] > latest[rec[0]][1]:
            latest[rec[0]] = rec
    assert rows(A.latest_status(readings), "station_id", "sequence_number", "humidity") == \
        sorted((s, r[1], r[4]) for s, r in latest.items())
    present = {(s, q) for s, q, *_ in out}
    missing = sorted((s, q) for s, r in latest.items() for q in range(1, r[1] + 1) if (s, q) not in present)
    assert rows(A.missing_all(readings)) == missing
    hot = [q for s, q in missing if s == 1][:50]
    assert [x[0] for x in A.missing_for_station(readings, 1).collect()] == hot
    count, want = collections.Counter(), []
    for s, q, _, ts, h, *_ in sorted(out, key=lambda x: (x[0], x[1])):
        if h is not None and h > 70:
            count[s] += 1
            want.append((s, q, count[s]))
    assert rows(rain_alerts(readings), "station_id", "s_no", "alert_count") == sorted(want)
