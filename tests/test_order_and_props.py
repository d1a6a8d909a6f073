"""Presentation order (O1-O5) and order-independence of the answers."""

from sorted_rows import rows

from telemetry.plans import analysis as A


def test_battery_order(golden):
    r, _ = golden
    got = [(x["station_id"], x["battery_status"]) for x in A.battery_distribution_ordered(r).collect()]
    assert got[:3] == [(1, "low"), (1, "medium"), (1, "high")]
    assert got[3:5] == [(2, "low"), (2, "high")]


def test_global_order_by_percentage_desc(spark, golden):
    r, _ = golden
    pct = [x["percentage"] for x in A.battery_global_ordered(r.where("station_id != 1")).collect()]
    assert pct == sorted(pct, reverse=True)


def test_top_k_orders(golden):
    r, _ = golden
    minutes = [x["minute"] for x in A.readings_per_minute(r, limit=2).collect()]
    assert len(minutes) == 2 and minutes == sorted(minutes, reverse=True)
    missing = [x[0] for x in A.missing_for_station(r, 2, limit=2).collect()]
    assert missing == [1, 4]


def test_answers_do_not_depend_on_input_order(golden):
    r, a = golden
    shuffled = r.repartition(7).orderBy("humidity")
    for f in (A.battery_distribution, A.battery_pivot, A.battery_global, A.drop_rate, A.drop_rate_cluster,
              A.missing_all, A.latest_status, A.weather_stats, A.readings_per_minute, A.station_counts):
        assert rows(f(shuffled)) == rows(f(r)), f.__name__
    assert rows(A.rain_validation(shuffled, a)) == rows(A.rain_validation(r, a))
    assert rows(A.rain_crosscheck(shuffled, a, "2100-01-01 00:00:00")) == \
        rows(A.rain_crosscheck(r, a, "2100-01-01 00:00:00"))
