"""Decode edge cases (FIXTURES.md section 3), one record each."""

import pytest

from telemetry.functions.codec import (decode_readings, encode_readings, flatten_readings,
                                       tag_readings)

FULL = '{"station_id":1,"s_no":1,"battery_status":"low","status_timestamp":1681521224,' \
       '"weather":{"humidity":%s,"temperature":100,"wind_speed":13}}'


def decode(spark, value):
    recs = spark.createDataFrame([(value, 0, 7)], "value string, partition int, offset long")
    good, dead = decode_readings(recs)
    return good.collect(), dead.collect()


@pytest.mark.parametrize("value,humidity", [
    (FULL % "71", 71), (FULL % "70", 70), (FULL % '"7"', 7), (FULL % "70.9", 70),
    ((FULL % "71").replace('{"station_id"', '{"extra":true,"station_id"'), 71),
    (FULL % "71" + " trailing junk", 71),
    # a field of the same name elsewhere in the record plays no part
    ((FULL % "70.9")[:-1] + ',"extra":{"humidity":"x"}}', 70), ((FULL % "70.9")[:-1] + ',"humidity":"70.9"}', 70),
    ('{"note":"\\"humidity\\":\\"1.5\\"",' + (FULL % "70.9")[1:], 70),
])
def test_good_readings(spark, value, humidity):
    good, dead = decode(spark, value)
    assert dead == [] and len(good) == 1
    assert good[0]["weather"]["humidity"] == humidity
    assert good[0]["station_id"] == 1 and good[0]["partition"] == 0 and good[0]["offset"] == 7


@pytest.mark.parametrize("value", [
    '{"station_id":1,"s_no":2,"battery_status":"low","status_timestamp":5}',
    '{"station_id":1,"s_no":2,"battery_status":"low","status_timestamp":5,"weather":null}',
])
def test_weather_absent_gives_three_nulls(spark, value):
    recs = spark.createDataFrame([(value,)], "value string")
    good, _ = decode_readings(recs)
    flat = flatten_readings(good).collect()[0]
    assert (flat["humidity"], flat["temperature"], flat["wind_speed"]) == (None, None, None)


def test_missing_numbers_default_to_zero(spark):
    good, _ = decode(spark, '{"station_id":null,"battery_status":"low","weather":{"humidity":null}}')
    g = good[0]
    assert (g["station_id"], g["s_no"], g["status_timestamp"]) == (0, 0, 0)
    assert (g["weather"]["humidity"], g["weather"]["temperature"], g["weather"]["wind_speed"]) == (0, 0, 0)


@pytest.mark.parametrize("value,reason", [
    (FULL % "3000000000", "bad number: humidity"),
    (FULL % '"wet"', "bad number: humidity"),
    (FULL % '{"a":1}', "bad number: humidity"),
    ('{"station_id":1,"weather":"wet"}', "malformed json"),
    ('{"station_id":1,"s_no', "malformed json"),
    ("plain text", "malformed json"),
    ("[1,2]", "malformed json"),
    ("null", "malformed json"),
    ("", "malformed json"),
])
def test_dead_letters(spark, value, reason):
    good, dead = decode(spark, value)
    assert good == [] and len(dead) == 1
    assert dead[0]["reason"] == reason and dead[0]["value"] == value
    assert (dead[0]["partition"], dead[0]["offset"]) == (0, 7)


def test_null_value_is_dropped(spark):
    recs = spark.createDataFrame([(None,)], "value string")
    good, dead = decode_readings(recs)
    assert good.count() == 0 and dead.count() == 0


@pytest.mark.parametrize("value,reason", [
    ("{}", "contract: battery_status is null"),
    (FULL.replace('"low"', "null") % "71", "contract: battery_status is null"),
    (FULL.replace('"low"', '"low-battery-x"') % "71", "contract: battery_status too long"),
])
def test_contract(spark, value, reason):
    recs = spark.createDataFrame([(value, 1, 2)], "value string, partition int, offset long")
    tagged = tag_readings(recs).collect()
    assert len(tagged) == 1 and tagged[0]["reason"] == reason


def test_encode_round_trip(spark, golden):
    r, _ = golden
    enc = encode_readings(r)
    assert enc.where("key = '3'").first()["value"].endswith('"weather":null}')
    good, dead = decode_readings(enc)
    assert dead.count() == 0
    back = flatten_readings(good)
    assert sorted(back.collect()) == sorted(r.drop("ingested_at").collect())


def test_enforce_contract_on_flat_readings(spark, golden):
    from pyspark.sql import functions as F

    from telemetry.functions.codec import enforce_contract
    r, _ = golden
    bad = r.withColumn("battery_status", F.when(F.col("sequence_number") == 2, F.lit(None))
                       .otherwise(F.col("battery_status")))
    ok, dead = enforce_contract(bad.drop("ingested_at"))
    assert ok.count() == 9 and dead.count() == 3
    d = dead.collect()
    assert {x["reason"] for x in d} == {"contract: battery_status is null"}
    assert all('"battery_status":null' in x["value"] for x in d)   # re-encoded message kept


def test_quoted_fractions_and_containers(spark):
    from telemetry.functions.codec import decode_alerts, decode_readings
    w = '"weather":{"humidity":%s,"temperature":1,"wind_speed":1}}'
    cases = [('{"station_id":1,"s_no":1,"battery_status":"low","status_timestamp":1,' + w % h, want) for h, want in
             (("70.9999999", None), ("70.9", None), ('"70"', None), ('"70.9"', "bad number: humidity"))]
    cases += [('{"station_id":1,"s_no":1,"battery_status":%s,"status_timestamp":1,' % b + w % "70", want) for b, want in
              (('"{}"', None), ('{"a":1}', "malformed json"), ("[1]", "malformed json"))]
    for value, want in cases:
        good, dead = decode_readings(spark.createDataFrame([(value,)], "value string"))
        assert [r["reason"] for r in dead.collect()] == ([want] if want else [])
        assert [r["weather"]["humidity"] for r in good.collect()] == ([] if want else [70])
    _, dead = decode_alerts(spark.createDataFrame([('{"station_id":1,"s_no":"1.5","message":"x"}',)], "value string"))
    assert [r["reason"] for r in dead.collect()] == ["bad number: s_no"]
