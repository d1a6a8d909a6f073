"""Decoding never fails and never loses a record: each non-null record is a reading or a
dead letter, exactly once (a bad record must not stop the stream)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telemetry.functions.codec import decode_readings, tag_readings

scalars = st.one_of(st.none(), st.booleans(), st.integers(-2**40, 2**40), st.floats(allow_nan=False),
                    st.text(max_size=8))
weather = st.one_of(scalars, st.fixed_dictionaries({}, optional={
    "humidity": scalars, "temperature": scalars, "wind_speed": scalars}))
message = st.fixed_dictionaries({}, optional={
    "station_id": scalars, "s_no": scalars, "battery_status": scalars,
    "status_timestamp": scalars, "weather": weather, "other": scalars})
values = st.one_of(st.none(), st.text(max_size=30), message.map(json.dumps),
                   message.map(lambda m: json.dumps(m)[:-1]))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, min_size=50, max_size=200))
def test_every_record_accounted_for(spark, batch):
    recs = spark.createDataFrame([(v, 0, i) for i, v in enumerate(batch)],
                                 "value string, partition int, offset long")
    good, dead = decode_readings(recs)
    offsets_good = [r["offset"] for r in good.collect()]
    offsets_dead = [r["offset"] for r in dead.collect()]
    non_null = [i for i, v in enumerate(batch) if v is not None]
    assert sorted(offsets_good + offsets_dead) == non_null
    tagged = tag_readings(recs).collect()
    assert sorted(r["offset"] for r in tagged) == non_null
    assert {r["offset"] for r in tagged if r["reason"] is None} <= set(offsets_good)
