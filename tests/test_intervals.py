"""Interval sets and the index of archived keys against Python sets."""

import random

from sorted_rows import rows

from telemetry.operators import intervals as I
from telemetry.session import scratch_path
from telemetry.streaming.folders import exists
from telemetry.streaming.index import ArchivedKeys

KEYS = "station_id long, sequence_number long"


def _expanded(df):
    return sorted((r["station_id"], q) for r in df.collect() for q in range(r["lo"], r["hi"] + 1))


def _random_keys(rng, n, stations=4, top=3 * I.BLOCK):
    out = set()
    while len(out) < n:
        s, q = rng.randrange(stations), rng.randrange(-50, top)
        out |= {(s, q + i) for i in range(rng.choice([1, 1, 5, 400]))}
    return out


def test_sets_as_intervals(spark):
    rng = random.Random(4)
    a, b = _random_keys(rng, 2000), _random_keys(rng, 2000)
    ia = I.from_keys(spark.createDataFrame([*a, *list(a)[:50], (None, 1), (1, None)], KEYS))
    assert _expanded(ia) == sorted(a)
    both = I.merged(ia.unionByName(I.from_keys(spark.createDataFrame(list(b), KEYS))))
    assert _expanded(both) == sorted(a | b)
    held = rows(both, "station_id", "lo", "hi", "block")
    assert all(lo // I.BLOCK == hi // I.BLOCK == block for _, lo, hi, block in held)
    assert not any((s, hi + 1) in a | b and (hi + 1) % I.BLOCK for s, _, hi, _ in held)  # none touches the next
    asked = list(_random_keys(rng, 1500)) + [(9, 1), (None, 3), (2, None)]
    got = rows(I.contained(spark.createDataFrame(asked, KEYS), both))
    assert got == sorted(set(asked) & (a | b))


def test_index_over_many_batches(spark):
    rng = random.Random(6)
    keys = ArchivedKeys(scratch_path(spark, "test-keys"))
    old = {(1, q) for q in range(10, 30)}
    keys.create(spark, spark.createDataFrame(list(old), KEYS))
    known = set(old)
    for batch in range(9):
        asked = _random_keys(rng, 60, 3, 400)
        seen = keys.archived(spark, batch, spark.createDataFrame(list(asked), KEYS))
        assert rows(seen) == sorted(asked & known)
        new = spark.createDataFrame(list(asked - known), KEYS)
        keys.write(spark, batch, new)
        if batch % 3 == 2:
            keys.write(spark, batch, new)  # the batch runs again
        known |= asked
    assert _expanded(keys.before(spark, 9)) == sorted(known)
    # batches 1 to 8 are one folder by now, and what it took over is gone
    assert [n for n in range(1, 12) if exists(spark, f"{keys.folder}/upto={n}")] == [8, 9]
    assert keys.archived(spark, 9, spark.createDataFrame([], KEYS)) is None
    keys.create(spark, spark.createDataFrame([(5, 5)], KEYS))  # the index is there: nothing changes
    assert _expanded(keys.before(spark, 9)) == sorted(known)


def test_folders_of_a_prefix():
    for n in range(300):
        covered = [b for p in ArchivedKeys.parts(n) for b in range(p - (p & -p) + 1, p + 1)]
        assert sorted(covered) == list(range(1, n + 1)) and len(list(ArchivedKeys.parts(n))) <= 9
