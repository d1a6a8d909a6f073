"""Shards of tables whose rows are mostly copies of one row."""

import collections
import random
import zlib

from llm_plain import text_of

from telemetry.llm import kdshards


def test_equal_rows_part_like_others(spark, make_docs):
    rng = random.Random(2)
    texts = ["one copy"] * 4000 + [text_of(rng, rng.randrange(1, 12)) for _ in range(1000)] + [None] * 200
    docs = make_docs(texts, ids=[7] * 4000 + list(range(1000, 2000)) + [None] * 200, clash=True).repartition(6)
    got = kdshards.shard_table(docs, shards=40).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in
        zip([7] * 4000 + list(range(1000, 2000)) + [None] * 200, texts))
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(40)) and max(size.values()) - min(size.values()) <= 2 * max(r.size for r in got)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_ties_follow_from_the_group_alone(spark, make_docs):
    docs = make_docs(["x"] * 500 + ["y"], ids=[1] * 500 + [2])

    def ties(parts):
        from telemetry.llm.frames import materialise
        raw = materialise(kdshards.points(docs.repartition(parts), "doc_id", "text", "source", "lang"), "points")
        return sorted(r.tie for r in kdshards.told_apart(raw).collect())
    assert ties(1) == ties(5) and len(set(ties(3))) == 501
