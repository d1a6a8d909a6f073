"""The pipeline stage by stage on the smallest tables, and the contract of the registered queries."""

import collections
import functools
import hashlib
import inspect
import math
import re

import corpus_pipeline
from llm_plain import lower_ascii, space_words
from telemetry.llm import quality_pu
from telemetry.llm.frames import materialise, table
from telemetry.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_queries_are_numbered_and_take_session_and_folder():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert all(len(inspect.signature(f).parameters) == 2 for f in QUERIES.values())


ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@functools.cache
def benchmark_windows(spark):
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = ALNUM.findall(lower_ascii(r.text))
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    return windows, {len(w) for w in windows}


def contaminated(text, spark):
    windows, sizes = benchmark_windows(spark)
    w = ALNUM.findall(lower_ascii(text))
    hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for k in range(n)}
    return bool(hit) and 20 * len(hit) >= len(w)


def plain_mix(rows):
    """Copies of each document by the Poisson quantile of its hash, the rate following the source's size ** 0.7."""
    size = collections.Counter()
    for r in rows:
        size[r.source] += len(r.text or "")
    weight = {s: n ** 0.7 if n else 0.0 for s, n in size.items()}
    out = collections.Counter()
    for r in rows:
        n = size[r.source]
        rate = weight[r.source] / sum(weight.values()) * sum(size.values()) / n if n else 1.0
        u = int(hashlib.md5(f"5:{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        copies, below, term = 0, 0.0, math.exp(-rate)
        while (below := below + term) <= u:
            copies += 1
            term *= rate / copies
        if copies:
            out[r.doc_id] += copies
    return out


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialise(stage(spark, kept[-1], SF), "stage"))
        assert kept[-1].schema.simpleString() == docs.schema.simpleString(), name
    ids = [collections.Counter(r.doc_id for r in k.select("doc_id").collect()) for k in kept]

    scores = quality_pu.score_table(docs, table(spark, SF, "labels"))
    assert set(ids[1]) == {r.doc_id for r in scores.filter("predicted = 1").collect()}

    def shingles(text):
        w = space_words(lower_ascii(text))
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])
    sets = {r.doc_id: shingles(r.text) for r in kept[1].collect()}
    group = {}
    for a in sorted(sets):
        for b in sorted(group):
            if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) and group[b] != group.get(a, a):
                old = group.get(a, a)
                for c in [*group, a]:
                    if group.get(c, c) == old:
                        group[c] = group[b]
        group.setdefault(a, a)
    low = {}
    for a, g in group.items():
        low[g] = min(a, low.get(g, a))
    assert set(ids[2]) == set(low.values())

    texts = {r.doc_id: r.text for r in kept[2].collect()}
    assert set(ids[3]) == {i for i, t in texts.items() if not contaminated(t, spark)} and max(ids[3].values()) == 1
    assert ids[4] == plain_mix(kept[3].select("doc_id", "source", "text").collect())
    last = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect()
    assert collections.Counter(r.doc_id for r in last) == ids[4]
    assert all(0 <= r.shard < 40 for r in last)
