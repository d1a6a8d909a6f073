"""Links inside components: cells against all pairs, pairs and counts against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_plain import lower_ascii, space_words, text_of

from telemetry.llm import class_links, jaccard


def shingles(text):
    w = space_words(lower_ascii(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def similar(a, b):
    return bool(a) and bool(b) and 4 * len(a & b) >= 3 * len(a | b)


def texts_of_groups():
    rng = random.Random(31)
    texts = ["", None, " \t", "one", "One", "one two", text_of(rng, 3000)]
    for size, many in ((6, 6), (30, 25), (90, 60), (400, 12)):
        base = text_of(rng, size, 10**6).split()
        for _ in range(many):
            w = list(base)
            for _ in range(rng.randrange(4)):  # some are equal, some linked only through others
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    grow = text_of(rng, 200, 10**6).split()
    texts += [" ".join(grow[:n]) for n in range(40, 200, 6)]  # a chain over several bands
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("parts", [{}, {"part_rows": 7, "part_elements": 300}])
def test_links_equal_brute_force(spark, make_docs, parts):
    texts = texts_of_groups()
    docs = make_docs(texts, clash=True)
    sets = [shingles(t) for t in texts]
    want = {i: sum(similar(s, t) for j, t in enumerate(sets) if j != i) for i, s in enumerate(sets)}
    got = jaccard.similarity_classes(docs, bucket_bytes=1 << 12, **parts)
    assert {r.doc_id: r.n_links for r in got.collect()} == want

    pairs, members = jaccard.similar_pairs(docs, bucket_bytes=1 << 12, **parts)
    first = {r.set_hash: sets[r.doc_id] for r in members.collect()}
    assert len(first) == len(set(sets))
    found = Counter((frozenset((first[r.set_a], first[r.set_b])), r.n_common, r.n_union) for r in pairs.collect())
    different = list(set(sets))
    assert found == Counter((frozenset((a, b)), len(a & b), len(a | b))
                            for i, a in enumerate(different) for b in different[:i] if similar(a, b))


def test_links_of_repeated_and_null_ids_and_no_rows(spark, make_docs):
    rng = random.Random(32)
    a, b = text_of(rng, 60, 10**6), text_of(rng, 60, 10**6)
    docs = make_docs([a, a + " x", a + " y", a, b, b, "", ""], ids=[1, 1, None, 2, None, 3, 4, 4])
    got = sorted(((r.doc_id, r.n_shingles, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert got == sorted([(1, 56, 3), (1, 57, 3), (None, 57, 3), (2, 56, 3), (None, 56, 1), (3, 56, 1), (4, 0, 0), (4, 0, 0)], key=str)
    none = docs.filter("false")
    assert jaccard.similarity_classes(none).count() == 0
    pairs, members = jaccard.similar_pairs(none)
    assert pairs.count() == members.count() == 0


def test_bitsets_of_a_cell_are_exact():
    rng = np.random.default_rng(33)
    for trial in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(1, 4000))).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, max(1, int(len(base) * rng.uniform(.7, 1))), replace=False),
                                          rng.integers(0, 2**63, int(rng.integers(0, 9))).astype(np.uint64)])) for _ in range(12)]
        side = np.array([0, 1] * 6) if trial % 2 else np.full(12, class_links.ITSELF)
        got = {(int(x), int(y)): int(c) for p, q, both in class_links.linked(sets, side, rows=5) for x, y, c in zip(p, q, both)}
        plain = [set(s.tolist()) for s in sets]
        assert got == {(i, j): len(plain[i] & plain[j]) for i in range(12) for j in range(i + 1, 12)
                       if similar(plain[i], plain[j]) and (side[i] != side[j] or side[i] == class_links.ITSELF)}


def test_a_large_component_is_cut_and_each_pair_meets_once(spark):
    rows = [(h, 5, 10 + h % 200, 1) for h in range(300)] + [(h, 7, 20, 1) for h in range(1000, 1020)]
    members = spark.createDataFrame(rows, "h long, root long, n long, copies long")
    met, largest = Counter(), Counter()
    for cell, part in class_links.cells(members, 32, 1 << 20).toPandas().groupby("cell"):
        largest[cell] = len(part)
        for a in part.itertuples():
            for b in part[part.h > a.h].itertuples():
                if a.side != b.side or a.side == class_links.ITSELF:
                    met[a.h, b.h] += 1
    size = {r[0]: r[2] for r in rows}
    root = {r[0]: r[1] for r in rows}
    assert max(met.values()) == 1
    assert max(largest.values()) < 120
    for a in size:
        for b in size:
            if a < b and root[a] == root[b] and 3 * max(size[a], size[b]) <= 4 * min(size[a], size[b]):
                assert met[a, b] == 1


def test_blocks_of_a_group_lose_no_pair(spark):
    rng = random.Random(34)
    groups = spark.createDataFrame([(g, h, 10) for g, many in ((1, 90), (2, 5)) for h in range(g * 1000, g * 1000 + many)],
                                   "g long, h long, n long")
    classes = groups.selectExpr("h", "X'0000000000000000' AS brief")
    known = spark.createDataFrame([(g * 1000 + i, g * 1000 + rng.randrange(i)) for g in (1, 2) for i in (2, 4)], "node long, root long")
    root = {r.node: r.root for r in known.collect()}
    rows = jaccard._open_rows(groups, known, classes, block=16)
    got = {(r.a, r.b) for r in rows.mapInArrow(jaccard._across, "a bigint, b bigint").collect()}
    hs = sorted(r.h for r in groups.collect())
    assert got == {(a, b) for a in hs for b in hs if a < b and a // 1000 == b // 1000 and root.get(a, a) != root.get(b, b)}
    assert max(r["count"] for r in rows.groupBy("g").count().collect()) < 60
