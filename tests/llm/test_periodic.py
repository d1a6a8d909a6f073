"""Periodic runs against a plain version that tries every period at every place."""

import hashlib
import random
import zlib

import pytest
from llm_plain import space_words

from telemetry.llm import periodic


def plain_runs(words, min_length=24, copies=3):
    """Every maximal stretch of each period, without those of which a smaller period holds."""
    found = {}
    n = len(words)
    for q in range(1, n // copies + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - start >= max(min_length, copies * q):
                    found.setdefault((start, i - start), q)
                start = i - q + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text):
    words = space_words(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{le},{q}\n" for s, le, q in runs), " ".join(kept))]
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *sha)


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@pytest.mark.parametrize("seed", range(300))
def test_random_words_as_plain(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randrange(1, 6)):
        part = [str(rng.randrange(rng.choice([1, 2, 3, 30]))) for _ in range(rng.randrange(1, 40))]
        words += part * rng.choice([1, 1, 2, 3, 5]) + part[:rng.randrange(len(part) + 1)]
    assert periodic.runs_of(words) == plain_runs(words)
    assert periodic.runs_of(words, 4) == plain_runs(words, 4)


def test_runs_that_touch_and_nest():
    a, b = ["x", "y"] * 15, ["y", "z"] * 15
    for words in (a + b, a + ["q"] + a, (["a"] * 25 + ["b"]) * 4, ["a"] * 24, ["a"] * 23, (["a", "b", "c"] * 8)[:-1]):
        assert periodic.runs_of(words) == plain_runs(words)


def test_long_repetitive_text_is_quick():
    words = ["a"] * 200_000 + [str(i % 7) for i in range(100_000)] + ["b", "c"] * 50_000
    assert periodic.runs_of(words) == [(0, 200_000, 1), (200_000, 100_000, 7), (300_000, 100_000, 2)]


def test_edges(spark, make_docs):
    texts = [None, "", " \n", "one two", "a " * 30, "a " * 30]
    docs = make_docs(texts, ids=[None, 1, 2, 3, 4, 4], clash=True)
    out = periodic.find_runs(docs.withColumnRenamed("n", "runs"))
    got = out.select("doc_id", "runs", "collapsed", "h").collect()
    assert len(got) == 6 and {r["h"] for r in got} == {"x"}
    assert [(len(r["runs"]), r["collapsed"]) for r in got] == [(0, ""), (0, ""), (0, ""), (0, "one two"), (1, "a"), (1, "a")]
    assert periodic.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs, runs="text")
    with pytest.raises(ValueError):
        periodic.runs_of(["a"] * 30, min_copies=2)


def test_planted_tails(spark, make_docs):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 90))) for _ in range(400)] + [None, "", "x"] * 10
    docs = make_docs(texts, clash=True)
    planted = {r["doc_id"]: r["text"] for r in periodic.with_planted_runs(docs).collect()}
    changed = 0
    for i, t in enumerate(texts):
        n, h = len(space_words(t)), zlib.crc32(str(i).encode())
        if h % 10 or not n:
            assert planted[i] == t
        else:
            changed += 1
            a, words = h // 10 % n, space_words(t)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            assert planted[i].split(" ") == [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    assert changed > 20


def test_query_as_plain(spark):
    from telemetry.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_periodic"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len(r["text"] or "") < 20_000:
            assert got[r["doc_id"]] == plain_row(r["doc_id"], r["text"]), r["doc_id"]
