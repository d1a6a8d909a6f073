"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from telemetry.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain(counts):
    """word -> (form, root, n, n_near, form_n)."""
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def plain_words(docs, every=97):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("group", [4, 40, 2048])
def test_random_words_as_plain(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 60) for _ in range(700)}
    words |= {"a" * n: n for n in range(5, 12)} | {"a" * n + "b": 90 - n for n in range(5, 12)} | {"ababab": 200, "bababa": 200, "bababab": 200}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"), group=group)
    assert rows_of(got) == plain(words)


def test_hot_half_is_split(spark):
    """Words of which most share their first or last letters."""
    rng = random.Random(1)
    words = {"prefix" + "".join(rng.choice("abcdefgh") for _ in range(4)): rng.randrange(3, 99) for _ in range(500)}
    words |= {"".join(rng.choice("abcdefgh") for _ in range(4)) + "ending": rng.randrange(3, 99) for _ in range(500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    groups = spelling.groups(df, 64)
    assert groups.groupBy("key", "class", "pre", "suf").count().filter("count > 64 and class - pre - suf > 1").isEmpty()
    assert rows_of(spelling.variants(df, group=64)) == plain(words)


def test_groups_hold_every_pair_once(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 8))) for _ in range(200)]
    words = sorted(set(words))
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    near = {r["word"]: r["n_near"] for r in spelling.near_words(df, 8).collect()}
    assert near == {w: k for w in words if (k := sum(one_edit(w, v) for v in words))}


def test_long_chain_of_forms(spark):
    words = {"aaaaa" + "b" * k: 3 * 2 ** k for k in range(20)}
    assert rows_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain(words)


def test_documents(spark, make_docs):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeinrstÉé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary).title() for _ in range(rng.randrange(0, 200))) + rng.choice(["", "…×÷ÿŸĀ1x"]) for _ in range(150)]
    texts += [None, "", "long" * 50_000, "Long" * 50_000, "LONG" * 50_000]
    ids = [None if i == 7 else i // 2 for i in range(len(texts))]  # ids twice
    docs = make_docs(texts, ids=ids, clash=True).withColumnRenamed("shard", "word")
    counts = plain_words([("" if i is None else i, t) for i, t in zip(ids, texts)])
    assert rows_of(spelling.variants(spelling.vocabulary(docs, typo_every=97))) == plain(counts)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()} == plain_words(zip(ids, texts), None)


def test_counts(spark, make_docs):
    docs = make_docs(["alpha bravo charlie", "alpha bravo", "alpha"] * 4)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()} == {"alpha": 12, "bravo": 8, "charlie": 4}


def test_empty(spark, make_docs):
    docs = make_docs(["few words", None])
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_query_as_plain(spark):
    from telemetry.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op12_spelling"](spark, sf)) == plain(plain_words(docs))
