"""Substring dedup against plain word windows: nothing repeated stays, nothing else goes."""

import random
import re

import pytest
from llm_plain import text_of

from telemetry.llm import chunk_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def judged(texts, spans):
    """(words of 50-word windows that a remaining text still repeats, removed words outside all repeats of 20 words)."""
    seen50, seen20, left, over = set(), set(), 0, 0
    for text, cuts in zip(texts, spans):
        raw = (text or "").encode()
        places = [m.span() for m in WORD.finditer(raw)]
        gone = [any(a <= x and y <= b for a, b in cuts) for x, y in places]
        may = [False] * len(places)
        for k in range(len(places) - 19):
            w = raw[places[k][0]:places[k + 19][1]]
            if w in seen20:
                may[k:k + 20] = [True] * 20
            seen20.add(w)
        over += sum(g and not m for g, m in zip(gone, may))
        for k in range(len(places) - 49):
            w = raw[places[k][0]:places[k + 49][1]]
            if w in seen50 and not any(gone[k:k + 50]):
                left += 1
            seen50.add(w)
    return left, over


def spans_of(docs, **options):
    rows = chunk_dedup.dedup_substrings(docs, **options).collect()
    return {r.doc_id: [(s.start, s.end) for s in r.spans] for r in rows}


def check(make_docs, texts):
    got = spans_of(make_docs(texts))
    return judged(texts, [got[i] for i in range(len(texts))])


@pytest.mark.parametrize("seed", range(4))
def test_copies_in_other_surroundings(make_docs, seed):
    """Passages that begin in one text and are quoted in parts by others; chance repeats of a few words everywhere."""
    rng = random.Random(seed)
    phrases = [text_of(rng, 6, 10**6) for _ in range(30)]
    base = [" ".join(rng.choice([text_of(rng, 9, 10**6), rng.choice(phrases)]) for _ in range(30)) for _ in range(40)]
    texts = list(base)
    for _ in range(80):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.choice(base).split(" ")
            at = rng.randrange(len(words) - 60)
            parts += [text_of(rng, rng.randrange(0, 30), 10**6), " ".join(words[at:at + rng.randrange(51, 160)])]
        texts.append("\n".join(parts))
    assert check(make_docs, texts) == (0, 0)


def test_texts_of_little_variety(make_docs):
    """Periodic texts of all kinds: alone, twice, with other words before, longer than their first copy."""
    rng = random.Random(7)
    texts = []
    for period in (["a"], ["in"], ["Ciónmenteueó."], ["x", "yy"], ["a", "b", "a"], [f"w{i}" for i in range(7)], [f"longer{i}" for i in range(40)]):
        run = " ".join(period * (300 // len(period)))
        texts += [run, run, "own words first " + run, text_of(rng, 33, 10**6) + " " + run + " " + text_of(rng, 20, 10**6), run + " " + run]
    texts += [" ".join(rng.choice("pqr") for _ in range(400)) for _ in range(10)]
    left, over = check(make_docs, texts)
    assert (left, over) == (0, 0)


def test_neighbouring_matches_of_different_texts_stay(make_docs):
    """Two repeats of 15 words side by side, from two texts: no repeat of 20 words, nothing goes."""
    rng = random.Random(3)
    a, b = text_of(rng, 60, 10**6), text_of(rng, 60, 10**6)
    mixed = " ".join(a.split()[10:25] + b.split()[30:45])
    got = spans_of(make_docs([a, b, mixed]))
    assert got == {0: [], 1: [], 2: []}


def test_words_that_go_on_elsewhere_stay(make_docs):
    rng = random.Random(4)
    body = text_of(rng, 30, 10**6)
    got = spans_of(make_docs([f"start{body}end of it", f"x {body} y"]))
    first, last = body.split()[0], body.split()[-1]
    (s, e), = got[1]
    assert f"x {body} y"[s:e].split() == body.split()[1:-1] and first and last


def test_insertion_into_a_periodic_text(make_docs):
    run = " ".join(["alpha beta gamma"] * 120)
    got = spans_of(make_docs([run, run[:700] + " inserted " + run[700:]]))
    words = run[:700] + " inserted " + run[700:]
    gone = sum(len(words[s:e].split()) for s, e in got[1])
    assert gone >= len(words.split()) - 12
