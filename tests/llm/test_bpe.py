"""Byte-pair encoding against the library that reads the same file."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemetry.llm import bpe

V = bpe.read_vocabulary()
LIBRARY = Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    LIBRARY.no_truncation()
    LIBRARY.no_padding()
    return LIBRARY


def ids_of(text):
    import numpy as np
    return np.frombuffer(bpe.Encoder(V).text(text), "<u4").tolist()


def check(library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(text) == want, text
    import numpy as np
    assert bpe.decoded(np.array(want, "<u4").tobytes(), V) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    check(LIBRARY, text)


def test_edge_texts_as_the_library(library):
    for text in ("", " ", "\n\t", "a", "A", "  two  words ", "don't we've 'S I'M", "1234 12a3", "ΑΣ ΣΑΣ Σ", "İstanbul", "é é",
                 "<|endoftext|>", "x<|startoftext|> y<|ENDOFTEXT|><|endoftext|", "日本語テキスト", "👍🏽 family 👨‍👩‍👧", "\x1c\x85\xa0a　b", "a" * 3000,
                 "ab" * 5000, "...!!!???", "x\x00y", "naïve Straße ŒUVRE", "'s's's", "’s"):
        check(library, text)


def test_every_character_as_the_library(library):
    """One character between letters: classes, case and normal form of all planes that hold any."""
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}" for c in points]
    encoder = bpe.Encoder(V)
    import numpy as np
    wrong = [hex(c) for c, t, e in zip(points, texts, library.encode_batch(texts, add_special_tokens=False))
             if np.frombuffer(encoder.text(t), "<u4").tolist() != e.ids]
    assert wrong == []


def test_random_words_of_merged_parts(library):
    rng = random.Random(4)
    parts = [s.replace("</w>", "") for s in V.strings[512:20000:37] if s.isascii()]
    for _ in range(200):
        check(library, "".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randrange(1, 40))))


def test_cache_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 2)
    encoder = bpe.Encoder(V)
    text = "one two three four one two three four one " * 3
    assert encoder.text(text) == bpe.Encoder(V).text(text)


def test_frames(spark, make_docs, library):
    long = "word " * 50_000 + "x" * 20_000
    texts = [None, "", "Hello world", "Hello world", long]
    docs = make_docs(texts, ids=[None, 1, 2, 2, 3], clash=True).withColumn("tokens", F.lit("old")).withColumn("decoded", F.lit(1))
    out = bpe.decode(bpe.encode(docs)).orderBy("doc_id", "text").collect()
    assert len(out) == 5 and set(docs.columns) == set(out[0].asDict())
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert len(r["tokens"]) == 4 * len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, result="text")


def test_query_equals_the_library(spark, library):
    import hashlib

    import numpy as np
    from telemetry.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op11_bpe"](spark, sf).collect()}
    assert got == want
