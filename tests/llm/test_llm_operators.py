"""The ten operators against plain Python on small random tables, and their edge cases."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from telemetry.llm import chunk_dedup, decontaminate, jaccard, kdshards, line_rules, mixing, page_text, quality_pu, site_lines, token_scan
from telemetry.llm.links import components
from llm_plain import lower_ascii, space_words, text_of

EDGES = [None, "", "   \n ", "One", "Ein Wörtchen", "x" * 5000, "a b c d e " * 800]


# ---- 1 ------------------------------------------------------------------------------------

def brute_decontaminate(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))
    out = {}
    for key, text in docs:
        w = words(text)
        hit, names = set(), set()
        for item, body in items:
            b = words(body)
            for i in range(max(1, len(b) - window + 1) if b else 0):
                win = b[i:i + window]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        names.add("null" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.setdefault(key, []).append((len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("block_words", [4_000_000, 20])
def test_decontaminate(spark, make_docs, block_words):
    rng = random.Random(1)
    items = [(i, text_of(rng, rng.choice([1, 3, 12, 13, 14, 40]), 30)) for i in range(12)] + [(90, None), (91, "..."), (None, "lone Item")]
    texts = EDGES + [text_of(rng, 40, 30) for _ in range(10)]
    texts += [text_of(rng, 30) + " " + t.upper() + ", " + text_of(rng, n) for _, t in items if t for n in (0, 300)] * 2
    docs = make_docs(texts, clash=True, ids=[*range(len(texts) - 2), 3, None])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collections.defaultdict(list)
    for r in decontaminate.match_table(docs, bench, block_words=block_words).collect():
        got[r.doc_id].append((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated))
    want = brute_decontaminate([(r.doc_id, r.text) for r in docs.collect()], items)
    assert {k: sorted(v) for k, v in got.items()} == want
    kept = decontaminate.decontaminate(docs, bench, block_words=block_words)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not x[-1] for v in want.values() for x in v)
    none = bench.filter("false")
    assert decontaminate.decontaminate(docs, none).count() == len(texts)
    assert decontaminate.match_table(docs.filter("false"), bench).count() == 0


def test_longest_match():
    q = decontaminate.Queries([(1, "a b c d e f g"), (2, "c d e x")], window=3)
    docs = [[q.vocab.get(w, 0) for w in decontaminate.words_of(t)] for t in (b"z a b c d e f q", b"c d e x", b"z")]
    hits, items, longest = decontaminate.match_shard(docs, q)
    assert longest == [(6, 1), (4, 0), (0, -1)]
    assert [sorted(x) for x in items] == [[0, 1], [0, 1], []]


# ---- 2 ------------------------------------------------------------------------------------

def brute_classes(rows):
    sets = []
    for key, text in rows:
        w = space_words(lower_ascii(text))
        sets.append((key, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 4 * len(a & b) >= 3 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    return sorted(((k, len(s), low.get(find(i)) if s else k) for i, (k, s) in enumerate(sets)), key=str)


def test_jaccard_classes(spark, make_docs):
    rng = random.Random(2)
    texts = list(EDGES)
    shared = text_of(rng, 30)
    for size in (1, 2, 4, 5, 6, 8, 9, 12, 17, 25, 40, 70, 130, 400):
        base = text_of(rng, size).split()
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
        texts.append(shared + " " + text_of(rng, size))  # a passage many documents share
    texts = [t.title() if t and rng.random() < 0.3 else t for t in texts]
    docs = make_docs(texts, clash=True, ids=[*range(len(texts) - 2), 5, None])
    got = jaccard.similarity_classes(docs, bucket_bytes=1 << 12)
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == want
    one = jaccard.keep_one(docs)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect() if r.doc_id is not None} == {c for k, n, c in want if c is not None}
    assert jaccard.similarity_classes(docs.filter("false")).count() == 0


def test_near_copy_goes_though_its_id_leads_elsewhere(spark, make_docs):
    rng = random.Random(21)
    a, b, c = (text_of(rng, 60, 10**6) for _ in range(3))
    docs = make_docs([a, a + " more", b, b, c, "", None], ids=[1, 5, 5, 5, None, 7, 7], clash=True)
    got = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, a), (5, b), (None, c), (7, ""), (7, None)], key=str)


def test_signatures_share_for_every_similar_pair():
    """The guarantee of the signatures alone, for sets at the similarity limit, with and without common shingles."""
    rng = np.random.default_rng(3)
    for trial in range(400):
        n = int(rng.integers(4, 300))
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        extra = n // 3  # n / (n + extra) >= 3/4
        cut = int(rng.integers(0, extra + 1))
        new = rng.integers(0, 2**63, extra).astype(np.uint64)
        sets = [np.unique(np.concatenate([both, new[:cut]])), np.unique(np.concatenate([both, new[cut:]]))]
        often = np.sort(rng.choice(both, int(rng.integers(0, n)), replace=False)) if trial % 2 else np.empty(0, np.uint64)
        sig, row = jaccard.signatures(np.concatenate(sets), np.cumsum([0, len(sets[0]), len(sets[1])]), often)
        assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())
        assert len(sig) < 4 * sum(map(len, sets)) + 20


def test_group_batches_are_joined_across_batch_edges():
    import pyarrow as pa
    rng = np.random.default_rng(4)
    g = np.sort(rng.integers(0, 9, 200))
    h = np.arange(200)
    bits = [b"\0" * 8] * 200
    table = pa.table([g, h, np.full(200, 10), h, pa.array(bits, pa.binary())], names=["g", "h", "n", "root", "b"])
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if g[i] == g[j]}
    for size in (1, 7, 200):
        got = {tuple(map(int, p)) for b in jaccard._across(iter(table.to_batches(size))) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
        assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 100), (7, 7), (None, 3), (200, 201), (202, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 50, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- 3 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("block_tokens", [1, 3, 1000])
def test_token_counts(spark, make_docs, block_tokens):
    import tiktoken
    rng = random.Random(5)
    texts = [None, "", "One", "Ein Wörtchen <|endoftext|>"] + [text_of(rng, rng.randrange(1, 30)) for _ in range(8)]
    docs = make_docs(texts, clash=True, ids=[*range(len(texts) - 2), 3, None])
    enc = tiktoken.Encoding("t", pat_str=token_scan.PATTERN, mergeable_ranks=token_scan.read_vocabulary(), special_tokens={})
    got = token_scan.token_counts(docs, block_tokens=block_tokens, file_bytes=200)
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=str) == \
        sorted(((r.doc_id, len(enc.encode_ordinary(r.text or ""))) for r in docs.collect()), key=str)
    assert token_scan.token_counts(docs.filter("false")).count() == 0


def test_scan_of_files_cut_anywhere(spark):
    rng = random.Random(6)
    for tail in (0, 4):
        counts = [rng.choice([0, 1, 2, 9]) for _ in range(12)]
        flat = np.array([t for c in counts for t in [*[5] * c, 7]] + [5] * tail, dtype=np.uint16)
        for size in (1, 2, 5, 100):
            rows = [("f", i, bytearray(flat[c:c + size].tobytes())) for i, c in enumerate(range(0, len(flat), size))]
            got = token_scan.scan(spark.createDataFrame(rows, "file string, block long, tokens binary"), 7).orderBy("seq").collect()
            assert [r.n_tokens for r in got] == counts + [tail] * (tail > 0)


# ---- 4 ------------------------------------------------------------------------------------

def test_quality_learns_without_negatives(spark, make_docs):
    rng = random.Random(7)
    good = [text_of(rng, 60) + ". " + text_of(rng, 30) + "." for _ in range(300)]
    bad = [" ".join(w + "***" for w in text_of(rng, 80).split()) for _ in range(60)]
    texts = good + bad + EDGES
    docs = make_docs(texts, clash=True, ids=[*range(len(texts) - 1), None])
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(0, 360, 2)] + [(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    got = quality_pu.score_table(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    judged = [(r.predicted, int(r.doc_id < 300)) for r in got if r.doc_id is not None and r.doc_id < 360]
    assert np.mean([p == q for p, q in judged]) > 0.97
    assert quality_pu.keep_good(docs, labels).columns == docs.columns
    assert {r.score for r in quality_pu.score_table(docs, labels.filter("false")).collect()} == {1.0}
    assert quality_pu.score_table(docs.filter("false"), labels).count() == 0


def test_quality_cut_follows_the_labels(spark, make_docs):
    """Far more good rows than the labels say, and a fit on a part of the rows: no good row is rejected for that."""
    rng = random.Random(71)
    good = [text_of(rng, 60) + ". " + text_of(rng, 30) + "." for _ in range(600)]
    bad = [" ".join(w + "***" for w in text_of(rng, 80).split()) for _ in range(60)]
    docs = make_docs(good + bad)
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(i, 0) for i in range(600, 660)], "doc_id long, quality int")
    for rows in (100, 20_000):
        got = quality_pu.score_table(docs, labels, fit_rows=rows).collect()
        assert np.mean([r.predicted == int(r.doc_id < 600) for r in got]) > 0.97


# ---- 5 ------------------------------------------------------------------------------------

def test_poisson_replication(spark, make_docs):
    texts = [text_of(random.Random(i), 5 + i % 7) for i in range(600)] + EDGES
    docs = make_docs(texts, clash=True, sources=["a", "b", None], ids=[*range(len(texts) - 1), None])
    weights = {"a": 3.0, "b": 1.0}
    rates = {r.source: r.rate for r in mixing.rates(docs, weights=weights).collect()}
    size = collections.Counter()
    for r in docs.collect():
        size[r.source] += len(r.text or "")
    total = sum(size.values())
    assert all(math.isclose(rates[s], weights.get(s, 0) / 4 * total / size[s]) for s in size)
    got = mixing.replicate(docs, weights=weights, with_details=True).collect()

    def copies(key, rate):
        u = int(hashlib.md5(f"5:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        below = p
        while below <= u:
            k += 1
            p *= rate / k
            below += p
        return k
    want = collections.Counter({(r.doc_id, c): 1 for r in docs.collect() for c in range(1, copies(r.doc_id, rates[r.source]) + 1)})
    assert collections.Counter((r.doc_id, r.copy) for r in got) == want
    assert mixing.replicate(docs, weights=weights).columns == docs.columns
    assert mixing.replicate(docs.filter("false")).count() == 0


def test_large_rate(spark):
    r = mixing.poisson_tables(spark.createDataFrame([("a", 2000.0), ("b", 0.0)], "source string, rate double")).collect()
    cdf = {x.source: x.cdf for x in r}
    assert cdf["b"][0] == 1.0 and abs(cdf["a"][-1] - 1) < 1e-9 and 1950 < next(i for i, c in enumerate(cdf["a"]) if c > 0.5) < 2050


# ---- 6 ------------------------------------------------------------------------------------

def test_site_lines(spark):
    rows = [(i, f"http://User@A.example:80/{i}", f"<p>Menu</p><p>own {i}</p><p>seldom {i % 9}</p>") for i in range(30)]
    rows += [(100 + i, "https://b.example/x", f"<p>Menu</p><script>own</script><b>{i}</b>") for i in range(4)]
    rows += [(300, "https://c.example/x", "<p>Menu</p><p>Menu</p>")]  # one page is no site
    rows += [(200, None, "<p>Menu</p>"), (201, "no url", None), (None, "http://a.example", ""), (3, "http://a.example/3", "<p>Menu</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS pages", "'y' AS line", "'z' AS n")
    from pyspark.sql import functions as F
    got = {(r.page_id, r.url): (r.host, r.n_lines, r.n_dropped, r.text) for r in
           site_lines.drop_site_lines(pages, site_lines.html_lines(F.col("html"))).collect()}
    assert len(got) == len(rows)
    assert got[(7, "http://User@A.example:80/7")] == ("a.example", 3, 2, "own 7") or got[(7, "http://User@A.example:80/7")][3] == "own 7\nseldom 7"
    assert got[(100, "https://b.example/x")] == ("b.example", 2, 1, "0")  # four pages are enough for a verdict
    assert got[(300, "https://c.example/x")] == ("c.example", 2, 0, "Menu\nMenu")
    assert got[(200, None)] == (None, 1, 0, "Menu") and got[(201, "no url")][3] == ""
    assert got[(3, "http://a.example/3")][3] == "" and got[(None, "http://a.example")][3] == ""


# ---- 7 ------------------------------------------------------------------------------------

def test_repeated_passages_go(spark, make_docs):
    rng = random.Random(8)
    passages = [text_of(rng, 70, 10**6) for _ in range(6)]
    short = text_of(rng, 12, 10**6)  # a license line
    texts = EDGES + [text_of(rng, 60, 10**6) + "\n" + short + "\n" + text_of(rng, 9, 10**6) + " " + p + " é" + text_of(rng, 60, 10**6) for p in passages for _ in range(5)]
    docs = make_docs(texts, clash=True, ids=[*range(len(texts) - 1), None])
    got = chunk_dedup.dedup_substrings(docs).collect()
    assert len(got) == len(texts)
    for p in passages:
        windows = {" ".join(p.split()[i:i + 50]) for i in range(20)}
        assert sum(any(w in (r.text or "") for w in windows) for r in got) == 1
    assert all(short in r.text for r in got if r.doc_id is None or r.doc_id >= len(EDGES))
    assert all(r.n_removed_words <= 75 for r in got if r.doc_id is None or r.doc_id >= len(EDGES))
    assert chunk_dedup.dedup_substrings(docs.filter("false")).count() == 0


def test_repeated_passages_go_whole(spark, make_docs):
    rng = random.Random(81)
    passages = [text_of(rng, 51, 10**6) for _ in range(200)]
    own = [(text_of(rng, 30, 10**6), text_of(rng, 30, 10**6)) for _ in range(400)]
    texts = [f"{a} {passages[i % 200]} {b}" for i, (a, b) in enumerate(own)]
    got = {r.doc_id: r for r in chunk_dedup.dedup_substrings(make_docs(texts), min_words=50).collect()}
    assert all(got[i].text == t and got[i].n_removed_words == 0 for i, t in enumerate(texts[:200]))
    for i in range(200, 400):  # to the byte: no word more, no word less
        assert got[i].text.split() == (own[i][0] + " " + own[i][1]).split() and got[i].n_removed_words == 51
    assert all(r.n_removed_words == 0 for r in chunk_dedup.dedup_substrings(make_docs(texts), min_words=52).collect())


def test_chunks_resist_insertions():
    from telemetry.llm.textblocks import blocks
    import pyarrow as pa
    text = text_of(random.Random(9), 2000, 10**6)
    a, b = (set(chunk_dedup.chunks(next(blocks(pa.array([t]))))[3].tolist()) for t in (text, text[:5000] + "inserted" + text[5000:]))
    assert len(a ^ b) <= 8 and len(a) > 100


# ---- 8 ------------------------------------------------------------------------------------

def test_page_text(spark):
    page = "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie'>We use cookies.</div><article><h1>A &amp; B</h1>" \
           "<p>First  <b>bold</b>\n text.<p>To.<ul><li>One</li><li>Two</li></ul></article><div id='comments'><p>nice post</p></div><footer>&copy; me</footer>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (None, "u", "<p"), (1, "u", page), (4, "u", "<article><p>" + "word " * 30000)]
    got = page_text.text_table(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = sorted((str(r.page_id), r.text, r.n_chars) for r in got)
    assert len(texts) == 6 and all(len(t) == n for _, t, n in texts)
    assert [t for k, t, _ in texts if k == "1"] == ["A & B\nFirst bold text.\nTo.\nOne\nTwo"] * 2
    assert [t for k, t, _ in texts if k in ("2", "3", "None")] == [""] * 3
    trees = page_text.fit(spark)
    r, lost, extra, total = random.Random(10), 0, 0, 0
    for _ in range(100):  # templates that the fit has not seen
        dom = page_text.parse(page_text.template_page(r))
        found = page_text.text_blocks(dom)
        keep = page_text.decode(dom, trees.log_odds(page_text.node_features([(dom, found)])))
        assert all(keep[n.parent] for n, k in zip(dom.nodes, keep) if k and n.parent >= 0)
        for i, _, _ in found:
            if dom.nodes[i].marked is not None:
                total += 1
                lost += dom.nodes[i].marked == "1" and not keep[i]
                extra += dom.nodes[i].marked == "0" and bool(keep[i])
    assert (lost + extra) / total < 0.02


def test_left_out_end_tags_hide_nothing():
    def shown(html):
        return [t for _, t, _ in page_text.text_blocks(page_text.parse(html))]
    for head in ("<head><title>x</title>", "<head><title>x", "<title>x", "<head><title>x <b>y</title><script>1<p>2</script>", "<head><title>x</title></head>"):
        assert shown(f"<html>{head}<body><article><p>One</p><p>Two</article></body></html>") == ["One", "Two"]
    assert shown("<head><title>x</title><article><p>One") == ["One"]  # no body tag either
    for lost in ("<svg><path>", "<object data=x>", "<iframe src=x>", "<noscript>", "<template>"):
        for end in ("</article></body></html>", ""):
            assert shown(f"<body><article><p>One</p>{lost}<p>Two</p><p>Three</p>{end}") == ["One", "Two", "Three"]
        assert shown(f"<body><div><p>One</p>{lost}</div><p>Two</p><svg><g>a</svg>") == ["One", "Two"]
    for kept in ("svg", "object", "iframe", "noscript", "template"):  # closed: hidden with all that is in it
        assert shown(f"<div><p>One</p><{kept}><div><p>a<p>b</div><{kept}>c</{kept}>d</{kept}><p>Two</div>") == ["One", "Two"]
    assert shown("<p>One</p><script>a") == ["One"]


def test_share_of_like_siblings_has_no_switch():
    for n in (198, 199, 200, 400):
        dom = page_text.parse("<div>" + "<p>a</p>" * n + "<aside>b</aside></div>")
        alike = page_text.node_features([(dom, page_text.text_blocks(dom))])[:, 18]
        assert alike[-1] == 1 / (n + 1) and alike[2] == n / (n + 1)


# ---- 9 ------------------------------------------------------------------------------------

def test_line_rules(spark, make_docs):
    rng = random.Random(11)
    good = "\n".join(text_of(rng, 20) + "." for _ in range(6))
    texts = EDGES + [good, good + "\n" + good, good + "\nAll Rights Reserved", "\n".join("a | b | c | d" for _ in range(30)),
                     good.upper().replace("W", "LOUD"), good.replace(" ", "# "), "same old words " * 40]
    docs = make_docs(texts, clash=True)
    got = {r.doc_id: r for r in line_rules.rule_table(docs).collect()}
    for i, t in enumerate(texts):
        w, g = space_words(t), got[i]
        tri = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if space_words(x)]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == \
            (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        assert g.base_failed == (len(w) < 50 or 2 * len(covered) > len(w))
    n = len(EDGES)
    assert [got[n + i].kept for i in range(7)] == [True, False, True, False, False, False, False]
    cleaned = {r.doc_id: r.text for r in line_rules.clean(docs).collect()}
    assert cleaned[n + 2] == good and line_rules.clean(docs).columns == docs.columns


# ---- 10 -----------------------------------------------------------------------------------

def test_shards(spark, make_docs):
    rng = random.Random(12)
    texts = EDGES + ["copy"] * 300 + [text_of(rng, rng.randrange(1, 60)) for _ in range(600)]
    docs = make_docs(texts, clash=True, sources=["a", "b", None], ids=[*range(len(texts) - 1), None])
    got = kdshards.shard_table(docs, shards=7).collect()
    import zlib
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    bytes_, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(7)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * (max(len(t or "") for t in texts) + 16)
    assert kdshards.shard_table(docs.filter("false")).count() == 0
    few = kdshards.shard_table(docs.limit(3), shards=40).collect()
    assert len(few) == 3 and all(0 <= r.shard < 40 for r in few)
    target = kdshards.shard_table(docs, target_bytes=20_000).collect()
    assert len({r.shard for r in target}) == -(-sum(r.size for r in got) // 20_000)
