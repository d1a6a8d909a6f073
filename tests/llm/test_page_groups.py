"""Pages are scored in groups: the grouping must not be seen, nor what else a table holds."""

import random

import numpy as np
import pytest

from telemetry.llm import page_text as P


@pytest.fixture(scope="module")
def trees(spark):
    return P.fit(spark, pages=60, rounds=6)


def test_groups_do_not_change_texts(trees, monkeypatch):
    r = random.Random(8)
    pages = [None, "", "<p>", "plain", "<div>" * 50] + [P.template_page(r) for _ in range(40)] + ["<main>" + "<p>long text. " * 5000]
    whole = list(P.main_texts(pages, trees))
    monkeypatch.setattr(P, "GROUP_CHARS", 1)
    assert list(P.main_texts(pages, trees)) == whole == [P.main_text(h, trees) for h in pages]


def test_dense_trees_follow_the_nodes():
    """Full trees evaluated level by level against walking them."""
    rng = np.random.default_rng(0)
    forest = P.Trees(rng.integers(0, 5, (4, 7)), rng.normal(size=(4, 7)), rng.normal(size=(4, 8)), rng.random(4))
    x = rng.normal(size=(50, 5))

    def walk(k, row):
        at = 0
        while at < 7:
            at = 2 * at + 1 + (row[forest.feature[k, at]] > forest.threshold[k, at])
        return forest.value[k, at - 7]
    want = [2 * sum(forest.weight[k] * walk(k, row) for k in range(4)) for row in x]
    assert np.allclose(forest.log_odds(x), want)


def test_subtree_sums():
    dom = P.parse("<div><p>ab.</p><ul><li>c1</li><li></li></ul></div><p>x</p>")
    features = P.node_features([(P.parse("<p>q</p>"), []), (dom, P.text_blocks(dom))])[2:]
    names = [n.tag for n in dom.nodes]
    chars = dict(zip(range(len(names)), np.expm1(features[:, 0]).round().astype(int).tolist()))
    assert names == ["#page", "div", "p", "ul", "li", "li", "p"]
    assert chars == {0: 6, 1: 5, 2: 3, 3: 2, 4: 2, 5: 0, 6: 1}
    assert features[3, 8] == 0.5  # a digit among two characters


def test_empty_table_and_clashing_names(spark, trees):
    pages = spark.createDataFrame([(1, "u", "<article><p>Text of it.</p></article>"), (None, None, None)],
                                  "page_id long, url string, html string")
    for c in ("text", "n_chars", "_html", "node", "score"):
        pages = pages.selectExpr("*", f"'x' AS {c}")
    got = P.add_text(pages, trees)
    rows = {r["page_id"]: r for r in got.collect()}
    assert set(got.columns) == set(pages.columns) and rows[None]["text"] == "" and rows[1]["_html"] == "x"
    out = P.add_text(pages.limit(0), trees)
    assert out.count() == 0
