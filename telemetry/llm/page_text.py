"""Main text of HTML pages: gradient-boosted trees over DOM nodes with hierarchical decoding.

Every page is parsed into its block elements (inline elements belong to the block around
them). A node is described by its subtree (text, links, punctuation, density), its attribute
tokens, its depth, its place among its siblings and their text, and what stands above it. Boosted trees
score how likely it holds main text. Decoding goes over the tree: a subtree is either left
out as a whole, or its root is kept and its children are decided in turn, whichever has the
higher sum of log odds; so nothing is kept below a node that is left out.

The trees are fitted here, with Spark's ``GBTClassifier`` on ``FIT_PAGES`` pages drawn from
templates with known main parts (``template_page``): a fixed, bounded number, independent
of the pages to extract from.

Output: character references decoded, white space within a block made one space, blocks
trimmed and joined in page order by one newline; empty blocks vanish, nothing else is cut.

Edge cases: a null or empty page, and one without main text, gives an empty text. Broken
markup (unclosed or crossing tags, a page cut short) is read as far as it goes: the head ends
with what cannot stand in it, and an element whose content is not shown (``HIDDEN``) hides
nothing if an element around it, or the page, ends before its own end tag; an unclosed title,
script or style hides its text up to the next tag (a script or style without end tag reads
no tags, as in browsers). Rows are
extracted one by one, so repeated rows, ties and null ids are kept as they are; further
columns are carried along (``add_text`` replaces a column of the result's name). One
narrow pass; pages are scored in groups of ``GROUP_CHARS`` characters, so memory is bounded by a
group or the longest page.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIT_PAGES = 500

#: Element names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template title svg iframe object".split())
#: Of these, the ones whose text is no text of the page even without their end tags.
NO_TEXT = frozenset("script style title".split())
FURNITURE = frozenset("nav footer header aside form menu dialog button select textarea".split())
MAIN = frozenset("article main".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
#: What an opening tag closes if it stands innermost, in this order.
CLOSERS = {tag: [closer for closer, among in (("p", CLOSES_P), ("li", {"li"}), ("dt", {"dt", "dd"}), ("dd", {"dt", "dd"}),
                                              ("td", {"td", "th", "tr"}), ("th", {"td", "th", "tr"}), ("tr", {"tr"}), ("option", {"option"}))
                 if tag in among] for tag in CLOSES_P | {"li", "dt", "dd", "td", "th", "tr", "option"}}
#: Parts of class, id and role tokens.
BAD_TOKENS = ("nav", "menu", "foot", "header", "masthead", "banner", "sidebar", "side", "widget", "cookie", "consent",
              "notice", "popup", "modal", "ad", "ads", "advert", "promo", "sponsor", "share", "social", "related",
              "recommend", "breadcrumb", "login", "signup", "subscribe", "newsletter", "search", "copyright", "legal", "tags", "pager", "toolbar")
GOOD_TOKENS = ("article", "content", "main", "post", "entry", "story", "body", "text", "prose")
TALK_TOKENS = ("comment", "comments", "reply", "replies", "discuss", "disqus", "feedback", "reviews")


#: A tag that the end of the page cuts short.
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*$")
_ASCII = re.compile("[\x00-\x7f]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...] = ()
    marked: str | None = None
    children: list[int] = field(default_factory=list)


class Dom(HTMLParser):
    """Block elements in document order and text pieces (node, inside a link, text); None marks a block edge."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1, 0)]
        self.open = [0]
        self.links = 0
        self.inputs: list[int] = []
        self.pieces: list[tuple[int, bool, str] | None] = []
        self.events: list[tuple[str, str | None, list | None]] = []  # (text), (end tag) or (start tag, attributes)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append(("", tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append(("", tag, attrs))
        if tag not in VOID and tag not in INLINE:
            self.events.append(("", tag, None))

    def handle_endtag(self, tag: str) -> None:
        self.events.append(("", tag, None))

    def handle_data(self, data: str) -> None:
        self.events.append((data, None, None))

    def hidden_ends(self) -> dict[int, int]:
        """The end tag of each hidden element that is closed before the elements around it end (places in ``events``)."""
        ends: dict[int, int] = {}
        stack: list[tuple[str, int]] = []
        count: dict[str, int] = {}
        for i, (_, tag, attrs) in enumerate(self.events):
            if tag is None or tag in INLINE or tag in VOID or tag == "head":
                continue
            if attrs is not None:
                stack.append((tag, i))
                count[tag] = count.get(tag, 0) + 1
            elif count.get(tag):
                while True:
                    name, at = stack.pop()
                    count[name] -= 1
                    if name == tag:
                        break
                if tag in HIDDEN:
                    ends[at] = i
        return ends

    def build(self) -> None:
        """Nodes and pieces from the events."""
        ends = self.hidden_ends() if any(tag in HIDDEN for _, tag, _ in self.events) else {}
        resume, mute = 0, False
        for i, (data, tag, attrs) in enumerate(self.events):
            if i < resume:
                continue
            if tag is None:
                if not mute:
                    self.pieces.append((self.open[-1], self.links > 0, data))
                continue
            mute = False
            if tag in HIDDEN:
                resume = ends.get(i, -1) + 1
                mute = attrs is not None and tag in NO_TEXT and not resume
            elif tag == "head":
                continue
            elif attrs is None:
                self.end(tag)
            else:
                self.start(tag, attrs)
        self.events = []

    def start(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.pieces.append((self.open[-1], False, " "))
        if tag == "a":
            self.links += 1
        if tag in ("input", "button", "select", "textarea"):
            self.inputs.append(self.open[-1])
        if tag in INLINE or tag in VOID and tag != "hr":
            return
        self.pieces.append(None)
        if tag == "hr":
            return
        self.links = 0
        for closer in CLOSERS.get(tag, ()):
            if self.nodes[self.open[-1]].tag == closer:
                self.open.pop()
        given = dict(attrs)
        words = " ".join(given.get(k) or "" for k in ("class", "id", "role")).lower() if given else ""
        tokens = tuple("".join(c if c.isalnum() else " " for c in words).split()) if words else ()
        node = Node(tag, self.open[-1], len(self.open), tokens, given.get("data-known"))
        self.nodes[self.open[-1]].children.append(len(self.nodes))
        self.nodes.append(node)
        self.open.append(len(self.nodes) - 1)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in INLINE or tag in VOID:
            return
        self.pieces.append(None)
        self.links = 0
        for i in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[i]].tag == tag:
                del self.open[i:]
                break


def parse(html: str | None) -> Dom:
    dom = Dom()
    dom.feed(_CUT_TAG.sub("", html or ""))
    dom.close()
    dom.build()
    return dom


def text_blocks(dom: Dom) -> list[tuple[int, str, int]]:
    """(node, text, characters in links) of each block of text, in page order."""
    out: list[tuple[int, str, int]] = []
    at, parts, linked = -1, [], 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((at, text, min(linked, len(text))))
    for piece in [*dom.pieces, None]:
        if piece is None or piece[0] != at:
            flush()
            parts, linked = [], 0
        if piece is None:
            at = -1
            continue
        at = piece[0]
        parts.append(piece[2])
        linked += len(piece[2].strip()) if piece[1] else 0
    return out


@functools.lru_cache(maxsize=1 << 14)
def _hits(tokens: tuple[str, ...]) -> tuple[int, int, int]:
    """How many tokens are, or for longer words hold, one of the bad, good and talk words."""
    return tuple(sum(any(t == w or (len(w) > 4 and w in t) for w in words) for t in tokens)
                 for words in (BAD_TOKENS, GOOD_TOKENS, TALK_TOKENS))


def _digits(text: str) -> int:
    rest = 0 if text.isascii() else sum(map(str.isdigit, _ASCII.sub("", text)))
    return rest + sum(map(text.count, "0123456789"))


@functools.lru_cache(maxsize=1 << 12)
def _kinds(tag: str) -> tuple[bool, ...]:
    return (tag in FURNITURE, tag in MAIN, tag == "p", tag in ("li", "ul", "ol"), tag in ("div", "section"),
            tag in ("h1", "h2", "h3", "h4", "h5", "h6"), tag in ("#page", "html", "body"),
            tag in ("blockquote", "pre", "td", "tr", "table", "tbody"))


Texts = list[tuple[int, str, int]]


def node_features(pages: list[tuple[Dom, Texts]]) -> np.ndarray:
    """One row of features per node of the pages, page after page.

    The nodes of all pages are one forest of arrays; sums over subtrees and what stands above a
    node go level by level.
    """
    sizes = [len(dom.nodes) for dom, _ in pages]
    first = np.cumsum([0, *sizes])
    n = int(first[-1])
    own = np.zeros((n, 8))  # chars, link chars, stops, blocks, words, chars in p, chars in li, digits
    begin, inputs = np.zeros(n), np.zeros(n)
    parent, depth = np.empty(n, np.int64), np.empty(n, np.int64)
    codes: dict[str, int] = {}
    code = np.empty(n, np.int64)
    hits = np.empty((n, 3))
    for (dom, texts), base, size in zip(pages, first.tolist(), sizes):
        end = base + size
        parent[base:end] = [base + node.parent for node in dom.nodes]
        depth[base:end] = [node.depth for node in dom.nodes]
        code[base:end] = [codes.setdefault(node.tag, len(codes)) for node in dom.nodes]
        hits[base:end] = [_hits(node.tokens) for node in dom.nodes]
        np.add.at(inputs, [base + i for i in dom.inputs], 1)
        seen = 0
        for i, text, linked in texts:
            tag, length = dom.nodes[i].tag, len(text)
            own[base + i] += (length, linked, sum(map(text.count, ".,;:!?")), 1, text.count(" ") + 1,
                              length * (tag == "p"), length * (tag == "li"), _digits(text))
            begin[base + i] = begin[base + i] or seen
            seen += length
    root = np.repeat(first[:-1], sizes)
    parent[first[:-1]] = first[:-1]
    kinds = np.array([_kinds(tag) for tag in codes], dtype=float).reshape(-1, 8)[code]

    # children of one parent stand together, in page order
    child = np.argsort(parent, kind="stable")
    child = child[parent[child] != child]
    above = parent[child]
    starts = np.r_[True, above[1:] != above[:-1]] if len(child) else np.zeros(0, bool)
    is_first = np.zeros(n, bool)
    is_first[child[starts]] = True
    family = np.bincount(above, minlength=n)[parent] * (depth > 0)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 1)))[1:]

    total, below = own.copy(), np.ones(n)
    for level in reversed(levels):
        up_to = parent[level]
        np.add.at(total, up_to, total[level])
        np.add.at(below, up_to, below[level])
        np.add.at(inputs, up_to, inputs[level])
        has_text = own[up_to, 0] > 0
        np.minimum.at(begin, up_to[has_text], begin[level[has_text]])
        lead = level[~has_text & is_first[level]]
        begin[parent[lead]] = begin[lead]
    flags = np.concatenate([hits > 0, kinds[:, :2]], axis=1)
    up = np.zeros((n, 5))
    for level in levels:
        up[level] = up[parent[level]] + flags[parent[level]]

    place, around, before, after, alike = (np.zeros(n) for _ in range(5))
    weight = np.log1p(total[:, 0])
    if len(child):
        count = family[child]
        at = np.arange(len(child))
        place[child] = (at - np.maximum.accumulate(np.where(starts, at, 0))) / count
        around[child] = (np.bincount(above, weight[child], minlength=n)[above] - weight[child]) / np.maximum(1, count - 1)
        before[child[1:]] = np.where(starts[1:], 0, weight[child[:-1]])
        after[child[:-1]] = np.where(starts[1:], 0, weight[child[1:]])
        _, same, times = np.unique(above * len(codes) + code[child], return_inverse=True, return_counts=True)
        alike[child] = times[same] / count
    chars = np.maximum(total[:, 0], 1)
    whole = np.maximum(1.0, total[root, 0])
    return np.column_stack([
        weight, total[:, 1] / chars, 100 * total[:, 2] / chars, np.log1p(below), np.log1p(total[:, 0] / below),
        total[:, 4] / np.maximum(total[:, 3], 1), total[:, 5] / chars, total[:, 6] / chars, total[:, 7] / chars,
        total[:, 0] / whole, begin / whole, np.log1p(inputs),
        depth, place, np.log1p(family), around, before, after, alike,
        hits, kinds[:, :2], up, kinds[:, 2:]])


# ---- training pages -----------------------------------------------------------------------

def template_page(r: random.Random) -> str:
    """A page of a random template; ``data-known`` marks main parts (1) and the rest (0)."""
    syllables = ["".join(r.choice("aeioubcdfghlmnprstäéñ") for _ in range(r.randint(1, 3))) for _ in range(40)]

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(r.randint(lo, hi)))

    def sentence(lo: int, hi: int) -> str:
        return words(lo, hi).capitalize() + r.choice([".", ".", ".", "!", "?", ""])

    def links(lo: int, hi: int) -> str:
        return "".join(f"<li data-known=0><a href='/{i}'>{words(1, 3)}</a></li>" for i in range(r.randint(lo, hi)))

    def attrs(kinds: list[str]) -> str:
        k = r.choice(kinds)
        return r.choice([f'class="{k}"', f'id="{k}"', f'class="{k} x{r.randint(1, 99)}"', f'role="{k}"'])

    def junk(place: str) -> str:
        kind = r.choice({
            "top": ["nav", "navdiv", "header", "ad", "notice", "login", "crumbs", "search"],
            "side": ["aside", "sidebar", "ad", "related", "newsletter"],
            "in": ["ad", "ad", "share", "related", "aside", "newsletter"],
            "end": ["footer", "footdiv", "comments", "comments", "related", "notice", "ad", "newsletter"]}[place])
        small = r.choice([(1, 6), (4, 15), (10, 40)])
        return {
            "nav": lambda: f"<nav data-known=0><ul data-known=0>{links(2, 9)}</ul></nav>",
            "navdiv": lambda: f"<div data-known=0 {attrs(['menu', 'topnav', 'main-menu', 'navbar'])}><ul data-known=0>{links(2, 9)}</ul></div>",
            "header": lambda: f"<header data-known=0><div data-known=0>{words(1, 5)}</div><p data-known=0>{sentence(2, 10)}</p></header>",
            "ad": lambda: f"<div data-known=0 {attrs(['ad', 'ads', 'advert', 'ad-slot', 'sponsored', 'promo-box'])}>{sentence(*small)}</div>",
            "notice": lambda: f"<div data-known=0 {attrs(['cookie-notice', 'cookie', 'consent', 'notice', 'popup'])}><p data-known=0>{sentence(*small)}</p><button>{words(1, 2)}</button></div>",
            "login": lambda: f"<form data-known=0><label>{words(1, 3)}</label><input><input><button>{words(1, 1)}</button></form>",
            "search": lambda: f"<form data-known=0 {attrs(['search', 'searchbox'])}><p data-known=0>{words(1, 4)}</p><input></form>",
            "crumbs": lambda: f"<div data-known=0 {attrs(['breadcrumb', 'breadcrumbs'])}><a href='/'>{words(1, 1)}</a> &gt; <a href='/b'>{words(1, 2)}</a></div>",
            "aside": lambda: f"<aside data-known=0><h3 data-known=0>{words(1, 4)}</h3><p data-known=0>{sentence(*small)}</p><ul data-known=0>{links(0, 5)}</ul></aside>",
            "sidebar": lambda: f"<div data-known=0 {attrs(['sidebar', 'side-column', 'widget'])}><div data-known=0>{sentence(*small)}</div><ul data-known=0>{links(0, 6)}</ul></div>",
            "related": lambda: f"<div data-known=0 {attrs(['related', 'related-posts', 'recommended'])}><h3 data-known=0>{words(1, 3)}</h3><ul data-known=0>{links(1, 6)}</ul></div>",
            "share": lambda: f"<div data-known=0 {attrs(['share', 'social', 'share-buttons'])}><a href='#'>{words(1, 1)}</a> <a href='#'>{words(1, 1)}</a></div>",
            "newsletter": lambda: f"<div data-known=0 {attrs(['newsletter', 'subscribe', 'signup'])}><p data-known=0>{sentence(3, 12)}</p><form data-known=0><input><button>{words(1, 1)}</button></form></div>",
            "footer": lambda: f"<footer data-known=0>{r.choice(['', '&copy; '])}{sentence(*small)}{r.choice(['', '<p data-known=0>' + sentence(2, 12) + '</p>'])}</footer>",
            "footdiv": lambda: f"<div data-known=0 {attrs(['footer', 'footer-links', 'legal', 'copyright'])}><p data-known=0>{sentence(*small)}</p></div>",
            "comments": lambda: f"<{(t := r.choice(['section', 'div', 'ol']))} data-known=0 {attrs(['comments', 'comment-list', 'replies', 'disqus'])}>"
            + "".join(f"<div data-known=0 class='{r.choice(['comment', 'reply', 'item'])}'><p data-known=0>{sentence(2, 60)}</p></div>" for _ in range(r.randint(1, 6))) + f"</{t}>",
        }[kind]()

    def body_part() -> str:
        kind = r.random()
        if kind < 0.72:
            size = r.choice([(1, 2), (1, 8), (5, 30), (20, 120), (60, 250)])
            text = " ".join(sentence(max(1, s // 2), s) for s in [min(size[1], 18)] * max(1, size[1] // 18))
            if r.random() < 0.1:
                text = text.replace(" ", r.choice([" | ", "*** ", "!! ", " "]))
            if r.random() < 0.15:
                text = f"<a href='/x'>{words(1, 3)}</a> " + text
            return r.choice([f"<p data-known=1>{text}</p>", f"<p data-known=1>{text}</p>", f"<p data-known=1><b>{text}<br>", f"<p data-known=1>{text}",
                             f"<div data-known=1>{text}</div>"])
        if kind < 0.82:
            return f"<{(h := r.choice(['h2', 'h3', 'h4']))} data-known=1>{words(1, 8)}</{h}>"
        if kind < 0.92:
            return "<ul data-known=1>" + "".join(f"<li data-known=1>{sentence(1, 25)}</li>" for _ in range(r.randint(1, 6))) + "</ul>"
        return f"<blockquote data-known=1><p data-known=1>{sentence(3, 40)}</p></blockquote>"

    parts = []
    for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
        parts.append(body_part())
        if r.random() < 0.08:
            parts.append(junk("in"))
    title = r.choice([f"<h1 data-known=1>{words(1, 10)}</h1>", f"<h1 data-known=1>{words(1, 10)}</h1>", f"<h1 data-known=1>{words(1, 10)}</h1>", ""])
    inner = title + "".join(parts) + (junk("end") if r.random() < 0.15 else "")
    if r.random() < 0.25:
        inner = f"<div data-known=1 {attrs(['body', 'text', 'inner', 'entry-content'])}>{inner}</div>"
    box = r.choice(["article", "article", "main", "div", "section"])
    known = attrs(["content", "post", "article-body", "story", "main", "entry", "main-content"]) if box in ("div", "section") or r.random() < 0.3 else ""
    core = f"<{box} data-known=1 {known}>{inner}</{box}>"
    if r.random() < 0.3:
        core = f"<div data-known=1 {attrs(['wrapper', 'page', 'container', 'row'])}>{junk('side') if r.random() < .4 else ''}{core}{junk('side') if r.random() < .5 else ''}</div>"
    top = "".join(junk("top") for _ in range(r.randint(0, 3)))
    end = "".join(junk("end") for _ in range(r.randint(0, 3)))
    tail = r.choice(["</body></html>", "</body></html>", ""])
    return f"<!DOCTYPE html><html data-known=1><head><title>{words(1, 8)}</title><script>var a='<p>';</script></head><body data-known=1>{top}{core}{end}{tail}"


def training_rows(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = random.Random(seed)
    read = [(dom, text_blocks(dom)) for dom in (parse(template_page(r)) for _ in range(pages))]
    marks = [node.marked for dom, _ in read for node in dom.nodes]
    known = np.array([m is not None for m in marks])
    return node_features(read)[known], np.array([float(m == "1") for m in marks if m is not None])


@dataclass
class Trees:
    """Boosted trees of one depth as full binary trees, node i above 2 i + 1 and 2 i + 2: a row of arrays per tree.

    A value at most the threshold goes left. Log odds are twice the weighted sum of the leaves.
    """

    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray      # trees x leaves
    weight: np.ndarray     # trees

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        inner = self.feature.shape[1]
        x = np.ascontiguousarray(x)
        flat, row = x.ravel(), np.arange(len(x)) * x.shape[1]
        for feature, threshold, value, weight in zip(self.feature, self.threshold, self.value, self.weight):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (flat[row + feature[at]] > threshold[at])
            out += weight * value[at - inner]
        return 2 * out


def fit(spark: SparkSession, pages: int = FIT_PAGES, seed: int = 3, rounds: int = 15, depth: int = 4) -> Trees:
    """Fit Spark's boosted trees on template pages and take their nodes as arrays."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors
    x, y = training_rows(pages, seed)
    rows = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"]).coalesce(2)
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=64).fit(rows)
    trees = len(model.trees)
    inner = (1 << depth) - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), np.array(model.treeWeights))
    for k, tree in enumerate(model.trees):
        def walk(node, at: int) -> None:
            if at >= inner:
                out.value[k, at - inner] = node.prediction()
            elif node.subtreeDepth() > 0:
                out.feature[k, at], out.threshold[k, at] = node.split().featureIndex(), node.split().threshold()
                walk(node.leftChild(), 2 * at + 1)
                walk(node.rightChild(), 2 * at + 2)
            else:  # an early leaf: everything goes left from here
                walk(node, 2 * at + 1)
        walk(tree._java_obj.rootNode(), 0)
    return out


# ---- extraction ---------------------------------------------------------------------------

def decode(dom: Dom, odds: np.ndarray) -> np.ndarray:
    """Kept nodes: the choice of highest total log odds in which nothing is kept below a node left out."""
    best = odds.copy()
    for i in range(len(dom.nodes) - 1, 0, -1):
        best[dom.nodes[i].parent] += max(0.0, best[i])
    keep = best > 0
    for i in range(1, len(dom.nodes)):
        keep[i] &= keep[dom.nodes[i].parent]
    return keep


#: Characters of markup whose pages are scored together.
GROUP_CHARS = 1 << 21


def main_texts(htmls: Iterable[str | None], trees: Trees) -> Iterator[str]:
    """The main text of every page, in order; pages are scored in groups of bounded size."""
    group: list[tuple[Dom, Texts]] = []
    held = 0

    def texts() -> Iterator[str]:
        odds = trees.log_odds(node_features(group))
        first = 0
        for dom, blocks in group:
            last = first + len(dom.nodes)
            keep = decode(dom, odds[first:last])
            yield "\n".join(t for i, t, _ in blocks if keep[i])
            first = last
    for html in htmls:
        dom = parse(html)
        group.append((dom, text_blocks(dom)))
        held += len(html or "")
        if held >= GROUP_CHARS:
            yield from texts()
            group, held = [], 0
    if group:
        yield from texts()


def main_text(html: str | None, trees: Trees) -> str:
    return next(main_texts([html], trees))


def add_text(pages: DataFrame, trees: Trees, html: str = "html", result: str = "text") -> DataFrame:
    """``pages`` with the main text of every page."""
    df = pages.withColumn(result, F.lit(""))
    at, out = df.columns.index(html), df.columns.index(result)
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(main_texts((h.as_py() for h in batch.column(at)), shared.value))
            yield batch.set_column(out, batch.schema.field(out), pa.array(texts, pa.string()))
    return df.mapInArrow(run, df.schema)


def text_table(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points)."""
    trees = fit(pages.sparkSession, **options)
    return add_text(pages.select(id_column, url, F.col(html).alias("_html")), trees, "_html", "text").select(
        id_column, url, "text", F.length("text").cast("long").alias("n_chars"))
