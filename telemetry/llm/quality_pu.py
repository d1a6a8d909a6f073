"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

The trusted positives are rows labelled good; the unlabelled rows are web text of any
quality, of which an estimated share ``prior`` is good. A linear model on text statistics
minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with logistic losses: the second term estimates the risk on negatives from unlabelled
minus positive rows, and when it turns negative (overfitting) the step is reversed.
Bad labels are not used as negatives in the risk; they take part in the estimate of the
prior (share of good rows among the labelled rows of the learning part) and in placing the
score: the cut lies where the fewest labelled rows of the learning part are on the wrong side,
whatever share of the corpus that rejects.

Bounds: the fit sees at most about ``FIT_ROWS`` positives and as many unlabelled rows,
chosen by a hash of the id; the prior and the cut use all labels. The cut is found in
histograms of ``BINS`` bins counted in the tasks. Scoring is one narrow pass over all
rows and whole texts, and one more over the labelled ones before it (over the learning part
if the labels are too many to be sent to all tasks; no text is shuffled).

Edge cases: a null text scores as an empty one; the score is always between 0 and 1. A
null id is never held out and has no label. Repeated label rows count as often as they
occur; a null label is no label. Without positives or unlabelled rows every score is the
prior (1 without any label). Rows are scored one by one, so repeats and ties are harmless;
further columns of the documents are kept, results are added under new names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.llm.frames import BROADCAST_ROWS, materialise, semi, small, unit_hash
from telemetry.llm.textblocks import SPACE_WORD, Block, blocks, row_counts, span_hashes, word_spans

FIT_ROWS = 20_000
CUT = 0.3
FOLDS = 5
#: Bins of a histogram of scores, and how often it is taken again around the cut.
BINS, ZOOMS = 4096, 3

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>{}[]\\^~=_@+/"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_BANG = np.zeros(256, dtype=bool)
_BANG[ord("!")] = True
_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def features(b: Block) -> np.ndarray:
    """Text statistics of each row: shares of character kinds, word shapes, repetition, lengths."""
    n = b.n
    size = np.diff(b.offsets).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(b.offsets))
    some = np.maximum(size, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask[b.data]], minlength=n) / some

    starts, ends, owner = word_spans(b, SPACE_WORD)
    words = np.maximum(row_counts(owner, n), 1).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    hashes = span_hashes(b.data, starts, ends)
    mean_len = np.bincount(owner, weights=lengths, minlength=n) / words
    long_words = np.bincount(owner[lengths > 20], minlength=n) / words
    short_words = np.bincount(owner[lengths <= 1], minlength=n) / words
    no_letter = np.bincount(owner[~_any(_LETTER, b, starts, ends)], minlength=n) / words
    with_symbol = np.bincount(owner[_any(_SYMBOL, b, starts, ends)], minlength=n) / words
    with_bang = np.bincount(owner[_any(_BANG, b, starts, ends)], minlength=n) / words
    capitals = np.cumsum(np.concatenate([[0], _CAPITAL[b.data]]))
    shout = (capitals[ends] - capitals[starts]) * 2 > np.maximum(lengths, 2)
    shouted = np.bincount(owner[shout], minlength=n) / words
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    stutter = np.bincount(owner[same], minlength=n) / words
    distinct, triples = np.ones(n), np.ones(n)
    if len(hashes):
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        kinds = np.bincount(o[new], minlength=n).astype(np.float64)
        distinct = np.log1p(kinds) / np.log1p(words)
        if len(hashes) > 2:
            t = hashes[:-2] + hashes[1:-1] * np.uint64(3) + hashes[2:] * np.uint64(7)
            inside = owner[:-2] == owner[2:]
            t, o = t[inside], owner[:-2][inside]
            order = np.lexsort((t, o))
            t, o = t[order], o[order]
            new = np.ones(len(t), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (o[1:] != o[:-1])
            triples = np.where(words > 2, np.bincount(o[new], minlength=n) / np.maximum(row_counts(o, n), 1), 1)
    ls, le, lo = word_spans(b, _LINE)
    lines = np.maximum(row_counts(lo, n), 1).astype(np.float64)
    line_words = words / lines
    closed = np.zeros(len(ls), dtype=bool)
    if len(ls):
        closed = _STOP[b.data[le - 1]] | _BANG[b.data[le - 1]]
    stat = np.stack([
        share(_LETTER), share(_CAPITAL), share(_DIGIT), share(_SYMBOL) * 10, share(_STOP) * 10, share(_BANG) * 10,
        mean_len / 10, long_words, short_words, no_letter, with_symbol, with_bang, shouted, stutter,
        distinct, triples, np.log1p(line_words) / 5, np.bincount(lo[closed], minlength=n) / lines,
        np.log1p(words) / 10, np.log1p(lines) / 10, (size == 0).astype(float)], axis=1)
    return np.concatenate([stat, stat ** 2, np.sqrt(np.abs(stat)), np.ones((n, 1))], axis=1)


def _any(mask: np.ndarray, b: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.cumsum(np.concatenate([[0], mask[b.data]]))
    return total[ends] > total[starts]


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    offset: float
    fixed: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        z = self.raw(x) - self.offset
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
        decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk with Adam on the whole sample."""
    if not len(positive) or not len(unlabelled):
        return Model(np.empty(0), np.empty(0), np.empty(0), 0.0, fixed=prior)
    mean, scale = unlabelled.mean(0), unlabelled.std(0)
    mean[-1] = 0.0
    scale = np.where(scale < 1e-9, 1.0, scale)
    p, u = np.clip((positive - mean) / scale, -8, 8), np.clip((unlabelled - mean) / scale, -8, 8)
    w, m, v = (np.zeros(p.shape[1]) for _ in range(3))

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = u.T @ sigmoid(zu) / len(u) - prior * (p.T @ sigmoid(zp)) / len(p)
        g_pos = -prior * (p.T @ sigmoid(-zp)) / len(p)
        g = (g_pos + g_neg if negative >= 0 else -g_neg) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(w, mean, scale, 0.0)


def place_cut(model: Model, labelled: DataFrame, cut: float) -> Model:
    """Shift the scores so that the fewest rows (z, good, bad) are on the wrong side of the cut; of equal
    places the widest gap."""
    if model.fixed is not None:
        return model
    lo, hi, all_bad = labelled.agg(F.min("z"), F.max("z"), F.sum("bad")).first()
    if lo is None:
        return model
    middle, good_below, bad_below = lo, 0, 0
    for _ in range(ZOOMS):
        width = (hi - lo) / BINS or 1.0
        rows = sorted(labelled.filter(F.col("z").between(lo, hi)).groupBy(F.floor((F.col("z") - lo) / width).alias("bin"))
                      .agg(F.min("z"), F.max("z"), F.sum("good"), F.sum("bad")).collect())
        low, high, good, bad = (np.array(x) for x in list(zip(*rows))[1:])
        goods, bads = good_below + np.append(0, np.cumsum(good)), bad_below + np.append(0, np.cumsum(bad))
        gap = np.concatenate([[0], low[1:] - high[:-1], [0]])
        at = int(np.lexsort((-gap, goods + all_bad - bads))[0])
        first, last = max(at - 1, 0), min(at, len(rows) - 1)
        middle = low[0] if at == 0 else np.nextafter(high[-1], np.inf) if at == len(rows) else (high[at - 1] + low[at]) / 2
        lo, hi, good_below, bad_below = float(low[first]), float(high[last]), int(goods[first]), int(bads[first])
    model.offset = float(middle - np.log(cut / (1 - cut)))
    return model


def _labelled(docs: DataFrame, known: DataFrame, n_known: int, model: Model, id_column: str, text: str, label: str) -> DataFrame:
    """(z, good, bad) of every labelled row of the learning part: raw score and labels of each kind."""
    rows = docs.filter(~held_out(F.col(id_column))).select(id_column, text)
    rows = semi(rows, known, id_column) if n_known <= BROADCAST_ROWS else rows
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [model.raw(features(b)) for b in blocks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(z) if z else np.empty(0), pa.float64())], names=["id", "z"])
    marks = known.groupBy(F.col(id_column).alias("id")).agg(F.sum((F.col(label) == 1).cast("long")).alias("good"), F.sum((F.col(label) != 1).cast("long")).alias("bad"))
    return rows.mapInArrow(run, f"id {kind}, z double").join(marks, "id").select("z", "good", "bad")


def held_out(id_column: Column) -> Column:
    """Rows kept out of learning: crc32 of the id as text is a multiple of 5 (null: learning part, unlabelled)."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _feature_rows(sample: DataFrame) -> np.ndarray:
    """Features of a bounded sample of texts, computed in the tasks and gathered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(list(features(b).astype(np.float32)), pa.list_(pa.float32()))], names=["x"])
    got = sample.mapInArrow(run, "x array<float>").toArrow().column("x").combine_chunks()
    width = 1 if not len(got) else len(got[0])
    return np.array(got.flatten(), dtype=np.float64).reshape(-1, width)


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          label: str = "quality", fit_rows: int = FIT_ROWS, cut: float = CUT, seed: int = 11) -> Model:
    """Fit on the learning part of ``labels`` (positives) and on all rows of the learning part (unlabelled)."""
    known = labels.filter(~held_out(F.col(id_column)) & F.col(label).isNotNull() & F.col(id_column).isNotNull())
    row = known.agg(F.count(F.lit(1)), F.sum((F.col(label) == 1).cast("long"))).first()
    n_known, n_good = row[0] or 0, row[1] or 0
    prior = n_good / n_known if n_known else 1.0
    n_docs = docs.count()
    draw = unit_hash(F.col(id_column), seed=seed)
    good = known.filter((F.col(label) == 1) & (draw < min(1.0, fit_rows / max(n_good, 1)))).select(id_column).distinct()
    positive = docs.select(id_column, text).join(small(good), id_column, "left_semi").select(text)
    rest = docs.filter(~held_out(F.col(id_column)) & (unit_hash(F.col(id_column), seed=seed + 1) < min(1.0, fit_rows / max(n_docs, 1)))).select(text)
    model = fit(_feature_rows(positive), _feature_rows(rest), prior)
    if model.fixed is not None:
        return model
    return place_cut(model, materialise(_labelled(docs, known, n_known, model, id_column, text, label), "labelled-scores"), cut)


def add_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (replaced if it is there): one narrow pass over whole texts."""
    df = docs.withColumn(score, F.lit(0.0))
    at, out = df.columns.index(text), df.columns.index(score)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = [m.score(features(b)) for b in blocks(batch.column(at))]
            yield batch.set_column(out, batch.schema.field(out),
                                   pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64()))
    return df.mapInArrow(run, df.schema)


def score_table(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                cut: float = CUT, **options) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = learn(docs, labels, id_column, text, cut=cut, **options)
    scored = add_score(docs.select(F.col(id_column), F.col(text).alias("_text")), model, "_text", "score")
    return scored.select(id_column, held_out(F.col(id_column)).alias("held_out"), "score",
                         F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", cut: float = CUT, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    from telemetry.llm.frames import fresh
    score = fresh("score")
    model = learn(docs, labels, text=text, cut=cut, **options)
    return add_score(docs, model, text, score).filter(F.col(score) >= cut).drop(score)
