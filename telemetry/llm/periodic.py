"""Periodic runs in texts: words repeated at a fixed lag, found online on sparse diagonals.

A run is a maximal stretch of consecutive words with smallest period q (words q apart are
identical) of at least ``max(min_length, min_copies * q)`` words. On the diagonal of lag q,
the cells (t - q, t) of equal words form a stretch of matches; the run is that stretch and
the q words before it.

For each word, its earlier occurrences lengthen the matches on the diagonals of their lags,
and a diagonal that ends with sufficient length emits its run at once. Only a few diagonals
can hold a run, so only those are kept active. The word is taken at scales k = 1, 2, 4, …
together with the k - 1 words after it, and the nearest earlier place of these k words, if
its lag q lies in (k / 2, k], is the active diagonal of the scale. No run is lost: inside a
run of smallest period q <= k, k words repeat at multiples of q only, so their nearest earlier
place is q words back; at 3 q words or more and k < 2 q, such places follow each other from
the run's second period to k words before its end. Nor is any false: a smaller period would
be a nearer place. Consecutive places with equal lag are one diagonal, whose match length is
their number and k - 1 words more. Words without another place at one scale have none at
larger ones, so ordinary text is done after a few scales, and n words cost n log n at most,
whatever they repeat.

Edge cases: null, empty and blank texts have no words and no runs; texts under ``min_length``
words have no runs. Rows are read one by one: repeated rows and null ids are kept, further
columns carried along (columns of the results' names are replaced). No rows give no rows.

Scale: one narrow pass without a shuffle, memory bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_COPIES = 24, 3
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _nearest(place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Lag to the nearest earlier place of the same symbol (0: none); ``place`` ascends."""
    order = np.argsort(symbol, kind="stable")
    same = symbol[order[1:]] == symbol[order[:-1]]
    lag = np.zeros(len(place), np.int64)
    lag[order[1:][same]] = (place[order[1:]] - place[order[:-1]])[same]
    return lag


def _diagonals(place: np.ndarray, lag: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(first place, matches, lag) of the diagonals of a scale: consecutive places with one lag in (k / 2, k]."""
    active = np.flatnonzero((2 * lag > k) & (lag <= k))
    if not len(active):
        return
    t, q = place[active], lag[active]
    first = np.flatnonzero(np.r_[True, (np.diff(t) != 1) | (np.diff(q) != 0)])
    size = np.diff(np.r_[first, len(t)])
    yield from zip(t[first].tolist(), (size + k - 1).tolist(), q[first].tolist())


def runs_of(words: list, min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``min_copies`` is 3 or more."""
    if min_copies < 3:
        raise ValueError("a run holds at least three periods")
    n = len(words)
    if n < min_length:
        return []
    number: dict = {}
    symbol = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out = []
    place, k = np.arange(n), 1
    while len(place) and k // 2 + 1 <= n // min_copies:
        lag = _nearest(place, symbol)
        for t, matches, q in _diagonals(place, lag, k):
            length = matches + q
            if length >= max(min_length, min_copies * q):
                out.append((t - q, length, q))
        # k words that stand nowhere else cannot be part of 2 k words that do
        again = lag > 0
        again[np.searchsorted(place, (place - lag)[again])] = True
        at = np.full(n, -1, np.int64)
        at[place[again]] = symbol[again]
        left, right = at[:n - k], at[k:]
        place = np.flatnonzero((left >= 0) & (right >= 0))
        _, symbol = np.unique(left[place] * n + right[place], return_inverse=True)
        k *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop)[:-1] == 0
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def find_runs(docs: DataFrame, text: str = "text", runs: str = "runs", rest: str = "collapsed",
              min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES) -> DataFrame:
    """``docs`` with the runs of every whole text (by start, then period) and the text without the repeats."""
    if text in (runs, rest) or runs == rest:
        raise ValueError("the result columns must be two others than the text column")
    out = docs.withColumn(runs, F.lit(None).cast(RUNS)).withColumn(rest, F.lit(None).cast("string"))
    at, to, to_rest = (out.columns.index(c) for c in (text, runs, rest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()  # ASCII white space
                here = runs_of(words, min_length, min_copies)
                found.append([dict(zip(("start", "length", "period"), r)) for r in here])
                texts.append(collapsed(words, here).decode())
            batch = batch.set_column(to, pa.field(runs, pa.list_(_RUN)), pa.array(found, pa.list_(_RUN)))
            yield batch.set_column(to_rest, pa.field(rest, pa.string()), pa.array(texts, pa.string()))
    return out.mapInArrow(run, out.schema)


def strongest(runs: str = "runs") -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period (null: no run)."""
    def better(best: Column, r: Column) -> Column:
        ours, theirs = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (ours > theirs), r).otherwise(best)  # runs come by start, then period
    none = F.lit(None).cast(RUNS[6:-1])
    return F.aggregate(runs, none, better)


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a periodic tail written into the text of about every tenth document.

    h = crc32 of the decimal id (null: no tail), g = h div 10, of n words: if h mod 10 = 0, every
    word i >= a is replaced by word a + (i - a) mod p, a = g mod n, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = docs.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("_words", F.when(F.col("_g").isNotNull(), words))
    first = "(_g % size(_words))"
    period = f"(1L + (size(_words) - {first}) div (3L + _g % 8))"
    place = f"if(i < {first}, i, {first} + (i - {first}) % {period})"
    written = F.expr(f"array_join(transform(_words, (w, i) -> _words[int({place})]), ' ')")
    return parts.withColumn(text, F.when(F.size("_words") > 0, written).otherwise(F.col(text))).drop("_g", "_words")
