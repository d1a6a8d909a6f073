"""Every link inside components of similar sets, counted or listed, each pair of classes once.

All links lie inside components. A component is cut into parts by size band and, where a
band is large, by hash, so that a part holds at most about ``PART_ROWS`` sets and
``PART_ELEMENTS`` elements; similar sets are in the same or in neighbouring bands. A cell is
one part, or two parts that can be similar: one row per (cell, set), each cell compared in
one task. However large a component is, a task holds two parts. A set is sent once for each
part of its own and the two neighbouring bands; a component of one part is one cell.

A cell numbers the elements that stand in two of its sets or more and in not all of them, and
compares sets as bitsets over these: the intersection is exact. Long bitsets are compared
only where the sizes and a folded parity bitmap leave it possible.

Counts leave a cell as one row per set, so no row per pair exists; ``pairs`` lists them for
callers that want the join itself. A component of two classes has its one link already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.llm.frames import attach, materialise, small

#: Similarity of linked sets as a fraction.
NUM, DEN = 3, 4
#: Sets and elements of a part: two parts are held by one task.
PART_ROWS, PART_ELEMENTS = 1 << 10, 1 << 19
#: Bits of the folded bitmap, which is used where bitsets are longer.
BRIEF_BITS = 1 << 11
#: Side of a set in its cell: of the first part, of the second, or of a part against itself.
FIRST, SECOND, ITSELF = 0, 1, 2

_U = np.uint64


def band(n: Column) -> Column:
    """Number of the size band: sizes of similar sets are at most one band apart."""
    tops, low = [], 1
    while low < 1 << 40:
        tops.append(low * DEN // NUM)
        low = tops[-1] + 1
    return F.size(F.filter(F.array(*[F.lit(t) for t in tops]), lambda t: t < n))


def cells(members: DataFrame, part_rows: int = PART_ROWS, part_elements: int = PART_ELEMENTS) -> DataFrame:
    """``members`` (h, root, n, ...) with ``cell`` and ``side``, a row for each cell a set is in."""
    whole = F.ceil(F.greatest(F.count(F.lit(1)) / part_rows, F.sum("n") / part_elements)).cast("long").alias("parts")
    large = materialise(members.groupBy("root").agg(whole).filter("parts > 1").select("root"), "large")
    banded = materialise(members.join(small(large), "root", "left_semi").withColumn("band", band(F.col("n"))), "banded")
    rest = members.join(small(large), "root", "left_anti") \
        .withColumn("cell", F.col("root").cast("string")).withColumn("side", F.lit(ITSELF))
    # per root at most one entry a band, of which there are fewer than a hundred
    parts = banded.groupBy("root", "band").agg(whole).groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("band", "parts"))).alias("parts"))
    placed = attach(banded, materialise(parts, "parts"), "root") \
        .withColumn("part", F.pmod(F.xxhash64("h"), F.element_at("parts", F.col("band"))))
    others = placed.select("*", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("other_band")) \
        .withColumn("others", F.try_element_at("parts", F.col("other_band"))).filter("others is not null") \
        .withColumn("other_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    own, other = F.struct("band", "part"), F.struct(F.col("other_band").alias("band"), F.col("other_part").alias("part"))
    low, high = F.least(own, other), F.greatest(own, other)
    cell = F.concat_ws(":", "root", low["band"], low["part"], high["band"], high["part"])
    side = F.when(own < other, FIRST).when(own > other, SECOND).otherwise(ITSELF)
    split = others.withColumn("cell", cell).withColumn("side", side).select(*members.columns, "cell", "side")
    return rest.select(*members.columns, "cell", "side").unionByName(split)


def linked(sets: list[np.ndarray], side: np.ndarray, rows: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, size of the intersection) for the linked pairs of a cell; ``sets`` are sorted and distinct."""
    m, n = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    u, owner = np.concatenate(sets), np.repeat(np.arange(m), n)
    _, local, count = np.unique(u, return_inverse=True, return_counts=True)
    everywhere = int((count == m).sum())
    numbered = (count > 1) & (count < m)
    number = np.cumsum(numbered) - 1
    take = numbered[local]
    width = -(-int(numbered.sum()) // 64)
    bits = np.zeros((m, width), dtype=_U)
    if width:
        at = number[local[take]]
        word = owner[take] * width + at // 64  # ascending: rows in turn, elements of a row sorted
        first = np.flatnonzero(np.diff(word, prepend=-1))
        bits.reshape(-1)[word[first]] = np.bitwise_or.reduceat(_U(1) << (at % 64).astype(_U), first)
    brief = None
    if width > BRIEF_BITS // 64:
        odd = np.empty((m, BRIEF_BITS // 64), dtype=_U)
        for i, s in enumerate(sets):
            parity = np.bincount((s & _U(BRIEF_BITS - 1)).astype(np.int64), minlength=BRIEF_BITS) & 1
            odd[i] = np.packbits(parity.astype(np.uint8)).view(_U)
        brief = odd
    every = np.arange(m)
    step = max(1, (1 << 21) // max(width, 1))
    for lo in range(0, m, rows):
        i = every[lo:lo + rows]
        may = (i[:, None] < every) & (NUM * n[i][:, None] <= DEN * n) & (NUM * n <= DEN * n[i][:, None]) \
            & ((side[i][:, None] != side) | (side[i][:, None] == ITSELF))
        if brief is not None:
            may &= 7 * np.bitwise_count(brief[i][:, None] ^ brief).sum(2, dtype=np.int64) <= n[i][:, None] + n
        x, y = np.nonzero(may)
        x += lo
        for a in range(0, len(x), step):
            p, q = x[a:a + step], y[a:a + step]
            both = everywhere + np.bitwise_count(bits[p] & bits[q]).sum(1, dtype=np.int64)
            ok = DEN * both >= NUM * (n[p] + n[q] - both)
            if ok.any():
                yield p[ok], q[ok], both[ok]


def _compare(batches: Iterator[pa.RecordBatch], of_cell) -> Iterator[pa.RecordBatch]:
    """``of_cell(h, copies, sets, side)`` for each cell of rows (cell, side, h, copies, elements) in the order of cells."""
    def finish(now: dict) -> pa.RecordBatch:
        sets = [np.frombuffer(e, _U) for _, _, e in now.values()]
        return of_cell(np.fromiter(now, np.int64, len(now)), np.array([c for _, c, _ in now.values()], np.int64), sets,
                       np.array([s for s, _, _ in now.values()]))

    cell, now = None, {}  # by h: a set may come twice
    for batch in batches:
        for c, s, h, copies, elements in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
            if c != cell:
                if len(now) > 1:
                    yield finish(now)
                cell, now = c, {}
            now.setdefault(h, (s, copies, elements.as_py()))
    if len(now) > 1:
        yield finish(now)


def _counts(h, copies, sets, side) -> pa.RecordBatch:
    total = np.zeros(len(h))  # whole numbers below 2**53
    for x, y, _ in linked(sets, side):
        total += np.bincount(x, weights=copies[y], minlength=len(h)) + np.bincount(y, weights=copies[x], minlength=len(h))
    some = total > 0
    return pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(total[some].astype(np.int64))], names=["h", "links"])


def _pairs(h, copies, sets, side) -> pa.RecordBatch:
    n = np.array([len(s) for s in sets], np.int64)
    found = [(h[x], h[y], both, n[x] + n[y] - both) for x, y, both in linked(sets, side)]
    a, b, both, union = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 4
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(both), pa.array(union)],
                                      names=["a", "b", "n_common", "n_union"])


def _cell_rows(members: DataFrame, elements: DataFrame, **parts) -> DataFrame:
    rows = materialise(cells(members, **parts), "cells")
    return rows.join(elements, "h").select("cell", "side", "h", "copies", "elements").repartition("cell").sortWithinPartitions("cell")


def link_counts(members: DataFrame, elements: DataFrame, **parts) -> DataFrame:
    """(h, links): documents of other classes that those of class ``h`` are linked with.

    ``members``: the classes (h, root, n, copies) of components of two or more;
    ``elements``: (h, elements) of them, repeats allowed.
    """
    of = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("copies").alias("all"))
    sized = materialise(attach(members, materialise(of, "component-sizes"), "root"), "members")
    two = sized.filter("m = 2").select("h", (F.col("all") - F.col("copies")).alias("links"))
    more = _cell_rows(sized.filter("m > 2").select("h", "root", "n", "copies"), elements, **parts) \
        .mapInArrow(lambda batches: _compare(batches, _counts), "h bigint, links bigint")
    return two.unionByName(more.groupBy("h").agg(F.sum("links").alias("links")))


def pairs(members: DataFrame, elements: DataFrame, **parts) -> DataFrame:
    """(a, b, n_common, n_union), a < b: every linked pair of different classes. As long as there are links."""
    return _cell_rows(members, elements, **parts) \
        .mapInArrow(lambda batches: _compare(batches, _pairs), "a bigint, b bigint, n_common bigint, n_union bigint")
