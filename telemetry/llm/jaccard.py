"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles are put into size bands such that two sets of Jaccard similarity
``3/4`` or more lie in the same or in neighbouring bands; each set takes part in the
instance of its own band and in that of the next. Within an instance the similarity bounds
the symmetric difference of a pair by ``k``, so when the shingle domain is cut into ``n1``
partitions, few of them can differ between the two. Each partition is cut into ``n2``
parts, and every subset of ``n2 - k2`` parts gives one signature: similar sets share one.

The domain of the signatures leaves out common shingles (boilerplate): the difference of
two sets does not grow by that, so the bound still holds, and texts that share only common
passages share no signature. A signature over no shingle says nothing and is not emitted.
A set whose partitions are so often empty that the bound no longer guarantees a filled
common signature also emits its prefix (its first shingles, common ones last); two such
sets share one of those. Hence no pair is missed, whatever the sizes and the common set.

Steps
1. ``shingle_sets``: one narrow pass gives every document the size, hash and parity bitmap
   of its set, and the shingles that several texts of a block share, with their counts.
   Documents of equal sets form a class; all further work is on classes.
2. ``signature_blobs``: a second pass packs signatures by bucket (4 bytes of signature and
   2 of row each), so a shuffle of some bytes a shingle replaces one of rows. Copies within
   a task are emitted once.
3. Each bucket keeps only signatures shared by two classes or more and links each class to
   the smallest of its group (a star, not all pairs); pairs that an exact lower bound on the
   difference (the bitmaps) allows are verified on the full sets.
4. Groups whose classes are not one component then give, for each class, the nearest of
   another component, and after these are verified all pairs across components that the
   bound allows. A pair left out is in one component already or was proven dissimilar.
   A group of many classes is compared block against block, a pair of blocks a task.
5. ``class_links`` verifies the pairs inside components of three classes or more and counts
   every document's links (``n_links``, copies included); ``similar_pairs`` lists them.

Edge cases: null and empty texts and texts of white space have no shingles, are linked
with nothing and are their own component. A text of fewer words than a shingle has its
whole word sequence as the only shingle. Repeated rows are copies. A null id takes part;
a component is named by its smallest non-null id. Further columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry.llm import class_links
from telemetry.llm.frames import fresh, materialise, semi, small
from telemetry.llm.links import components
from telemetry.llm.textblocks import LOWER, SPACE_WORD, blocks, constants, mix64, span_hashes, word_spans

NGRAM = 5
#: Similarity of linked sets as a fraction; the band limits below are derived for it.
NUM, DEN = 3, 4
#: Text bytes whose signatures one bucket takes.
BUCKET_BYTES = 16 << 20
#: Bands up to this size use three parts a partition, of which one may differ.
SMALL_BAND = 62
#: Most bits of a parity bitmap (two or more per element below that), and of its folded copy.
SKETCH_BITS, BRIEF_BITS = 1 << 17, 1 << 11
#: Classes of a group that are compared as one block.
GROUP_ROWS = 1 << 10
#: Share of the sets from which on a shingle is common, and the most common shingles there can be.
COMMON = 1 / 2000
COMMON_MOST = 1 << 20

_SHINGLE = constants(5, 64)
_U = np.uint64


# ---- sets ---------------------------------------------------------------------------------

def block_sets(b, ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, row bounds) of a block."""
    data = LOWER[b.data]
    starts, ends, row = word_spans(b, SPACE_WORD)
    words = span_hashes(data, starts, ends)
    per_row = np.bincount(row, minlength=b.n)
    first = np.cumsum(per_row) - per_row
    out, bounds = [], np.zeros(b.n + 1, dtype=np.int64)
    if len(words) >= ngram:
        m = len(words) - ngram + 1
        full = np.zeros(m, dtype=_U)
        for j in range(ngram):
            full += words[j:j + m] * _SHINGLE[j]
        full = mix64(full)
    for i in range(b.n):
        n, s = int(per_row[i]), int(first[i])
        if n >= ngram:
            out.append(np.unique(full[s:s + n - ngram + 1]))
        elif n:
            # of another kind than full shingles: the count takes part
            out.append(mix64((words[s:s + n] * _SHINGLE[:n]).sum(dtype=_U, keepdims=True) + _SHINGLE[32 + n]))
        else:
            out.append(np.empty(0, dtype=_U))
        bounds[i + 1] = bounds[i] + len(out[-1])
    return (np.concatenate(out) if out else np.empty(0, _U)), bounds


def set_hashes(u: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Order-free 64-bit hash of each set with its size."""
    total = np.zeros(len(u) + 1, dtype=_U)
    np.cumsum(mix64(u ^ _SHINGLE[60]), out=total[1:])
    n = np.diff(bounds)
    return mix64(total[bounds[1:]] - total[bounds[:-1]] + n.astype(_U) * _SHINGLE[61]).view(np.int64)


def sketches(u: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Parity bitmap of each set: bits that differ are at most as many as elements that differ.

    The size is a power of two from twice the elements up, so that dissimilar sets show.
    """
    out = []
    for a, z in zip(bounds[:-1], bounds[1:]):
        bits = min(SKETCH_BITS, max(64, 1 << int(2 * (z - a) - 1).bit_length() if z > a else 64))
        counts = np.bincount((u[a:z] & _U(bits - 1)).astype(np.int64), minlength=bits)
        out.append(np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def fold(bitmap: bytes, size: int) -> np.ndarray:
    """A parity bitmap brought to ``size`` bytes (halves are added); as 64-bit words."""
    words = np.frombuffer(bitmap, _U)
    return np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0) if len(bitmap) > size else words


def shingle_sets(docs: DataFrame, id_column: str, text: str, ngram: int) -> DataFrame:
    """A narrow pass. Kind 0: id, set hash ``h``, size ``n`` and bitmap of each row; kind 1: a
    shingle ``h`` that ``n`` (3 or more) different sets of a block share."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1)):
                u, bounds = block_sets(b, ngram)
                h, n = set_hashes(u, bounds), np.diff(bounds)
                bitmaps = sketches(u, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(b.n, np.int32)), ids.slice(b.first, b.n), pa.array(h), pa.array(n),
                     pa.array(bitmaps, pa.binary()),
                     pa.array([fold(x, BRIEF_BITS // 8).tobytes() for x in bitmaps], pa.binary())], names=names)
                new = np.zeros(b.n, dtype=bool)
                new[np.unique(h, return_index=True)[1]] = True
                shared, count = np.unique(u[np.repeat(new, n)], return_counts=True)
                shared, count = shared[count >= 3], count[count >= 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(shared), np.int32)), pa.nulls(len(shared), ids.type), pa.array(shared.view(np.int64)),
                     pa.array(count.astype(np.int64)), pa.nulls(len(shared), pa.binary()), pa.nulls(len(shared), pa.binary())], names=names)
    names = ["kind", "id", "h", "n", "sketch", "brief"]
    return docs.select(F.col(id_column), F.col(text)).mapInArrow(
        run, f"kind int, id {kind}, h bigint, n bigint, sketch binary, brief binary")


def common_shingles(found: DataFrame) -> np.ndarray:
    """Sorted shingles found in a share of ``COMMON`` of the sets or more; at most ``COMMON_MOST``.

    The counts sum to at most the sizes of all sets, which bounds how many reach the limit.
    """
    sets, total = found.filter("kind = 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    limit = max(20, sets * COMMON, (total or 0) / COMMON_MOST)
    rows = found.filter("kind = 1").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= limit).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().view(_U)) if len(rows) else np.empty(0, _U)


def full_sets(docs: DataFrame, text: str, ngram: int) -> DataFrame:
    """Set hash and all shingles of each row (for verification)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(0)):
                u, bounds = block_sets(b, ngram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_hashes(u, bounds)),
                     pa.array([u[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:])], type=pa.binary())],
                    names=["h", "elements"])
    return docs.select(text).mapInArrow(run, "h bigint, elements binary")


# ---- signatures ---------------------------------------------------------------------------

def band_tops(largest: int) -> np.ndarray:
    """Largest set size of each band: a set and any similar one are at most one band apart."""
    tops, low = [], 1
    while not tops or tops[-1] < largest:
        tops.append(low * DEN // NUM)
        low = tops[-1] + 1
    return np.array(tops, dtype=np.int64)


def partitions(top: np.ndarray) -> np.ndarray:
    """``n1`` of the instance of a band: enough that typical sets keep a filled undamaged partition."""
    return np.where(top <= SMALL_BAND, np.ceil(0.17 * top), np.ceil(0.31 * top)).astype(np.int64) + 1


def _instance(u: np.ndarray, bounds: np.ndarray, common: np.ndarray, n: np.ndarray,
              top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of the rows in the instance of band top ``top[row]`` (0: not taking part).

    ``common`` flags elements outside the domain of the signatures.
    """
    rare = np.flatnonzero(~common)
    rare_bounds = np.searchsorted(rare, bounds)
    sigs, owners = [], []
    largest_partner = np.minimum(top, n * DEN // NUM)
    k = (n + largest_partner) // 7  # |A ^ B| <= (|A| + |B|) / 7 at similarity 3/4
    for parts, k2 in ((3, 1), (1, 0)):
        rows = np.flatnonzero((top > 0) & ((top <= SMALL_BAND) == (parts == 3)) & (k > 0))
        if not len(rows):
            continue
        n1 = partitions(top[rows])
        cells = n1 * parts
        base = np.cumsum(cells) - cells
        lens = (rare_bounds[1:] - rare_bounds[:-1])[rows]
        spot = np.repeat(rare_bounds[rows] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        e = u[rare[spot]]
        cell = (((e >> _U(32)) * np.repeat(cells, lens).astype(_U)) >> _U(32)).astype(np.int64) + np.repeat(base, lens)
        edge = np.flatnonzero(np.diff(cell, prepend=-1))
        sums = np.zeros(int(cells.sum()), dtype=_U)
        filled = np.zeros(len(sums), dtype=bool)
        if len(edge):
            sums[cell[edge]] = np.add.reduceat(mix64(e ^ _SHINGLE[50]), edge)
            filled[cell[edge]] = True
        sums, filled = sums.reshape(-1, parts), filled.reshape(-1, parts)
        owner = np.repeat(rows, n1)
        where = (np.arange(len(owner)) - np.repeat(base // parts, n1)).astype(_U) * _SHINGLE[51] \
            + top[owner].astype(_U) * _SHINGLE[52]
        keep = parts - k2
        for s, subset in enumerate(itertools.combinations(range(parts), keep)):
            some = filled[:, subset].any(1)
            total = where[some] + _SHINGLE[53 + s]
            for j, c in enumerate(subset):
                total = total + mix64(sums[some, c] + _SHINGLE[40 + j])
            sigs.append(mix64(total))
            owners.append(owner[some])
        # Partitions of which every subset is filled, against those that may be damaged too far.
        safe = np.bincount(np.repeat(np.arange(len(rows)), n1), weights=filled.sum(1) > parts - keep, minlength=len(rows))
        flat = rows[safe <= k[rows] // (k2 + 1)]
        for r in flat:
            prefix = int(n[r]) - math.ceil(NUM * int(n[r]) / DEN) + 1
            of, last = u[bounds[r]:bounds[r + 1]], common[bounds[r]:bounds[r + 1]]
            first = np.concatenate([of[~last], of[last]])[:prefix]
            sigs.append(mix64(first * _SHINGLE[58] + top[r:r + 1].astype(_U) * _SHINGLE[57]))
            owners.append(np.full(prefix, r))
    if not sigs:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(sigs), np.concatenate(owners)


def signatures(u: np.ndarray, bounds: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) for all sets: the instance of the own band and that of the next.

    ``often``: the sorted common shingles, the same for all sets.
    """
    common = np.zeros(len(u), dtype=bool)
    if len(often):
        common = often[np.minimum(np.searchsorted(often, u), len(often) - 1)] == u
    n = np.diff(bounds)
    tops = band_tops(int(n.max(initial=1)) * DEN // NUM + 1)
    band = np.searchsorted(tops, n)
    out = []
    for step in (0, 1):
        top = np.where(n > 0, tops[np.minimum(band + step, len(tops) - 1)], 0)
        out.append(_instance(u, bounds, common, n, top))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def signature_blobs(docs: DataFrame, text: str, ngram: int, buckets: int, often: np.ndarray) -> DataFrame:
    """bucket, classes (hash and size of each row) and packed entries (signature, row)."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for b in blocks(batch.column(0)):
                u, bounds = block_sets(b, ngram)
                h, n = set_hashes(u, bounds), np.diff(bounds)
                if len(seen) > 1_000_000:
                    seen.clear()  # copies are then emitted again, which does no harm
                new = np.zeros(b.n, dtype=bool)
                for i in np.unique(h, return_index=True)[1]:
                    new[i] = n[i] > 0 and int(h[i]) not in seen
                seen.update(h[new].tolist())
                take = np.repeat(new, n)
                u, n, h = u[take], n[new], h[new]
                if not len(h):
                    continue
                sig, row = signatures(u, np.concatenate([[0], np.cumsum(n)]), shared.value)
                bucket = ((sig >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                sig, row = (sig & _U(0xFFFFFFFF)).astype(np.uint32)[order], row[order].astype(np.int64)
                rows = {"bucket": [], "classes": [], "sizes": [], "sigs": [], "owners": []}
                for k in np.flatnonzero(np.diff(cuts)):
                    s, r = sig[cuts[k]:cuts[k + 1]], row[cuts[k]:cuts[k + 1]]
                    by = np.argsort(r, kind="stable")
                    members, local = np.unique(r[by], return_inverse=True)
                    for lo in range(0, len(members), 65536):  # rows are numbered in two bytes
                        part = (local >= lo) & (local < lo + 65536)
                        rows["bucket"].append(int(k))
                        rows["classes"].append(h[members[lo:lo + 65536]].tobytes())
                        rows["sizes"].append(n[members[lo:lo + 65536]].astype(np.int32).tobytes())
                        rows["sigs"].append(s[by][part].tobytes())
                        rows["owners"].append((local[part] - lo).astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["bucket"], pa.int32()), *(pa.array(rows[c], pa.binary()) for c in ("classes", "sizes", "sigs", "owners"))],
                    names=list(rows))
    return docs.select(text).mapInArrow(run, "bucket int, classes binary, sizes binary, sigs binary, owners binary")


_GROUPS = "g bigint, rep bigint, rep_n int, h bigint, n int"


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Signatures of a bucket that two classes or more share: their classes with the smallest as head."""
    sig, cls, size = [], [], []
    for c, z, s, o in zip(pdf["classes"], pdf["sizes"], pdf["sigs"], pdf["owners"]):
        at = np.frombuffer(o, np.uint16)
        sig.append(np.frombuffer(s, np.uint32))
        cls.append(np.frombuffer(c, np.int64)[at])
        size.append(np.frombuffer(z, np.int32)[at])
    sig, cls, size = np.concatenate(sig), np.concatenate(cls), np.concatenate(size)
    order = np.argsort(sig)
    ordered = sig[order]
    same = ordered[1:] == ordered[:-1]
    more = np.zeros(len(sig), dtype=bool)
    more[1:] |= same
    more[:-1] |= same
    order = order[more]
    sig, cls, size = sig[order], cls[order], size[order]
    order = np.lexsort((cls, sig))
    sig, cls, size = sig[order], cls[order], size[order]
    new = np.ones(len(sig), dtype=bool)
    new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
    sig, cls, size = sig[new], cls[new], size[new]
    if not len(sig):
        return pd.DataFrame({"g": [], "rep": [], "rep_n": [], "h": [], "n": []})
    first = np.flatnonzero(np.diff(sig.astype(np.int64), prepend=-1))
    count = np.diff(np.append(first, len(sig)))
    content = mix64(np.add.reduceat(mix64(cls.view(_U)), first) + count.astype(_U)).view(np.int64)
    keep = np.zeros(len(first), dtype=bool)
    keep[np.unique(content, return_index=True)[1]] = True  # equal groups once
    keep &= count > 1
    each = np.repeat(keep, count)
    return pd.DataFrame({"g": np.repeat(content, count)[each], "rep": np.repeat(cls[first], count)[each],
                         "rep_n": np.repeat(size[first], count)[each], "h": cls[each], "n": size[each]})


# ---- verification -------------------------------------------------------------------------

def _allowed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and bitmaps do not rule them out."""
    a = classes.select(F.col("h").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("as"))
    b = classes.select(F.col("h").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("bs"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "an", "bn", "as", "bs").mapInArrow(_bound, "a bigint, b bigint")


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, ngram: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of classes whose full sets are similar enough, as edges (u, v), and the full sets.

    Only the texts that stand for a class of some pair are read again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.array(batch.column(i), np.int64) for i in (0, 1))
            good = np.zeros(len(a), dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                good[i] = DEN * both >= NUM * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["u", "v"])
    pairs = materialise(_allowed(pairs, classes), "pairs")
    ends = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    heads = classes.join(small(materialise(ends, "ends")), "h", "left_semi").select("id")
    sets = materialise(full_sets(semi(docs, heads, "id"), "text", ngram), "elements")
    links = pairs.join(sets.select(F.col("h").alias("a"), F.col("elements").alias("x")), "a") \
        .join(sets.select(F.col("h").alias("b"), F.col("elements").alias("y")), "b") \
        .select("a", "b", "x", "y").mapInArrow(run, "u bigint, v bigint")
    return links, sets


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.array(batch.column(2)) + np.array(batch.column(3))
        ok = np.zeros(len(batch), dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
            size = min(len(x), len(y))
            ok[i] = 7 * int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum()) <= n[i]
        ok = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])


def _apart(root: np.ndarray, side: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j are of different components and, where two blocks are compared, of different blocks."""
    return (root[i][:, None] != root[j]) & ((side[i][:, None] != side[j]) | (side[j] == class_links.ITSELF))


def _group_pairs(h: np.ndarray, n: np.ndarray, root: np.ndarray, bits: np.ndarray, side: np.ndarray, rows: int = 256) -> Iterator[np.ndarray]:
    """Pairs of a group in different components that the size and bitmap bounds allow, block by block."""
    order = np.argsort(n, kind="stable")
    h, n, root, bits, side = h[order], n[order], root[order], bits[order], side[order]
    end = np.searchsorted(n, n * DEN // NUM, "right")
    for lo in range(0, len(h), rows):
        i = np.arange(lo, min(len(h), lo + rows))
        for at in range(lo + 1, int(end[i[-1]]), 4096):
            j = np.arange(at, min(int(end[i[-1]]), at + 4096))
            x, y = np.nonzero(_apart(root, side, i, j) & (i[:, None] < j) & (j < end[i][:, None]))
            ok = 7 * np.bitwise_count(bits[i[x]] ^ bits[j[y]]).sum(1, dtype=np.int64) <= n[i[x]] + n[j[y]]
            p, q = h[i[x[ok]]], h[j[y[ok]]]
            yield np.stack([np.minimum(p, q), np.maximum(p, q)], 1)


def _nearest_pairs(h: np.ndarray, n: np.ndarray, root: np.ndarray, bits: np.ndarray, side: np.ndarray, rows: int = 256) -> Iterator[np.ndarray]:
    """For each class of a group the class of another component that the bitmaps show as nearest, if the bounds allow it."""
    for lo in range(0, len(h), rows):
        i = np.arange(lo, min(len(h), lo + rows))
        best, at = np.full(len(i), 1, dtype=np.int64), np.zeros(len(i), dtype=np.int64)
        for first in range(0, len(h), 1024):
            j = np.arange(first, min(len(h), first + 1024))
            slack = 7 * np.bitwise_count(bits[i][:, None] ^ bits[j]).sum(2, dtype=np.int64) - n[i][:, None] - n[j]
            other = _apart(root, side, i, j) & (NUM * n[i][:, None] <= DEN * n[j]) & (NUM * n[j] <= DEN * n[i][:, None])
            slack = np.where(other, slack, 1)
            near = slack.argmin(1)
            low = slack[np.arange(len(i)), near]
            at = np.where(low < best, j[near], at)
            best = np.minimum(best, low)
        ok = best <= 0
        p, q = h[i[ok]], h[at[ok]]
        yield np.stack([np.minimum(p, q), np.maximum(p, q)], 1)


def _across(batches: Iterator[pa.RecordBatch], of_group=_group_pairs) -> Iterator[pa.RecordBatch]:
    """Rows (g, h, n, root, bitmap) in the order of g: the pairs of each group, repeats within a batch once.

    A sixth column is the side of the row where two blocks of a group are compared.
    """
    held: list[list[np.ndarray]] = []

    def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
        g, h, n, root, bits, side = columns
        cuts = np.append(np.flatnonzero(np.diff(g, prepend=~g[:1])), len(g))
        found = []
        for a, z in zip(cuts[:-1], cuts[1:]):
            size = min(map(len, bits[a:z]))
            found += of_group(h[a:z], n[a:z], root[a:z], np.stack([fold(x, size) for x in bits[a:z]]), side[a:z])
        both = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    for batch in batches:
        if not len(batch):
            continue
        now = [np.array(batch.column(i)) for i in range(4)]
        now.append(np.array(batch.column(4).to_pylist(), dtype=object))
        now.append(np.array(batch.column(5)) if batch.num_columns > 5 else np.full(len(batch), class_links.ITSELF))
        last = int(np.searchsorted(now[0], now[0][-1], "left"))
        if last or (held and held[0][0][0] != now[0][0]):
            # all groups but the last are complete
            if held and held[0][0][0] != now[0][0] and not last:
                done, held = held, []
            else:
                done, held = [*held, [c[:last] for c in now]], []
            yield pairs([np.concatenate(c) for c in zip(*done)])
        held.append([c[last:] for c in now])
    if held:
        yield pairs([np.concatenate(c) for c in zip(*held)])


def _open_rows(groups: DataFrame, known: DataFrame, classes: DataFrame, block: int = GROUP_ROWS) -> DataFrame:
    """Rows (g, h, n, root, brief, side) of the groups of three classes or more (two are a star) in several components, by g.

    A group of more than ``block`` rows is cut into blocks by hash; ``g`` is then a pair of blocks,
    and a row stands in every pair that its block is of.
    """
    named = materialise(groups.select("g", "h", "n").join(known.withColumnRenamed("node", "h"), "h", "left")
                        .withColumn("root", F.coalesce("root", "h")), "named")
    open_groups = named.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m")) \
        .filter("lo <> hi and m > 2").select("g", F.ceil(F.col("m") / block).alias("blocks"))
    rows = named.join(open_groups, "g").join(classes.select("h", "brief"), "h")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return rows.withColumn("own", F.pmod(F.xxhash64("h"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select(F.when(F.col("blocks") == 1, F.col("g")).otherwise(F.xxhash64("g", low, high)).alias("g"), "h", "n", "root", "brief",
                F.when(F.col("own") < F.col("other"), class_links.FIRST).when(F.col("own") > F.col("other"), class_links.SECOND)
                .otherwise(class_links.ITSELF).alias("side")) \
        .repartition("g").sortWithinPartitions("g")


# ---- the operator -------------------------------------------------------------------------

def similarity_classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                       ngram: int = NGRAM, bucket_bytes: int = BUCKET_BYTES, **parts) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links), n_links.

    ``n_links`` is the number of other rows the row is linked with, copies included.
    """
    links, rows, classes, sets = _links(docs, id_column, text, ngram, bucket_bytes)
    members = _members(links, classes)
    known = classes.join(members.select("h", "root").join(class_links.link_counts(members, sets, **parts), "h", "left"), "h", "left") \
        .filter("copies > 1 or root is not null").select("h", "copies", "root", "links")
    labelled = rows.join(small(materialise(known, "known")), "h", "left").withColumn("root", F.coalesce("root", "h"))
    n_links = F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).otherwise(F.lit(0))
    return _named(labelled.withColumn("n_links", n_links.cast("long"))).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", "n_links")


def similar_pairs(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  ngram: int = NGRAM, bucket_bytes: int = BUCKET_BYTES, **parts) -> tuple[DataFrame, DataFrame]:
    """The join itself: (set_a, set_b, n_common, n_union) for each linked pair of different sets, and the sets of the rows.

    The second table has a row per row of ``docs``: id and ``set_hash``; rows of equal sets that
    are not empty are linked with each other. The first is as long as there are links between
    different sets: the square of a group of near copies.
    """
    links, rows, classes, sets = _links(docs, id_column, text, ngram, bucket_bytes)
    found = class_links.pairs(_members(links, classes), sets, **parts)
    return found.withColumnsRenamed({"a": "set_a", "b": "set_b"}), rows.select(F.col("id").alias(id_column), F.col("h").alias("set_hash"))


def _links(docs: DataFrame, id_column: str, text: str, ngram: int = NGRAM,
           bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Links (u, v) that connect every component, rows (id, h, n), classes (h, id, n, copies, ...), full sets of all linked classes."""
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = materialise(shingle_sets(docs, "id", "text", ngram), "sets")
    rows = found.filter("kind = 0").select("id", "h", "n", "sketch", "brief")
    classes = materialise(rows.groupBy("h").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
                                                  F.first("brief").alias("brief"), F.count(F.lit(1)).alias("copies")), "classes")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))
    groups = materialise(
        signature_blobs(docs, "text", ngram, buckets, common_shingles(found)).groupBy("bucket")
        .applyInPandas(_shared, _GROUPS).dropDuplicates(["g", "h"]), "groups")

    stars = groups.filter(f"rep <> h and {NUM} * greatest(n, rep_n) <= {DEN} * least(n, rep_n)") \
        .select(F.col("rep").alias("a"), F.col("h").alias("b")).distinct()
    links, sets = _verify(stars, docs, classes, ngram)
    links = materialise(links, "links")

    # Groups that are not one component yet: first each class with its nearest of another
    # component, which joins nearly all that belong together, then all pairs across that are left.
    # One step along the star is enough to know most classes that are together by then.
    near = links.groupBy(F.greatest("u", "v").alias("node")).agg(F.min(F.least("u", "v")).alias("root"))
    for of_group in (_nearest_pairs, _group_pairs):
        known = near if of_group is _nearest_pairs else components(links)
        more = _open_rows(groups, known, classes) \
            .mapInArrow(lambda batches, f=of_group: _across(batches, f), "a bigint, b bigint").distinct()
        new, also = _verify(more.join(stars, ["a", "b"], "left_anti"), docs, classes, ngram)
        links, sets = materialise(links.unionByName(new), "links"), sets.unionByName(also)
    return links, rows.select("id", "h", "n"), classes, sets


def _members(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(h, root, n, copies) of the classes in components of two classes or more."""
    below = components(links)
    nodes = below.select(F.col("node").alias("h"), "root").unionByName(below.select(F.col("root").alias("h"), "root").distinct())
    return materialise(nodes.join(classes.select("h", "n", "copies"), "h"), "component-members")


def _named(labelled: DataFrame) -> DataFrame:
    """Rows (id, n, root, ...) with the component's smallest id."""
    name = labelled.filter("n > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    return labelled.join(name, "root", "left") \
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))


def _classes(docs: DataFrame, id_column: str, text: str, ngram: int = NGRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Id, component_id and hash of the row's set, for each row."""
    links, rows, _, _ = _links(docs, id_column, text, ngram, bucket_bytes)
    labelled = rows.join(components(links).withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    return _named(labelled).select(F.col("id").alias(id_column), "component_id", F.col("h").alias("set_hash"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group: the row whose id names its component.

    Rows without words stay. Of rows equal in id and text one stays; rows that share an id
    but not their text are told apart by the text, and each stays only if it leads its own component. Null ids: a component of null ids only
    keeps each of its different texts, any other its smallest id.
    """
    classes = materialise(_classes(docs, id_column, text, **options), "set-classes") \
        .withColumn("leads", F.col(id_column).eqNullSafe(F.col("component_id")))
    ids = classes.groupBy(id_column).agg(F.max("leads").alias("leads"), F.count(F.lit(1)).alias("rows")).filter("leads")
    ids = materialise(ids, "leaders")
    again = ids.filter("rows > 1")
    # rows of an id that stands more than once: only those whose own set leads
    digest, mark, key, h = (fresh(x) for x in ("text", "mark", "id", "set"))
    rows = semi(docs, again, id_column).withColumn(digest, F.xxhash64(text))
    sets = shingle_sets(rows.select(F.col(digest).alias("id"), F.col(text).alias("text")), "id", "text", options.get("ngram", NGRAM)) \
        .filter("kind = 0").select(F.col("id").alias(mark), F.col("h").alias(h)).distinct()
    lead = semi(classes.filter("leads"), again, id_column).select(F.col(id_column).alias(key), F.col("set_hash").alias(h)).distinct()
    rows = rows.join(sets, F.col(digest) == F.col(mark))
    rows = rows.join(lead, rows[id_column].eqNullSafe(lead[key]) & (rows[h] == lead[h]), "left_semi").drop(digest, mark, h)
    return semi(docs, ids.filter("rows = 1"), id_column).unionByName(rows.dropDuplicates([id_column, text]))
