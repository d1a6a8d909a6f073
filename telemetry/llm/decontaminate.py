"""Benchmark decontamination with suffix arrays over shards of the training corpus.

Each task cuts its documents into shards, turns every shard into a sequence of word
numbers and sorts its suffixes (prefix doubling). Every suffix of every benchmark item is
looked up by binary search: the interval of the shard's suffixes that share its first
``window`` words gives all places where they occur, and from each such place the longest
verbatim match with any item is found in the order of the items' own suffixes.

Rules and edge cases
- Words: A-Z lower-cased, then runs of ASCII letters, digits and non-ASCII characters.
- A window is ``window`` consecutive words of an item; an item of fewer words (but not
  none) is one window. Document words inside any occurrence of a window are hit.
- Null and empty texts have no words: never hit, never contaminated. Items without words
  or with a null text have no window. An empty benchmark leaves every document clean.
- Repeated rows and repeated or null ids are handled row by row; a null item id is named
  ``null`` in the list. Any further columns of ``docs`` are left alone: results are added
  under new names (``add_matches``), or rows are removed (``decontaminate``).

Scale: one scan, no shuffle. The benchmark reaches the tasks in blocks of at most
``block_words`` words (each collected and broadcast alone); further blocks are further
narrow passes over the same rows, so neither the driver nor a task holds the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry.llm.textblocks import ALNUM_WORD, LOWER, blocks

WINDOW = 13
BLOCK_WORDS = 4_000_000
#: Text bytes per suffix array.
SHARD_BYTES = 4 << 20

_TABLE = bytes(int(LOWER[i]) if ALNUM_WORD[i] else 32 for i in range(256))

RESULT = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("longest_match", T.LongType()), T.StructField("longest_at", T.LongType()),
]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Queries:
    """A block of benchmark items: one sequence of word numbers (0 ends an item), its sorted
    suffixes, and the distinct windows with the items that hold them."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.names: list[str] = []
        flat: list[int] = []
        rest: list[int] = []
        where: dict[tuple[int, ...], set[int]] = {}
        first: list[int] = []
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of((text or "").encode())]
            if not ids:
                continue
            for i in range(max(1, len(ids) - window + 1)):
                w = tuple(ids[i:i + window])
                if w not in where:
                    first.append(len(flat) + i)
                where.setdefault(w, set()).add(len(self.names))
            self.names.append("null" if item is None else str(item))
            flat += [*ids, 0]
            rest += range(len(ids), -1, -1)
        self.flat = np.array(flat or [0], dtype=np.int32)
        self.rest = np.array(rest or [0], dtype=np.int64)
        self.window_at = np.array(first, dtype=np.int64)
        self.window_len = np.array([len(w) for w in where], dtype=np.int64)
        self.window_items = [sorted(v) for v in where.values()]
        self.depth = int(self.rest.max())
        self.suffixes = suffix_array(self.flat, len(self.vocab), self.depth)


def suffix_array(seq: np.ndarray, known: int, depth: int) -> np.ndarray:
    """Places of known words (number > 0), sorted by what follows, to ``depth`` words at least.

    Word 0 (unknown to the benchmark, or an end of a document) sorts first and ends a
    comparison in practice: no query contains it. Several words are packed in one key, so
    the sorted depth grows by the packing factor per round, and only ties are sorted again.
    """
    n = len(seq)
    rank = seq.astype(np.int64)
    top, reach = known, 1
    places = np.flatnonzero(seq > 0)
    while True:
        bits = max(1, int(top).bit_length())
        pack = max(2, 62 // bits)
        key = rank.copy()
        for j in range(1, pack):
            key <<= bits
            if j * reach < n:
                key[:n - j * reach] |= rank[j * reach:]
        reach *= pack
        order = np.argsort(key[places])
        places = places[order]
        ordered = key[places]
        new = np.ones(len(places), dtype=np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        group = np.cumsum(new)
        if reach >= depth or (len(group) and group[-1] == len(places)) or not len(group):
            return places
        rank = np.zeros(n, dtype=np.int64)
        rank[places] = group
        top = int(group[-1])


def compare(a: np.ndarray, at: np.ndarray, b: np.ndarray, place: np.ndarray,
            limit: np.ndarray, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of a[at:] and b[place:], at most ``limit`` words, and the sign of a minus b (0 at the limit)."""
    common = np.zeros(len(at), dtype=np.int64)
    sign = np.zeros(len(at), dtype=np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        k = common[live][:, None] + np.arange(step)
        i, j = at[live][:, None] + k, place[live][:, None] + k
        x = np.where(i < len(a), a[np.minimum(i, len(a) - 1)], 0)
        y = np.where(j < len(b), b[np.minimum(j, len(b) - 1)], 0)
        differs = x != y
        any_ = differs.any(1)
        n = np.where(any_, differs.argmax(1), step)
        reached = common[live] + n >= limit[live]
        stop = any_ & ~reached
        rows = np.flatnonzero(stop)
        sign[live[rows]] = np.sign(x[rows, n[rows]].astype(np.int64) - y[rows, n[rows]])
        common[live] = np.minimum(common[live] + n, limit[live])
        live = live[~any_ & ~reached]
    return common, sign


def search(seq: np.ndarray, places: np.ndarray, q: Queries, upper: bool) -> np.ndarray:
    """Binary search of every window among the sorted suffixes: the first place not below it (``upper``: above it)."""
    lo = np.zeros(len(q.window_at), dtype=np.int64)
    hi = np.full(len(lo), len(places), dtype=np.int64)
    while len(live := np.flatnonzero(lo < hi)):
        mid = (lo[live] + hi[live]) // 2
        _, sign = compare(seq, places[mid], q.flat, q.window_at[live], q.window_len[live])
        right = sign <= 0 if upper else sign < 0
        lo[live] = np.where(right, mid + 1, lo[live])
        hi[live] = np.where(right, hi[live], mid)
    return lo


def longest_matches(seq: np.ndarray, at: np.ndarray, q: Queries) -> np.ndarray:
    """Longest verbatim match with any item suffix that starts at each place: with a neighbour in suffix order."""
    lo = np.zeros(len(at), dtype=np.int64)
    hi = np.full(len(at), len(q.suffixes), dtype=np.int64)
    while len(live := np.flatnonzero(lo < hi)):
        mid = (lo[live] + hi[live]) // 2
        s = q.suffixes[mid]
        _, sign = compare(seq, at[live], q.flat, s, q.rest[s])
        right = sign >= 0
        lo[live] = np.where(right, mid + 1, lo[live])
        hi[live] = np.where(right, hi[live], mid)
    best = np.zeros(len(at), dtype=np.int64)
    for side in (lo - 1, lo):
        ok = np.flatnonzero((side >= 0) & (side < len(q.suffixes)))
        s = q.suffixes[side[ok]]
        common, _ = compare(seq, at[ok], q.flat, s, q.rest[s])
        best[ok] = np.maximum(best[ok], common)
    return best


def match_shard(docs: list[list[int]], q: Queries) -> tuple[list, list, list]:
    """Per document: hit places (array), item numbers (set), (longest match, its place)."""
    sizes = np.array([len(d) + 1 for d in docs], dtype=np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    seq = np.zeros(int(ends[-1]), dtype=np.int32)
    for d, start in zip(docs, starts):
        seq[start:start + len(d)] = d
    hits = [np.empty(0, np.int64)] * len(docs)
    items: list[set[int]] = [set() for _ in docs]
    longest = [(0, -1)] * len(docs)
    if not q.names:
        return hits, items, longest
    places = suffix_array(seq, len(q.vocab), int(q.window_len.max()))
    lo, hi = search(seq, places, q, False), search(seq, places, q, True)
    count = hi - lo
    found = np.flatnonzero(count)
    if not len(found):
        return hits, items, longest
    which = np.repeat(found, count[found])
    within = np.arange(len(which)) - np.repeat(np.cumsum(count[found]) - count[found], count[found])
    at = places[lo[which] + within]
    doc = np.searchsorted(ends, at, "right")
    step = np.zeros(len(seq) + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + q.window_len[which], -1)
    covered = np.cumsum(step[:-1]) > 0
    for d in np.unique(doc):
        hits[d] = np.flatnonzero(covered[starts[d]:ends[d]])
    for d, w in np.unique(np.stack([doc, which], 1), axis=0):
        items[d].update(q.window_items[w])
    spots = np.unique(at)
    length = longest_matches(seq, spots, q)
    owner = np.searchsorted(ends, spots, "right")
    for k in np.lexsort((-spots, length)):  # the longest last, of equals the earliest place
        longest[owner[k]] = (int(length[k]), int(spots[k] - starts[owner[k]]))
    return hits, items, longest


def _shards(column: pa.Array, vocab: dict[bytes, int]) -> Iterator[tuple[int, list[list[int]]]]:
    get = vocab.get
    for b in blocks(column, SHARD_BYTES):
        yield b.first, [[get(w, 0) for w in words_of(b.text(i))] for i in range(b.n)]


def _pass(shared, text: str, out: str):
    """A narrow pass: adds or extends the struct column of raw matches of a block of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = shared.value
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            before = batch.column(batch.schema.get_field_index(out)).to_pylist()
            after = []
            for first, docs in _shards(col, q.vocab):
                hits, items, longest = match_shard(docs, q)
                for i, ids in enumerate(docs):
                    old = before[first + i]
                    runs, names, best, at = ([], [], 0, -1) if old is None else \
                        (old["hit"], old["items"], old["longest"], old["at"])
                    if len(hits[i]):
                        runs = np.union1d(np.array(runs, dtype=np.int64), hits[i]).tolist()
                    n, p = longest[i]
                    after.append({"n_words": len(ids), "hit": runs,
                                  "items": names + [q.names[k] for k in items[i]],
                                  "longest": max(best, n), "at": p if n > best else at})
            i = batch.schema.get_field_index(out)
            yield batch.set_column(i, batch.schema.field(i), pa.array(after, type=batch.schema.field(i).type))
    return run


_RAW = "struct<n_words:bigint,hit:array<bigint>,items:array<string>,longest:bigint,at:bigint>"


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[list]:
    """The benchmark in lists of at most about ``block_words`` words, one in memory at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"] or "") // 2 + 1
        if size >= block_words:
            yield block
            block, size = [], 0
    yield block


def add_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                result: str = "matches") -> DataFrame:
    """``docs`` with a struct column ``result``: the hit words, the items, the longest match.

    Only narrow passes over ``docs``; a column already named ``result`` is replaced.
    """
    sc = docs.sparkSession.sparkContext
    df = docs.withColumn(result, F.lit(None).cast(_RAW))
    for block in item_blocks(benchmark, item, item_text, block_words):
        df = df.mapInArrow(_pass(sc.broadcast(Queries(block, window)), text, result), df.schema)
    return df



def match_table(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                text: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest match and its word place."""
    raw = add_matches(docs.select(F.col(id_column), F.col(text).alias("_text")), benchmark,
                      text="_text", result="_m", **options)
    m = F.col("_m")
    items = F.array_sort(F.array_distinct(m["items"]))
    hit, words = F.size(m["hit"]).cast("long"), m["n_words"]
    return raw.select(
        id_column, words.alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        _is_contaminated(hit, words).alias("contaminated"),
        m["longest"].alias("longest_match"), m["at"].alias("longest_at"))


def _is_contaminated(hit, words):
    return (hit > 0) & (20 * hit >= words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows of which at least a twentieth of the words are benchmark words."""
    from telemetry.llm.frames import fresh
    m = fresh("matches")
    raw = add_matches(docs, benchmark, text=text, result=m, **options)
    hit = F.size(F.col(m)["hit"])
    return raw.filter(~_is_contaminated(hit, F.col(m)["n_words"])).drop(m)
