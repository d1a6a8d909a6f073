"""Substring dedup by content-defined chunks.

A gear rolling hash runs over the bytes of each text; a chunk ends where bits of the hash
that depend on the last 16 bytes are zero, or, where that happens nowhere near, at the lowest
hash around (and at a longest size), so chunk borders move with the content and an insertion
changes only the chunks around it. Chunks are deduplicated by a 64-bit digest: the first place,
by (document id, position), keeps the content. A passage is a run of chunks that all stood
earlier, in a row in one text, extended byte by byte to both sides as far as the text agrees
with that around the earlier place. Passages of at least ``min_words`` whole words are removed,
without the parts of words at their ends; shorter ones (chance, license lines) stay, also side
by side. Not seen is a passage that holds no whole chunk, or of which every chunk stood still
earlier in places that do not agree with it for ``min_words`` words.

Edge cases: null and empty texts have no chunks and stay (an empty text results). Of
repeated passages in one text the first stays. Rows equal in id and text: the first place
is shared, so their content stays in each of them; distinct texts of one id are ordered by
their hash. A null id sorts first. Cuts fall between UTF-8 characters. Other columns are not read.

Scale: chunks that recur within a block are resolved there, so a chunk that half the
corpus holds is one row per block (2 MB of text) in the only shuffle of chunks, which sorts
the rows of a digest by place; the others stand alone there. Found places are gathered per text, whose size bounds them. A match that
covers the next chunk and the bytes that decide its borders would hold that chunk too, so the
text around an earlier place is needed as far as repeated chunks stand in a row and little
more, ``REACH`` bytes at most. It is looked up once a place, and only for runs that can reach ``min_words``: those that
cannot are known by the words in the chunks beside them and the hashes of the 16 bytes at each side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry.llm.frames import materialise
from telemetry.llm.textblocks import SPACE_WORD, Block, blocks, constants, mix64, row_counts, span_hashes, word_spans

MIN_WORDS = 20
#: One byte in ``1 << CHUNK_BITS`` ends a chunk; none is longer than ``MAX_BYTES``.
CHUNK_BITS = 6
MAX_BYTES = 512
#: Bytes without a border on both sides of a place from which on lowest hashes make borders, and how far these are the lowest.
SPARSE, NEAR = 32, 16
#: Bytes beyond a chunk that decide its borders.
CONTEXT = 2 * SPARSE + 16
#: Bytes beyond a run that are compared at most: a passage of 50 words or so is covered from any run in it, a longer
#: one by its runs together.
REACH = 512

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_GEAR = (constants(99, 256) >> np.uint64(16)).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of gear[byte i-j] << j over the last 16 bytes."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        more = np.zeros_like(h)
        more[step:] = h[:-step] << np.uint32(step)
        h = h + more
    return h


def _lowest(h: np.ndarray, reach: int) -> np.ndarray:
    """The lowest value within ``reach`` places on both sides (a power of two)."""
    low = h
    step = 1
    while step <= reach:  # windows of 2 * step values beginning at each place
        more = low.copy()
        np.minimum(low[:-step], low[step:], out=more[:-step])
        low, step = more, step * 2
    out = low.copy()
    out[reach:] = low[:len(h) - reach]
    return out


def _between_characters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places moved on to where a UTF-8 character begins."""
    for _ in range(3):
        inside = at < len(data)
        inside[inside] = (data[at[inside]] & 0xC0) == 0x80
        at = at + inside
    return at


def borders(b: Block, chunk_bits: int = CHUNK_BITS, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """Sorted chunk starts of a block with its end; every row starts a chunk.

    Where the hash makes no border for ``SPARSE`` bytes around a place (texts of little variety), borders
    are at the lowest hash of ``NEAR`` bytes around, equal ones too: in a periodic text one a period.
    """
    data = b.data
    if not len(data):
        return np.zeros(1, np.int64)
    h = rolling(data)
    mask = np.uint32(((1 << chunk_bits) - 1) << (16 - chunk_bits))
    at = _between_characters(data, np.flatnonzero((h & mask) == 0) + 1)
    at = np.union1d(np.append(at, len(data)), b.offsets)
    gap = np.flatnonzero(np.diff(at) > 2 * SPARSE)
    if len(gap):
        short = h & np.uint32(0xFFFF)  # what depends on the last 16 bytes alone
        low = _between_characters(data, np.flatnonzero(short == _lowest(short, NEAR)) + 1)
        left = np.searchsorted(at, low, "right") - 1
        low = low[(low - at[left] > SPARSE) & (at[np.minimum(left + 1, len(at) - 1)] - low > SPARSE)]
        if len(low):
            keep, last = [], -NEAR
            for x in low.tolist():
                if x - last >= NEAR:
                    keep.append(x)
                    last = x
            at = np.union1d(at, keep)
    long = np.flatnonzero(np.diff(at) > max_bytes)
    if len(long):
        at = np.union1d(at, np.concatenate([np.arange(at[k] + max_bytes, at[k + 1], max_bytes) for k in long]))
        at = np.union1d(_between_characters(data, at), b.offsets)
    inner = at[(at > 0) & (at < len(data))]
    return np.concatenate([[0], inner, [len(data)]])


def chunks(b: Block, **options) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start within the row, bytes, digest) of every chunk of a block."""
    at = borders(b, **options)
    at = at[np.append(np.diff(at) > 0, True)]
    starts, ends = at[:-1], at[1:]
    if len(starts) and starts[-1] == ends[-1]:
        starts, ends = starts[:-1], ends[:-1]
    row = np.searchsorted(b.offsets, starts, "right") - 1
    return row, starts - b.offsets[row], ends - starts, span_hashes(b.data, starts, ends).view(np.int64)


def _text_hash(b: Block) -> np.ndarray:
    return span_hashes(b.data, b.offsets[:-1], b.offsets[1:]).view(np.int64)


def _beside(b: Block, row: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, sides) of every chunk: packed numbers of words that begin in it, in what a match can reach
    before and after it and in the 15 bytes before and after it, and of bytes of the chunks before and after
    it (bits from ``AT``); hashes of the 16 bytes at each side."""
    first = word_spans(b, SPACE_WORD)[0]
    lo, hi = b.offsets[row], b.offsets[row + 1]
    at, end = lo + start, lo + start + size
    before = np.where(start > 0, np.roll(at, 1), at)
    after = np.where(end < hi, np.roll(end, -1), end)

    def words(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.searchsorted(first, np.minimum(y, hi)) - np.searchsorted(first, np.maximum(x, lo))
    packed = np.zeros(len(at), np.int64)
    parts = (words(at, end), words(before - CONTEXT, at), words(end, after + CONTEXT), words(at - 15, at), words(end, end + 15), at - before, after - end)
    for n, part in zip(AT, parts):
        packed |= part.astype(np.int64) << n
    h = np.append(rolling(b.data), np.uint32(0)).astype(np.int64)
    return packed, h[at - 1] << 32 | h[np.minimum(end + 15, len(b.data))]


#: Places of the numbers in ``words`` (of 10 bits each, the fourth and fifth of 5).
AT = (0, 10, 20, 30, 35, 40, 50)
#: Bits of the size in ``spot``, below the start.
SIZE_BITS = 10
#: Bits of ``words``: the 16 bytes before (after) the chunk equal those of the first place.
LEFT, RIGHT = 1 << 60, 1 << 61


def _chunk_rows(docs: DataFrame, options: dict) -> DataFrame:
    """A narrow row for every chunk: id and text hash, ``spot`` (start and size), the words in and beside it.

    A chunk that stood earlier within the block (by place) has in ``beside`` and ``head_start`` where it last did,
    and a key of its own. For others the key is the digest, and ``beside`` has the hashes of the bytes at its sides.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1)):
                row, start, size, digest = chunks(b, **options)
                order_of = sorted(range(b.n), key=lambda i: _order(ids[b.first + i].as_py(), i))
                rank = np.empty(b.n, dtype=np.int64)
                rank[order_of] = np.arange(b.n)
                order = np.lexsort((start, rank[row], digest))
                again = np.zeros(len(row), dtype=bool)
                again[order[1:]] = digest[order[1:]] == digest[order[:-1]]
                head = np.arange(len(row))
                head[order[1:]] = order[:-1]  # the nearest earlier place: one lag throughout a periodic text
                text = _text_hash(b)
                words, sides = _beside(b, row, start, size)
                words |= np.where(sides >> 32 == sides[head] >> 32, LEFT, 0) * again
                words |= np.where(sides & 0xFFFFFFFF == sides[head] & 0xFFFFFFFF, RIGHT, 0) * again
                # equal rows side by side share places: the later is no repeat of the earlier
                own = np.flatnonzero(again)
                if len(np.unique(text)) < b.n:
                    first = {}
                    twin = np.array([first.setdefault((ids[b.first + i].as_py(), int(text[i])), i) != i for i in range(b.n)])
                    again[own[twin[row[own]]]] = False
                words = np.where(again, words, words & (LEFT - 1))
                first = start[head].astype(np.int32)
                key = np.where(again, mix64(text[row].view(np.uint64) + start.astype(np.uint64)).view(np.int64), digest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), ids.take(pa.array(row + b.first)), pa.array(text[row]), pa.array(start << SIZE_BITS | size),
                     pa.array(words), pa.array(np.where(again, text[row[head]], sides)), pa.array(first, mask=~again)],
                    names=["key", "id", "text_hash", "spot", "words", "beside", "head_start"])
    return docs.mapInArrow(run, f"key bigint, id {kind}, text_hash bigint, spot bigint, words bigint, beside bigint, head_start int")


def _order(value, i: int) -> tuple:
    return (value is not None, value if value is not None else 0, i)


def repeated_chunks(docs: DataFrame, **options) -> DataFrame:
    """(id, text_hash, spots): starts and sizes of the chunks of a text that stood earlier, with an earlier place
    (text hash and start) and the words in and beside them."""
    rows = _chunk_rows(docs, options)
    # rows that are resolved already stand alone, away from the chunks that many blocks hold
    again = F.col("head_start").isNotNull()
    first = F.first(F.struct("id", "text_hash", "spot", "beside")).over(
        Window.partitionBy("key", again.cast("int")).orderBy("id", "text_hash", "spot"))
    met = rows.withColumn("first", first).filter(
        again | ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("spot") == F.col("first.spot"))))
    same = F.col("beside").bitwiseXOR(F.col("first.beside"))
    words = F.col("words").bitwiseOR(F.when(F.shiftright(same, 32) == 0, F.lit(LEFT)).otherwise(F.lit(0))) \
        .bitwiseOR(F.when(same.bitwiseAND(F.lit(0xFFFFFFFF)) == 0, F.lit(RIGHT)).otherwise(F.lit(0)))
    spot = F.struct("spot", F.when(again, F.col("beside")).otherwise(F.col("first.text_hash")).alias("head"),
                    F.when(again, F.col("head_start").cast("long")).otherwise(F.shiftright("first.spot", SIZE_BITS)).alias("head_start"),
                    F.when(again, F.col("words")).otherwise(words).alias("words"))
    return met.groupBy("id", "text_hash").agg(F.collect_list(spot).alias("spots"))


def _ends(found: DataFrame, min_words: int) -> DataFrame:
    """A row for each run that can hold ``min_words`` words and each of its ends: the run (s, e) of the text, its
    end to look at (``right`` or left), the byte ``pos`` of the text ``head`` that stands there, and how far to compare."""
    kind = found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, *found = _runs(batch.column(2), min_words)
            took = pa.array(text, pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(took), batch.column(1).take(took), *map(pa.array, found, kinds)],
                                             names=["id", "text_hash", "s", "e", "right", "head", "pos", "size"])
    return found.mapInArrow(run, f"id {kind}, text_hash bigint, s int, e int, right boolean, head bigint, pos int, size int")


def _runs(lists: pa.ListArray, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, s, e, right, head, pos, size) of the ends of runs, from a list of repeated chunks per text.

    Repeated chunks that stand in a row are a chain; a run is a part of a chain whose earlier places follow each
    other in one text. A match of a run can go on as far as the chain and the chunk beside it.
    """
    spots = lists.flatten()
    text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    spot, head, there, words = (spots.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                for c in ("spot", "head", "head_start", "words"))
    start, size = spot >> SIZE_BITS, spot & ((1 << SIZE_BITS) - 1)
    order = np.lexsort((start, text))
    order = order[np.r_[True, (np.diff(text[order]) != 0) | (np.diff(start[order]) != 0)]] if len(order) else order  # each chunk once
    text, start, size, head, words = text[order], start[order], size[order], head[order], words[order]
    lag = there[order] - start
    end, n = start + size, len(order)
    if not n:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, bool, np.int64, np.int32, np.int32))
    new_chain = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != end[:-1])]
    new_run = new_chain | np.r_[True, (head[1:] != head[:-1]) | (lag[1:] != lag[:-1])]
    run_first, chain_first = np.flatnonzero(new_run), np.flatnonzero(new_chain)
    run_last = np.r_[run_first[1:], n] - 1
    chain_of = (np.cumsum(new_chain) - 1)[run_first]
    first, last = chain_first[chain_of], (np.r_[chain_first[1:], n] - 1)[chain_of]
    own, held = np.add.reduceat(words & 1023, run_first), np.add.reduceat(words & 1023, chain_first)[chain_of]
    left, right = (words[run_first] & LEFT) != 0, (words[run_last] & RIGHT) != 0

    def number(at: np.ndarray, part: int, bits: int = 1023) -> np.ndarray:
        return words[at] >> AT[part] & bits
    most = 1 + np.where(left | right, held, own) + np.where(left, number(first, 1), number(run_first, 3, 31)) \
        + np.where(right, number(last, 2), number(run_last, 4, 31))
    far = np.stack([np.where(left, start[run_first] - start[first] + number(first, 5) + CONTEXT, 16),
                    np.where(right, end[last] - end[run_last] + number(last, 6) + CONTEXT, 16)], 1)
    far = np.where(far <= 16, 16, np.minimum(REACH, 128 * -(-far // 128)))
    keep = np.flatnonzero(most >= min_words)
    a, z = run_first[keep], run_last[keep]
    both = np.tile([False, True], len(keep))
    pos = np.stack([start[a] + lag[a], end[z] + lag[a]], 1).ravel()
    return (np.repeat(text[a], 2), np.repeat(start[a], 2).astype(np.int32), np.repeat(end[z], 2).astype(np.int32), both,
            np.repeat(head[a], 2), pos.astype(np.int32), far[keep].ravel().astype(np.int32))


def _around(texts: DataFrame, ends: DataFrame) -> DataFrame:
    """From texts with their hashes ``h``: (head, pos, right, size, near): ``size`` bytes and one more before or after the places that ``ends`` names."""
    wants = ends.select("head", "pos", "right", "size").distinct().groupBy(F.col("head").alias("h")) \
        .agg(F.collect_list(F.struct("pos", "right", "size")).alias("wants"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h, wants in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text.as_py() or "").encode()
                out += [(h, p, right, n, raw[p:p + n + 1] if right else raw[max(0, p - n - 1):p]) for p, right, n in map(dict.values, wants)]
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out) if out else [()] * 5, kinds)), names=["head", "pos", "right", "size", "near"])
    return texts.join(wants, "h").select("text", "h", "wants").mapInArrow(run, "head bigint, pos int, right boolean, size int, near binary") \
        .dropDuplicates(["head", "pos", "right", "size"])


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                     **options) -> DataFrame:
    """One row per row of ``docs``: id, text without repeated passages, n_words, n_removed_words, n_spans, and
    spans, the removed bytes of the UTF-8 text."""
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch], once: bool = False) -> Iterator[pa.RecordBatch]:
        """Texts with their hashes; with ``once``, of equal texts of a task the first."""
        seen: set[int] = set()
        for batch in batches:
            h = [_text_hash(b) for b in blocks(batch.column(1))]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(h) if h else np.empty(0, np.int64))],
                                             names=["id", "text", "h"])
            if once:
                new = [not (x in seen or seen.add(x)) for x in out.column(2).to_pylist()]
                out = out.filter(pa.array(new, pa.bool_()))
            yield out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column(2)
            for b in blocks(batch.column(1)):
                ws, we, owner = word_spans(b, SPACE_WORD)
                n_words = row_counts(owner, b.n)
                gone, places, removed = [], [], np.zeros(b.n, np.int64)
                for i in range(b.n):
                    raw = b.text(i)
                    cuts = _passages(raw, spots[b.first + i].as_py() or [], min_words)
                    out, at = [], 0
                    for s, e in cuts:
                        out.append(raw[at:s])
                        at = e
                        removed[i] += len(raw[s:e].split())
                    out.append(raw[at:])
                    gone.append(b"".join(out).decode("utf-8", "replace"))
                    places.append([{"start": s, "end": e} for s, e in cuts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, b.n), pa.array(gone, pa.string()), pa.array(n_words), pa.array(removed),
                     pa.array([len(x) for x in places], pa.int64()), pa.array(places, _SPANS)],
                    names=["id", "text", "n_words", "n_removed_words", "n_spans", "spans"])
    with_hash = docs.mapInArrow(hashed, f"id {kind}, text string, h bigint")
    texts = docs.mapInArrow(lambda batches: hashed(batches, True), f"id {kind}, text string, h bigint").select("text", "h")
    ends = materialise(_ends(repeated_chunks(docs, **options), min_words), "repeats")
    own = F.col("head") == F.col("text_hash")  # an earlier place of the same text is at hand when it is cut
    near = materialise(_around(texts, ends.filter(~own)), "around")
    met = ends.filter(~own).join(near, ["head", "pos", "right", "size"]) \
        .unionByName(ends.filter(own).withColumn("near", F.lit(None).cast("binary")))
    found = met.groupBy(F.col("id").alias("found_id"), "text_hash") \
        .agg(F.collect_list(F.struct("s", "e", "right", "pos", "size", "near")).alias("spots"))
    joined = with_hash.join(found, with_hash["id"].eqNullSafe(found["found_id"]) & (with_hash["h"] == found["text_hash"]), "left") \
        .select("id", "text", "spots")
    return joined.mapInArrow(cut, f"id {kind}, text string, n_words bigint, n_removed_words bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>") \
        .withColumnRenamed("id", id_column)


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _passages(raw: bytes, ends: list[dict], min_words: int) -> list[tuple[int, int]]:
    """Places (start, end) to remove: the runs of a text, each extended as far as the text agrees with that around
    its earlier place, cut back to whole words, if that leaves ``min_words``; the space between what stands before and after stays."""
    wide: dict[tuple[int, int], list] = {}
    for x in ends:
        # start, end, and whether a word of the earlier text goes on before and after them
        run = wide.setdefault((x["s"], x["e"]), [x["s"], x["e"], False, False])
        p, size, near = x["pos"], x["size"], x["near"]
        if x["right"]:
            near = raw[p:p + size + 1] if near is None else near
            n = _agree(raw[x["e"]:x["e"] + size], near)
            run[1], run[3] = x["e"] + n, not near[n:n + 1].isspace() and n < len(near)
        else:
            near = (raw[max(0, p - size - 1):p] if near is None else near)[::-1]
            n = _agree(raw[max(0, x["s"] - size):x["s"]][::-1], near)
            run[0], run[2] = x["s"] - n, not near[n:n + 1].isspace() and n < len(near)
    joined: list[list[int]] = []
    for run in sorted(wide.values()):
        s, e = _whole_words(raw, *run)
        if e - s < 2 * min_words - 1 or len(raw[s:e].split()) < min_words:
            continue
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    out = []
    for s, e in joined:
        if 0 < s < e < len(raw) and not raw[s - 1:s].isspace() and not raw[e:e + 1].isspace():
            s += 1
        out.append((s, e))
    return out


def _whole_words(raw: bytes, s: int, e: int, more_before: bool, more_after: bool) -> tuple[int, int]:
    """The span without the parts of words at its ends, be they parts here or in the earlier text."""
    if s < e and not raw[s:s + 1].isspace() and (more_before or s > 0 and not raw[s - 1:s].isspace()):
        while s < e and not raw[s:s + 1].isspace():
            s += 1
    if s < e and not raw[e - 1:e].isspace() and (more_after or e < len(raw) and not raw[e:e + 1].isspace()):
        while s < e and not raw[e - 1:e].isspace():
            e -= 1
    return s, e
