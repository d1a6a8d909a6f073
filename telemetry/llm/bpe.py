"""Byte-pair encoding and decoding with a tokenizer file of merge ranks.

A text is cut at the strings of special tokens, brought to NFC and lower case, and split
into pieces (``PIECE``). The UTF-8 bytes of a piece, each written as one symbol of the
vocabulary and the last with the end-of-word mark, form a doubly linked list. All adjacent
pairs that have a merge stand in a priority queue of (rank, place). The pair of lowest rank,
of equal ones the leftmost, is merged: its right symbol leaves the list, and the pairs that
the new symbol forms with its neighbours are queued. Entries whose symbols have changed since
are skipped when they come up. So a piece of n bytes costs n log n, however long it is.
Decoding looks up the vocabulary string of every id and joins the strings by one space, as
the file, which names no decoder, prescribes.

Ids are held as little-endian unsigned 32-bit numbers in one binary value per text.

A vocabulary file is read once by the driver from a path and broadcast: its size is fixed. A
worker keeps the ids of short pieces it has met, at most two generations of ``KEPT`` of them.

Edge cases: null and empty texts have no tokens (an empty binary) and decode to an empty
text; a null value of ids decodes to an empty text, an id outside the vocabulary raises.
Strings of special tokens inside a text are special tokens, in this spelling only. Rows are
encoded one by one, so repeated rows, ties and null ids are kept; further columns are carried
along (a column of the result's name is replaced). No rows give no rows.

Scale: one narrow pass without a shuffle, memory bounded by the longest text.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Pieces a worker keeps per generation, and the longest piece kept.
KEPT, KEPT_LENGTH = 1 << 18, 40

#: Fixed value: the piece pattern of the vocabulary; the second form is the same on ASCII text.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Letters and digits that the pattern library knows from later editions of Unicode than the
#: vocabulary's reader (first and last), and letters whose lower case Python's tables do not have yet.
LATER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
LATER_CASES = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
               0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_later = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER_LETTERS)
LATER = frozenset(chr(c) for a, b in LATER_LETTERS for c in range(a, b + 1)) | frozenset(map(chr, LATER_CASES))
LATER_PIECE = regex.compile("(?V1)" + PIECE.pattern.replace(r"\p{L}", rf"[\p{{L}}--[{_later}]]").replace(r"\p{N}", rf"[\p{{N}}--[{_later}]]"))
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r 0-9a-z]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file as tables over ids."""

    strings: tuple[str, ...]                           # by id, special tokens included
    inner: tuple[int, ...]                             # id of each byte inside a piece
    last: tuple[int, ...]                              # id of each byte at the end of a piece
    merges: dict[tuple[int, int], tuple[int, int]]     # pair of ids -> (rank, id of the merged symbol)
    special: dict[str, int]


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """The tables of a tokenizer file (BPE over byte symbols with an end-of-word mark)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [""] * (max([*ids.values(), *special.values()]) + 1)
    for s, i in [*ids.items(), *special.items()]:
        strings[i] = s
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return Vocabulary(
        tuple(strings), tuple(ids[c] for c in byte_symbols()), tuple(ids[c + end] for c in byte_symbols()),
        {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}, special)


def merge(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Ids of a piece after all merges, from the ids of its bytes (the list is used up)."""
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            queue.append((found[0], i, found[1]))
    heapq.heapify(queue)
    while queue:
        rank, i, made = heapq.heappop(queue)
        j = after[i]
        # stale: the symbol is gone, stands last, or either symbol of the pair has changed
        if symbols[i] < 0 or j == n or merges.get((symbols[i], symbols[j])) != (rank, made):
            continue
        symbols[i], symbols[j] = made, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = merges.get((made, symbols[k]))
            if found:
                heapq.heappush(queue, (found[0], i, found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get((symbols[h], made))
            if found:
                heapq.heappush(queue, (found[0], h, found[1]))
    return [s for s in symbols if s >= 0]


class Encoder(dict):
    """Piece -> its ids as bytes; what is met anew is merged and kept for a while."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v, self.older = v, {}
        self.cut = re.compile("(" + "|".join(map(re.escape, v.special)) + ")") if v.special else None

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode()
            inner = self.v.inner
            ids = np.array(merge([*(inner[b] for b in raw[:-1]), self.v.last[raw[-1]]], self.v.merges), "<u4").tobytes()
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def text(self, text: str) -> bytes:
        if not self.cut or "<" not in text:
            return self.plain(text)
        return b"".join(np.array([self.v.special[part]], "<u4").tobytes() if i % 2 else self.plain(part)
                        for i, part in enumerate(self.cut.split(text)))

    def plain(self, text: str) -> bytes:
        if text.isascii():
            pieces = ASCII_PIECE.findall(text.lower())
        else:
            # every letter is lowered by itself: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if not LATER.isdisjoint(set(text)):
                pieces = LATER_PIECE.findall(text.translate(LATER_CASES))
            else:
                pieces = PIECE.findall(text)
        return b"".join(map(self.__getitem__, pieces))


def decoded(ids: bytes | None, v: Vocabulary) -> str:
    return " ".join(map(v.strings.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _mapped(df: DataFrame, source: str, result: str, kind: str, arrow: pa.DataType, vocabulary: str, make) -> DataFrame:
    """``df`` with ``result`` = what the function made by ``make(tables)`` gives for each value of ``source``."""
    out = df.withColumn(result, F.lit(None).cast(kind)) if result != source else df
    at, to = out.columns.index(source), out.columns.index(result)
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make(shared.value)
        for batch in batches:
            values = pa.array([each(x.as_py()) for x in batch.column(at)], arrow)
            yield batch.set_column(to, pa.field(result, arrow), values)
    return out.mapInArrow(run, out.schema)


def encode(docs: DataFrame, text: str = "text", result: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the ids of every whole text (binary, little-endian unsigned 32-bit)."""
    if result == text:
        raise ValueError("the result column must not be the text column")

    def make(v: Vocabulary):
        encoder = Encoder(v)
        return lambda t: encoder.text(t or "")
    return _mapped(docs, text, result, "binary", pa.binary(), vocabulary, make)


def decode(tokens: DataFrame, ids: str = "tokens", result: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens`` with the text of every value of ids."""
    if result == ids:
        raise ValueError("the result column must not be the ids column")
    return _mapped(tokens, ids, result, "string", pa.string(), vocabulary, lambda v: lambda b: decoded(b, v))
