"""Arrow text columns as flat byte blocks, with vectorised words, hashes and line spans.

The functions run inside ``mapInArrow`` tasks. A record batch is cut into blocks of whole
rows of at most ``BLOCK_BYTES`` text bytes (one longer row is a block of its own), so the
working arrays of a task stay bounded by the longest text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21

#: Lower-cases ASCII A-Z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that stop at ASCII white space only.
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True


@dataclass
class Block:
    """Rows ``first`` to ``last`` (exclusive) of a batch: their bytes and row offsets."""

    first: int
    last: int
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, last - first + 1 entries, starting at 0

    @property
    def n(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(n, max(last, first + 1))
        yield Block(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def word_spans(b: Block, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word; words never cross rows."""
    inside = is_word[b.data]
    edge = np.empty(len(inside) + 1, dtype=bool)
    if not len(inside):
        z = np.empty(0, np.int64)
        return z, z, z
    edge[0], edge[-1] = inside[0], False
    edge[1:-1] = inside[1:] & ~inside[:-1]
    cuts = b.offsets[1:-1]
    cuts = cuts[cuts < len(inside)]
    edge[cuts] = inside[cuts]
    starts = np.flatnonzero(edge[:-1])
    edge[0] = False
    edge[-1] = inside[-1]
    edge[1:-1] = inside[:-1] & ~inside[1:]
    cuts = cuts[cuts > 0]
    edge[cuts] = inside[cuts - 1]
    ends = np.flatnonzero(edge)
    return starts, ends, np.searchsorted(b.offsets, starts, "right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers drawn from a seed."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = constants(77, 256)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept and grown per worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (polynomial over the bytes, mixed with the length)."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=total[1:])
    poly = (total[ends] - total[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)
