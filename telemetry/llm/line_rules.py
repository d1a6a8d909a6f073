"""Line-first cleaning: rules on every line, then a verdict on what is left of the document.

A line fails if it is
- navigation: two or more separator words (``|``, ``>``), a fifth of its words or more;
- symbol noise: more than a quarter of its words hold one of ``#*$%&|<>``;
- shouting: three words or more, over half of them with two or more A-Z and no a-z;
- a fragment: fewer than five words and no closing punctuation;
- boilerplate: it holds one of ``PHRASES`` in any case;
- a repeat: equal to an earlier line with a word of the same text.
Failed lines are removed. A document is dropped if the base rules fail (too few words, too
many words in repeated three-word windows) or if over half of its words went with lines.

Edge cases: null and empty texts have no words, all counts are 0 and the base rules fail.
Lines without a word belong to no rule and are dropped from the cleaned text. Rows are judged one by one, so
repeated rows, ties and further columns of any name do no harm (``add_rules`` adds one
struct column). Whole texts are used; one narrow pass, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry.llm.textblocks import SPACE_WORD, Block, blocks, row_counts, span_hashes, word_spans

MIN_WORDS = 50
#: Phrases of page furniture.
PHRASES = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
           "log in", "sign up", "subscribe to", "javascript", "skip to content")
_PHRASE = re.compile("|".join(PHRASES).encode(), re.IGNORECASE)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[[ord(c) for c in ".!?:;\"')"]] = True
_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER_CASE = np.zeros(256, dtype=bool)
_LOWER_CASE[97:123] = True

FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, " \
         "n_lost_words bigint, base_failed boolean, kept boolean"


def _seen_before(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Flags entries equal to an earlier entry of the same owner."""
    order = np.lexsort((np.arange(len(value)), value, owner))
    again = np.zeros(len(value), dtype=bool)
    if len(value) > 1:
        a, b = order[1:], order[:-1]
        again[a] = (value[a] == value[b]) & (owner[a] == owner[b])
    return again


def _count(mask: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.cumsum(np.concatenate([[0], mask[data]]))
    return total[ends] - total[starts]


def judge(b: Block) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(columns per row, line starts, line ends, kept lines) of a block."""
    n, data = b.n, b.data
    ws, we, owner = word_spans(b, SPACE_WORD)
    ls, le, line_row = word_spans(b, _LINE)
    line = np.searchsorted(ls, ws, "right") - 1
    lines = len(ls)
    line_words = np.bincount(line, minlength=lines)
    n_words = row_counts(owner, n)
    row = np.repeat(np.arange(n), np.diff(b.offsets))
    in_word = SPACE_WORD[data] & ((data & 0xC0) != 0x80)
    word_chars = row_counts(row[in_word], n)
    n_symbols = row_counts(row[_SYMBOL[data]], n)

    some = line_words > 0
    dup = np.zeros(lines, dtype=bool)
    dup[some] = _seen_before(line_row[some], span_hashes(data, ls[some], le[some]))
    n_dup = row_counts(line_row[dup], n)

    repeated = np.zeros(len(ws) + 2, dtype=bool)
    if len(ws) > 2:
        h = span_hashes(data, ws, we)
        t = h[:-2] + h[1:-1] * np.uint64(0x9E3779B97F4A7C15) + h[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
        at = np.flatnonzero(owner[:-2] == owner[2:])
        order = at[np.lexsort((t[at], owner[at]))]
        same = (t[order[1:]] == t[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = np.zeros(len(ws), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        spots = np.flatnonzero(twice)
        for j in range(3):
            repeated[spots + j] = True
    n_repeat = row_counts(owner[repeated[:len(ws)]], n)

    length = we - ws
    separator = (length == 1) & ((data[ws] == ord("|")) | (data[ws] == ord(">"))) if len(ws) else np.empty(0, bool)
    symbol = _count(_SYMBOL, data, ws, we) > 0
    shout = (_count(_UPPER, data, ws, we) >= 2) & (_count(_LOWER_CASE, data, ws, we) == 0)

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line[mask], minlength=lines)
    seps = per_line(separator)
    failed = (seps >= 2) & (5 * seps >= line_words)
    failed |= 4 * per_line(symbol) > line_words
    failed |= (line_words >= 3) & (2 * per_line(shout) > line_words)
    closed = np.zeros(lines, dtype=bool)
    if len(ws):
        last = np.searchsorted(line, np.arange(lines), "right") - 1  # last word of a line
        closed[some] = _CLOSE[data[we[last[some]] - 1]]
    failed |= (line_words < 5) & ~closed
    if lines:
        text = data.tobytes()
        for m in _PHRASE.finditer(text):
            k = int(np.searchsorted(ls, m.start(), "right")) - 1
            failed[k] |= m.end() <= le[k]
    failed |= dup
    failed &= some
    lost = np.bincount(line_row[failed], weights=line_words[failed], minlength=n).astype(np.int64)
    base = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
    columns = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
               "n_repeat_words": n_repeat, "n_lost_words": lost, "base_failed": base,
               "kept": ~base & (2 * lost <= n_words)}
    return columns, ls, le, some & ~failed


def add_rules(docs: DataFrame, text: str = "text", result: str = "rules", cleaned: str | None = None) -> DataFrame:
    """``docs`` with a struct column ``result`` of counts and verdict, and with ``cleaned`` a column of the remaining lines."""
    df = docs.withColumn(result, F.lit(None).cast(f"struct<{FIELDS.replace(' ', ':').replace(',:', ',')}>"))
    if cleaned:
        df = df.withColumn(cleaned, F.lit(""))
    at, out = df.columns.index(text), df.columns.index(result)
    new_text = df.columns.index(cleaned) if cleaned else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, texts = [], []
            kind = batch.schema.field(out).type
            for b in blocks(batch.column(at)):
                columns, ls, le, keep = judge(b)
                parts.append(pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in kind], fields=list(kind)))
                if cleaned:
                    first = np.searchsorted(ls, b.offsets)
                    raw = b.data.tobytes()
                    texts += ["\n".join(raw[ls[k]:le[k]].decode() for k in range(x, y) if keep[k])
                              for x, y in zip(first[:-1], first[1:])]
            batch = batch.set_column(out, batch.schema.field(out), pa.concat_arrays(parts) if parts else pa.array([], kind))
            if cleaned:
                batch = batch.set_column(new_text, batch.schema.field(new_text), pa.array(texts, pa.string()))
            yield batch
    return df.mapInArrow(run, df.schema)


def rule_table(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the counts, base_failed, kept and the words lost."""
    return add_rules(docs.select(F.col(id_column), F.col(text).alias("_text")), "_text", "_r").select(id_column, "_r.*")


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without failed lines and without rejected rows."""
    from telemetry.llm.frames import fresh
    rules, rest = fresh("rules"), fresh("text")
    judged = add_rules(docs, text, rules, rest).filter(F.col(rules)["kept"])
    return judged.withColumn(text, F.col(rest)).drop(rules, rest)
