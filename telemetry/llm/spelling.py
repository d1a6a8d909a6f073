"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The vocabulary is every run of letters that occurs often enough in whole texts. Two words are
near if they differ by one inserted, deleted or replaced letter. For a group of words there is
one bitset per (position, letter), one bit a word. A word walks through its letters and tracks
the words of its group in a few word-parallel steps: ``zero`` holds those equal so far; where
the letters differ first, words pass from it into one of the sets with one error, compared
from there on at the same position (replaced), the next (the other word has a letter more) or
the one before (a letter less).

Groups. Words of n and n + 1 letters meet in class n (words of equal length in the class of
that length). A group of more than ``GROUP`` words is split by the place of the first difference:
pairs that differ first in the second half of the open letters agree in the first half, the
others agree in the second. So every word goes to one group for its first half and to one for
its second, each pair is looked for in exactly one group, and splitting goes on until a group
is small or its words have one open letter, which bounds it by the square of the alphabet.

A word's form is its near word of most occurrences (ties: the first in code-point order) if
that has at least ``RATIO`` times its own; its root is the last word reached by forms.

Edge cases: null texts have no words; a null id counts as an empty one where the planted typos
need it. Repeated rows count again. Words without near words have n_near 0 and are their own
root. No documents, or none with frequent words, give no rows. Other columns are not read.

Scale: occurrences are counted per document and per task before the shuffle. Every word has a
few rows in a few groups; a letter or half that most words share makes a group that is split
again, never one task. No pairs are written, only each word's count of near words and its best
one per group. Roots are found by doubling, in rounds by the logarithm of the longest chain
(occurrences double at every step, so chains are short).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry.llm.frames import attach, materialise

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
#: Words of a group above which it is split.
GROUP = 2048
#: Words a counting task holds before it hands on its counts.
HELD = 200_000

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


# ---- vocabulary ------------------------------------------------------------------------------

def with_typo(word: str, raw: bytes, prefix_crc: int, every: int) -> str:
    """``word`` without one letter if ``every`` divides the crc32 of prefix and word."""
    h = zlib.crc32(raw, prefix_crc)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, typo_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``min_length`` letters and ``min_count`` occurrences.

    With ``typo_every`` a letter is deleted from the words of a document whose crc32 of
    ``<id>:<word>`` that number divides, before words are counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out
        for batch in batches:
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = Counter(LETTERS.findall((value.as_py() or "").encode().lower().decode()))  # bytes: A-Z only
                prefix = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for word, n in words.items():
                    if typo_every and len(word) >= min_length:
                        word = with_typo(word, word.encode(), prefix, typo_every)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > HELD:
                    yield counts()
        if held:
            yield counts()
    return docs.select(F.col(id_column).cast("string"), text).mapInArrow(run, "word string, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---- groups ----------------------------------------------------------------------------------

def _key():
    """Words of a group agree in class, in ``pre`` first and in ``suf`` last letters."""
    return F.concat_ws(":", "class", "pre", "suf", F.expr("left(word, pre)"), F.expr("right(word, suf)"))


def groups(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, class, pre, suf, key): the groups in which each word meets words near it."""
    opened = words.select("word", "n", F.explode(F.expr("array(length(word), length(word) - 1)")).alias("class"),
                          F.lit(0).alias("pre"), F.lit(0).alias("suf")).withColumn("key", _key())
    done = []
    while True:
        large = opened.groupBy("key").count().filter(F.col("count") > group).select("key", F.lit(True).alias("large"))
        if large.isEmpty():
            break
        tagged = attach(opened, large, "key").withColumn("large", F.coalesce("large", F.lit(False)) & (F.col("class") - F.col("pre") - F.col("suf") > 1))
        tagged = materialise(tagged, "groups")
        done.append(tagged.filter("not large").drop("large"))
        middle = "int(pre + (class - pre - suf) div 2)"
        opened = tagged.filter("large").select(
            "word", "n", "class", F.explode(F.expr(f"array(struct({middle} as pre, suf), struct(pre, int(class - {middle}) as suf))")).alias("half")) \
            .select("word", "n", "class", "half.pre", "half.suf").withColumn("key", _key())
    for part in done:
        opened = opened.unionByName(part)
    return opened


def near_in_group(words: list[str], short: int, last: bool) -> Iterator[tuple[int, int]]:
    """(place, bitset of the places of near words) of every word, where words have ``short`` or one more letters.

    Only pairs that differ first at one of the ``short`` letters count, and with ``last`` those
    that differ first behind them.
    """
    index: list[dict[str, int]] = [{} for _ in range(short + 1)]
    longer, bit = 0, 1
    for word in words:
        for slice_, letter in zip(index, word):
            slice_[letter] = slice_.get(letter, 0) | bit
        if len(word) > short:
            longer |= bit
        bit <<= 1
    everything = bit - 1
    equal = everything ^ longer
    for place, word in enumerate(words):
        zero, replaced, added, dropped = everything, 0, 0, 0
        if len(word) == short:
            for j, letter in enumerate(word):
                here = index[j].get(letter, 0)
                differs = zero & ~here
                replaced = replaced & here | differs
                added = (added | differs) & index[j + 1].get(letter, 0)
                zero &= here
            found = replaced & equal | added & longer
            if last:
                found |= zero & longer
        else:
            for j, letter in enumerate(word):
                here = index[j].get(letter, 0)
                dropped &= index[j - 1].get(letter, 0) if j else 0
                if j < short or last:
                    dropped |= zero & ~here
                zero &= here
            found = dropped & equal
        if found:
            yield place, found


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, words of a key by falling n, then word -> each word's near words in the group."""
    out: list[list] = [[], [], [], []]
    key, rows = None, []

    def close() -> None:
        if len(rows) < 2:
            return
        class_, pre, suf = rows[0][2:]
        open_letters = [r[0][pre:len(r[0]) - suf] for r in rows]
        for place, found in near_in_group(open_letters, class_ - pre - suf, suf == 0):
            first = rows[(found & -found).bit_length() - 1]
            for column, value in zip(out, (rows[place][0], found.bit_count(), first[0], first[1])):
                column.append(value)

    def take() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                            pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                                           names=["word", "near", "form", "form_n"])
        for column in out:
            column.clear()
        return batch
    for batch in batches:
        for k, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                close()
                key, rows = k, []
            rows.append(row)
        if len(out[0]) > 10_000:
            yield take()
    close()
    yield take()


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n_near, form, form_n) of words with near words: how many, and the most frequent of them."""
    found = groups(words, group).repartition("key").sortWithinPartitions("key", F.desc("n"), "word") \
        .select("key", "word", "n", "class", "pre", "suf") \
        .mapInArrow(_best, "word string, near bigint, form string, form_n bigint")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")) \
        .select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


# ---- forms and roots -------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, form) without loops -> (word, root): the last word reached, by doubling."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(attach(now, step, "root"), "forms")
        now = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next is not null").isEmpty():
            return now


def variants(words: DataFrame, group: int = GROUP, ratio: int = RATIO) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n."""
    words = materialise(words.select("word", "n"), "words")
    near = near_words(words, group).withColumnRenamed("word", "_word")
    enough = F.col("form_n") >= ratio * F.col("n")
    table = words.join(near, words["word"] == near["_word"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    table = materialise(table, "variants")
    last = roots(table.filter("form is not null")).withColumnRenamed("word", "_word")
    return table.join(last, table["word"] == last["_word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
