"""Token counts of documents in flat token files, found by their separators.

A flat token file is a run of token ids (two bytes each, four for larger vocabularies) in
which every document ends with the end-of-document id; there is no index. It is held in
blocks of a fixed number of tokens, cut without regard to documents: rows (file, block,
tokens). A scan finds the separators of each block by one vectorised comparison; since
documents run across blocks, the counts at the edges are stitched by a prefix scan: the
number of separators before a block numbers its documents, and the tokens since the last
separator before it belong to its first document.

``tokenise`` writes such files from documents, one per block of texts, with the ids of the
documents in file order beside them (the files themselves stay unindexed); ``scan`` reads
any. A vocabulary file is read once by the driver from a path and broadcast (fixed size).

Edge cases: null and empty texts are documents of 0 tokens. A file without a separator at
its end has an open last document, which is counted. Strings of special tokens in a text
are ordinary text. Repeated rows are documents of their own; a null id is carried. No rows
give no rows. Further columns are not read.

Scale: blocks are rows, spread over tasks whatever the file sizes. The prefix scan is a
window over one row per block (three numbers) within a file, a file being at most one
block of texts long here; the tokens are never shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry.llm.frames import materialise
from telemetry.llm.textblocks import blocks

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the piece pattern that goes with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS = 1 << 16
FILE_BYTES = 4 << 20


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes -> id, from lines of base64 and number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _encoder(ranks: dict[bytes, int], pattern: str):
    import tiktoken
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenise(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
             pattern: str = PATTERN, block_tokens: int = BLOCK_TOKENS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Flat files as rows (file, block, tokens, ids): ``ids`` of the documents of a file, in its first block only.

    The end-of-document id is the number after the vocabulary's last.
    """
    ranks = read_vocabulary(vocabulary)
    end = max(ranks.values()) + 1
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[id_column].dataType.simpleString()
    width = np.uint16 if end < 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value, pattern)
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1), file_bytes):
                flat = np.concatenate([np.array([*enc.encode_ordinary(b.text(i).decode()), end], dtype=width) for i in range(b.n)])
                cuts = range(0, len(flat), block_tokens)
                here = ids.slice(b.first, b.n).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{part:08d}-{number:06d}"] * len(cuts)), pa.array(np.arange(len(cuts)), pa.int64()),
                     pa.array([flat[c:c + block_tokens].tobytes() for c in cuts], pa.binary()),
                     pa.array([here if c == 0 else None for c in cuts], pa.list_(ids.type))],
                    names=["file", "block", "tokens", "ids"])
                number += 1
    return docs.select(id_column, text).mapInArrow(run, f"file string, block bigint, tokens binary, ids array<{kind}>")


def scan(files: DataFrame, end: int, token_bytes: int = 2) -> DataFrame:
    """(file, seq, n_tokens): the documents of each file in order, with their tokens (separator not counted)."""
    width = {2: np.uint16, 4: np.uint32}[token_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, head, tail, inner = [], [], [], []
            for raw in batch.column(2):
                tokens = np.frombuffer(raw.as_buffer(), width) if raw.is_valid else np.empty(0, width)
                at = np.flatnonzero(tokens == end)
                n.append(len(at))
                head.append(int(at[0]) if len(at) else len(tokens))  # before the first separator, or all
                tail.append(len(tokens) - int(at[-1]) - 1 if len(at) else len(tokens))
                inner.append(np.diff(at) - 1)  # whole documents between separators
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(head, pa.int64()),
                 pa.array(tail, pa.int64()), pa.array([x.tolist() for x in inner], pa.list_(pa.int64()))],
                names=["file", "block", "n_ends", "head", "tail", "inner"])
    found = files.select("file", "block", "tokens").mapInArrow(
        run, "file string, block bigint, n_ends bigint, head bigint, tail bigint, inner array<bigint>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Tokens that stand open before a block: all tails since the last block with a separator, that block's included.
    runs = found.withColumn("ends_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0))) \
        .withColumn("segment", F.coalesce(F.sum((F.col("n_ends") > 0).cast("long")).over(before), F.lit(0)))
    # a block that closes documents opens the segment after it with its tail
    in_segment = Window.partitionBy("file", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_tail = F.lag("tail").over(Window.partitionBy("file").orderBy("block"))
    opened = runs.withColumn("first_open", F.when(F.row_number().over(Window.partitionBy("file", "segment").orderBy("block")) == 1,
                                                  F.coalesce(last_tail, F.lit(0))).otherwise(F.lit(0)))
    open_before = F.coalesce(F.sum(F.when(F.col("n_ends") == 0, F.col("head")).otherwise(0) + F.col("first_open")).over(in_segment), F.lit(0)) \
        + F.col("first_open")
    stitched = opened.withColumn("open", open_before)
    closed = stitched.filter("n_ends > 0").select(
        "file", F.posexplode(F.concat(F.array(F.col("open") + F.col("head")), "inner")).alias("i", "n_tokens"), "ends_before") \
        .select("file", (F.col("ends_before") + F.col("i")).alias("seq"), "n_tokens")
    ends = Window.partitionBy("file").orderBy(F.col("block").desc())
    rest = stitched.withColumn("r", F.row_number().over(ends)).filter("r = 1").select(
        "file", (F.col("ends_before") + F.col("n_ends")).alias("seq"),
        F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("head")).alias("n_tokens")).filter("n_tokens > 0")
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, **options) -> DataFrame:
    """One row per document: id, file, seq, n_tokens; the files are written to the shared folder first."""
    end = max(read_vocabulary(vocabulary).values()) + 1
    files = materialise(tokenise(docs, id_column, text, vocabulary, **options), "tokens")
    names = files.filter("ids is not null").select("file", F.posexplode("ids").alias("seq", id_column))
    counts = scan(files, end, 2 if end < 1 << 16 else 4)
    return names.join(counts, ["file", "seq"], "left").select(
        id_column, "file", F.col("seq").cast("long").alias("seq"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
