"""Sharding by a k-d tree of weighted medians.

Every document is a point of metadata coordinates (source, language, size, id), each
scaled to 20 bits, with 40 bits of a hash of the document below, so that documents of
equal metadata can still be told apart. A node for several leaves is split along its
widest coordinate where the bytes on the left reach the left leaves' share. The weighted
median is found by histograms: tasks sum bytes per bin of every open node at once, the
driver sees at most ``BINS`` sums a node and narrows the bin until it holds one key.

Law: ``bytes`` - the sizes of the shards are equal but for single documents at the cuts.

Edge cases: size is the UTF-8 bytes of the text plus 16 (null text: 16; its crc32 is that of no
bytes, 0). Null metadata has the lowest coordinate. Rows equal in id and text get running numbers, so
that they part like others; which of them goes where cannot be seen. No rows give no rows; with fewer documents
than shards some shards stay empty. Further columns are not read.

Scale: one pass over the texts makes a narrow table (written once); the passes of the tree
read that alone, combine inside the tasks and shuffle only sums. Slots are numbered within
(shard, hash range) from offsets of the ranges, so no shard is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry.llm.frames import attach, fresh, materialise, semi, small

SHARDS = 40
BIN_BITS = 14
BINS = 1 << BIN_BITS
COORD_BITS, TIE_BITS = 20, 40
KEY_BITS = COORD_BITS + TIE_BITS
DIMS = ("source", "lang", "bytes", "id")
#: Documents of one numbering group.
SLOT_ROWS = 50_000


def points(docs: DataFrame, id_column: str, text: str, source: str, lang: str) -> DataFrame:
    """id, size, text_crc32, tie and the raw coordinates of every row."""
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))

    def place(c: str) -> Column:
        return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) + 1, F.lit(0)).cast("double")
    number = F.expr(f"try_cast(`{id_column}` AS DOUBLE)")
    return docs.select(
        F.col(id_column).alias("id"), size.alias("size"), crc.alias("text_crc32"),
        F.xxhash64(F.col(id_column), crc, size).bitwiseAND((1 << TIE_BITS) - 1).alias("tie"),
        place(source).alias("c0"), place(lang).alias("c1"), F.log2(size).alias("c2"),
        number.alias("c3"))


def told_apart(raw: DataFrame) -> DataFrame:
    """``raw`` (a written table) with another tie for each of the rows equal in id, checksum and size.

    They are numbered inside the blocks of the written table, after the numbers of the blocks before, so a
    group of copies is never in one task; the set of ties follows from the size of the group alone.
    """
    key, part, at, before, block = (fresh(x) for x in ("key", "part", "at", "before", "block"))
    named = raw.withColumns({key: F.struct("id", "text_crc32", "size"), part: F.spark_partition_id(), at: F.monotonically_increasing_id()})
    twins = named.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    if twins.isEmpty():
        return raw
    numbered = materialise(named, "copies")  # partition and place are fixed from here on
    some = semi(numbered, twins, key)
    counts = some.groupBy(key, part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.struct(key, part).alias(block), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    number = F.row_number().over(Window.partitionBy(key, part).orderBy(at)) + F.col(before)
    apart = attach(some.withColumn(block, F.struct(key, part)), offsets, block) \
        .withColumn("tie", F.xxhash64("tie", number).bitwiseAND((1 << TIE_BITS) - 1))
    alone = numbered.join(small(twins), key, "left_anti")
    return materialise(alone.select(*raw.columns).unionByName(apart.select(*raw.columns)), "points")


def keyed(raw: DataFrame) -> DataFrame:
    """Coordinates scaled to 20 bits over the whole table, with the tie below: k0 .. k3."""
    cols = range(len(DIMS))
    ends = raw.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in cols for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    top = float((1 << COORD_BITS) - 1)

    def key(i: int) -> Column:
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or hi <= lo:
            return F.col("tie")
        step = F.floor((F.col(f"c{i}") - lo) / F.lit(hi - lo) * top)
        return F.shiftleft(F.coalesce(step, F.lit(0)).cast("long"), TIE_BITS) + F.col("tie")
    return raw.select("id", "size", "text_crc32", "tie", *[key(i).alias(f"k{i}") for i in cols])


@dataclass
class Tree:
    """Nodes in arrays: an inner node sends keys up to ``cut`` of ``dim`` left; a leaf has a shard number."""

    dim: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    shard: list[int] = field(default_factory=lambda: [-1])
    leaves: list[int] = field(default_factory=lambda: [1])

    def add(self, leaves: int) -> int:
        for column, value in ((self.dim, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.shard, -1), (self.leaves, leaves)):
            column.append(value)
        return len(self.dim) - 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Node of every row of ``keys`` (rows, dims)."""
        dim, cut, left, right = (np.array(x, dtype=np.int64) for x in (self.dim, self.cut, self.left, self.right))
        node = np.zeros(len(keys), dtype=np.int64)
        while len(live := np.flatnonzero(dim[node] >= 0)):
            at = node[live]
            node[live] = np.where(keys[live, dim[at]] <= cut[at], left[at], right[at])
            if not (dim[node[live]] >= 0).any():
                break
        return node


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(f"k{i}")).to_numpy() for i in range(len(DIMS))], 1)


def _spans(table: DataFrame, tree: Tree, open_nodes: list[int]) -> dict[int, tuple]:
    """Per open node: bytes and the lowest and highest key of each dimension."""
    shared = table.sparkSession.sparkContext.broadcast((tree, set(open_nodes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, wanted = shared.value
        for batch in batches:
            keys, size = _keys(batch), batch.column(batch.schema.get_field_index("size")).to_numpy()
            node = t.find(keys)
            found = [x for x in np.unique(node).tolist() if x in wanted]
            masks = [node == x for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array([int(size[m].sum()) for m in masks], pa.int64()),
                 *(pa.array([int(f(keys[m, i])) for m in masks], pa.int64()) for i in range(len(DIMS)) for f in (np.min, np.max))],
                names=["node", "bytes", *(f"{n}{i}" for i in range(len(DIMS)) for n in ("lo", "hi"))])
    names = [f"{n}{i}" for i in range(len(DIMS)) for n in ("lo", "hi")]
    sums = table.mapInArrow(run, "node bigint, bytes bigint, " + ", ".join(f"{n} bigint" for n in names)) \
        .groupBy("node").agg(F.sum("bytes").alias("bytes"), *[(F.min if n[0] == "l" else F.max)(n).alias(n) for n in names])
    return {r["node"]: (r["bytes"], [r[f"lo{i}"] for i in range(len(DIMS))], [r[f"hi{i}"] for i in range(len(DIMS))])
            for r in sums.collect()}  # a row per open node


def _histogram(table: DataFrame, tree: Tree, ranges: dict[int, tuple[int, int, int]]) -> dict[int, list]:
    """Per open node (dim, lo, width of a bin): sorted (bin, bytes, rows) of the bins in range."""
    shared = table.sparkSession.sparkContext.broadcast((tree, ranges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, want = shared.value
        for batch in batches:
            keys, size = _keys(batch), batch.column(batch.schema.get_field_index("size")).to_numpy()
            node = t.find(keys)
            out = [[], [], [], []]
            for x in np.unique(node).tolist():
                if x not in want:
                    continue
                dim, lo, width = want[x]
                rows = node == x
                bins = (keys[rows, dim] - lo) // width
                ok = (bins >= 0) & (bins < BINS)
                kinds, at = np.unique(bins[ok], return_inverse=True)
                out[0].append(np.full(len(kinds), x))
                out[1].append(kinds)
                out[2].append(np.bincount(at, weights=size[rows][ok], minlength=len(kinds)).astype(np.int64))
                out[3].append(np.bincount(at, minlength=len(kinds)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(o) if o else np.empty(0), pa.int64()) for o in out],
                names=["node", "bin", "bytes", "n"])
    sums = table.mapInArrow(run, "node bigint, bin bigint, bytes bigint, n bigint") \
        .groupBy("node", "bin").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    found: dict[int, list] = {}
    rows = sums.toArrow()  # at most BINS rows per open node, in one job (a local iterator runs one a partition)
    for node, *row in zip(*(rows.column(c).to_pylist() for c in ("node", "bin", "bytes", "n"))):
        found.setdefault(node, []).append(tuple(row))
    return {k: sorted(v) for k, v in found.items()}


def grow(table: DataFrame, leaves: int) -> Tree:
    """Split nodes level by level until every node is one leaf."""
    tree = Tree(leaves=[leaves])
    open_nodes = [0] if leaves > 1 else []
    while open_nodes:
        spans = _spans(table, tree, open_nodes)
        ranges, want = {}, {}
        for x in list(open_nodes):
            if x not in spans:  # no rows: a split anywhere will do
                spans[x] = (0, [0] * len(DIMS), [0] * len(DIMS))
            total, lo, hi = spans[x]
            widths = [(h >> TIE_BITS) - (s >> TIE_BITS) for s, h in zip(lo, hi)]
            dim = int(np.argmax(widths))
            half = tree.leaves[x] // 2
            want[x] = [dim, round(total * half / tree.leaves[x]), lo[dim] - 1]  # dim, bytes wanted left, cut so far
            ranges[x] = (dim, lo[dim], max(1, -(-(hi[dim] - lo[dim] + 1) // BINS)))
        while ranges:
            sums = _histogram(table, tree, ranges)
            after = {}
            for x, (dim, lo, width) in ranges.items():
                for bin_, size, n in sums.get(x, []):
                    if size <= want[x][1]:
                        want[x][1] -= size
                        want[x][2] = lo + (bin_ + 1) * width - 1
                        continue
                    if width > 1 and n > 1:
                        after[x] = (dim, lo + bin_ * width, -(-width // BINS))
                    elif 2 * want[x][1] > size:  # one document or equal ones: to the nearer side
                        want[x][2] = lo + (bin_ + 1) * width - 1
                    break
            ranges = after
        level, open_nodes = open_nodes, []
        for x in level:
            half = tree.leaves[x] // 2
            tree.dim[x], tree.cut[x] = want[x][0], want[x][2]
            tree.left[x] = tree.add(half)
            tree.right[x] = tree.add(tree.leaves[x] - half)
            open_nodes += [c for c in (tree.left[x], tree.right[x]) if tree.leaves[c] > 1]
    for number, x in enumerate(i for i in range(len(tree.dim)) if tree.leaves[i] == 1):
        tree.shard[x] = number
    return tree


def shard_table(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None,
                id_column: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    The number of leaves is ``shards``, or with ``target_bytes`` what brings leaves to that size.
    """
    raw = materialise(points(docs, id_column, text, source, lang), "points")
    n, total = raw.agg(F.count(F.lit(1)), F.sum("size")).first()
    if target_bytes:
        shards = max(1, -(-(total or 0) // target_bytes))
    table = keyed(told_apart(raw))
    tree = grow(table, shards) if n else Tree(shard=[0])
    shared = docs.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        number = np.array(t.shard, dtype=np.int32)
        for batch in batches:
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "size", "text_crc32", "tie")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(number[t.find(_keys(batch))])],
                                             names=["id", "size", "text_crc32", "tie", "shard"])
    kind = raw.schema["id"].dataType.simpleString()
    placed = materialise(table.mapInArrow(run, f"id {kind}, size bigint, text_crc32 bigint, tie bigint, shard int"), "shards")

    groups = max(1, -(-n // (shards * SLOT_ROWS)))
    part = F.floor(F.col("tie") / F.lit((1 << TIE_BITS) / groups)).cast("int")
    placed = placed.withColumn("part", F.struct("shard", part.alias("range")))
    before = Window.partitionBy("part.shard").orderBy("part.range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")) \
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    row = F.row_number().over(Window.partitionBy("part").orderBy("tie", "id"))
    return attach(placed, offsets, "part").select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + row - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
