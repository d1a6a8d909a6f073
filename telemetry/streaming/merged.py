"""Tables that micro-batches add to and that merge as they grow.

Folder n (counted from 1) holds what the batches n - b + 1 to n added, merged into one, b being
the lowest set bit of n: 1 batch, 2, 1, 4, 1, 2, 1, 8, ... The folders that hold all batches up to
n are found from n alone, log2(n) of them at most, and each row is rewritten log2(n) times at
most, so neither reading nor upkeep grows with the batches that passed. ``base`` holds what
there was before the first batch, whose number ``start`` holds.

A replayed batch reads only folders of batches before it and overwrites its own, so whatever it
added the first time is taken back. Folders whose content a later one took over are removed
once that later batch is committed, that is when the next batch runs.

``merge`` must be associative and commutative over the rows, and keep the schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from telemetry.streaming.folders import exists, hadoop, remove


def _low_bit(n: int) -> int:
    return n & -n


class MergedTable:
    def __init__(self, folder: str, schema: str, merge: Callable[[DataFrame], DataFrame], sort: tuple[str, ...]):
        self.folder, self.schema, self.merge, self.sort = folder, schema, merge, sort
        self._start: int | None = None

    def create(self, spark: SparkSession, rows: DataFrame | None = None, batch_id: int = 0) -> None:
        """Start the table with ``rows`` (not merged yet) before ``batch_id``; does nothing if it is there."""
        if not exists(spark, f"{self.folder}/start/_SUCCESS"):
            self._write(spark.createDataFrame([], self.schema) if rows is None else self.merge(rows), "base")
            spark.range(batch_id, batch_id + 1).write.mode("overwrite").parquet(f"{self.folder}/start")

    def start(self, spark: SparkSession) -> int:
        """The first batch that added to the table."""
        if self._start is None:
            self._start = spark.read.schema("id long").parquet(f"{self.folder}/start").first()["id"]
        return self._start

    def _write(self, rows: DataFrame, name: str) -> None:
        # sorted, so that the statistics of the files leave out keys not asked for
        rows.sortWithinPartitions(*self.sort).write.mode("overwrite").parquet(f"{self.folder}/{name}")

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*[f"{self.folder}/{name}" for name in names])

    @staticmethod
    def parts(n: int, after: int = 0) -> Iterator[int]:
        """Folders that together hold the batches ``after`` + 1 to n."""
        while n > after:
            yield n
            n -= _low_bit(n)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What all batches before ``batch_id`` added, not merged across folders (batches count from 0)."""
        return self._read(spark, ["base", *(f"upto={n}" for n in self.parts(batch_id) if n > self.start(spark))])

    def write(self, spark: SparkSession, batch_id: int, rows: DataFrame) -> None:
        """Add the rows of this batch."""
        n = batch_id + 1
        taken = [i for i in self.parts(n - 1, n - _low_bit(n)) if i > self.start(spark)]
        if taken:
            rows = rows.unionByName(self._read(spark, [f"upto={i}" for i in taken]))
        self._write(self.merge(rows), f"upto={n}")
        for i in self.parts(n - 2, n - 1 - _low_bit(n - 1)) if n > 1 else ():
            remove(spark, f"{self.folder}/upto={i}")

    def newest(self, spark: SparkSession) -> int:
        """Batches that the table holds. Lists the few folders that are left."""
        path, fs = hadoop(spark, self.folder)
        names = [str(s.getPath().getName()) for s in fs.listStatus(path)]
        done = [int(x[5:]) for x in names if x.startswith("upto=") and exists(spark, f"{self.folder}/{x}/_SUCCESS")]
        return max(done, default=self.start(spark))

    def now(self, spark: SparkSession) -> DataFrame:
        """The merged table as of the newest batch."""
        return self.merge(self.before(spark, self.newest(spark)))
