"""Counters of streams: from the writes of a batch itself, and from the progress of queries.

``Counted`` attaches a row count to a DataFrame that is written anyway, so that a counter costs
no job of its own. ``ProgressLog`` is a ``StreamingQueryListener``: it keeps what each query
reports after a micro-batch (rows read, rates, durations and the metrics that ``observe`` put on
the stream), outside the function that processes the batch.
"""

from __future__ import annotations

import json
import logging
from collections import deque

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Micro-batches whose counters the driver keeps.
HISTORY = 1000

log = logging.getLogger("telemetry.streaming")


class Counted:
    """Counts rows of a DataFrame, all (``rows``) and those that meet conditions, while something else runs it."""

    def __init__(self, df: DataFrame, **conditions: Column):
        self._seen = Observation()
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("rows"),
                             *[F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()])

    def __getitem__(self, name: str) -> int:
        """A count of the first finished action over ``df`` (waits for it)."""
        return int(self._seen.get.get(name) or 0)


class BatchCounters:
    """Per-micro-batch counters (records in, dead letters, rows written); the last ``HISTORY`` are kept."""

    def __init__(self):
        self.history: deque[dict] = deque(maxlen=HISTORY)

    def record(self, name: str, batch_id: int, **counts: int) -> dict:
        row = {"query": name, "batch_id": batch_id, **counts}
        self.history.append(row)
        log.info("%s", row)
        return row


class ProgressLog(StreamingQueryListener):
    """Progress of the session's queries, newest last."""

    def __init__(self, history: int = HISTORY):
        self.progress: deque[dict] = deque(maxlen=history)
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        log.info("started %s %s", event.name, event.runId)

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        self.progress.append({"name": p.get("name"), "run": p["runId"], "batch_id": p["batchId"], "rows": p["numInputRows"],
                              "milliseconds": p.get("durationMs", {}).get("triggerExecution"),
                              "late": sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators") or []),
                              "observed": {k: dict(v) for k, v in (p.get("observedMetrics") or {}).items()}})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)] = event.exception

    def of(self, run_id: str) -> list[dict]:
        """Progress of one run of a query."""
        return [p for p in self.progress if p["run"] == str(run_id)]


def watch(spark: SparkSession) -> ProgressLog:
    """A progress log that listens to the session's queries from now on (``spark.streams.removeListener`` ends it)."""
    listener = ProgressLog()
    spark.streams.addListener(listener)
    return listener
