"""Keyed sensor telemetry on Spark: decode, alert, archive and analyse station readings.

Every public function takes and returns DataFrames; thresholds, keys and reference
times are arguments. Subpackages:

* ``sources``   -- driver tables, adapters that turn them into readings/alerts, archive tables
* ``functions`` -- column expressions: JSON codec, exact rounding, epoch helpers
* ``operators`` -- keyed running numbering, first-write-wins dedupe, gaps, latest row
* ``plans``     -- whole user queries (analysis, quality checks) and their SQL oracles
* ``streaming`` -- Structured Streaming jobs (alerts with a running count, archives)
"""

from telemetry.session import local_session, scratch_path

__all__ = ["local_session", "scratch_path"]
