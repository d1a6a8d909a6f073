"""Operators that Spark lacks as one call: bounded per-key ordering, first write wins, gaps,
latest row, rain alerts."""

from telemetry.operators.alerts import alerts_to_table, rain_alerts, raining, stateless_alerts
from telemetry.operators.dedupe import first_write_wins, insert_if_absent, key_conflicts
from telemetry.operators.gaps import expand_gaps, first_missing, gap_ranges
from telemetry.operators.keyed import keyed_lag, keyed_row_number, sequence_bucket, time_bucket
from telemetry.operators.latest import latest_per_key
from telemetry.operators.scan import blocked_lag, blocked_row_number

__all__ = ["alerts_to_table", "rain_alerts", "raining", "stateless_alerts", "first_write_wins",
           "insert_if_absent", "key_conflicts", "expand_gaps", "first_missing", "gap_ranges",
           "blocked_lag", "blocked_row_number", "keyed_lag", "keyed_row_number", "sequence_bucket", "time_bucket", "latest_per_key"]
