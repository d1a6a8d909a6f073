"""Scalar column expressions shared by queries and their SQL oracles.

Most helpers return SQL text so that the exact same expression is used by Spark
(``F.expr``) and, in the ``duckdb`` dialect, by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) --------------------------------
RAIN_THRESHOLD = 70                      # rain is strictly humidity > 70
RAIN_MESSAGE = "It is raining"           # constant text of every alert
BATTERY_LEVELS = ("low", "medium", "high")
BATTERY_CUTS = (0.30, 0.70)              # p < .30 low, p < .70 medium, else high
BATTERY_EXPECTED_PCT = {"low": 30.0, "medium": 40.0, "high": 30.0}
EXPECTED_DROP_PCT = 10.0
EXPECTED_RAIN_PCT = 29.7                 # 30 of 101 humidity values exceed 70
BATTERY_MAX_LEN = 10                     # VARCHAR(10) NOT NULL in the readings table
HUMIDITY_RANGE = (0, 100)
# -----------------------------------------------------------------------------------------

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def evaluate_once(col: Column, name: str) -> Column:
    """``col`` computed once per row even when referenced many times downstream.

    Catalyst substitutes aliases into pushed-down filters and collapsed projections, which
    re-evaluates expensive expressions (JSON encode/parse) at every reference. A
    one-element generator is a boundary neither rule crosses. One per ``select``.
    """
    return F.explode(F.array(col)).alias(name)


def _idiv(dialect: str) -> str:
    return "div" if dialect == "spark" else "//"


def round_ratio_sql(num: str, den: str, digits: int, dialect: str = "spark") -> str:
    """``ROUND(num / den, digits)`` on exact numerics, half away from zero, as DOUBLE.

    ``num`` and ``den`` are integer expressions. Integer arithmetic keeps the result
    exact in every engine (no binary-float ties); NULL when ``den`` is 0 or NULL.
    """
    s = 10 ** digits
    q = (f"((2 * {s} * abs({num}) + abs({den})) {_idiv(dialect)} (2 * abs(NULLIF({den}, 0))))")
    return (f"(CAST((CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * {q} AS DOUBLE)"
            f" / CAST({s} AS DOUBLE))")


def round_ratio(num: str, den: str, digits: int) -> Column:
    return F.expr(round_ratio_sql(num, den, digits, "spark"))


def pct_sql(part: str, whole: str, digits: int = 2, dialect: str = "spark") -> str:
    """``ROUND(100.0 * part / whole, digits)`` exactly."""
    return round_ratio_sql(f"(100 * ({part}))", whole, digits, dialect)


def pct(part: str, whole: str, digits: int = 2) -> Column:
    return F.expr(pct_sql(part, whole, digits, "spark"))


def epoch_seconds_sql(ts: str, dialect: str = "spark") -> str:
    """Whole epoch seconds of a TIMESTAMP_NTZ, independent of the session time zone."""
    if dialect == "spark":
        return f"timestampdiff(SECOND, {EPOCH_NTZ}, {ts})"
    return f"CAST(epoch_us({ts}) // 1000000 AS BIGINT)"


def epoch_seconds(ts: str) -> Column:
    return F.expr(epoch_seconds_sql(ts))


def epoch_micros(ts: str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ: a number that grows along event time."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {ts})")


def seconds_to_ntz_sql(secs: str, dialect: str = "spark") -> str:
    """``to_timestamp(epoch_seconds)`` as a zone-free TIMESTAMP_NTZ."""
    if dialect == "spark":
        return f"timestampadd(SECOND, {secs}, {EPOCH_NTZ})"
    return f"make_timestamp(CAST({secs} AS BIGINT) * 1000000)"


def seconds_to_ntz(secs: str) -> Column:
    return F.expr(seconds_to_ntz_sql(secs))


def minute_of_sql(secs: str, dialect: str = "spark") -> str:
    """``date_trunc('minute', to_timestamp(secs))`` (floor, also before 1970)."""
    if dialect == "spark":
        return seconds_to_ntz_sql(f"({secs} - pmod({secs}, 60))", dialect)
    return seconds_to_ntz_sql(f"({secs} - ((({secs}) % 60) + 60) % 60)", dialect)


def minute_of(secs: str) -> Column:
    return F.expr(minute_of_sql(secs))


def battery_from_fraction_sql(p: str) -> str:
    lo, hi = BATTERY_CUTS
    return (f"CASE WHEN {p} < {lo} THEN 'low' WHEN {p} < {hi} THEN 'medium' ELSE 'high' END")


def battery_rank_sql(status: str) -> str:
    """Sort rank: low 1, medium 2, anything else 3."""
    return f"CASE {status} WHEN 'low' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"


def battery_rank(status: str = "battery_status") -> Column:
    return F.expr(battery_rank_sql(status))


def station_from_host_sql(explicit: str, host: str, dialect: str = "spark") -> str:
    """Explicit id first, else the trailing ``-<digits>`` ordinal of a host name + 1, else 1."""
    if dialect == "spark":
        ordinal = f"try_add(try_cast(regexp_extract({host}, '-([0-9]+)$', 1) AS BIGINT), 1L)"
    else:
        ordinal = (f"(TRY_CAST(NULLIF(regexp_extract({host}, '-([0-9]+)$', 1), '') AS BIGINT) + 1)")
    return f"COALESCE(CAST({explicit} AS BIGINT), {ordinal}, CAST(1 AS BIGINT))"


def station_from_host(explicit: str, host: str) -> Column:
    return F.expr(station_from_host_sql(explicit, host))
