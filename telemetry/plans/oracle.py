"""Independent SQL answers (DuckDB dialect) over the driver's pre-registered tables.

The adapters are restated in plain SQL with ``row_number`` windows and ``generate_series``
-- the direct, unoptimised forms -- and rounding, host names and battery levels in SQL of
their own, so the Spark plans are checked against a different formulation, not against
themselves.
"""

from __future__ import annotations

CTES: dict[str, str] = {
    "ev_n": """SELECT event_id, ts, user_id, value, props,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
       FROM events""",
    "ev": """SELECT CAST(user_id + 1 AS BIGINT) AS station_id,
              CAST(rn AS BIGINT) AS sequence_number,
              CASE WHEN event_id % 10 < 3 THEN 'low' WHEN event_id % 10 < 7 THEN 'medium' ELSE 'high' END
                AS battery_status,
              CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp",
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
              CAST(20 + event_id % 101 AS INTEGER) AS temperature,
              CAST(floor(value) % 51 AS INTEGER) AS wind_speed,
              make_timestamp(CAST(epoch_us(ts) // 1000000 AS BIGINT) * 1000000) AS ingested_at
       FROM ev_n WHERE (event_id // 10) % 10 <> 7""",
    "li_raw": """SELECT CAST(l_orderkey AS BIGINT) AS station_id,
              CAST(l_linenumber AS BIGINT) AS sequence_number,
              CASE l_returnflag WHEN 'A' THEN 'low' WHEN 'N' THEN 'medium' WHEN 'R' THEN 'high' END
                AS battery_status,
              CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS "timestamp",
              CAST(trunc(l_quantity) AS INTEGER) AS humidity,
              CAST(20 + l_suppkey % 101 AS INTEGER) AS temperature,
              CAST(l_partkey % 51 AS INTEGER) AS wind_speed,
              make_timestamp(CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) * 1000000) AS ingested_at,
              l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag
       FROM lineitem""",
    "li_ranked": """SELECT *, row_number() OVER (PARTITION BY station_id, sequence_number
              ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                       l_tax, l_linestatus, l_returnflag) AS arrival_rank
       FROM li_raw""",
    "li": """SELECT station_id, sequence_number, battery_status, "timestamp", humidity, temperature,
              wind_speed, ingested_at
       FROM li_ranked WHERE arrival_rank = 1""",
    "ev_alert_msgs": """SELECT station_id, sequence_number AS s_no, "timestamp" AS status_timestamp, humidity,
              CAST(row_number() OVER (PARTITION BY station_id ORDER BY sequence_number) AS BIGINT)
                AS alert_count,
              'It is raining' AS message, ingested_at
       FROM ev WHERE humidity > 70""",
    "alerts_ev": """SELECT station_id, s_no AS sequence_number, status_timestamp AS "timestamp", humidity,
              alert_count, ingested_at AS detected_at
       FROM ev_alert_msgs WHERE s_no % 13 <> 0""",
    "alerts_li": """SELECT station_id, sequence_number, "timestamp", humidity,
              CAST(row_number() OVER (PARTITION BY station_id ORDER BY sequence_number) AS BIGINT)
                AS alert_count,
              ingested_at AS detected_at
       FROM li WHERE humidity > 35 AND station_id % 2 = 0""",
}

DEPS: dict[str, list[str]] = {
    "ev_n": [], "ev": ["ev_n"], "li_raw": [], "li_ranked": ["li_raw"], "li": ["li_ranked"],
    "ev_alert_msgs": ["ev"], "alerts_ev": ["ev_alert_msgs"], "alerts_li": ["li"],
}

READING_COLS = ('station_id, sequence_number, battery_status, "timestamp", humidity, temperature, '
                'wind_speed, ingested_at')


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(uses: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH`` the adapter CTEs named in ``uses`` (and their dependencies), then ``body``."""
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in _closure(uses)]
    parts += [f"{n} AS (\n{sql}\n)" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


def rnd(num: str, den: str, digits: int) -> str:
    """Exact decimal rounding, half up, of a non-negative ratio: halves are added before the whole division."""
    scale = 10 ** digits
    return f"(CAST((2 * {scale} * CAST({num} AS HUGEINT) + {den}) // (2 * NULLIF({den}, 0)) AS DOUBLE) / {scale}.0::DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rnd(f"100 * ({part})", whole, digits)


def station_from_host(explicit: str, host: str) -> str:
    """The given id; else one more than what follows the last dash, if that is digits; else 1."""
    last = f"list_last(string_split({host}, '-'))"
    digits = f"len(string_split({host}, '-')) > 1 AND regexp_full_match({last}, '[0-9]+')"
    return f"CAST(coalesce({explicit}, CASE WHEN {digits} THEN CAST({last} AS BIGINT) + 1 END, 1) AS BIGINT)"


def battery_from_fraction(p: str) -> str:
    return f"CASE WHEN {p} >= 0.7::DOUBLE THEN 'high' WHEN {p} >= 0.3::DOUBLE THEN 'medium' ELSE 'low' END"


def json_reading(alias: str = "") -> str:
    """DuckDB text of a reading message (no NULLs in the adapters' readings)."""
    p = f"{alias}." if alias else ""
    v = lambda c: f'CAST({p}{c} AS VARCHAR)'
    return ("'{\"station_id\":' || " + v("station_id") + " || ',\"s_no\":' || " + v("sequence_number")
            + " || ',\"battery_status\":\"' || " + f"{p}battery_status" + " || '\",\"status_timestamp\":' || "
            + v('"timestamp"') + " || ',\"weather\":{\"humidity\":' || " + v("humidity")
            + " || ',\"temperature\":' || " + v("temperature") + " || ',\"wind_speed\":' || " + v("wind_speed")
            + " || '}}'")


def json_alert() -> str:
    v = lambda c: f"CAST({c} AS VARCHAR)"
    return ("'{\"station_id\":' || " + v("station_id") + " || ',\"s_no\":' || " + v("s_no")
            + " || ',\"status_timestamp\":' || " + v("status_timestamp") + " || ',\"humidity\":' || "
            + v("humidity") + " || ',\"alert_count\":' || " + v("alert_count")
            + " || ',\"message\":\"' || message || '\"}'")


def _wire_cte() -> str:
    from telemetry.sources.wire import fault_number_sql, fault_sql, offset_sql
    return f"""SELECT CAST(station_id AS VARCHAR) AS key,
              {fault_sql('json', 'humidity', 'battery_status', 'f', 'VARCHAR')} AS value,
              CAST(station_id % 10 AS INTEGER) AS "partition",
              CAST({offset_sql('"timestamp"')} AS BIGINT) AS "offset",
              f, station_id, sequence_number, battery_status, "timestamp", humidity, temperature, wind_speed
       FROM (SELECT *, {json_reading()} AS json, {fault_number_sql()} AS f FROM ev) e"""


CTES["wire_ev"] = _wire_cte()
DEPS["wire_ev"] = ["ev"]
CTES["li_alert_msgs"] = """SELECT station_id, sequence_number AS s_no, "timestamp" AS status_timestamp, humidity,
              CAST(row_number() OVER (PARTITION BY station_id ORDER BY l_shipdate, l_partkey, l_suppkey,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag) AS BIGINT) AS alert_count,
              ingested_at, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_linestatus, l_returnflag
       FROM li_raw WHERE humidity > 35"""
DEPS["li_alert_msgs"] = ["li_raw"]
