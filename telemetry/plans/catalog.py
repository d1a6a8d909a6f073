"""Registered queries: name -> (Spark callable over an sf folder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.functions import codec as C
from telemetry.schemas import READINGS_TOPIC
from telemetry.functions import exprs as X
from telemetry.operators import alerts as AL
from telemetry.operators.dedupe import first_write_wins
from telemetry.operators.keyed import time_bucket
from telemetry.plans import analysis as A
from telemetry.plans import oracle as O
from telemetry.plans import quality as Q
from telemetry.session import scratch_path
from telemetry.sources import adapters as S
from telemetry.sources import wire as W
from telemetry.sources.tables import table
from telemetry.streaming import jobs as J
from telemetry.streaming import live as L
from telemetry.streaming.topics import TopicSink, read_topic, write_topic_batch, write_topic_in_slices
from telemetry.streaming.views import ArchiveViews

EV_AS_OF = "2024-01-28 00:00:00"
LI_AS_OF = "1999-01-01 00:00:00"
MISSING_STATION = 1

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


def ev(spark, d):
    return S.readings_ev(spark, d)


def li(spark, d):
    return S.readings_li(spark, d)


# ---- adapters -----------------------------------------------------------------------------

@register("readings_ev", O.with_ctes(["ev"], f"SELECT {O.READING_COLS} FROM ev"))
def q_readings_ev(spark, d):
    return ev(spark, d)


@register("readings_li", O.with_ctes(["li_raw"], f"SELECT {O.READING_COLS} FROM li_raw"))
def q_readings_li(spark, d):
    return S.readings_li_raw(spark, d, keep_arrival=False)


@register("archive_readings_li", O.with_ctes(["li"], f"SELECT {O.READING_COLS} FROM li"))
def q_archive_readings_li(spark, d):
    return li(spark, d)


# ---- battery ------------------------------------------------------------------------------

# Oracles are written in their own forms (joins to totals, SUM(CASE), EXCEPT, EXISTS), not in
# the shape of the Spark plans, so the two sides check each other.

@register("battery_distribution", O.with_ctes(["ev"], f"""SELECT c.station_id, c.battery_status, c.messages,
       {O.pct("c.messages", "tot.n")} AS percentage
FROM (SELECT station_id, battery_status, COUNT(*) AS messages FROM ev GROUP BY station_id, battery_status) c
JOIN (SELECT station_id, COUNT(*) AS n FROM ev GROUP BY station_id) tot ON tot.station_id = c.station_id"""))
def q_battery_distribution(spark, d):
    return A.battery_distribution(ev(spark, d))


def _pivot_sql(t: str) -> str:
    def n(level):
        return f"SUM(CASE WHEN battery_status = '{level}' THEN 1 ELSE 0 END) AS n_{level}"
    return O.with_ctes([t], f"""SELECT station_id, total,
       {O.pct("n_low", "total")} AS low_pct, {O.pct("n_medium", "total")} AS medium_pct,
       {O.pct("n_high", "total")} AS high_pct
FROM (SELECT station_id, COUNT(*) AS total, {n('low')}, {n('medium')}, {n('high')}
      FROM {t} GROUP BY station_id) s""")


@register("battery_pivot", _pivot_sql("ev"))
def q_battery_pivot(spark, d):
    return A.battery_pivot(ev(spark, d))


@register("battery_pivot_li", _pivot_sql("li"))
def q_battery_pivot_li(spark, d):
    return A.battery_pivot(li(spark, d))


@register("battery_global", O.with_ctes(["ev"], f"""SELECT battery_status, messages,
       {O.pct("messages", "(SELECT COUNT(*) FROM ev)")} AS percentage
FROM (SELECT battery_status, COUNT(*) AS messages FROM ev GROUP BY battery_status) g"""))
def q_battery_global(spark, d):
    return A.battery_global(ev(spark, d))


# ---- drops and gaps -------------------------------------------------------------------------

def _drop_sql(t: str) -> str:
    return O.with_ctes([t], f"""SELECT station_id, hi AS expected_messages, n AS received_messages,
       hi - n AS dropped_messages, {O.pct("hi - n", "hi")} AS drop_rate_pct
FROM (SELECT station_id, MAX(sequence_number) AS hi, COUNT(*) AS n FROM {t} GROUP BY station_id) s""")


@register("drop_rate", _drop_sql("ev"))
def q_drop_rate(spark, d):
    return A.drop_rate(ev(spark, d))


@register("drop_rate_li", _drop_sql("li"))
def q_drop_rate_li(spark, d):
    return A.drop_rate(li(spark, d))


@register("drop_rate_cluster", O.with_ctes(["ev"], f"""SELECT CAST(SUM(hi) AS BIGINT) AS expected_total,
       CAST(SUM(n) AS BIGINT) AS received_total,
       CAST(SUM(hi) - SUM(n) AS BIGINT) AS dropped_total,
       {O.pct("SUM(hi) - SUM(n)", "SUM(hi)")} AS drop_rate_pct
FROM (SELECT MAX(sequence_number) AS hi, COUNT(*) AS n FROM ev GROUP BY station_id) s"""))
def q_drop_rate_cluster(spark, d):
    return A.drop_rate_cluster(ev(spark, d))


@register("missing_for_station", O.with_ctes(["ev"], f"""SELECT missing_sequence FROM (
    SELECT "range" AS missing_sequence
    FROM range(1, (SELECT MAX(sequence_number) FROM ev WHERE station_id = {MISSING_STATION}) + 1)
    EXCEPT
    SELECT sequence_number FROM ev WHERE station_id = {MISSING_STATION}) m
ORDER BY missing_sequence LIMIT 50"""))
def q_missing_for_station(spark, d):
    return A.missing_for_station(S.readings_ev(spark, d, station=MISSING_STATION), MISSING_STATION, 50)


_ALL_MISSING = """SELECT station_id, missing_sequence FROM (
    SELECT station_id, unnest(range(1, MAX(sequence_number) + 1)) AS missing_sequence FROM {t} GROUP BY station_id
    EXCEPT
    SELECT station_id, sequence_number FROM {t}) m"""


@register("missing_all", O.with_ctes(["ev"], _ALL_MISSING.format(t="ev")))
def q_missing_all(spark, d):
    return A.missing_all(ev(spark, d))


def _gaps_sql(t: str) -> str:
    # Islands of consecutive missing numbers, found from the exploded answer.
    return O.with_ctes([t], """SELECT station_id, MIN(missing_sequence) AS gap_start,
       MAX(missing_sequence) AS gap_end, COUNT(*) AS missing_count
FROM (SELECT station_id, missing_sequence,
             missing_sequence - row_number() OVER (PARTITION BY station_id ORDER BY missing_sequence) AS island
      FROM missing) m
GROUP BY station_id, island""", extra=[("missing", _ALL_MISSING.format(t=t))])


@register("gap_ranges", _gaps_sql("ev"))
def q_gap_ranges(spark, d):
    return A.gaps(ev(spark, d))


@register("gap_ranges_li", _gaps_sql("li"))
def q_gap_ranges_li(spark, d):
    return A.gaps(li(spark, d))


# ---- latest, validation, statistics ----------------------------------------------------------

def _latest_sql(t: str) -> str:
    cols = ", ".join(f"r.{c.strip()}" for c in O.READING_COLS.split(","))
    return O.with_ctes([t], f"""SELECT {cols}
FROM {t} r JOIN (SELECT station_id, MAX(sequence_number) AS top FROM {t} GROUP BY station_id) m
  ON m.station_id = r.station_id AND m.top = r.sequence_number""")


@register("latest_status", _latest_sql("ev"))
def q_latest_status(spark, d):
    return A.latest_status(ev(spark, d))


@register("latest_status_li", _latest_sql("li"))
def q_latest_status_li(spark, d):
    return A.latest_status(li(spark, d))


@register("rain_validation", O.with_ctes(["ev", "alerts_ev"], """SELECT station_id,
       CAST(SUM(above) AS BIGINT) AS readings_above_70, CAST(SUM(alert) AS BIGINT) AS alerts_stored
FROM (SELECT station_id, CASE WHEN humidity > 70 THEN 1 ELSE 0 END AS above, 0 AS alert, 1 AS reading FROM ev
      UNION ALL
      SELECT station_id, 0, 1, 0 FROM alerts_ev) u
GROUP BY station_id HAVING SUM(reading) > 0"""))
def q_rain_validation(spark, d):
    readings = ev(spark, d)
    return A.rain_validation(readings, S.alerts_ev(spark, d, readings))


def _crosscheck_sql(t: str, alerts: str, threshold: int, as_of: str) -> str:
    return O.with_ctes([t, alerts], f"""SELECT station_id, COUNT(*) AS qualifying_readings,
       CAST(SUM(found) AS BIGINT) AS matching_alerts, CAST(COUNT(*) - SUM(found) AS BIGINT) AS missing_alerts
FROM (SELECT x.station_id,
             CASE WHEN EXISTS (SELECT 1 FROM {alerts} y
                               WHERE y.station_id = x.station_id AND y.sequence_number = x.sequence_number)
                  THEN 1 ELSE 0 END AS found
      FROM {t} x
      WHERE x.humidity > {threshold} AND x.ingested_at < TIMESTAMP '{as_of}' - INTERVAL 30 SECOND) z
GROUP BY station_id""")


@register("rain_crosscheck", _crosscheck_sql("ev", "alerts_ev", 70, EV_AS_OF))
def q_rain_crosscheck(spark, d):
    readings = ev(spark, d)
    return A.rain_crosscheck(readings, S.alerts_ev(spark, d, readings), EV_AS_OF)


@register("rain_crosscheck_li", _crosscheck_sql("li", "alerts_li", S.LI_RAIN_THRESHOLD, LI_AS_OF))
def q_rain_crosscheck_li(spark, d):
    archive = li(spark, d)
    return A.rain_crosscheck(archive, S.alerts_li(spark, d, archive), LI_AS_OF, S.LI_RAIN_THRESHOLD)


@register("weather_stats", O.with_ctes(["ev"], f"""SELECT station_id,
       {O.rnd("SUM(temperature)", "COUNT(temperature)", 1)} AS avg_temp_f,
       MIN(temperature) AS min_temp_f,
       MAX(temperature) AS max_temp_f,
       {O.rnd("SUM(humidity)", "COUNT(humidity)", 1)} AS avg_humidity,
       {O.rnd("SUM(wind_speed)", "COUNT(wind_speed)", 1)} AS avg_wind_kmh,
       COUNT(*) AS samples
FROM ev GROUP BY station_id"""))
def q_weather_stats(spark, d):
    return A.weather_stats(ev(spark, d))


@register("readings_per_minute", O.with_ctes(["ev"], """SELECT minute, COUNT(*) AS readings
FROM (SELECT time_bucket(INTERVAL '1 minute', make_timestamp("timestamp" * 1000000)) AS minute FROM ev) b
GROUP BY minute ORDER BY minute DESC LIMIT 20"""))
def q_readings_per_minute(spark, d):
    return A.readings_per_minute(ev(spark, d))


@register("station_counts", O.with_ctes(["ev"], "SELECT station_id, COUNT(*) AS readings FROM ev GROUP BY station_id"))
def q_station_counts(spark, d):
    return A.station_counts(ev(spark, d))


@register("table_counts", O.with_ctes(["ev", "alerts_ev"], """SELECT 'weather_readings' AS table_name, COUNT(*) AS row_count FROM ev
UNION ALL SELECT 'rain_alerts' AS table_name, COUNT(*) AS row_count FROM alerts_ev"""))
def q_table_counts(spark, d):
    readings = ev(spark, d)
    return A.table_counts(readings, S.alerts_ev(spark, d, readings))


# ---- alerts ----------------------------------------------------------------------------------


@register("rain_alerts", O.with_ctes(["ev_alert_msgs"],
          "SELECT station_id, s_no, status_timestamp, humidity, alert_count, message FROM ev_alert_msgs"))
def q_rain_alerts(spark, d):
    return AL.rain_alerts(ev(spark, d))


@register("rain_alerts_stateless", O.with_ctes(["ev"], """SELECT station_id, sequence_number AS s_no,
       "timestamp" AS status_timestamp, humidity, CAST(0 AS BIGINT) AS alert_count, 'It is raining' AS message
FROM ev WHERE humidity > 70"""))
def q_rain_alerts_stateless(spark, d):
    return AL.stateless_alerts(ev(spark, d))


@register("encode_alerts", O.with_ctes(["ev_alert_msgs"],
          f"SELECT CAST(station_id AS VARCHAR) AS key, {O.json_alert()} AS value FROM ev_alert_msgs"))
def q_encode_alerts(spark, d):
    return C.encode_alerts(AL.rain_alerts(ev(spark, d)))


@register("archive_alerts", O.with_ctes(["li_alert_msgs"], """SELECT station_id, s_no AS sequence_number,
       status_timestamp AS "timestamp", humidity, alert_count, ingested_at AS detected_at
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, s_no ORDER BY l_shipdate, l_partkey, l_suppkey,
             l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag) AS arrival_rank
      FROM li_alert_msgs) m
WHERE arrival_rank = 1"""))
def q_archive_alerts(spark, d):
    """Alerts counted over the raw ``li`` stream (every arriving copy counts), then
    archived first-write-wins by arrival: the kept copy keeps its count."""
    raw = S.readings_li_raw(spark, d)
    # Bucket = (ship day, block of 1024 part keys): non-decreasing along the arrival order
    # (ship date, part key, ...), so even a station with all copies on one day is split.
    bucket = F.struct(time_bucket("arr_l_shipdate").alias("day"),
                      F.floor(F.col("arr_l_partkey") / F.lit(1024)).alias("part_block"))
    alerts = AL.rain_alerts(raw, threshold=S.LI_RAIN_THRESHOLD, order=S.LI_ARRIVAL_COLS,
                            bucket=bucket, carry=["ingested_at", *S.LI_ARRIVAL_COLS])
    first = first_write_wins(alerts, ["station_id", "s_no"], S.LI_ARRIVAL_COLS)
    return AL.alerts_to_table(first, F.col("ingested_at"))


# ---- codec -----------------------------------------------------------------------------------

@register("encode_readings", O.with_ctes(["ev"],
          f"SELECT CAST(station_id AS VARCHAR) AS key, {O.json_reading()} AS value FROM ev"))
def q_encode_readings(spark, d):
    return C.encode_readings(ev(spark, d))


def _decoded(spark, d):
    return C.decode_readings(W.wire_ev(spark, d), keep=("value",))


def _zero11(col: str) -> str:
    return f"CASE WHEN f = {W.FAULT_EMPTY_OBJECT} THEN 0 ELSE {col} END"


def _null_if(col: str, faults) -> str:
    return f"CASE WHEN f IN ({', '.join(map(str, faults))}) THEN NULL ELSE {col} END"


_DEAD_DECODE = [W.FAULT_TRUNCATED, W.FAULT_HUMIDITY_TEXT, W.FAULT_OUT_OF_RANGE, W.FAULT_JSON_NULL,
                W.FAULT_WEATHER_TEXT]
_DROPPED = [W.FAULT_NULL_VALUE]
_CONTRACT = [W.FAULT_BATTERY_NULL, W.FAULT_EMPTY_OBJECT]
_NO_WEATHER = [W.FAULT_NO_WEATHER, W.FAULT_EMPTY_OBJECT]


def _in(xs) -> str:
    return ", ".join(map(str, xs))


@register("decode_readings", O.with_ctes(["wire_ev"], f"""SELECT {_zero11('station_id')} AS station_id,
       {_zero11('sequence_number')} AS s_no,
       {_null_if('battery_status', _CONTRACT)} AS battery_status,
       {_zero11('"timestamp"')} AS status_timestamp,
       {_null_if('humidity', _NO_WEATHER)} AS humidity,
       {_null_if('temperature', _NO_WEATHER)} AS temperature,
       {_null_if('wind_speed', _NO_WEATHER)} AS wind_speed,
       "partition", "offset"
FROM wire_ev WHERE f NOT IN ({_in(_DEAD_DECODE + _DROPPED)})"""))
def q_decode_readings(spark, d):
    good, _ = _decoded(spark, d)
    return good.select("station_id", "s_no", "battery_status", "status_timestamp",
                       F.col("weather.humidity").alias("humidity"),
                       F.col("weather.temperature").alias("temperature"),
                       F.col("weather.wind_speed").alias("wind_speed"), "partition", "offset")


@register("dead_letters", O.with_ctes(["wire_ev"], f"""SELECT '{READINGS_TOPIC}' AS source, "partition", "offset", value,
       CASE WHEN f IN ({W.FAULT_TRUNCATED}, {W.FAULT_JSON_NULL}, {W.FAULT_WEATHER_TEXT}) THEN '{C.MALFORMED}'
            WHEN f IN ({W.FAULT_HUMIDITY_TEXT}, {W.FAULT_OUT_OF_RANGE}) THEN '{C.BAD_NUMBER}humidity'
            ELSE '{C.CONTRACT}battery_status is null' END AS reason
FROM wire_ev WHERE f IN ({_in(_DEAD_DECODE + _CONTRACT)})"""))
def q_dead_letters(spark, d):
    return C.dead_letters_of(C.tag_readings(W.wire_ev(spark, d)))


@register("flatten_readings", O.with_ctes(["wire_ev"], f"""SELECT station_id, sequence_number, battery_status,
       "timestamp", {_null_if('humidity', _NO_WEATHER)} AS humidity,
       {_null_if('temperature', _NO_WEATHER)} AS temperature,
       {_null_if('wind_speed', _NO_WEATHER)} AS wind_speed
FROM wire_ev WHERE f NOT IN ({_in(_DEAD_DECODE + _DROPPED + _CONTRACT)})"""))
def q_flatten_readings(spark, d):
    return C.archivable(C.tag_readings(W.wire_ev(spark, d))).drop("partition", "offset")


@register("contract_violations", O.with_ctes(["wire_ev"], f"""SELECT {_zero11('station_id')} AS station_id,
       {_zero11('sequence_number')} AS sequence_number, '{C.CONTRACT}battery_status is null' AS reason
FROM wire_ev WHERE f IN ({_in(_CONTRACT)})"""))
def q_contract_violations(spark, d):
    good, _ = _decoded(spark, d)
    return Q.contract_violations(C.flatten_readings(good))


@register("decode_props", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity
FROM events""")
def q_decode_props(spark, d):
    ev_ = table(spark, d, "events", "event_id", "props")
    k = F.from_json("props", "k STRING").getField("k")
    return ev_.select("event_id", C.coerce_number(k, "int").alias("humidity"))


# ---- scalar functions re-aimed at columns ------------------------------------------------------

_HOST = """CASE event_id % 4 WHEN 0 THEN 'sensor-node-' || CAST(user_id AS {t})
                            WHEN 1 THEN 'station-' || CAST(user_id AS {t}) || 'a'
                            WHEN 2 THEN 'host' || CAST(user_id AS {t})
                            ELSE 'sensor-node-' END"""
_EXPLICIT = "CASE WHEN event_id % 5 = 0 THEN event_id END"


@register("station_from_host", f"""SELECT event_id, host, {O.station_from_host('explicit_id', 'host')} AS station_id
FROM (SELECT event_id, {_HOST.format(t='VARCHAR')} AS host, {_EXPLICIT} AS explicit_id FROM events) h""")
def q_station_from_host(spark, d):
    hosts = table(spark, d, "events", "event_id", "user_id").select(
        "event_id", F.expr(_HOST.format(t="STRING")).alias("host"), F.expr(_EXPLICIT).alias("explicit_id"))
    return hosts.select("event_id", "host", X.station_from_host("explicit_id", "host").alias("station_id"))


_FRACTION = "CAST((event_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)"


@register("bucket_battery", f"""SELECT event_id, {_FRACTION} AS p, {O.battery_from_fraction(_FRACTION)} AS battery_status
FROM events""")
def q_bucket_battery(spark, d):
    e = table(spark, d, "events", "event_id").select("event_id", F.expr(_FRACTION).alias("p"))
    return e.select("event_id", "p", F.expr(X.battery_from_fraction_sql("p")).alias("battery_status"))


# ---- quality -----------------------------------------------------------------------------------

def _dev(obs: str, exp: str) -> str:
    return f"{obs} - {exp} AS deviation, abs({obs} - {exp}) <= {Q.TOLERANCE_PCT} AS within_tolerance"


@register("battery_deviation", O.with_ctes(["ev"], f"""SELECT g.battery_status, g.percentage, e.expected_pct,
       {_dev('g.percentage', 'e.expected_pct')}
FROM (SELECT battery_status, {O.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS percentage
      FROM ev GROUP BY battery_status) g
LEFT JOIN (VALUES ('low', CAST(30.0 AS DOUBLE)), ('medium', CAST(40.0 AS DOUBLE)), ('high', CAST(30.0 AS DOUBLE)))
     AS e(battery_status, expected_pct) ON e.battery_status = g.battery_status"""))
def q_battery_deviation(spark, d):
    return Q.battery_deviation(ev(spark, d))


@register("drop_deviation", O.with_ctes(["ev"], f"""SELECT drop_rate_pct, CAST(10.0 AS DOUBLE) AS expected_pct,
       {_dev('drop_rate_pct', 'CAST(10.0 AS DOUBLE)')}
FROM (SELECT {O.pct("SUM(expected - received)", "SUM(expected)")} AS drop_rate_pct
      FROM (SELECT MAX(sequence_number) AS expected, COUNT(*) AS received FROM ev GROUP BY station_id) s) c"""))
def q_drop_deviation(spark, d):
    return Q.drop_deviation(ev(spark, d))


@register("rain_share", O.with_ctes(["ev"], f"""SELECT readings, raining, rain_pct, CAST(29.7 AS DOUBLE) AS expected_pct,
       {_dev('rain_pct', 'CAST(29.7 AS DOUBLE)')}
FROM (SELECT COUNT(*) AS readings, COUNT(*) FILTER (WHERE humidity > 70) AS raining,
             {O.pct("COUNT(*) FILTER (WHERE humidity > 70)", "COUNT(*)")} AS rain_pct FROM ev) s"""))
def q_rain_share(spark, d):
    return Q.rain_share(ev(spark, d))


@register("key_conflicts_li", O.with_ctes(["li_raw"], """SELECT station_id, sequence_number, COUNT(*) AS copies
FROM li_raw GROUP BY station_id, sequence_number
HAVING COUNT(DISTINCT (battery_status, "timestamp", humidity, temperature, wind_speed)) > 1"""))
def q_key_conflicts_li(spark, d):
    return Q.key_conflicts_report(S.readings_li_raw(spark, d, keep_arrival=False))


# ---- streaming ---------------------------------------------------------------------------------
# Each stream query writes its topic (derived from the tables) in time-ordered slices to a fresh
# folder under the shared checkpoint root, runs the stream to the end of the input
# (availableNow, one file per trigger = one slice per micro-batch) and returns the sink.


STREAM_SLICES = 4


STATE_BYTES_PER_TRIGGER = 8 << 20


def _run(spark, records, start, name: str, order: str = "offset", max_bytes: int | None = None):
    paths = J.StreamPaths(scratch_path(spark, name))
    topic = f"{paths.root}/topic"
    write_topic_in_slices(records, topic, STREAM_SLICES, order=order)
    source = read_topic(spark, "parquet", topic, max_per_trigger=None if max_bytes else W.TOPIC_PARTITIONS,
                        max_bytes_per_trigger=max_bytes)
    query = start(source, paths)
    query.awaitTermination()
    return J.read_sink(spark, paths.sink)


_STREAM_ALERT_ROWS = f"""FROM wire_ev
WHERE f NOT IN ({_in(_DEAD_DECODE + _DROPPED + _NO_WEATHER)}) AND humidity > 70"""


@register("stream_alerts", O.with_ctes(["wire_ev"], f"""SELECT station_id, sequence_number AS s_no,
       "timestamp" AS status_timestamp, humidity,
       CAST(row_number() OVER (PARTITION BY station_id ORDER BY "partition", "offset") AS BIGINT) AS alert_count,
       'It is raining' AS message
{_STREAM_ALERT_ROWS}"""))
def q_stream_alerts(spark, d):
    sink = _run(spark, W.wire_ev(spark, d), J.start_alert_stream, "stream-alerts")
    return sink.select(*AL.ALERT_FIELDS)


@register("stream_alerts_keyed_state", REGISTRY["stream_alerts"].sql)
def q_stream_alerts_keyed_state(spark, d):
    """The running count kept in Spark's keyed state store instead of a carried table."""
    # One station's rows of one micro-batch form one group, so the batch is capped in bytes.
    sink = _run(spark, W.wire_ev(spark, d), J.start_alert_stream_keyed_state, "stream-alerts-state",
                max_bytes=STATE_BYTES_PER_TRIGGER)
    return sink.select(*AL.ALERT_FIELDS)


@register("stream_alerts_stateless", O.with_ctes(["wire_ev"], f"""SELECT station_id, sequence_number AS s_no,
       "timestamp" AS status_timestamp, humidity, CAST(0 AS BIGINT) AS alert_count, 'It is raining' AS message, key
{_STREAM_ALERT_ROWS}"""))
def q_stream_alerts_stateless(spark, d):
    return _run(spark, W.wire_ev(spark, d), J.start_stateless_alert_stream, "stream-alerts-stateless")


@register("stream_archive", REGISTRY["flatten_readings"].sql)
def q_stream_archive(spark, d):
    """Readings topic with faults and producer retries -> first-write-wins archive."""
    records = W.with_resends(W.records_from_readings(S.readings_ev(spark, d), ids=True))
    sink = _run(spark, records, J.start_archive_stream, "stream-archive", order="send_at")
    return sink.select("station_id", "sequence_number", "battery_status", "timestamp", "humidity",
                       "temperature", "wind_speed")


@register("stream_archive_alerts", O.with_ctes(["ev_alert_msgs"], """SELECT station_id, s_no AS sequence_number,
       status_timestamp AS "timestamp", humidity, alert_count
FROM ev_alert_msgs"""))
def q_stream_archive_alerts(spark, d):
    """Alert topic with producer retries -> first-write-wins alert archive."""
    records = W.with_resends(W.alert_records(AL.rain_alerts(S.readings_ev(spark, d))))

    def start(src, paths):
        return J.start_archive_stream(src, paths, alerts=True)

    sink = _run(spark, records, start, "stream-archive-alerts", order="send_at")
    return sink.select("station_id", "sequence_number", "timestamp", "humidity", "alert_count")


_FLAT = REGISTRY["flatten_readings"].sql


@register("stream_pipeline", O.with_ctes(["wire_ev"], f"""SELECT r.station_id, r.readings_above_70,
       COALESCE(a.alerts_sent, 0) AS alerts_sent, COALESCE(a.alerts_stored, 0) AS alerts_stored,
       COALESCE(m.missing_alerts, 0) AS missing_alerts
FROM (SELECT station_id, COUNT(*) FILTER (WHERE humidity > 70) AS readings_above_70 FROM ({_FLAT}) x GROUP BY station_id) r
LEFT JOIN (SELECT station_id, COUNT(*) AS alerts_stored,
                  COUNT(*) + COUNT(*) FILTER (WHERE {W.RESEND_SQL}) AS alerts_sent
           {_STREAM_ALERT_ROWS} GROUP BY station_id) a ON a.station_id = r.station_id
LEFT JOIN (SELECT station_id, COUNT(*) AS missing_alerts
           FROM (SELECT station_id, sequence_number FROM ({_FLAT}) y WHERE humidity > 70
                 EXCEPT SELECT station_id, sequence_number {_STREAM_ALERT_ROWS}) z
           GROUP BY station_id) m ON m.station_id = r.station_id"""))
def q_stream_pipeline(spark, d):
    """Readings topic with faults and retries -> readings archive, and -> counted alerts -> alert
    topic -> alert archive; then validation and cross-check over the two stored archives.
    Retried readings raise their alert again (``alerts_sent``); the archive keeps one."""
    root = scratch_path(spark, "stream-pipeline")
    reading, alert, stored = (J.StreamPaths(f"{root}/{x}") for x in ("readings", "alerts", "alert-archive"))
    alert_topic = TopicSink("parquet", f"{root}/alert-topic")
    records = W.with_resends(W.records_from_readings(S.readings_ev(spark, d), ids=True))
    write_topic_in_slices(records, f"{root}/topic", STREAM_SLICES, order="send_at")
    source = read_topic(spark, "parquet", f"{root}/topic", max_per_trigger=W.TOPIC_PARTITIONS)
    J.start_archive_stream(source, reading).awaitTermination()
    J.start_alert_stream(source, alert, topic=alert_topic).awaitTermination()
    J.start_archive_stream(read_topic(spark, "parquet", alert_topic.topic), stored, alerts=True).awaitTermination()
    readings, alerts = J.read_sink(spark, reading.sink), J.read_sink(spark, stored.sink)
    sent = J.read_sink(spark, alert.sink).groupBy("station_id").agg(F.count(F.lit(1)).alias("alerts_sent"))
    check = A.rain_crosscheck(readings, alerts, min_age_seconds=0).select("station_id", "missing_alerts")
    return (A.rain_validation(readings, alerts).join(sent, "station_id", "left").join(check, "station_id", "left")
            .select("station_id", "readings_above_70", "alerts_stored",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("alerts_sent", "missing_alerts")]))


# ---- live reports -------------------------------------------------------------------------------

@register("live_minutes", O.with_ctes(["wire_ev"], f"""SELECT time_bucket(INTERVAL '1 minute', make_timestamp("timestamp" * 1000000)) AS minute,
       COUNT(*) AS readings
FROM ({_FLAT}) x GROUP BY 1"""))
def q_live_minutes(spark, d):
    """Event-time windows over the readings topic, appended as the watermark passes each minute."""
    paths = J.StreamPaths(scratch_path(spark, "live-minutes"))
    readings, topic = S.readings_ev(spark, d), f"{paths.root}/topic"
    write_topic_in_slices(W.records_from_readings(readings), topic, STREAM_SLICES)
    write_topic_batch(L.closing_reading(readings), "parquet", topic)
    L.start_minute_counts(read_topic(spark, "parquet", topic, max_per_trigger=W.TOPIC_PARTITIONS), paths).awaitTermination()
    return J.read_sink(spark, paths.sink).select(X.seconds_to_ntz("unix_seconds(minute)").alias("minute"), "readings")


@register("live_drop_rate", O.with_ctes(["wire_ev"], f"""SELECT station_id, expected_messages, received_messages,
       expected_messages - received_messages AS dropped_messages,
       {O.pct("expected_messages - received_messages", "expected_messages")} AS drop_rate_pct
FROM (SELECT station_id, MAX(sequence_number) AS expected_messages, COUNT(*) AS received_messages
      FROM ({_FLAT}) x GROUP BY station_id) s"""))
def q_live_drop_rate(spark, d):
    """Drop rates as an update-mode aggregate of the readings topic, upserted by station."""
    paths = J.StreamPaths(scratch_path(spark, "live-drop-rate"))
    write_topic_in_slices(W.wire_ev(spark, d), f"{paths.root}/topic", STREAM_SLICES)
    L.start_drop_rate(read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=W.TOPIC_PARTITIONS), paths).awaitTermination()
    return L.DropRates(paths.sink).report(spark)


@register("live_rain_check", O.with_ctes(["ev", "alerts_ev"], """SELECT station_id, COUNT(*) AS qualifying_readings,
       COUNT(*) FILTER (WHERE stored) AS matching_alerts, COUNT(*) FILTER (WHERE NOT stored) AS missing_alerts
FROM (SELECT r.station_id, EXISTS (SELECT 1 FROM alerts_ev a WHERE a.station_id = r.station_id
                                   AND a.sequence_number = r.sequence_number) AS stored
      FROM ev r WHERE r.humidity > 70) x
GROUP BY station_id"""))
def q_live_rain_check(spark, d):
    """Readings topic left-joined to the alert topic in event time; the alerts of some readings never come."""
    paths = J.StreamPaths(scratch_path(spark, "live-rain-check"))
    topic, alert_topic = f"{paths.root}/topic", f"{paths.root}/alert-topic"
    readings = S.readings_ev(spark, d)
    alerts = AL.rain_alerts(readings).where(F.col("s_no") % S.EV_MISSING_ALERT_EVERY != 0)
    slices = STREAM_SLICES // 2  # four stateful steps: fewer micro-batches, the same state carried between them
    write_topic_in_slices(W.records_from_readings(readings, faults=False), topic, slices)
    write_topic_in_slices(W.alert_records(alerts), alert_topic, slices)
    write_topic_batch(L.closing_reading(readings), "parquet", topic)
    write_topic_batch(L.closing_alert(readings), "parquet", alert_topic)
    source, raised = (read_topic(spark, "parquet", t, max_per_trigger=W.TOPIC_PARTITIONS) for t in (topic, alert_topic))
    L.start_rain_check(source, raised, paths).awaitTermination()
    return L.rain_check_report(J.read_sink(spark, paths.sink))


@register("archive_views", O.with_ctes(["wire_ev"], f"""SELECT s.station_id, samples, expected_messages, newest.battery_status,
       newest."timestamp" AS last_timestamp, avg_humidity, max_temp_f
FROM (SELECT station_id, COUNT(*) AS samples, MAX(sequence_number) AS expected_messages,
             {O.rnd("SUM(humidity)", "COUNT(humidity)", 1)} AS avg_humidity, MAX(temperature) AS max_temp_f
      FROM ({_FLAT}) x GROUP BY station_id) s
JOIN ({_FLAT}) newest ON newest.station_id = s.station_id AND newest.sequence_number = s.expected_messages"""))
def q_archive_views(spark, d):
    """Reports kept up to date by the archive stream itself, batch by batch, over a topic with retries."""
    paths = J.StreamPaths(scratch_path(spark, "archive-views"))
    records = W.with_resends(W.records_from_readings(S.readings_ev(spark, d), ids=True))
    write_topic_in_slices(records, f"{paths.root}/topic", STREAM_SLICES, order="send_at")
    source = read_topic(spark, "parquet", f"{paths.root}/topic", max_per_trigger=W.TOPIC_PARTITIONS)
    J.start_archive_stream(source, paths, views=True).awaitTermination()
    views = ArchiveViews(paths.views)
    newest = views.latest_status(spark).select("station_id", "battery_status", F.col("timestamp").alias("last_timestamp"))
    return views.weather_stats(spark).select("station_id", "samples", "avg_humidity", "max_temp_f") \
        .join(views.drop_rate(spark).select("station_id", "expected_messages"), "station_id").join(newest, "station_id")
