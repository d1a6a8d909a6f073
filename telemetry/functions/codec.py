"""JSON wire codec for readings and alerts.

Decoding follows the original consumer's mapper: unknown fields are ignored, absent or
null numbers become 0 (they were primitives), whole numbers as text and fractions are
coerced ("7" -> 7, 70.9 -> 70; "70.9" is refused), a text field holds no object or array. Numbers are therefore parsed as text first and repaired with
``try_cast``; anything that cannot be repaired is a dead letter with a reason instead of
an exception. A NULL record value is dropped (it carries nothing to report).

Everything is built-in column expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.functions.exprs import BATTERY_MAX_LEN, evaluate_once
from telemetry.schemas import ALERT_WIRE, ALERTS_TOPIC, READING_WIRE, READINGS_TOPIC

# ---- fixed values: dead-letter reasons ------------------------------------------------
MALFORMED = "malformed json"
BAD_NUMBER = "bad number: "
CONTRACT = "contract: "
# ----------------------------------------------------------------------------------------

_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def coerce_number(text: Column, spark_type: str) -> Column:
    """A number as text to an integer type: fractions truncate, text and out-of-range values
    give NULL. The fraction of a plain decimal is cut off as text, so that nothing rounds up."""
    whole = F.regexp_replace(text, r"^(\s*[+-]?[0-9]+)\.[0-9]*(\s*)$", "$1$2")
    return F.when(text.rlike(r"^-?[0-9]{1,18}\z"), text.try_cast(spark_type)) \
        .otherwise(whole.try_cast("decimal(38,6)").try_cast(spark_type))


def _kind(path: str, value: Column | str = "value") -> Column:
    """Type that the record itself gives a field ('STRING', 'DECIMAL(3,1)', 'OBJECT<...>', ...): parsing as
    text drops the difference between 70.9 and "70.9", and between an object and its text. Read
    from the record's structure, and only for the records that ask for it."""
    return F.schema_of_variant(F.variant_get(F.try_parse_json(value), "$." + path.removeprefix("_j."), "variant"))


def _when(asked: Column, answer: Column) -> Column:
    """``answer`` where ``asked`` holds, evaluated only there; else false."""
    return F.coalesce(F.when(asked, answer), F.lit(False))


def _container(path: str) -> Column:
    return _when(F.col(path).rlike(r"^[\[{]"), _kind(path).rlike("^(OBJECT|ARRAY)"))


def _parse_once(j: Column) -> Column:
    """Parse once per record (filters and projections read ``_j`` many times)."""
    return evaluate_once(j, "_j")


def _with_numbers(parsed: DataFrame, nums: dict[str, tuple[str, str]]) -> tuple[DataFrame, dict[str, Column], Column]:
    """``parsed`` with its number fields coerced once per record, the value of each, and the reason of the
    first that cannot be repaired. ``nums``: name -> (path below ``_j``, Spark type).

    The fields go through one array function each for values and kinds: written out per field, the
    expressions made one generated method too large for the JVM to compile, and the decode was interpreted.
    """
    texts = F.array(*[F.col(path) for path, _ in nums.values()])
    quoted = F.transform(F.array("value"), lambda v: F.array(*[_kind(path, v) == "STRING" for path, _ in nums.values()]))
    numbers = F.struct(F.transform(texts, lambda t: coerce_number(t, "bigint")).alias("whole"),
                       F.when(F.exists(texts, lambda t: t.contains(".")), quoted[0]).alias("quoted"))
    out = parsed.select("*", evaluate_once(numbers, "_n"))
    val = {k: F.col("_n.whole")[i].try_cast(t) for i, (k, (_, t)) in enumerate(nums.items())}
    bad = None
    for i, (k, (path, _)) in enumerate(nums.items()):
        asked = (F.col(path).isNotNull() & val[k].isNull()) | _when(F.col(path).contains("."), F.col("_n.quoted")[i])
        bad = (F.when if bad is None else bad.when)(asked, F.lit(BAD_NUMBER + k))
    return out, val, bad


def _position(records: DataFrame) -> list[Column]:
    cols = set(records.columns)
    part = F.col("partition").cast("int") if "partition" in cols else F.lit(None).cast("int")
    off = F.col("offset").cast("long") if "offset" in cols else F.lit(None).cast("long")
    return [part.alias("partition"), off.alias("offset")]


def _extra(keep) -> list[str]:
    return [k for k in keep if k not in ("value", "partition", "offset")]


def _split(parsed: DataFrame, reason: Column, good_cols: list[Column], source: str,
           keep: list[str]) -> tuple[DataFrame, DataFrame]:
    tagged = parsed.withColumn("_reason", reason)
    good = tagged.where(F.col("value").isNotNull() & F.col("_reason").isNull()).select(*good_cols, *keep)
    dead = tagged.where(F.col("value").isNotNull() & F.col("_reason").isNotNull()).select(
        F.lit(source).alias("source"), "partition", "offset", "value", F.col("_reason").alias("reason"))
    return good, dead


def decode_readings(records: DataFrame, source: str = READINGS_TOPIC,
                    keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Topic records (``value`` text, optional key/partition/offset/timestamp) ->
    (reading messages, dead letters). ``keep`` names extra record columns to carry."""
    parsed, reason, good_cols = _decode_reading_columns(records, keep)
    return _split(parsed, reason, good_cols, source, list(keep))


def tag_readings(records: DataFrame, keep: tuple[str, ...] = (), contract: bool = True) -> DataFrame:
    """One pass over topic records: flat archive columns, position, raw ``value`` and a
    ``reason`` that is NULL for an archivable reading, else why it is a dead letter
    (malformed, bad number, or, with ``contract``, the table contract). NULL record values
    are dropped."""
    parsed, reason, good_cols = _decode_reading_columns(records, keep)
    msgs = parsed.select(*good_cols, "value", *_extra(keep), reason.alias("_decode_reason")) \
        .where(F.col("value").isNotNull())
    flat = flatten_readings(msgs, keep=("partition", "offset", "value", *_extra(keep), "_decode_reason"))
    decode = F.col("_decode_reason")
    return flat.withColumn("reason", F.coalesce(decode, contract_reason()) if contract else decode).drop("_decode_reason")


def dead_letters_of(tagged: DataFrame, source: str = READINGS_TOPIC) -> DataFrame:
    return tagged.where(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), "partition", "offset", "value", "reason")


def archivable(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNull()).drop("reason", "value")


def _decode_reading_columns(records: DataFrame, keep: tuple[str, ...]):
    j = F.from_json("value", READING_WIRE, _JSON_OPTS)
    parsed = records.select("value", *_position(records), *_extra(keep), _parse_once(j))
    w = "_j.weather"
    nums = {
        "station_id": ("_j.station_id", "bigint"),
        "s_no": ("_j.s_no", "bigint"),
        "status_timestamp": ("_j.status_timestamp", "bigint"),
        "humidity": (f"{w}.humidity", "int"),
        "temperature": (f"{w}.temperature", "int"),
        "wind_speed": (f"{w}.wind_speed", "int"),
    }
    parsed, val, bad = _with_numbers(parsed, nums)
    reason = F.when(F.col("_j").isNull() | F.col("_j._corrupt").isNotNull()
                    | _container("_j.battery_status"), F.lit(MALFORMED)).otherwise(bad)

    weather = F.when(F.col(w).isNull(), F.lit(None)).otherwise(F.struct(
        F.coalesce(val["humidity"], F.lit(0)).alias("humidity"),
        F.coalesce(val["temperature"], F.lit(0)).alias("temperature"),
        F.coalesce(val["wind_speed"], F.lit(0)).alias("wind_speed")))
    good_cols = [
        F.coalesce(val["station_id"], F.lit(0).cast("long")).alias("station_id"),
        F.coalesce(val["s_no"], F.lit(0).cast("long")).alias("s_no"),
        F.col("_j.battery_status").alias("battery_status"),
        F.coalesce(val["status_timestamp"], F.lit(0).cast("long")).alias("status_timestamp"),
        weather.alias("weather"),
        "partition", "offset",
    ]
    return parsed, reason, good_cols


def decode_alerts(records: DataFrame, source: str = ALERTS_TOPIC,
                  keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Alert topic records -> (alert messages, dead letters)."""
    parsed, reason, good_cols = _decode_alert_columns(records, keep)
    return _split(parsed, reason, good_cols, source, list(keep))


def tag_alerts(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One pass over alert records: the message's columns, position, raw ``value`` and a ``reason``
    that is NULL for an alert, else why it is a dead letter. NULL record values are dropped."""
    parsed, reason, good_cols = _decode_alert_columns(records, keep)
    return parsed.select(*good_cols, "value", *_extra(keep), reason.alias("reason")).where(F.col("value").isNotNull())


def _decode_alert_columns(records: DataFrame, keep: tuple[str, ...]):
    j = F.from_json("value", ALERT_WIRE, _JSON_OPTS)
    parsed = records.select("value", *_position(records), *_extra(keep), _parse_once(j))
    nums = {"station_id": "bigint", "s_no": "bigint", "status_timestamp": "bigint",
            "humidity": "int", "alert_count": "bigint"}
    parsed, val, bad = _with_numbers(parsed, {k: (f"_j.{k}", t) for k, t in nums.items()})
    reason = F.when(F.col("_j").isNull() | F.col("_j._corrupt").isNotNull()
                    | _container("_j.message"), F.lit(MALFORMED)).otherwise(bad)
    good_cols = [F.coalesce(val[k], F.lit(0).cast(t)).alias(k) for k, t in nums.items()]
    good_cols += [F.col("_j.message").alias("message"), "partition", "offset"]
    return parsed, reason, good_cols


def flatten_readings(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message -> archive columns: weather flattened (NULL weather gives three NULLs),
    s_no -> sequence_number, status_timestamp -> timestamp."""
    return messages.select(
        "station_id",
        F.col("s_no").alias("sequence_number"),
        "battery_status",
        F.col("status_timestamp").alias("timestamp"),
        F.col("weather.humidity").alias("humidity"),
        F.col("weather.temperature").alias("temperature"),
        F.col("weather.wind_speed").alias("wind_speed"),
        *keep,
    )


def contract_reason(battery: str = "battery_status", humidity: str = "humidity",
                    levels: tuple[str, ...] | None = None) -> Column:
    """Why a reading may not be archived (NULL when it may). The table demands a
    non-null battery status of at most 10 characters; ``levels`` adds the known set and
    the humidity range used by the quality report."""
    b = F.col(battery)
    r = F.when(b.isNull(), F.lit(CONTRACT + "battery_status is null")) \
        .when(F.length(b) > BATTERY_MAX_LEN, F.lit(CONTRACT + "battery_status too long"))
    if levels is not None:
        r = r.when(~b.isin(*levels), F.lit(CONTRACT + "battery_status unknown")) \
            .when((F.col(humidity) < 0) | (F.col(humidity) > 100), F.lit(CONTRACT + "humidity out of range"))
    return r


def enforce_contract(readings: DataFrame, source: str = READINGS_TOPIC,
                     position: tuple[str, str] = ("partition", "offset")) -> tuple[DataFrame, DataFrame]:
    """Split flat readings into (archivable, dead letters). Dead letters keep the
    re-encoded message as ``value`` when the raw text is not carried."""
    tagged = readings.withColumn("_reason", contract_reason())
    ok = tagged.where(F.col("_reason").isNull()).drop("_reason")
    cols = set(readings.columns)
    value = F.col("value") if "value" in cols else encode_reading_value()
    pos = [F.col(c) if c in cols else F.lit(None) for c in position]
    dead = tagged.where(F.col("_reason").isNotNull()).select(
        F.lit(source).alias("source"), pos[0].cast("int").alias("partition"),
        pos[1].cast("long").alias("offset"), value.alias("value"), F.col("_reason").alias("reason"))
    return ok, dead


def _weather_struct() -> Column:
    all_null = F.col("humidity").isNull() & F.col("temperature").isNull() & F.col("wind_speed").isNull()
    return F.when(all_null, F.lit(None)).otherwise(
        F.struct("humidity", "temperature", "wind_speed"))


def encode_reading_value() -> Column:
    """JSON text of a flat reading, every field written (``"weather":null`` included)."""
    msg = F.struct(
        F.col("station_id").alias("station_id"),
        F.col("sequence_number").alias("s_no"),
        F.col("battery_status").alias("battery_status"),
        F.col("timestamp").alias("status_timestamp"),
        _weather_struct().alias("weather"))
    return F.to_json(msg, {"ignoreNullFields": "false"})


def encode_readings(readings: DataFrame) -> DataFrame:
    """Flat readings -> topic records keyed by the decimal station id."""
    return readings.select(F.col("station_id").cast("string").alias("key"),
                           encode_reading_value().alias("value"))


def encode_alert_value() -> Column:
    """JSON text of an alert message."""
    msg = F.struct(*[F.col(c) for c in ["station_id", "s_no", "status_timestamp", "humidity",
                                        "alert_count", "message"]])
    return F.to_json(msg, {"ignoreNullFields": "false"})


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alert messages -> topic records, re-keyed by the payload's station id."""
    return alerts.select(F.col("station_id").cast("string").alias("key"), encode_alert_value().alias("value"))


def alert_topic_records(alerts: DataFrame) -> DataFrame:
    """Alert messages with their ``partition`` and ``offset`` -> topic records. The key is an input
    ``key`` column if there is one, else the payload's station id; the record time and the headers are
    the input record's (``record_timestamp``, ``headers``) if they were carried."""
    key = F.col("key") if "key" in alerts.columns else F.col("station_id").cast("string")
    time = F.col("record_timestamp") if "record_timestamp" in alerts.columns else F.lit(None).cast("timestamp")
    return alerts.select(key.alias("key"), encode_alert_value().alias("value"), "partition", "offset",
                         time.alias("timestamp"), *[c for c in alerts.columns if c == "headers"])
