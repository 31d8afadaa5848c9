"""Record validation, dead-letter records and data-quality reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from kerbside.functions.json_codec import END, bracketed, sole_object
from kerbside.schemas import ANY_FEED, FEEDS

# Plausible ranges of each measurement, bounds included.
LAT_RANGE = (12.0, 14.0)
LON_RANGE = (76.5, 78.5)
SPEED_RANGE = (0.0, 120.0)
AQI_RANGE = (0.0, 500.0)
VOLTAGE_RANGE = (150.0, 280.0)

# Reason codes.
MALFORMED_JSON = "MALFORMED_JSON"
NULL_GPS_COORDINATE = "NULL_GPS_COORDINATE"
IMPOSSIBLE_GPS_COORDINATE = "IMPOSSIBLE_GPS_COORDINATE"
INVALID_SPEED = "INVALID_SPEED"
NULL_SIGNAL_METRIC = "NULL_SIGNAL_METRIC"
NEGATIVE_WAIT_TIME = "NEGATIVE_WAIT_TIME"
NULL_AQI_VALUE = "NULL_AQI_VALUE"
OUT_OF_RANGE_AQI = "OUT_OF_RANGE_AQI"
NULL_METER_READING = "NULL_METER_READING"
OUT_OF_RANGE_VOLTAGE = "OUT_OF_RANGE_VOLTAGE"

Rule = tuple[str, Callable[[Callable[[str], Column]], Column]]

# Per feed: (reason, test for the fault), the first fault found being the one reported.
RULES: dict[str, list[Rule]] = {
    "bus_gps": [
        (NULL_GPS_COORDINATE, lambda f: f("lat").isNull() | f("lon").isNull()),
        (IMPOSSIBLE_GPS_COORDINATE, lambda f: ~f("lat").between(*LAT_RANGE) | ~f("lon").between(*LON_RANGE)),
        # NaN compares as neither too low nor too high in the rule to match; Spark ranks it above 120.
        (INVALID_SPEED, lambda f: f("speed_kmh").isNull()
            | (~f("speed_kmh").between(*SPEED_RANGE) & ~F.isnan(f("speed_kmh")))),
    ],
    "traffic_signals": [
        (NULL_SIGNAL_METRIC, lambda f: f("avg_wait_sec").isNull() | f("vehicle_count").isNull()),
        (NEGATIVE_WAIT_TIME, lambda f: f("avg_wait_sec") < 0),
    ],
    "air_quality": [
        (NULL_AQI_VALUE, lambda f: f("aqi").isNull()),
        (OUT_OF_RANGE_AQI, lambda f: ~f("aqi").between(*AQI_RANGE)),
    ],
    "smart_meters": [
        (NULL_METER_READING, lambda f: f("kwh_reading").isNull() | f("voltage").isNull()),
        (OUT_OF_RANGE_VOLTAGE, lambda f: ~f("voltage").between(*VOLTAGE_RANGE)),
    ],
}

REASONS = [MALFORMED_JSON, *(code for rules in RULES.values() for code, _ in rules)]


def error_reason(feed: str, field: Callable[[str], Column] = F.col) -> Column:
    """First reason that makes a record of this feed invalid, NULL for a valid one."""
    reason = F.lit(None).cast("string")
    for code, is_faulty in reversed(RULES[feed]):
        reason = F.when(is_faulty(field), F.lit(code)).otherwise(reason)
    return reason


def validate(df: DataFrame, feed: str) -> DataFrame:
    """Typed rows of one feed plus ``error_reason``."""
    return df.withColumn("error_reason", error_reason(feed))


def valid_rows(df: DataFrame, feed: str) -> DataFrame:
    """Typed rows of one feed that pass every rule."""
    return df.where(error_reason(feed).isNull())


def feed_of(topic: Column) -> Column:
    """Feed named by a topic: the part after the last dot, so a prefixed topic works as well."""
    return F.substring_index(topic, ".", -1)


def validate_messages(raw: DataFrame) -> DataFrame:
    """Messages of any mix of feeds plus ``error_reason``, in one pass and with one decode per message.

    A value that is no JSON object (unreadable, array, scalar, empty or missing) is MALFORMED_JSON.
    A message of an unknown feed carries no reason: no rule applies to it.
    """
    elements = T.ArrayType(T.StructType([*ANY_FEED.fields, T.StructField(END, T.BooleanType())]))
    # One generated row per message: unlike a projected column, it is not copied into every filter and branch
    # above, so each message is parsed once.
    parsed = F.from_json(bracketed(F.col("value").cast("string")), elements, {"allowSingleQuotes": "false"})
    decoded = raw.select("*", F.explode(F.array(parsed)).alias("_p"))
    body = F.get("_p", F.lit(0))
    by_feed = F.lit(None).cast("string")
    for feed in FEEDS:
        by_feed = F.when(
            feed_of(F.col("topic")) == feed, error_reason(feed, body.getField)
        ).otherwise(by_feed)
    reason = F.when(sole_object(F.col("_p")).isNull(), F.lit(MALFORMED_JSON)).otherwise(by_feed)
    return decoded.withColumn("error_reason", reason).drop("_p")


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) branches of validated rows."""
    ok = F.col("error_reason").isNull()
    return validated.where(ok).drop("error_reason"), validated.where(~ok)


def dlq_records(rejected: DataFrame) -> DataFrame:
    """Rejected messages as dead-letter rows; an unreadable payload is kept as its raw text, an empty key as NULL."""
    return rejected.select(
        F.col("topic").alias("source_topic"),
        "error_reason",
        F.nullif(F.col("key").cast("string"), F.lit("")).alias("original_key"),
        F.col("value").cast("string").alias("original_payload"),
        F.current_timestamp().alias("quarantined_at"),
    )


def dlq_messages(records: DataFrame) -> DataFrame:
    """Dead-letter rows as ``(key, value)`` messages, a readable payload nested as JSON."""
    text = F.col("original_payload")
    raw = text.cast("variant")
    # NaN passes for a number in messages but not in a nested payload, which then stays text.
    payload = F.when(F.col("error_reason") == MALFORMED_JSON, raw).otherwise(F.coalesce(F.try_parse_json(text), raw))
    body = F.struct(
        "source_topic", "error_reason", "original_key", payload.alias("original_payload"), "quarantined_at"
    )
    return records.select(
        F.col("original_key").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def dlq_report(
    rejected: DataFrame, window: str | None = None, time_col: str = "quarantined_at"
) -> DataFrame:
    """Share of each reason among the rejected rows, over everything or per time window."""
    keys = []
    if window is not None:
        rejected = rejected.withColumn("window_start", F.window(time_col, window)["start"])
        keys = ["window_start"]
    counts = rejected.groupBy(*keys, "error_reason").agg(F.count(F.lit(1)).alias("n"))
    # Sums over one row per reason (and window), not over the rejected rows themselves.
    total = F.sum("n").over(Window.partitionBy(*keys))
    share = F.when(total > 0, 100.0 * F.col("n") / total).otherwise(F.lit(0.0))
    return counts.withColumn("pct", share).orderBy(*keys, F.desc("n"), "error_reason")


def null_aqi_rate(readings: DataFrame) -> DataFrame:
    """How many air-quality readings came without a value."""
    missing = F.count_if(F.col("aqi").isNull())
    total = F.count(F.lit(1))
    return readings.agg(
        total.alias("total_readings"),
        missing.alias("null_readings"),
        F.when(total > 0, 100.0 * missing / total).otherwise(F.lit(0.0)).alias("null_pct"),
    )
