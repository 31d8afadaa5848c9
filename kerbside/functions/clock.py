"""Event-time helpers. None of them depends on the session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

_UNIT_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def duration_ms(text: str) -> int:
    """Milliseconds of a Spark duration text such as ``"15 minutes"``."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text)
    if not found or found[2] not in _UNIT_MS:
        raise ValueError(f"not a fixed duration: {text!r}")
    return int(found[1]) * _UNIT_MS[found[2]]


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text (``Z`` or offset form) to TIMESTAMP; malformed text gives NULL."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp")


def epoch_ms(df: DataFrame, time_col: str = "event_time") -> Column:
    """Epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column, microseconds floored."""
    if isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        return F.floor(ntz_micros(f"`{time_col}`", "1970-01-01 00:00:00") / 1000)
    return F.unix_millis(F.col(time_col))


def ntz_micros(expr: str, origin: str) -> Column:
    """Microseconds from a wall-clock origin to a TIMESTAMP_NTZ expression, whatever the session time zone."""
    seconds = f"CAST(CAST({expr} - TIMESTAMP_NTZ'{origin}' AS INTERVAL SECOND) AS DECIMAL(18, 6))"
    return F.expr(f"CAST({seconds} * 1000000 AS BIGINT)")


def iso_instant(ms: Column) -> Column:
    """Epoch milliseconds to ISO text: no fraction on a whole second, else three digits."""
    seconds = F.floor(ms / 1000)
    day_time = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    fraction = F.pmod(ms, F.lit(1000))
    return F.concat(
        F.translate(day_time.cast("string"), " ", "T"),
        F.when(fraction == 0, F.lit("")).otherwise(F.format_string(".%03d", fraction)),
        F.lit("Z"),
    )


def time_block(ms: Column, width_ms: int) -> Column:
    """Number of the fixed-width time block that holds an epoch-millisecond value."""
    return F.floor(ms / F.lit(width_ms))
