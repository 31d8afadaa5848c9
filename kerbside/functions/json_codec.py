"""JSON decoding and encoding of message values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from kerbside.functions.clock import parse_event_time


#: Field of the element that follows each text while it is parsed.
END = "_end_of_message"


def bracketed(text: Column) -> Column:
    """The text as the first of two elements of a JSON array.

    Text that ends early, goes on after its object, or is no object then spoils the array or hides its end.
    """
    return F.concat(F.lit("["), text, F.lit(f',{{"{END}":true}}]'))


def sole_object(elements: Column) -> Column:
    """What was parsed from ``bracketed`` text, if that is one whole object, else NULL."""
    whole = (F.size(elements) == 2) & F.get(elements, F.lit(1))[END].isNotNull()
    return F.when(whole, F.get(elements, F.lit(0)))


def decode_json(
    raw: DataFrame,
    schema: T.StructType,
    keep: tuple[str, ...] = (),
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Message bytes to flat typed columns plus ``event_time``; ``keep`` names envelope columns to carry.

    PERMISSIVE turns missing, mistyped or unreadable fields into NULL; FAILFAST stops the job instead.
    """
    body = F.from_json(F.col("value").cast("string"), schema, {"mode": mode})
    flat = raw.where(F.col("value").isNotNull()).select(*keep, body.alias("m")).select(*keep, "m.*")
    if "timestamp" in schema.fieldNames():
        flat = flat.withColumn("event_time", parse_event_time("timestamp"))
    return flat


def encode_json(
    df: DataFrame,
    key: str | None,
    keep_nulls: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows to ``(key, value)`` messages; ``keep_nulls`` writes NULL fields out instead of leaving them away."""
    body = F.struct(*[F.col(c) for c in (columns or df.columns)])
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    message_key = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return df.select(message_key.alias("key"), F.to_json(body, options).alias("value"))
