"""Reference tables and the joins that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kerbside.functions.json_codec import bracketed, sole_object

SCHEDULE_COLUMNS = ("scheduled_arrival_time", "route_name", "terminal")


def latest_by_key(
    log: DataFrame, key: str = "key", order: str = "offset", deleted: str | None = None
) -> DataFrame:
    """Newest row per key of an upsert log, without the keys whose newest row is a delete.

    ``deleted`` names the column whose NULL marks a delete (default: no deletes). The aggregate keeps
    one row per key on the map side, so a key with a long history costs no more than any other.
    """
    others = [c for c in log.columns if c != key]
    newest = log.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
    if deleted is not None:
        newest = newest.where(F.col("_r").getField(deleted).isNotNull())
    return newest.select(key, *[F.col("_r").getField(c).alias(c) for c in others])


def enrich_positions(gps: DataFrame, schedule: DataFrame) -> DataFrame:
    """Every position with its route's schedule columns and ``schedule_match``.

    ``schedule`` must hold one row per route. There is no broadcast hint: the planner broadcasts the
    schedule while its size stays under the session's threshold and otherwise sorts and merges, with
    adaptive execution splitting a hot route.
    """
    side = schedule.select("route_id", *SCHEDULE_COLUMNS, F.lit(True).alias("_found"))
    return (
        gps.join(side, "route_id", "left")
        .withColumn("schedule_match", F.coalesce("_found", F.lit(False)))
        .select(*gps.columns, *SCHEDULE_COLUMNS, "schedule_match")
    )


def enrich_messages(raw: DataFrame, schedule: DataFrame) -> DataFrame:
    """The same join on messages, without a schema: fields nobody declared pass through.

    Keys stay as they are. A matched position gains the schedule's columns, an unmatched one only
    ``schedule_match``. Messages that are no JSON object are left to the validator.
    """
    added = [*SCHEDULE_COLUMNS, "schedule_match"]
    # Generated, so that each message is parsed once.
    text = bracketed(F.col("value").cast("string"))
    elements = F.from_json(text, "array<map<string, variant>>", {"allowSingleQuotes": "false"})
    parsed = (
        raw.select("key", F.explode(F.array(elements)).alias("_p"))
        .select("key", sole_object(F.col("_p")).alias("fields")).where(F.col("fields").isNotNull())
    )
    route = F.try_variant_get(F.col("fields")["route_id"], "$", "string")
    side = schedule.select("route_id", *SCHEDULE_COLUMNS)
    joined = parsed.withColumn("route_id", route).join(side.withColumn("_found", F.lit(True)), "route_id", "left")

    def entry(name: str) -> list:
        return [F.lit(name), F.col(name).cast("variant")]

    matched = F.create_map(
        *[part for name in SCHEDULE_COLUMNS for part in entry(name)],
        F.lit("schedule_match"), F.lit(True).cast("variant"),
    )
    unmatched = F.create_map(F.lit("schedule_match"), F.lit(False).cast("variant"))
    own = F.map_filter("fields", lambda name, _: ~name.isin(*added))
    return joined.select(
        "key", F.to_json(F.map_concat(own, F.when(F.col("_found"), matched).otherwise(unmatched))).alias("value")
    )


def dedupe_readings(
    readings: DataFrame,
    keys: tuple[str, ...] = ("sensor_id", "event_time"),
    order: str = "event_id",
    lateness: str | None = None,
) -> DataFrame:
    """One row per redelivered reading: the first by ``order``, or on a stream the first to arrive.

    A reading with a NULL key can't be told from another and stays.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    if readings.isStreaming:
        named, unnamed = readings.where(known), readings.where(~known)
        once = named.withWatermark("event_time", lateness or "5 minutes").dropDuplicatesWithinWatermark(list(keys))
        return once.unionByName(unnamed)
    # Only keys whose hash stands twice can be repeated: eight bytes a reading are counted, and the planner sends the
    # few repeated hashes to the readings. A hot key's rows are cut to the first on the map side.
    marked = readings.withColumn("_key", F.when(known, F.xxhash64(*keys)))
    repeated = marked.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key")
    once = marked.join(repeated, "_key", "left_anti")
    several = marked.join(repeated, "_key", "left_semi")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    first = several.withColumn("_place", place).where(F.col("_place") == 1)
    return once.select(*readings.columns).unionByName(first.select(*readings.columns))
