"""Air-quality emergencies: hazardous readings with repeat alerts muted per sensor.

The rule is a chain: whether a reading alerts depends on the alert before it. It is computed in DataFrame functions,
side by side, from what a stretch of time does to the state at its start.

Time is cut into blocks as wide as the mute, so a block holds one alert at most. What a block needs to know of the
past is one offset: the place in it until which the alert of the block before mutes it (0 if there was none). Its
alert is the first reading at or after that offset, and the alert's own offset is what the next block needs to know;
a block without such a reading leaves 0. A run of blocks is then a map from offset to offset, constant between the
readings of its first block, and the map of a longer run is the composition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.clock import epoch_ms, time_block

# A reading above this is hazardous; an alert mutes its sensor for this long.
HAZARDOUS_AQI = 300.0
MUTE_MS = 120_000

_STEP = "struct<upto: int, value: int>"


def is_hazardous(threshold: float = HAZARDOUS_AQI) -> Column:
    """A reading above the threshold from a sensor that did not time out (a missing status passes)."""
    timed_out = F.col("sensor_status").eqNullSafe("TIMEOUT")
    return F.col("aqi").isNotNull() & ~timed_out & (F.col("aqi") > threshold)


def aqi_emergencies(
    readings: DataFrame,
    threshold: float = HAZARDOUS_AQI,
    mute_ms: int = MUTE_MS,
    block_ms: int = 3_600_000,
    id_col: str = "event_id",
) -> DataFrame:
    """Readings that raise an alert: (sensor_id, zone, aqi, ms, event id).

    A sensor's first hazardous reading alerts; after an alert the next one is the first hazardous
    reading at least ``mute_ms`` later. No task walks a sensor's readings from end to end:

    1. Readings of one sensor and millisecond collapse to the first, since it mutes the others. Those of one sensor
       and run (about ``block_ms``) meet in one task, as sorted offsets by block, and become the run's map. Offsets
       are distinct milliseconds, which bounds a run whatever the number of readings.
    2. Per sensor, the maps applied one after the other give each run its offset on entry. A map has no more steps
       than its run's first block has readings, and mostly one or two, as chains soon meet.
    3. Back where its readings are, each run lists its alerts from that offset and picks their readings.

    The readings are read and shuffled once, the maps once and the entries once; all else stays in place.
    """
    rows = readings.where(is_hazardous(threshold))
    rows = rows.select("sensor_id", "zone", "aqi", epoch_ms(rows).alias("ms"), F.col(id_col).alias("id")).where(
        F.col("ms").isNotNull() & F.col("sensor_id").isNotNull()
    )
    reading = F.min_by(F.struct("id", "zone", "aqi"), "id").alias("r")
    if mute_ms <= 0:
        return _named(rows.groupBy("sensor_id", "ms").agg(reading), id_col)
    blocks = max(1, block_ms // mute_ms)
    run = ["sensor_id", "run"]
    # The tests for NULL here, true as they are, make every use of the shuffle ask for the same, so that all share it.
    placed = rows.withColumn("run", time_block(F.col("ms"), blocks * mute_ms)).where(F.col("run").isNotNull()).repartition(*run)
    first = placed.groupBy(*run, "ms").agg(reading).where(F.col("r").isNotNull())
    offset = F.pmod("ms", F.lit(mute_ms)).cast("int")
    block = (time_block(F.col("ms"), mute_ms) - F.col("run") * blocks).cast("int").alias("block")
    by_block = first.groupBy(*run, block).agg(F.sort_array(F.collect_list(offset)).alias("offsets"))
    runs = by_block.groupBy(*run).agg(F.sort_array(F.collect_list(F.struct("block", "offsets"))).alias("blocks"))

    maps = runs.select(*run, _map(F.col("blocks"), blocks, mute_ms).alias("steps"))
    chains = maps.groupBy("sensor_id").agg(F.sort_array(F.collect_list(F.struct("run", "steps"))).alias("runs"))
    entries = chains.select("sensor_id", F.explode(_entries(F.col("runs"), mute_ms)).alias("e")).select("sensor_id", "e.*")
    alerts = runs.join(entries, run).select(
        *run, F.explode(_alerts(F.col("run"), F.col("blocks"), F.col("entry"), blocks, mute_ms)).alias("ms"))
    return _named(first.join(alerts, [*run, "ms"]), id_col)


def _named(first: DataFrame, id_col: str) -> DataFrame:
    return first.select("sensor_id", "r.zone", "r.aqi", "ms", F.col("r.id").alias(id_col))


def _place(sorted_array: Column, value: Column, most: int, key: str | None = None) -> Column:
    """How many elements (or their ``key``) are below ``value``: binary search in an array of at most ``most``."""
    def further(low: Column, step: Column) -> Column:
        found = F.get(sorted_array, low + step - 1)
        found = found if key is None else found[key]
        return F.when(found < value, low + step).otherwise(low)

    steps = ", ".join(str(1 << k) for k in range(most.bit_length(), -1, -1))
    return F.aggregate(F.expr(f"array({steps})"), F.lit(0), further)


def _first_at(offsets: Column, value: Column, mute_ms: int) -> Column:
    """The first offset at or after ``value``, else NULL."""
    return F.get(offsets, _place(offsets, value, mute_ms))


def _step(upto: Column, value: Column) -> Column:
    return F.struct(upto.cast("int").alias("upto"), F.coalesce(value, F.lit(0)).cast("int").alias("value"))


def _shortened(steps: Column) -> Column:
    """Of neighbouring steps to the same value only the last. The one-element array gives the steps a name."""
    def last_of_value(all_steps: Column) -> Column:
        return F.filter(all_steps, lambda s, i: ~s["value"].eqNullSafe(F.get(all_steps, i + 1)["value"]))

    return F.get(F.transform(F.array(steps), last_of_value), F.lit(0))


def _map(blocks: Column, n_blocks: int, mute_ms: int) -> Column:
    """Map of a run as steps (upto, value): on entry with an offset up to ``upto`` it leaves ``value``."""
    any_offset = F.lit(mute_ms - 1)
    head = F.get(blocks, F.lit(0))
    from_start = F.concat(F.transform(head["offsets"], lambda o: _step(o, o)), F.array(_step(any_offset, F.lit(0))))
    start = F.when(head["block"] == 0, from_start).otherwise(F.array(_step(any_offset, F.get(head["offsets"], F.lit(0)))))

    def through(done: Column, block: Column) -> Column:
        follows = block["block"] == done["block"] + 1
        value = lambda s: F.when(follows, s["value"]).otherwise(F.lit(0))
        steps = F.transform(done["steps"], lambda s: _step(s["upto"], _first_at(block["offsets"], value(s), mute_ms)))
        return F.struct(block["block"].alias("block"), _shortened(steps).alias("steps"))

    first = F.struct(head["block"].alias("block"), start.cast(f"array<{_STEP}>").alias("steps"))
    nothing_after = F.array(_step(any_offset, F.lit(0)))
    return F.aggregate(
        F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))), first, through,
        lambda done: F.when(done["block"] == n_blocks - 1, done["steps"]).otherwise(nothing_after),
    )


def _entries(runs: Column, mute_ms: int) -> Column:
    """(run, entry) of a sensor's runs: what the run right before leaves, else 0."""
    kind = "array<struct<run: bigint, entry: int>>"

    def through(done: Column, run: Column) -> Column:
        entry = F.when(run["run"] == done["run"] + 1, done["value"]).otherwise(F.lit(0))
        value = F.get(run["steps"], _place(run["steps"], entry, mute_ms + 1, "upto"))["value"]
        found = F.concat(done["found"], F.array(F.struct(run["run"].alias("run"), entry.alias("entry"))))
        return F.struct(run["run"].alias("run"), value.alias("value"), found.cast(kind).alias("found"))

    start = F.struct(F.lit(None).cast("bigint").alias("run"), F.lit(0).alias("value"), F.array().cast(kind).alias("found"))
    return F.aggregate(runs, start, through, lambda done: done["found"])


def _alerts(run: Column, blocks: Column, entry: Column, n_blocks: int, mute_ms: int) -> Column:
    """Milliseconds of a run's alerts."""
    kind = "array<bigint>"

    def through(done: Column, block: Column) -> Column:
        value = F.when(block["block"] == done["block"] + 1, done["value"]).otherwise(F.lit(0))
        at = _first_at(block["offsets"], value, mute_ms)
        ms = (run * n_blocks + block["block"]) * mute_ms + at
        found = F.when(at.isNull(), done["found"]).otherwise(F.concat(done["found"], F.array(ms)))
        return F.struct(
            block["block"].alias("block"), F.coalesce(at, F.lit(0)).alias("value"), found.cast(kind).alias("found"))

    start = F.struct(F.lit(-1).alias("block"), entry.alias("value"), F.array().cast(kind).alias("found"))
    return F.aggregate(blocks, start, through, lambda done: done["found"])
