"""Gridlock: consecutive signal cycles of one junction with a long average wait."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions.clock import epoch_ms, time_block

# A cycle breaches above this wait, and this many breaches in a row are gridlock.
BREACH_WAIT_SEC = 180.0
BREACH_CYCLES = 3


#: Blocks of time that make a block of the next level: minutes, hours, then a junction's whole history.
WIDENINGS = (60,)


def gridlock(
    signals: DataFrame,
    wait: float = BREACH_WAIT_SEC,
    cycles: int = BREACH_CYCLES,
    latch: bool = True,
    block_ms: int = 60_000,
    id_col: str = "event_id",
) -> DataFrame:
    """Cycles at which a junction is reported: (junction_id, zone, avg_wait, ms, event id).

    ``latch=True`` reports a streak once, at its ``cycles``-th breach; ``latch=False`` reports every
    cycle that ends ``cycles`` breaches in a row. Cycles without a wait neither count nor reset.

    Either rule looks at no more than ``cycles`` cycles back, so a junction's history is cut into blocks of
    ``block_ms`` that are sorted side by side. Only the first and last few cycles of each block rise to the next
    level, where wider blocks hold them, and so on up to the whole junction: a cycle is settled at the first level
    at which its look-back stays inside a block. The largest group that is sorted is one junction's cycles of
    ``block_ms``, or the ends of the blocks of one level below.
    """
    look_back = cycles if latch else cycles - 1
    rows = (
        signals.select("junction_id", "zone", "avg_wait_sec", epoch_ms(signals).alias("ms"), F.col(id_col))
        .where(F.col("avg_wait_sec").isNotNull() & F.col("ms").isNotNull() & F.col("junction_id").isNotNull())
        .withColumn("breach", (F.col("avg_wait_sec") > wait) & ~F.isnan("avg_wait_sec"))
    )
    widths = [block_ms]
    for more in WIDENINGS:
        widths.append(widths[-1] * more)
    home = time_block(F.col("ms"), block_ms)
    # ``end``: the row stands at an end of its block of the level before; ``open``: its look-back left that block.
    level = rows.select(
        "*", F.lit(True).alias("end"), F.lit(True).alias("open"), F.lit(False).alias("hit"),
        F.lit(None).cast("double").alias("avg_wait"))
    for width in [*widths, None]:
        block = F.lit(0).cast("long") if width is None else time_block(F.col("ms"), width)
        # Settled hits stay in their first block, beside the rows that go on.
        order = Window.partitionBy("junction_id", F.when(F.col("end"), block), F.when(~F.col("end"), home)).orderBy("ms", id_col)
        judged = F.col("end") & F.col("open")
        level = level.select(
            "junction_id", "zone", "avg_wait_sec", "ms", id_col, "breach",
            (judged & F.lag("ms", look_back).over(order).isNull()).alias("open"),
            (F.col("end") & F.lead("ms", look_back).over(order).isNull()).alias("tail"),
            F.when(judged, _reported(order, cycles, latch)).otherwise(F.col("hit")).alias("hit"),
            F.when(judged, _mean_wait(order, cycles)).otherwise(F.col("avg_wait")).alias("avg_wait"),
        )
        level = level.withColumn("end", F.col("open") | F.col("tail")).drop("tail").where(F.col("end") | F.col("hit"))
    return level.where("hit").select("junction_id", "zone", "avg_wait", "ms", id_col)


def _reported(order, cycles: int, latch: bool) -> Column:
    hit = F.col("breach")
    for back in range(1, cycles):
        hit = hit & F.lag("breach", back, False).over(order)
    return hit & ~F.lag("breach", cycles, False).over(order) if latch else hit


def _mean_wait(order, cycles: int) -> Column:
    # Oldest first, so that the sum rounds as a running sum does.
    total = F.lag("avg_wait_sec", cycles - 1).over(order)
    for back in range(cycles - 2, 0, -1):
        total = total + F.lag("avg_wait_sec", back).over(order)
    if cycles > 1:
        total = total + F.col("avg_wait_sec")
    return total / cycles
