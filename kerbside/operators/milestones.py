"""Running event count with a mark at every n-th event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions.clock import epoch_ms, time_block
from kerbside.operators.staging import staged


def event_milestones(
    df: DataFrame,
    every: int = 200,
    id_col: str = "event_id",
    bucket_ms: int = 60_000,
    bucket_rows: int = 4_000_000,
) -> DataFrame:
    """Events number ``every``, 2·``every``, ... in (event time, id) order: (processed, ms, event id).

    No task sees the whole sequence. The first pass over the events counts them per millisecond. Running totals, within
    time buckets and over the buckets, tell in which milliseconds milestones lie, and the second pass takes the
    events of these only and numbers them by id. Where such a millisecond holds more than ``bucket_rows`` events,
    runs of ``bucket_rows`` ids are counted and numbered by themselves. Ids must be unique and not negative. Counts
    and the events taken are staged, since several steps read them.
    """
    rows = df.select(epoch_ms(df).alias("ms"), F.col(id_col)).where(
        F.col("ms").isNotNull() & F.col(id_col).isNotNull()
    )
    bucket = time_block(F.col("ms"), bucket_ms).alias("bucket")
    counts = staged(rows.groupBy(bucket, "ms").agg(F.count(F.lit(1)).alias("n")))

    # Three levels of running totals, so that none runs over more than a bucket, a day's buckets or all days.
    buckets = counts.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn(
        "day", F.floor(F.col("bucket") * bucket_ms / 86_400_000))
    days = _with_start(buckets.groupBy("day").agg(F.sum("n").alias("n")), [], ["day"]).select(
        "day", F.col("start").alias("day_start"))
    starts = _with_start(buckets, ["day"], ["bucket"]).join(days, "day").select(
        "bucket", (F.col("day_start") + F.col("start")).alias("bucket_start"))
    moments = _with_start(counts, ["bucket"], ["ms"]).join(starts, "bucket").select(
        "ms", "n", (F.col("bucket_start") + F.col("start")).alias("start"))

    piece = F.when(F.col("n") > bucket_rows, F.floor(F.col(id_col) / bucket_rows)).otherwise(0).alias("piece")
    taken = staged(rows.join(moments.where(_holds_one(every)), "ms").select("ms", id_col, "start", piece))
    counted = taken.groupBy("ms", "piece").agg(F.count(F.lit(1)).alias("n"), F.first("start").alias("before"))
    pieces = _with_start(counted, ["ms"], ["piece"]).withColumn("start", F.col("before") + F.col("start"))
    place = F.row_number().over(Window.partitionBy("ms", "piece").orderBy(id_col))
    return (
        taken.drop("start").join(pieces.where(_holds_one(every)).select("ms", "piece", "start"), ["ms", "piece"])
        .select((F.col("start") + place).alias("processed"), "ms", id_col)
        .where(F.col("processed") % every == 0)
    )


def _holds_one(every: int) -> Column:
    """Whether a milestone lies in the ``n`` numbers after ``start``."""
    return F.floor((F.col("start") + F.col("n")) / every) > F.floor(F.col("start") / every)


def _with_start(counts: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """Counts plus the total of the counts before each one."""
    before = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))


def processed_count(df: DataFrame, every: int = 200) -> DataFrame:
    """Number of events so far and the milestone last passed; on a stream, a running total."""
    total = F.count(F.lit(1))
    return df.groupBy().agg(total.alias("processed"), (total - total % every).alias("milestone"))
