"""Ward energy totals: 15-minute windows and the report levels above them."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F


def ward_energy(
    meters: DataFrame,
    window: str = "15 minutes",
    lateness: str = "45 minutes",
    weights: bool = False,
) -> DataFrame:
    """Per (window, ward): total kWh, mean power factor and peak voltage.

    Rows without reading or voltage are left out. The same call serves batch and stream; on a stream
    rows later than ``lateness`` are dropped. ``weights`` adds the counts a roll-up needs.
    """
    usable = meters.where(F.col("kwh_reading").isNotNull() & F.col("voltage").isNotNull())
    if usable.isStreaming:
        usable = usable.withWatermark("event_time", lateness)
    measures = [
        F.sum("kwh_reading").alias("total_kwh_consumed"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.max("voltage").alias("peak_voltage"),
    ]
    if weights:
        measures += [
            F.count(F.lit(1)).alias("reading_count"),
            F.count("power_factor").alias("power_factor_count"),
        ]
    grouped = usable.groupBy(F.window("event_time", window), "ward_id").agg(*measures)
    return grouped.select(
        "ward_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in ("window", "ward_id")],
    )


def energy_rollup(summary: DataFrame, level: str = "day") -> DataFrame:
    """Window summaries (with weights) to day, week, month, quarter or year totals per ward."""
    period = F.to_date(F.date_trunc(level, F.col("window_start").cast("date"))).alias("period_start")
    factor_sum = F.sum(F.col("avg_power_factor") * F.col("power_factor_count"))
    factor_rows = F.sum("power_factor_count")
    return summary.groupBy("ward_id", period).agg(
        F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
        F.when(factor_rows > 0, factor_sum / factor_rows).alias("avg_power_factor"),
        F.max("peak_voltage").alias("peak_voltage"),
        F.sum("reading_count").alias("reading_count"),
    )


def energy_days(summary: DataFrame) -> DataFrame:
    """Window summaries (with weights) to sums per (ward, date), which add up to those of any longer period."""
    return summary.groupBy("ward_id", F.to_date("window_start").alias("date")).agg(
        F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
        F.sum(F.col("avg_power_factor") * F.col("power_factor_count")).alias("power_factor_sum"),
        F.sum("power_factor_count").alias("power_factor_count"),
        F.max("peak_voltage").alias("peak_voltage"),
        F.sum("reading_count").alias("reading_count"),
    )


def energy_periods(days: DataFrame, level: str = "month") -> DataFrame:
    """``energy_rollup`` out of the sums per (ward, date)."""
    period = F.to_date(F.date_trunc(level, F.col("date"))).alias("period_start")
    factor_rows = F.sum("power_factor_count")
    return days.groupBy("ward_id", period).agg(
        F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
        F.when(factor_rows > 0, F.sum("power_factor_sum") / factor_rows).alias("avg_power_factor"),
        F.max("peak_voltage").alias("peak_voltage"),
        F.sum("reading_count").alias("reading_count"),
    )


def archive_rows(summary: DataFrame, batch_id: int | None = None, job_started: datetime | None = None) -> DataFrame:
    """Summary rows as archived: with the partition column ``date``, the batch that wrote them and its job's start."""
    rows = summary.withColumn("date", F.to_date("window_start"))
    if batch_id is not None:
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
    return rows if job_started is None else rows.withColumn("job_started", F.lit(job_started).cast("timestamp"))


def latest_ward_energy(archive: DataFrame) -> DataFrame:
    """Newest version of each (ward, window) in an archive that update-mode batches append to.

    The start of the job decides before the batch, whose numbers begin again with a new checkpoint.
    """
    keys = ["ward_id", "window_start"]
    others = [c for c in archive.columns if c not in keys]
    newer = [c for c in ("job_started", "batch_id") if c in others]
    newest = archive.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*newer)).alias("_r"))
    return newest.select(*keys, *[F.col("_r").getField(c).alias(c) for c in others]).select(*archive.columns)


def compact_archive(archive: DataFrame, path: str) -> None:
    """Rewrite an archive to one version per window and one file per (ward, date).

    Dates of one ward spread over tasks, so a ward with most of the rows is no hot spot. ``path`` must not hold
    the archive itself: overwriting it would delete what is still to be read.
    """
    target = path.removeprefix("file:").rstrip("/") + "/"
    if any(unquote(f).removeprefix("file:").replace("///", "/").startswith(target) for f in archive.inputFiles()):
        raise ValueError(f"{path} holds the archive that is to be compacted")
    (
        latest_ward_energy(archive)
        .repartition("ward_id", "date")
        .write.mode("overwrite")
        .partitionBy("ward_id", "date")
        .parquet(path)
    )
