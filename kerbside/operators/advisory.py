"""Rolling air-quality averages, health advisories and the quarterly trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbside.functions.clock import duration_ms

# Fixed value: an average above this is unhealthy.
UNHEALTHY_AQI = 150.0


def rolling_aqi(
    readings: DataFrame,
    window: str = "10 minutes",
    slide: str = "1 minute",
    lateness: str = "5 minutes",
) -> DataFrame:
    """Mean AQI per (sliding window, zone).

    Batch: readings are first reduced to one sum and count per (zone, slide step), and only those few
    rows are copied into the windows they belong to. Stream: one stateful aggregate over Spark's own
    sliding windows, rows later than ``lateness`` dropped.
    """
    present = readings.where(F.col("aqi").isNotNull())
    if present.isStreaming:
        present = present.withWatermark("event_time", lateness)
    width, step = duration_ms(window), duration_ms(slide)
    if present.isStreaming or width % step:
        return _rolling_direct(present, window, slide)
    panes = (
        present.groupBy(F.window("event_time", slide)["start"].alias("pane"), "zone")
        .agg(F.sum("aqi").alias("s"), F.count("aqi").alias("n"))
    )
    back = F.explode(F.sequence(F.lit(0), F.lit(width // step - 1))).alias("back")
    steps_back = F.make_dt_interval(secs=(F.col("back") * step / 1000).cast("decimal(18,6)"))
    span = F.make_dt_interval(secs=F.lit(width / 1000).cast("decimal(18,6)"))
    return (
        panes.select("zone", "pane", "s", "n", back)
        .groupBy((F.col("pane") - steps_back).alias("window_start"), "zone")
        .agg((F.sum("s") / F.sum("n")).alias("rolling_avg_aqi"))
        .select("window_start", (F.col("window_start") + span).alias("window_end"), "zone", "rolling_avg_aqi")
    )


def _rolling_direct(present: DataFrame, window: str, slide: str) -> DataFrame:
    grouped = present.groupBy(F.window("event_time", window, slide), "zone").agg(
        F.avg("aqi").alias("rolling_avg_aqi")
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "zone",
        "rolling_avg_aqi",
    )


def rolling_aqi_sql(spark: SparkSession, view: str, window: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    """The rolling average as a SQL statement over a registered view of readings, batch or streaming."""
    duration_ms(window), duration_ms(slide)
    return spark.sql(
        f"""
        SELECT w.start AS window_start, w.end AS window_end, zone, avg(aqi) AS rolling_avg_aqi
        FROM (SELECT window(event_time, '{window}', '{slide}') AS w, zone, aqi
              FROM IDENTIFIER(:view) WHERE aqi IS NOT NULL)
        GROUP BY w, zone
        """,
        args={"view": view},
    )


def health_advisories(rolling: DataFrame, zones: DataFrame, threshold: float = UNHEALTHY_AQI) -> DataFrame:
    """Windows whose average is unhealthy, with the zone's name, population and schools.

    Zones without a profile drop out. The planner broadcasts the profile while it is small enough.
    """
    profile = zones.select("zone", "zone_name", "population", "num_schools")
    return (
        rolling.where(F.col("rolling_avg_aqi") > threshold)
        .join(profile, "zone")
        .select("zone", "zone_name", "population", "num_schools", "window_start", "window_end", "rolling_avg_aqi")
    )


def aqi_quarterly_trend(readings: DataFrame) -> DataFrame:
    """Mean and peak AQI per zone and calendar quarter."""
    quarter = F.to_date(F.date_trunc("quarter", F.col("event_time").cast("date"))).alias("quarter_start")
    return (
        readings.where(F.col("aqi").isNotNull())
        .groupBy("zone", quarter)
        .agg(
            F.avg("aqi").alias("avg_aqi"),
            F.max("aqi").alias("peak_aqi"),
            F.count("aqi").alias("reading_count"),
        )
    )


def aqi_daily(readings: DataFrame) -> DataFrame:
    """Sums, counts and a quantile sketch of AQI per zone and day, which reports over longer periods merge."""
    return (
        readings.where(F.col("aqi").isNotNull() & ~F.isnan("aqi"))
        .groupBy("zone", F.col("event_time").cast("date").alias("day"))
        .agg(
            F.sum("aqi").alias("aqi_sum"), F.count("aqi").alias("reading_count"), F.max("aqi").alias("peak_aqi"),
            F.kll_sketch_agg_double("aqi").alias("sketch"),
        )
    )


def aqi_quarterly_change(daily: DataFrame) -> DataFrame:
    """Quarters out of ``aqi_daily``: mean, peak, median, slope of the daily means and change of the mean.

    The median comes from the merged sketches; its rank is off by 2 percent at most, with 99 percent confidence.
    ``slope_per_day`` is the least-squares slope, NULL with a single day. ``change`` is against the quarter right
    before, NULL where the zone has none.
    """
    quarter = F.to_date(F.date_trunc("quarter", F.col("day"))).alias("quarter_start")
    merged = daily.groupBy("zone", quarter).agg(
        (F.sum("aqi_sum") / F.sum("reading_count")).alias("avg_aqi"),
        F.max("peak_aqi").alias("peak_aqi"),
        F.sum("reading_count").alias("reading_count"),
        F.regr_slope(F.col("aqi_sum") / F.col("reading_count"), F.unix_date("day")).alias("slope_per_day"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch"), F.lit(0.5)).alias("median_aqi"),
    )
    by_zone = Window.partitionBy("zone").orderBy("quarter_start")
    follows = F.lag("quarter_start").over(by_zone) == F.add_months("quarter_start", -3)
    return merged.withColumn("change", F.when(follows, F.col("avg_aqi") - F.lag("avg_aqi").over(by_zone)))
