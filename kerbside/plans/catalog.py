"""Registered queries: operator pipelines over the sensor tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbside.functions.json_codec import decode_json, encode_json
from kerbside.operators import advisory, alerts, aqi, bunching, energy, enrich, milestones, validate
from kerbside.operators import gridlock as gridlock_op
from kerbside.operators.staging import new_path
from kerbside.plans import views
from kerbside.schemas import BUS_GPS
from kerbside.sources.reference import EnergyDays
from kerbside.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]


def _six_digits(column: str) -> Column:
    """Mean or share rounded to six digits.

    Means of two-digit values often lie exactly between two roundings, where the order of summation
    decides; the nudge, here and in the SQL, makes every order round alike.
    """
    return F.round(F.col(column) + 1e-9, 6)


def ward_energy_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = energy.ward_energy(views.feed(spark, sf_dir, "smart_meters"))
    return summary.withColumns({
        "total_kwh_consumed": F.round("total_kwh_consumed", 6),
        "avg_power_factor": _six_digits("avg_power_factor"),
    })


def energy_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _energy_rollup(spark, sf_dir, "day")


def energy_weekly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _energy_rollup(spark, sf_dir, "week")


def energy_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _energy_rollup(spark, sf_dir, "month")


def _energy_rollup(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    summary = energy.ward_energy(views.feed(spark, sf_dir, "smart_meters", year=True), weights=True)
    return energy.energy_rollup(summary, level).withColumns({
        "total_kwh_consumed": F.round("total_kwh_consumed", 4),
        "avg_power_factor": _six_digits("avg_power_factor"),
    })


def energy_monthly_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months out of kept days: two update-mode batches reach an archive, and the days follow its commits."""
    meters = views.feed(spark, sf_dir, "smart_meters", year=True)
    late = F.col("event_time") >= F.lit("2024-11-01").cast("timestamp_ntz")
    changed = energy.ward_energy(meters.where(late)).select("ward_id", "window_start")
    updated = energy.ward_energy(meters, weights=True).join(changed, ["ward_id", "window_start"], "left_semi")
    archive = new_path(spark)
    write, days = jobs.dual_sink(lambda messages: None, archive, ("date",)), EnergyDays(spark, archive, new_path(spark))
    for number, batch in enumerate((energy.ward_energy(meters.where(~late), weights=True), updated)):
        write(batch, number)
        kept = days.refresh()
    return energy.energy_periods(kept, "month").withColumns({
        "total_kwh_consumed": F.round("total_kwh_consumed", 4),
        "avg_power_factor": _six_digits("avg_power_factor"),
    })


def energy_archive_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two update-mode batches, the second with the windows that changed, appended to one archive and reconciled."""
    meters = views.feed(spark, sf_dir, "smart_meters")
    cut = F.lit("2024-01-01 06:07:00").cast("timestamp_ntz")
    early = energy.ward_energy(meters.where(F.col("event_time") < cut))
    changed = energy.ward_energy(meters.where(F.col("event_time") >= cut)).select("ward_id", "window_start")
    updated = energy.ward_energy(meters).join(changed, ["ward_id", "window_start"], "left_semi")
    archive = energy.archive_rows(early, 0).unionByName(energy.archive_rows(updated, 1))
    return energy.latest_ward_energy(archive).select(
        "ward_id", "window_start", "date", "batch_id",
        F.round("total_kwh_consumed", 6).alias("total_kwh_consumed"), "peak_voltage",
    )


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisory.rolling_aqi(views.feed(spark, sf_dir, "air_quality"))


def aqi_rolling_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir).withColumn("rolling_avg_aqi", _six_digits("rolling_avg_aqi"))


def aqi_rolling_10m_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.feed(spark, sf_dir, "air_quality").createOrReplaceTempView("aqi_readings")
    rolling = advisory.rolling_aqi_sql(spark, "aqi_readings")
    return rolling.withColumn("rolling_avg_aqi", _six_digits("rolling_avg_aqi"))


def aqi_advisory(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = advisory.health_advisories(_rolling(spark, sf_dir), views.zone_profile(spark, sf_dir))
    return found.withColumn("rolling_avg_aqi", _six_digits("rolling_avg_aqi"))


def aqi_quarterly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = advisory.aqi_quarterly_trend(views.feed(spark, sf_dir, "air_quality", year=True))
    return trend.withColumn("avg_aqi", _six_digits("avg_aqi"))


def aqi_quarterly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = advisory.aqi_daily(views.feed(spark, sf_dir, "air_quality", year=True))
    return advisory.aqi_quarterly_change(daily).drop("median_aqi").withColumns(
        {name: _six_digits(name) for name in ("avg_aqi", "slope_per_day", "change")})


def route_schedule_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.route_schedule_log(spark, sf_dir)
    return enrich.latest_by_key(log, "route_id", deleted="route_name").drop("offset")


def gps_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_positions(
        views.feed(spark, sf_dir, "bus_gps"), route_schedule_latest(spark, sf_dir)
    )


def gps_enriched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus messages enriched without a schema; the unreadable ones drop out."""
    found = enrich.enrich_messages(
        views.messages(spark, sf_dir, "bus_gps"), route_schedule_latest(spark, sf_dir)
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BUS_GPS.fields)
    body = F.from_json("value", f"{schema}, scheduled_arrival_time string, route_name string, terminal string, "
                                "schedule_match boolean")
    return found.select(F.col("key").cast("string").alias("key"), body.alias("m")).select("key", "m.*")


def route_schedule_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_json(route_schedule_latest(spark, sf_dir), "route_id", columns=[
        "route_id", "route_name", "terminal", "scheduled_arrival_time"])


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.split(validate.validate_messages(views.all_messages(spark, sf_dir)))[1]


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.dlq_records(_rejected(spark, sf_dir)).drop("quarantined_at")


def dlq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.dlq_report(_rejected(spark, sf_dir)).withColumn("pct", _six_digits("pct"))


def dlq_report_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = validate.dlq_report(_rejected(spark, sf_dir), "5 minutes", "event_time")
    return report.withColumn("pct", _six_digits("pct"))


def null_aqi_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.null_aqi_rate(views.feed(spark, sf_dir, "air_quality")).withColumn(
        "null_pct", _six_digits("null_pct"))


def _valid(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validate.valid_rows(views.feed(spark, sf_dir, name), name)

    return run


def aqi_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aqi.aqi_emergencies(views.feed(spark, sf_dir, "air_quality"))


def gridlock_latched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridlock_op.gridlock(views.feed(spark, sf_dir, "traffic_signals"))


def gridlock_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridlock_op.gridlock(views.feed(spark, sf_dir, "traffic_signals"), latch=False)


def bus_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metres_rounded(bunching.bus_bunching(views.feed(spark, sf_dir, "bus_gps"), stage_rows=True))


def bus_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metres_rounded(bunching.close_contacts(views.feed(spark, sf_dir, "bus_gps"), stage_rows=True))


def bus_contact_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bunching.contact_intervals(views.feed(spark, sf_dir, "bus_gps"), stage_rows=True)
    return found.withColumn("closest_meters", F.round("closest_meters", 4))


def _metres_rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("distance_meters", F.round("distance_meters", 4))


def incidents_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.all_incidents(
        aqi_emergency(spark, sf_dir), gridlock_latched(spark, sf_dir), bus_bunching(spark, sf_dir)
    )


def incident_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alerts as unkeyed JSON with their NULL fields written out."""
    return encode_json(incidents_all(spark, sf_dir), None, keep_nulls=True)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus messages decoded again; of unreadable ones only the fields before the fault come back."""
    decoded = decode_json(views.messages(spark, sf_dir, "bus_gps"), BUS_GPS, keep=("offset",))
    return decoded.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).drop("timestamp")


def dedupe_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.dedupe_readings(views.duplicated_air_quality(spark, sf_dir))


def event_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return milestones.event_milestones(views.feed(spark, sf_dir, "traffic_signals"))


def processed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return milestones.processed_count(views.table(spark, sf_dir, "events"))


def queries() -> dict[str, Query]:
    named = [
        ward_energy_15m, energy_daily_rollup, energy_weekly_rollup, energy_monthly_rollup, energy_monthly_kept,
        energy_archive_latest, aqi_rolling_10m, aqi_rolling_10m_sql, aqi_advisory, aqi_quarterly_trend,
        aqi_quarterly_change, route_schedule_latest, route_schedule_messages, gps_enriched, gps_enriched_messages, dlq_records, dlq_report,
        dlq_report_5m, null_aqi_rate, aqi_emergency, gridlock_latched, gridlock_rolling, bus_bunching,
        bus_pair_distance, bus_contact_intervals, incidents_all, incident_messages, json_roundtrip, dedupe_readings,
        event_milestones, processed_count,
    ]
    found: dict[str, Query] = {query.__name__: query for query in named}
    for name in ("bus_gps", "traffic_signals", "air_quality", "smart_meters"):
        found[f"valid_{name}"] = _valid(name)
    return found
