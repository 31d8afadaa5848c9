"""City sensor tables derived from the given ``events`` and ``nation`` tables.

Every view is a projection of the whole table, so its size and the work over it grow with the data.
Times stay TIMESTAMP_NTZ, which makes the views independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions.clock import ntz_micros
from kerbside.schemas import FEED_KEYS, FEEDS

_BUS_GPS = [
    "concat('RT-', lpad(u % 8 + 1, 3, '0')) AS route_id",
    "concat('RT-', lpad(u % 8 + 1, 3, '0'), '-BUS-', lpad((u div 8) % 3, 3, '0')) AS bus_id",
    """CASE WHEN id % 53 = 0 THEN NULL WHEN id % 59 = 0 THEN 0.0D
            ELSE 12.9D + 0.01D * (u % 8)
                 + ((u div 8) % 3) * (CASE WHEN (slot + u % 8) % 3 = 0 THEN 0.0005D ELSE 0.01D END)
                 + k * 0.000001D END AS lat""",
    "77.6D + k * 0.000001D AS lon",
    "CASE WHEN id % 61 = 0 THEN -5.0D WHEN id % 67 = 0 THEN NULL ELSE k * 0.6D END AS speed_kmh",
    "k AS occupancy_pct",
]
_AIR_QUALITY = [
    "concat('AQS-', lpad(u % 60 + 1, 3, '0')) AS sensor_id",
    "concat('ZONE-', lpad(u % 30 + 1, 2, '0')) AS zone",
    "CASE WHEN id % 20 = 0 THEN NULL ELSE value END AS pm25",
    "CASE WHEN id % 20 = 0 THEN NULL ELSE value * 1.2D END AS pm10",
    "CASE WHEN id % 20 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS no2",
    """CASE WHEN id % 20 = 0 THEN NULL WHEN id % 97 = 0 THEN 600.0D
            WHEN (slot + u % 10) % 2 = 0 THEN k * 5.0D ELSE k * 2.0D END AS aqi""",
    "CASE WHEN id % 20 = 0 THEN 'TIMEOUT' ELSE 'OK' END AS sensor_status",
]
_TRAFFIC_SIGNALS = [
    "concat('JN-', lpad(u % 20 + 1, 4, '0')) AS junction_id",
    "concat('ZONE-', lpad(u % 10 + 1, 2, '0')) AS zone",
    "CASE WHEN id % 47 = 0 THEN NULL ELSE k END AS vehicle_count",
    "CASE WHEN id % 41 = 0 THEN NULL WHEN id % 43 = 0 THEN -1.0D ELSE k * 3.0D END AS avg_wait_sec",
    "CASE k % 3 WHEN 0 THEN 'GREEN' WHEN 1 THEN 'AMBER' ELSE 'RED' END AS signal_phase",
]
_SMART_METERS = [
    "concat('MTR-', lpad(u, 6, '0')) AS meter_id",
    "concat('WARD-', lpad(u % 15 + 1, 3, '0')) AS ward_id",
    "CASE WHEN id % 31 = 0 THEN NULL ELSE value END AS kwh_reading",
    "CASE WHEN id % 71 = 0 THEN NULL ELSE CAST(145 + (id * 37) % 140 AS DOUBLE) END AS voltage",
    "CASE WHEN id % 37 = 0 THEN NULL ELSE 0.80D + (k % 20) * 0.01D END AS power_factor",
]
_FEED_COLUMNS = {
    "bus_gps": _BUS_GPS,
    "air_quality": _AIR_QUALITY,
    "traffic_signals": _TRAFFIC_SIGNALS,
    "smart_meters": _SMART_METERS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str, year: bool = False) -> DataFrame:
    """One sensor feed as typed rows with ``event_time`` (NTZ) and ``event_id``.

    30 days become 12 hours, so that rules on the scale of minutes fire, or a ``year`` for reports over periods.
    """
    micros = ntz_micros("ts", "2024-01-01 00:00:00")
    scaled = micros * 12 if year else F.floor(micros / 60)
    number = F.get_json_object("props", "$.k").cast("int")
    # Generated, not projected: the JSON is then read once per event however often k is used above.
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("u"), "value",
        F.explode(F.array(number)).alias("k"), scaled.alias("et"),
    )
    event_time = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(
        secs=(F.col("et") / 1_000_000).cast("decimal(18,6)")
    )
    return base.withColumn("slot", F.expr("et div 1200000000")).select(
        *map(F.expr, _FEED_COLUMNS[name]), event_time.alias("event_time"), F.col("id").alias("event_id")
    )


def messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One feed as keyed JSON messages; of the bus feed some values are unreadable: they break off, go on
    after the object or hold a second one."""
    rows = feed(spark, sf_dir, name).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
    text = F.to_json(F.struct(*FEEDS[name].fieldNames()))
    if name == "bus_gps":
        bad = F.when(F.col("event_id") % 2 == 0, F.lit("{bad json")).when(
            F.col("event_id") % 3 == 0, F.lit('{"lat": 13.0}{"lon": 77.0}')).otherwise(F.lit('{"lat": 13.0} junk}'))
        text = F.when(F.col("event_id") % 101 == 0, bad).otherwise(text)
    return rows.select(
        F.col(FEED_KEYS[name]).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(name).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        "event_time",
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of all four feeds, told apart by topic."""
    first, *others = [messages(spark, sf_dir, name) for name in FEEDS]
    for other in others:
        first = first.unionByName(other)
    return first


def duplicated_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air quality in which every tenth reading was delivered twice."""
    readings = feed(spark, sf_dir, "air_quality")
    return readings.unionByName(readings.where(F.col("event_id") % 10 == 0))


def zone_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('ZONE-', lpad(n_nationkey + 1, 2, '0')) AS zone",
        "n_name AS zone_name",
        "100000 + 10000 * n_nationkey AS population",
        "20 + n_nationkey AS num_schools",
    )


def route_schedule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert log of the route schedule, with one update (RT-002) and one delete (RT-005)."""
    routes = table(spark, sf_dir, "nation")
    number = F.col("n_nationkey")
    base = routes.select(
        F.concat(F.lit("RT-"), F.lpad((number + 1).cast("string"), 3, "0")).alias("route_id"),
        F.col("n_name").alias("route_name"),
        F.concat(F.lit("T-"), "n_name").alias("terminal"),
        F.format_string("%02d:%02d:00", F.expr("8 + n_nationkey div 12"), number * 5 % 60).alias("scheduled_arrival_time"),
        number.cast("long").alias("offset"),
    )
    update = base.where("route_id = 'RT-002'").withColumns(
        {"scheduled_arrival_time": F.lit("09:00:00"), "offset": F.lit(100).cast("long")}
    )
    delete = base.where("route_id = 'RT-005'").select(
        "route_id",
        *[F.lit(None).cast("string").alias(c) for c in ("route_name", "terminal", "scheduled_arrival_time")],
        F.lit(101).cast("long").alias("offset"),
    )
    return base.unionByName(update).unionByName(delete)
