"""Schemas of the four sensor feeds, the reference tables and the outputs."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


BUS_GPS = _schema(
    ("bus_id", _S), ("route_id", _S), ("lat", _D), ("lon", _D),
    ("speed_kmh", _D), ("occupancy_pct", _I), ("timestamp", _S),
)
AIR_QUALITY = _schema(
    ("sensor_id", _S), ("zone", _S), ("pm25", _D), ("pm10", _D),
    ("no2", _D), ("aqi", _D), ("sensor_status", _S), ("timestamp", _S),
)
TRAFFIC_SIGNALS = _schema(
    ("junction_id", _S), ("zone", _S), ("vehicle_count", _I),
    ("avg_wait_sec", _D), ("signal_phase", _S), ("timestamp", _S),
)
SMART_METERS = _schema(
    ("meter_id", _S), ("ward_id", _S), ("kwh_reading", _D),
    ("voltage", _D), ("power_factor", _D), ("timestamp", _S),
)

FEEDS: dict[str, T.StructType] = {
    "bus_gps": BUS_GPS,
    "traffic_signals": TRAFFIC_SIGNALS,
    "air_quality": AIR_QUALITY,
    "smart_meters": SMART_METERS,
}

# The feeds share no field name with two types, so one struct decodes them all in a single parse.
ANY_FEED = T.StructType(
    list({field.name: field for feed in FEEDS.values() for field in feed.fields}.values())
)

# Partition key of each feed's records.
FEED_KEYS = {
    "bus_gps": "route_id",
    "traffic_signals": "junction_id",
    "air_quality": "sensor_id",
    "smart_meters": "meter_id",
}

ROUTE_SCHEDULE = _schema(
    ("route_id", _S), ("route_name", _S), ("terminal", _S), ("scheduled_arrival_time", _S),
)
ZONE_PROFILE = _schema(("zone", _S), ("zone_name", _S), ("population", _I), ("num_schools", _I))

# What a keyed message log delivers for every record.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", _L),
    T.StructField("timestamp", T.TimestampType()),
])

ALERT = T.StructType([
    T.StructField("incident_type", _S, False),
    T.StructField("junction_id", _S),
    T.StructField("zone", _S),
    T.StructField("sensor_id", _S),
    T.StructField("aqi", _D),
    T.StructField("route_id", _S),
    T.StructField("bus_id_1", _S),
    T.StructField("bus_id_2", _S),
    T.StructField("distance_meters", _D, False),
    T.StructField("detected_at", _S),
    T.StructField("details", _S),
])
