"""Incident alerts: one column layout for the three detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.clock import iso_instant
from kerbside.schemas import ALERT

# Alert types and the wording of their details.
AQI_EMERGENCY = "AQI_EMERGENCY"
TRAFFIC_GRIDLOCK = "TRAFFIC_GRIDLOCK"
BUS_BUNCHING = "BUS_BUNCHING"
AQI_DETAILS = "Sensor %s in %s reported hazardous AQI=%.0f"
GRIDLOCK_DETAILS = "Junction %s exceeded 180s avg wait for 3 consecutive cycles (avg=%.0fs)"
BUNCHING_DETAILS = "Buses %s and %s on route %s within %.0fm for >5 minutes"

_DETAILS: dict[str, tuple[str, tuple[str, ...]]] = {
    AQI_EMERGENCY: (AQI_DETAILS, ("sensor_id", "zone", "aqi")),
    TRAFFIC_GRIDLOCK: (GRIDLOCK_DETAILS, ("junction_id", "zone", "avg_wait")),
    BUS_BUNCHING: (BUNCHING_DETAILS, ("bus_id_1", "bus_id_2", "route_id", "distance_meters")),
}


def _details(kind: str) -> Column:
    wording, columns = _DETAILS[kind]
    # The gridlock text does not name the zone.
    return F.format_string(wording, *[F.col(c) for c in columns if kind != TRAFFIC_GRIDLOCK or c != "zone"])


def as_alert(found: DataFrame, kind: str) -> DataFrame:
    """Detector output (its own columns plus ``ms``) to the eleven alert columns."""
    own = set(_DETAILS[kind][1])
    filled = {
        "incident_type": F.lit(kind),
        "detected_at": iso_instant(F.col("ms")),
        "details": _details(kind),
    }
    if kind != BUS_BUNCHING:
        filled["distance_meters"] = F.lit(0.0)

    def column(name: str, dtype) -> Column:
        value = filled.get(name, F.col(name) if name in own else F.lit(None).cast(dtype))
        return value.alias(name)

    return found.select(*[column(f.name, f.dataType) for f in ALERT.fields])


def all_incidents(aqi: DataFrame, gridlock: DataFrame, bunching: DataFrame) -> DataFrame:
    """One alert table from the output of the three detectors."""
    return (
        as_alert(aqi, AQI_EMERGENCY)
        .unionByName(as_alert(gridlock, TRAFFIC_GRIDLOCK))
        .unionByName(as_alert(bunching, BUS_BUNCHING))
    )
