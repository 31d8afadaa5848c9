"""Detectors on boundary tables and, key by key, against event-at-a-time plain_rules."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row, functions as F

import plain_rules
from kerbside.operators import alerts
from kerbside.operators.aqi import aqi_emergencies
from kerbside.operators.bunching import bus_bunching, close_contacts, contact_intervals
from kerbside.operators.gridlock import gridlock
from kerbside.streaming.detectors import BunchingProcessor, dealt

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
START_MS = int(START.timestamp() * 1000)
ROAD = 200.0 / 111_194.92664455873  # degrees of latitude in 200 m


def at(ms):
    return START + timedelta(milliseconds=ms)


def aqi_table(spark, rows):
    data = [(s, "ZONE-01", v, st, at(ms), i) for s, v, st, ms, i in rows]
    return spark.createDataFrame(
        data, "sensor_id string, zone string, aqi double, sensor_status string, event_time timestamp, event_id long"
    )


def signal_table(spark, rows):
    data = [(j, "ZONE-01", w, at(ms), i) for j, w, ms, i in rows]
    return spark.createDataFrame(
        data, "junction_id string, zone string, avg_wait_sec double, event_time timestamp, event_id long"
    )


def gps_table(spark, rows):
    data = [(r, b, lat, lon, at(ms), i) for r, b, lat, lon, ms, i in rows]
    return spark.createDataFrame(
        data, "route_id string, bus_id string, lat double, lon double, event_time timestamp, event_id long"
    )


def ids(df):
    return sorted(row.event_id for row in df.collect())


def hazards(*seconds, sensor="S"):
    return [(sensor, 400.0, "OK", int(s * 1000), i) for i, s in enumerate(seconds)]


# --- air quality ---------------------------------------------------------------------------------

@pytest.mark.parametrize("rows, expected", [
    ([("S", 300.0, "OK", 0, 0), ("S", 300.1, "OK", 1, 1)], [1]),
    (hazards(0, 119.999, 120), [0, 2]),
    (hazards(0, 60, 119, 121, 239, 241), [0, 3, 5]),
    ([("S", 400.0, "TIMEOUT", 0, 0), ("S", 400.0, None, 1, 1)], [1]),
    ([("S", None, "OK", 0, 0), ("S", float("nan"), "OK", 1, 1)], [1]),
    ([("S", 400.0, "OK", 5, 1), ("S", 500.0, "OK", 5, 0)], [0]),
    ([], []),
])
def test_aqi_boundaries(spark, rows, expected):
    assert ids(aqi_emergencies(aqi_table(spark, rows))) == expected


@pytest.mark.parametrize("block_ms", [120_000, 500_000, 3_600_000])
def test_aqi_against_simulator(spark, block_ms):
    rng, rows = random.Random(block_ms), []
    for sensor in range(150):
        pace = rng.choice([1, 500, 20_000, 60_000, 119_000, 121_000, 300_000])
        ms = 0
        for _ in range(rng.randrange(1, 120)):
            ms += rng.choice([0, 0, 1, pace, rng.randrange(pace + 1), rng.randrange(2 * pace + 1), 120_000])
            value = rng.choice([None, 100.0, 300.0, 301.0, 400.0, 500.0])
            rows.append((f"S{sensor}", value, rng.choice(["OK", "OK", None, "TIMEOUT"]), ms, len(rows)))
    rng.shuffle(rows)
    assert ids(aqi_emergencies(aqi_table(spark, rows), block_ms=block_ms)) == plain_rules.aqi(rows)


def test_aqi_one_busy_sensor(spark):
    # A sensor with a reading nearly every millisecond: far more entry cases than alerts.
    rows = spark.range(400_000).select(
        F.lit("S").alias("sensor_id"), F.lit("Z").alias("zone"), F.lit(400.0).alias("aqi"),
        F.lit("OK").alias("sensor_status"),
        F.timestamp_millis(F.col("id") + F.floor(F.col("id") / 7) + START_MS).alias("event_time"),
        F.col("id").alias("event_id"),
    )
    plain = [("S", 400.0, "OK", i + i // 7, i) for i in range(400_000)]
    assert ids(aqi_emergencies(rows, block_ms=130_000)) == plain_rules.aqi(plain)


def test_aqi_stays_in_the_jvm_and_reads_once(spark, tmp_path):
    rows = [(f"S{i % 5}", 400.0, "OK", 7_000 * i, i) for i in range(4000)]
    aqi_table(spark, rows).write.parquet(f"{tmp_path}/readings")
    found = aqi_emergencies(spark.read.parquet(f"{tmp_path}/readings"))
    assert ids(found) == plain_rules.aqi(rows)
    run = found._jdf.queryExecution().executedPlan().toString()
    final = run.split("== Initial Plan ==")[0]
    assert "Python" not in final and "Pandas" not in final and "Arrow" not in final
    exchanges = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert final.count("FileScan") == 1 and len(exchanges) <= 3, final


# --- gridlock ------------------------------------------------------------------------------------

def cycles(*waits):
    return [("J", w, 60_000 * i, i) for i, w in enumerate(waits)]


@pytest.mark.parametrize("waits, latch, expected", [
    ((181, 181, 180, 181, 181, 181, 181), True, [(5, 181.0)]),
    ((181, None, 181, 181), True, [(3, 181.0)]),
    ((181, 181, 181, 181), False, [(2, 181.0), (3, 181.0)]),
    ((181, 182, 183, 100, 190, 190, 190), True, [(2, 182.0), (6, 190.0)]),
    ((200, 200, float("nan"), 200, 200), True, []),
    ((180.0, 180.0, 180.0), True, []),
])
@pytest.mark.parametrize("block_ms", [60_000, 120_000, 3_600_000])
def test_gridlock_boundaries(spark, waits, latch, expected, block_ms):
    rows = cycles(*[None if w is None else float(w) for w in waits])
    found = gridlock(signal_table(spark, rows), latch=latch, block_ms=block_ms).collect()
    assert sorted((r.event_id, round(r.avg_wait, 6)) for r in found) == expected


@pytest.mark.parametrize("latch", [True, False])
def test_gridlock_one_busy_junction(spark, latch):
    # Nearly all cycles are one junction's, and nearly all of these fall into one hour.
    rng, rows = random.Random(3), []
    for i in range(60_000):
        ms = 36 * i if i % 50 else 3_600_000 * rng.randrange(40) + rng.randrange(1000)
        rows.append(("J" if i % 100 else "K", rng.choice([100.0, 200.0, 201.0, 202.0, 203.0]), ms, i))
    found = gridlock(signal_table(spark, rows).repartition(8), latch=latch)
    assert sorted((r.event_id, round(r.avg_wait, 6)) for r in found.collect()) == plain_rules.gridlock(rows, latch)


@pytest.mark.parametrize("latch", [True, False])
@pytest.mark.parametrize("block_ms", [1_000, 90_000, 3_600_000])
def test_gridlock_against_simulator(spark, latch, block_ms):
    rng, rows = random.Random(block_ms), []
    for junction in range(100):
        ms, bias = 0, rng.random()
        for _ in range(rng.randrange(1, 60)):
            ms += rng.choice([0, 1, 30_000, 60_000, 600_000])
            wait = None if rng.random() < 0.1 else rng.choice([100.0, 180.0]) if rng.random() < bias else 200.0 + rng.randrange(9)
            rows.append((f"J{junction}", wait, ms, len(rows)))
    rng.shuffle(rows)
    found = gridlock(signal_table(spark, rows), latch=latch, block_ms=block_ms).collect()
    assert sorted((r.event_id, round(r.avg_wait, 6)) for r in found) == plain_rules.gridlock(rows, latch)


# --- bunching ------------------------------------------------------------------------------------

def two_buses(*steps):
    """steps: (second, offset of bus B from bus A in units of 200 m), both buses reporting at once."""
    rows = []
    for second, offset in steps:
        for bus, lat in (("A", 12.9), ("B", 12.9 + offset * ROAD)):
            rows.append(("R", bus, lat, 77.6, int(second * 1000), len(rows)))
    return rows


def every_minute(first, last, offset):
    return [(60 * m, offset) for m in range(first, last + 1)]


def pairs(df):
    return sorted((r.event_id, r.bus_id_2) for r in df.collect())


CASES = {
    "held just too short": two_buses(*every_minute(0, 4, 0.5), (299.999, 0.5)),
    "held long enough": two_buses(*every_minute(0, 4, 0.5), (300, 0.5)),
    "separated in between": two_buses(*every_minute(0, 4, 0.5), (270, 3), *every_minute(5, 9, 0.5)),
    "at 200 m": two_buses(*every_minute(0, 6, 0.999999)),
    "beyond 200 m": two_buses(*every_minute(0, 6, 1.000001)),
    "reported again after separation": two_buses(*every_minute(0, 8, 0.5), (500, 3), *every_minute(9, 16, 0.5)),
    "silence keeps the streak": two_buses((0, 0.5), (3600, 0.5)),
    "apart during the silence": [
        *two_buses((0, 0.5)),
        ("R", "A", 12.9, 77.6, 1_800_000, 10), ("R", "B", 13.0, 77.6, 1_800_001, 11),
        ("R", "A", 12.9, 77.6, 3_600_000, 12), ("R", "B", 12.9, 77.6, 3_600_001, 13),
    ],
    "alone during the silence": [
        *two_buses((0, 0.5)),
        ("R", "A", 12.9, 77.6, 1_800_000, 10), ("R", "B", 13.0, 77.6, 1_980_001, 11),
        ("R", "A", 12.9, 77.6, 3_600_000, 12), ("R", "B", 12.9, 77.6, 3_600_001, 13),
    ],
    "other bus just fresh": [
        ("R", "A", 12.9, 77.6, 0, 0), ("R", "B", 12.9, 77.6, 180_000, 1), ("R", "A", 12.9, 77.6, 300_001, 2),
        ("R", "B", 12.9, 77.6, 480_001, 3),
    ],
    "other bus just stale": [
        ("R", "A", 12.9, 77.6, 0, 0), ("R", "B", 12.9, 77.6, 180_001, 1), ("R", "A", 12.9, 77.6, 360_001, 2),
        ("R", "B", 12.9, 77.6, 480_001, 3),
    ],
    "missing position": [*two_buses(*every_minute(0, 3, 0.5)), ("R", "B", None, 77.6, 200_000, 50),
                         *[(r, b, lat, lon, ms + 240_000, i + 60) for r, b, lat, lon, ms, i in two_buses(*every_minute(0, 2, 0.5))]],
    "other routes do not count": [(f"R{b}", b, *rest) for _, b, *rest in two_buses(*every_minute(0, 8, 0.5))],
    "at a pole and the date line": [
        *[("P", "A", 89.9999, 10.0, 60_000 * m, 2 * m) for m in range(8)],
        *[("P", "B", 89.9999, -170.0, 60_000 * m, 2 * m + 1) for m in range(8)],
        *[("D", "A", 0.0, 179.9999, 60_000 * m, 100 + 2 * m) for m in range(8)],
        *[("D", "B", 0.0, -179.9999, 60_000 * m, 101 + 2 * m) for m in range(8)],
    ],
}


@pytest.fixture(scope="module")
def bunching_cases(spark):
    rows = []
    for number, (name, case) in enumerate(CASES.items()):
        rows += [(f"{number}/{r}", b, lat, lon, ms, number * 1000 + i) for r, b, lat, lon, ms, i in case]
    return plain_rules.bunching(rows), pairs(bus_bunching(gps_table(spark, rows)))


@pytest.mark.parametrize("name, number", [(name, i) for i, name in enumerate(CASES)])
def test_bunching_boundaries(bunching_cases, name, number):
    expected, found = ([p for p in side if p[0] // 1000 == number] for side in bunching_cases)
    assert found == expected


def test_bunching_boundary_counts(bunching_cases):
    counts = {name: sum(p[0] // 1000 == i for p in bunching_cases[1]) for i, name in enumerate(CASES)}
    assert counts == {
        "held just too short": 0, "held long enough": 1, "separated in between": 0, "at 200 m": 1,
        "beyond 200 m": 0, "reported again after separation": 2, "silence keeps the streak": 1,
        "apart during the silence": 0, "alone during the silence": 1, "other bus just fresh": 1,
        "other bus just stale": 0, "missing position": 1, "other routes do not count": 0,
        "at a pole and the date line": 2,
    }


def random_walks(seed, routes=60):
    rng, rows = random.Random(seed), []
    for route in range(routes):
        buses = rng.randrange(2, 6)
        spread = rng.choice([0.3, 1.0, 3.0])
        gaps = rng.choice([[5, 30], [60, 90, 170], [120, 180, 181, 400], [30, 60, 3000]])
        place = [rng.random() * spread for _ in range(buses)]
        clock = [rng.randrange(200_000) for _ in range(buses)]
        for _ in range(rng.randrange(10, 120)):
            bus = min(range(buses), key=clock.__getitem__)
            place[bus] += rng.uniform(-0.3, 0.3) * spread
            position = None if rng.random() < 0.03 else 12.9 + place[bus] * ROAD
            rows.append((f"R{route}", f"B{bus}", position, 77.6, clock[bus], len(rows)))
            clock[bus] += rng.choice(gaps) * 1000 + rng.choice([0, 0, 1, -1, 500])
            if rng.random() < 0.1:
                clock[bus] -= clock[bus] % 180_000
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, hold", [(1, 300_000), (2, 300_000), (3, 100_000), (4, 900_000)])
def test_bunching_against_simulator(spark, seed, hold):
    rows = random_walks(seed)
    expected = plain_rules.bunching(rows, hold=hold)
    assert len(expected) > 5
    assert pairs(bus_bunching(gps_table(spark, rows), hold_ms=hold, stage_rows=seed % 2 == 0)) == expected


class KeptMap:
    """A map state in memory."""

    def __init__(self):
        self.held = {}

    def iterator(self):
        return iter(list(self.held.items()))

    def updateValue(self, key, value):
        self.held[tuple(key)] = tuple(value)

    def removeKey(self, key):
        del self.held[tuple(key)]


class KeptStates:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, KeptMap())


def released(rows, hold, blocks, step=90_000):
    """Alerts (id, other bus) and states of the stream's processor, driven key by key and watermark by watermark."""
    block = {bus: int(bus[1:]) % blocks for _, bus, *_ in rows}
    keyed = defaultdict(list)
    for route, bus, lat, lon, ms, rid in rows:
        if lat is None:
            continue
        for other in range(blocks):
            key = (route, min(block[bus], other), max(block[bus], other))
            keyed[key].append(Row(bus_id=bus, lat=lat, lon=lon, ms=ms, event_id=rid, block=block[bus]))
    alerts, states = [], {}
    for key, own in keyed.items():
        states[key] = KeptStates()
        for start in range(0, max(row.ms for row in own) + 1, step):
            processor = BunchingProcessor(200.0, hold, 180_000)
            processor.init(states[key])
            due = [row for row in own if start <= row.ms < start + step]
            found, wake = processor.release(key, due, start + step)
            alerts += [(row.event_id, row.bus_id_2) for row in found]
            positions = states[key].maps["positions"].held.values()
            assert all(place[2] >= start + step - 180_000 for place in positions)
            assert wake == (min(place[2] for place in positions) + 180_001 if positions else None)
    return sorted(alerts), states


@pytest.mark.parametrize("blocks", [1, 2, 3])
@pytest.mark.parametrize("seed, hold", [(1, 300_000), (3, 100_000), (8, 0)])
def test_blocks_of_buses_against_simulator(seed, hold, blocks):
    rows = random_walks(seed)
    expected = plain_rules.bunching(rows, hold=hold)
    alerts, _ = released(rows, hold, blocks)
    assert len(expected) > 5 and alerts == expected


def test_positions_near_poles_and_without_number():
    rng, rows = random.Random(2), []
    spots = [(89.9995, 10.0), (89.9995, -170.0), (89.9, 0.0), (-12.0, 180.0), (-12.0, -179.9995), (-12.0, 179.0),
             (math.nan, 1.0)]
    for i in range(600):
        rows.append(("R", f"B{rng.randrange(6)}", *rng.choice(spots), i * 7_000, i))
    expected = plain_rules.bunching(rows, hold=20_000)
    assert len(expected) > 20 and released(rows, 20_000, 2)[0] == expected


def test_busy_route_is_several_keys(spark):
    buses = spark.range(5000).select(F.lit("R").alias("route_id"), F.concat(F.lit("B"), "id").alias("bus_id"))
    keyed = dealt(buses, 4).groupBy("low", "high").agg(F.count("*").alias("n"), F.countDistinct("block").alias("blocks")).collect()
    assert len(keyed) == 10 and sum(r.n for r in keyed) == 20_000
    assert all(r.blocks == (1 if r.low == r.high else 2) for r in keyed) and max(r.n for r in keyed) < 3_000


def intervals(df):
    return sorted((r.route_id, r.bus_id_1, r.bus_id_2, r.from_ms - START_MS, r.to_ms - START_MS, r.comparisons) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 6])
def test_contact_intervals_against_simulator(spark, seed):
    rows = random_walks(seed)
    expected = plain_rules.contacts(rows)
    assert len(expected) > 50 and any(first < last for *_, first, last, _ in expected)
    assert intervals(contact_intervals(gps_table(spark, rows).repartition(5))) == expected


def test_contact_intervals_at_boundaries(spark):
    rows = []
    for number, case in enumerate(CASES.values()):
        rows += [(f"{number}/{r}", b, lat, lon, ms, number * 1000 + i) for r, b, lat, lon, ms, i in case]
    assert intervals(contact_intervals(gps_table(spark, rows))) == plain_rules.contacts(rows)
    assert contact_intervals(gps_table(spark, rows).limit(0)).count() == 0


def test_close_contacts_hold_the_alerts(spark):
    gps = gps_table(spark, random_walks(5, routes=20)).repartition(7)
    contacts = set(pairs(close_contacts(gps)))
    assert set(pairs(bus_bunching(gps))) <= contacts


# --- alerts --------------------------------------------------------------------------------------

def test_alert_columns_and_wording(spark):
    found = alerts.all_incidents(
        spark.createDataFrame([("S", "ZONE-01", 302.5, START_MS, 1)],
                              "sensor_id string, zone string, aqi double, ms long, event_id long"),
        spark.createDataFrame([("J", "ZONE-02", 200.0, START_MS + 7, 2)],
                              "junction_id string, zone string, avg_wait double, ms long, event_id long"),
        spark.createDataFrame([("R", "B2", "B1", 150.4, START_MS + 120, 3)],
                              "route_id string, bus_id_1 string, bus_id_2 string, distance_meters double, ms long, event_id long"),
    )
    by_type = {row.incident_type: row.asDict() for row in found.collect()}
    assert found.columns == [
        "incident_type", "junction_id", "zone", "sensor_id", "aqi", "route_id", "bus_id_1", "bus_id_2",
        "distance_meters", "detected_at", "details",
    ]
    assert by_type["AQI_EMERGENCY"]["details"] == "Sensor S in ZONE-01 reported hazardous AQI=303"
    assert by_type["AQI_EMERGENCY"]["detected_at"] == "2024-01-01T00:00:00Z"
    assert by_type["AQI_EMERGENCY"]["distance_meters"] == 0.0
    assert by_type["TRAFFIC_GRIDLOCK"]["details"] == (
        "Junction J exceeded 180s avg wait for 3 consecutive cycles (avg=200s)")
    assert by_type["TRAFFIC_GRIDLOCK"]["detected_at"] == "2024-01-01T00:00:00.007Z"
    assert by_type["BUS_BUNCHING"]["details"] == "Buses B2 and B1 on route R within 150m for >5 minutes"
    assert by_type["BUS_BUNCHING"]["zone"] is None
