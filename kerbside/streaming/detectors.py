"""The incident detectors on streams: one small state machine per key.

Rows of a key are handled in (event time, id) order within a micro-batch and in arrival order across
micro-batches; late rows are handled, not dropped. With ``in_event_order`` rows wait in the state until the
watermark has passed them, so the order is that of the batch detectors whatever the arrival; rows behind the
watermark of the micro-batch before, which may have been passed on, are dropped and counted in the query's
progress (``numRowsDroppedByWatermark``). The columns that come out are those of the batch detectors. A
micro-batch's rows of one key are sorted in memory, so ``max_per_batch`` of the source bounds what a backlog may
bring at once. State is kept for good unless ``ttl_ms`` is given; ``in_event_order`` also drops positions that no
later row can be compared with.

A route's buses are dealt into blocks, and a key of the bunching detector is a route with two of them, so that a
busy route is several tasks. What becomes of two buses depends on their own rows only, and they meet under one key.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from kerbside.functions.clock import epoch_ms
from kerbside.functions.geo import EARTH_RADIUS_M
from kerbside.operators.aqi import HAZARDOUS_AQI, MUTE_MS, is_hazardous
from kerbside.operators.bunching import HOLD_MS, NEAR_METRES, STALE_MS
from kerbside.operators.gridlock import BREACH_CYCLES, BREACH_WAIT_SEC

#: Blocks that a route's buses are dealt into.
BUS_BLOCKS = 4


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda row: (row.ms, row.event_id))


class Detector(StatefulProcessor):
    """A state machine that can also be driven by the watermark."""

    def release(self, key, rows: list[Row], watermark: int) -> tuple[Iterator[Row], int | None]:
        """Alerts of rows that the watermark has passed, and when the key is to be woken if it brings no rows."""
        return (self.handleInputRows(key, iter(rows), None) if rows else iter(())), None

    def close(self) -> None:
        pass


class AqiProcessor(Detector):
    """Hazardous readings of one sensor; state is the time of its last alert."""

    def __init__(self, mute_ms: int = MUTE_MS, ttl_ms: int | None = None):
        self._mute_ms, self._ttl_ms = mute_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last_alert", "ms long", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last.get()[0] if self._last.exists() else None
        alerts = []
        for row in _in_order(rows):
            if last is None or row.ms - last >= self._mute_ms:
                last = row.ms
                alerts.append(Row(sensor_id=key[0], zone=row.zone, aqi=row.aqi, ms=row.ms, event_id=row.event_id))
        if alerts:
            self._last.update((last,))
        return iter(alerts)


class GridlockProcessor(Detector):
    """Signal cycles of one junction; state is its current streak of breaches."""

    def __init__(self, wait: float, cycles: int, latch: bool, ttl_ms: int | None = None):
        self._wait, self._cycles, self._latch, self._ttl_ms = wait, cycles, latch, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Length of the streak and the waits of its last few cycles: all that either rule looks at.
        self._streak = handle.getValueState("streak", "length long, waits array<double>", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        length, waits = self._streak.get() if self._streak.exists() else (0, [])
        waits = list(waits)
        alerts = []
        for row in _in_order(rows):
            if not row.avg_wait_sec > self._wait:
                length, waits = 0, []
                continue
            length, waits = length + 1, [*waits, row.avg_wait_sec][-self._cycles:]
            if length == self._cycles or (length > self._cycles and not self._latch):
                alerts.append(Row(
                    junction_id=key[0], zone=row.zone, avg_wait=sum(waits) / self._cycles,
                    ms=row.ms, event_id=row.event_id,
                ))
        self._streak.update((length, waits))
        return iter(alerts)


class BunchingProcessor(Detector):
    """Positions of a route's buses of two blocks; state is each bus's last position and the streaks of close pairs.

    A position is compared with the buses in the cells around it and with those it has a streak with. To any other
    it is far and there is no streak to end.
    """

    def __init__(self, metres: float, hold_ms: int, stale_ms: int, ttl_ms: int | None = None):
        self._metres, self._hold_ms, self._stale_ms, self._ttl_ms = metres, hold_ms, stale_ms, ttl_ms
        self._side = metres * 1.001 + 0.01

    def init(self, handle: StatefulProcessorHandle) -> None:
        place = "lat double, lon double, ms long, block int"
        self._positions = handle.getMapState("positions", "bus string", place, self._ttl_ms)
        self._streaks = handle.getMapState(
            "streaks", "bus_a string, bus_b string", "since long, alerted boolean", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return iter(self._advance(key, rows, None)[0])

    def release(self, key, rows: list[Row], watermark: int) -> tuple[Iterator[Row], int | None]:
        alerts, wake = self._advance(key, rows, watermark)
        return iter(alerts), wake

    def _advance(self, key, rows, watermark: int | None) -> tuple[list[Row], int | None]:
        # Both maps are read once and their changes written once per micro-batch.
        positions = {bus[0]: tuple(place) for bus, place in self._positions.iterator()}
        streaks = {tuple(pair): tuple(streak) for pair, streak in self._streaks.iterator()}
        before, known, moved, alerts = dict(streaks), set(positions), set(), []
        cells, partners = defaultdict(set), defaultdict(set)
        for bus, (lat, lon, _, _) in positions.items():
            cells[self._cell(lat, lon)].add(bus)
        for a, b in streaks:
            partners[a].add(b)
            partners[b].add(a)
        for row in _in_order(rows):
            bus = row.bus_id
            if bus in positions:
                cells[self._cell(*positions[bus][:2])].discard(bus)
            positions[bus] = (row.lat, row.lon, row.ms, row.block)
            moved.add(bus)
            cell = self._cell(row.lat, row.lon)
            cells[cell].add(bus)
            around = (cells.get(tuple(map(sum, zip(cell, step))), ()) for step in product((-1, 0, 1), repeat=3))
            for other in partners[bus].union(*around):
                if other == bus or other not in positions:
                    continue
                lat, lon, ms, block = positions[other]
                if abs(row.ms - ms) > self._stale_ms or (key[1] != key[2] and block == row.block):
                    continue
                metres = _metres(row.lat, row.lon, lat, lon)
                pair = (min(bus, other), max(bus, other))
                if not metres <= self._metres:
                    if streaks.pop(pair, None):
                        partners[bus].discard(other)
                        partners[other].discard(bus)
                    continue
                partners[bus].add(other)
                partners[other].add(bus)
                since, alerted = streaks.setdefault(pair, (row.ms, False))
                if not alerted and row.ms - since >= self._hold_ms:
                    streaks[pair] = (since, True)
                    alerts.append(Row(
                        route_id=key[0], bus_id_1=bus, bus_id_2=other,
                        distance_meters=metres, ms=row.ms, event_id=row.event_id,
                    ))
        wake = None
        if watermark is not None:
            # Rows to come are not older than the watermark, so these positions are stale to all of them.
            gone = {bus for bus, place in positions.items() if place[2] < watermark - self._stale_ms}
            for bus in gone & known:
                self._positions.removeKey((bus,))
            moved -= gone
            left = [place[2] for bus, place in positions.items() if bus not in gone]
            wake = min(left) + self._stale_ms + 1 if left else None
        for bus in moved:
            self._positions.updateValue((bus,), positions[bus])
        for pair in before.keys() - streaks.keys():
            self._streaks.removeKey(pair)
        for pair, streak in streaks.items():
            if before.get(pair) != streak:
                self._streaks.updateValue(pair, streak)
        return alerts, wake

    def _cell(self, lat: float, lon: float) -> tuple[int, int, int]:
        """Cube of a position in earth-centred coordinates; positions that are near lie in the same or touching cubes."""
        if not (math.isfinite(lat) and math.isfinite(lon)):
            return 0, 0, 0  # near to nothing
        up, east = math.radians(lat), math.radians(lon)
        across = math.cos(up) * EARTH_RADIUS_M
        axes = across * math.cos(east), across * math.sin(east), math.sin(up) * EARTH_RADIUS_M
        return tuple(math.floor(axis / self._side) for axis in axes)


class EventOrder(StatefulProcessor):
    """Holds a key's rows until the watermark has passed them, then hands them in order to another processor.

    The state keeps the rows above the watermark; a timer stands at the first of them. Rows of the watermark's own
    millisecond wait too, since one with a later microsecond may still come.
    """

    def __init__(self, inner: Detector, schema: StructType):
        self._inner, self._schema, self._row = inner, schema, Row(*schema.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getListState("held", self._schema)
        self._inner.init(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [tuple(row[name] for name in self._schema.names) for row in rows]
        self._held.appendList(arrived)
        self._wake(arrived)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = [self._row(*values) for values in self._held.get()]
        due = [row for row in held if row.ms < watermark]
        if due:
            waiting = [tuple(row) for row in held if row.ms >= watermark]
            if waiting:
                self._held.put(waiting)
                self._wake(waiting)
            else:
                self._held.clear()
        alerts, wake = self._inner.release(key, due, watermark)
        if wake is not None:
            self._handle.registerTimer(wake)
        return alerts

    def _wake(self, rows: list[tuple]) -> None:
        at = self._schema.names.index("ms")
        self._handle.registerTimer(min(row[at] for row in rows) + 1)

    def close(self) -> None:
        self._inner.close()


def _metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    if not all(map(math.isfinite, (lat1, lon1, lat2, lon2))):
        return math.nan
    half_lat, half_lon = math.radians(lat2 - lat1) / 2, math.radians(lon2 - lon1) / 2
    h = math.sin(half_lat) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(half_lon) ** 2
    return 2 * EARTH_RADIUS_M * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def _keyed(rows: DataFrame, keys: list[str], processor: Detector, output: str, in_event_order: bool) -> DataFrame:
    time_mode = "None" if processor._ttl_ms is None else "ProcessingTime"
    if in_event_order:
        if processor._ttl_ms is not None:
            raise ValueError("ttl_ms counts processing time; it does not go with in_event_order")
        # The event time itself stays among the columns: rows behind its watermark are dropped by it.
        schema = StructType([field for field in rows.schema if field.name not in (*keys, "event_time")])
        processor, time_mode = EventOrder(processor, schema), "EventTime"
    else:
        rows = rows.drop("event_time")
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Update", timeMode=time_mode
    )


def _with_ms(rows: DataFrame, wanted: Column, *columns: str) -> DataFrame:
    """The ``wanted`` rows with their time in milliseconds.

    The test names the event time too, so that the optimizer leaves it above the watermark: rows that a detector does
    not want still tell how late it is, else the wanted ones would wait for one another.
    """
    kept = rows.where(wanted.eqNullSafe(F.col("event_time").isNotNull()))
    return kept.select(*columns, epoch_ms(rows).alias("ms"), "event_id", "event_time").dropna(
        subset=[columns[0], "ms", "event_id"]
    )


def stream_aqi_emergencies(
    readings: DataFrame,
    threshold: float = HAZARDOUS_AQI,
    mute_ms: int = MUTE_MS,
    ttl_ms: int | None = None,
    in_event_order: bool = False,
) -> DataFrame:
    """Streaming counterpart of ``aqi_emergencies``; only hazardous readings reach the state."""
    rows = _with_ms(readings, is_hazardous(threshold), "sensor_id", "zone", "aqi")
    output = "sensor_id string, zone string, aqi double, ms long, event_id long"
    return _keyed(rows, ["sensor_id"], AqiProcessor(mute_ms, ttl_ms), output, in_event_order)


def stream_gridlock(
    signals: DataFrame,
    wait: float = BREACH_WAIT_SEC,
    cycles: int = BREACH_CYCLES,
    latch: bool = True,
    ttl_ms: int | None = None,
    in_event_order: bool = False,
) -> DataFrame:
    """Streaming counterpart of ``gridlock``."""
    rows = _with_ms(signals, F.col("avg_wait_sec").isNotNull(), "junction_id", "zone", "avg_wait_sec")
    output = "junction_id string, zone string, avg_wait double, ms long, event_id long"
    return _keyed(rows, ["junction_id"], GridlockProcessor(wait, cycles, latch, ttl_ms), output, in_event_order)


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """Each bus's rows with its ``block``, once for every block that may hold another bus: (``low``, ``high``).

    Two buses of a route meet under exactly one (``low``, ``high``), wherever their blocks lie.
    """
    block, other = F.col("block"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    placed = rows.withColumn("block", F.pmod(F.xxhash64("bus_id"), F.lit(blocks)).cast("int")).select("*", other)
    return placed.withColumns({"low": F.least(block, "other"), "high": F.greatest(block, "other")}).drop("other")


def stream_bus_bunching(
    gps: DataFrame,
    metres: float = NEAR_METRES,
    hold_ms: int = HOLD_MS,
    stale_ms: int = STALE_MS,
    ttl_ms: int | None = None,
    in_event_order: bool = False,
    bus_blocks: int = BUS_BLOCKS,
) -> DataFrame:
    """Streaming counterpart of ``bus_bunching``, keyed by route and two blocks of its buses.

    A position goes to ``bus_blocks`` of the ``bus_blocks * (bus_blocks + 1) / 2`` keys of its route. The number
    belongs to the state: a job keeps it as long as its checkpoint.
    """
    if bus_blocks < 1:
        raise ValueError("buses need a block")
    located = F.col("bus_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rows = dealt(_with_ms(gps, located, "route_id", "bus_id", "lat", "lon"), bus_blocks)
    output = (
        "route_id string, bus_id_1 string, bus_id_2 string, distance_meters double, ms long, event_id long"
    )
    processor = BunchingProcessor(metres, hold_ms, stale_ms, ttl_ms)
    return _keyed(rows, ["route_id", "low", "high"], processor, output, in_event_order)
