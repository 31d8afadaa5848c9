"""Event-at-a-time state machines, in plain Python, that the detectors must agree with."""

from __future__ import annotations

from math import atan2, cos, radians, sin, sqrt


def metres_between(lat1, lon1, lat2, lon2):
    a = sin(radians(lat2 - lat1) / 2) ** 2
    a += cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2
    return 6_371_000.0 * 2 * atan2(sqrt(a), sqrt(1 - a))


def aqi(rows, threshold=300.0, mute=120_000):
    """rows: (sensor, aqi, status, ms, id) -> ids that alert."""
    last, found = {}, []
    for sensor, value, status, ms, rid in sorted(rows, key=lambda r: (r[3], r[4])):
        if value is None or status == "TIMEOUT" or value <= threshold:
            continue
        if sensor in last and ms - last[sensor] < mute:
            continue
        last[sensor] = ms
        found.append(rid)
    return sorted(found)


def gridlock(rows, latch=True, wait=180.0, cycles=3):
    """rows: (junction, wait, ms, id) -> (id, mean wait) that alert."""
    streaks, found = {}, []
    for junction, value, ms, rid in sorted(rows, key=lambda r: (r[2], r[3])):
        if value is None:
            continue
        streak = streaks.setdefault(junction, [])
        if not value > wait:
            streak.clear()
            continue
        streak.append(value)
        if len(streak) == cycles or (not latch and len(streak) > cycles):
            found.append((rid, round(sum(streak[-cycles:]) / cycles, 6)))
    return sorted(found)


def bunching(rows, metres=200.0, hold=300_000, stale=180_000):
    """rows: (route, bus, lat, lon, ms, id) -> (id, other bus) that alert."""
    places, since, alerted, found = {}, {}, set(), []
    for route, bus, lat, lon, ms, rid in sorted(rows, key=lambda r: (r[4], r[5])):
        if lat is None or lon is None:
            continue
        buses = places.setdefault(route, {})
        buses[bus] = (lat, lon, ms)
        for other, (olat, olon, oms) in buses.items():
            if other == bus or abs(ms - oms) > stale:
                continue
            pair = (route, *sorted((bus, other)))
            if metres_between(lat, lon, olat, olon) <= metres:
                if since.setdefault(pair, ms) <= ms - hold and pair not in alerted:
                    alerted.add(pair)
                    found.append((rid, other))
            else:
                since.pop(pair, None)
                alerted.discard(pair)
    return sorted(found)


def contacts(rows, metres=200.0, stale=180_000):
    """rows as above -> (route, bus, other bus, first ms, last ms, comparisons) per contact."""
    places, open_, found = {}, {}, []
    for route, bus, lat, lon, ms, rid in sorted(rows, key=lambda r: (r[4], r[5])):
        if lat is None or lon is None:
            continue
        buses = places.setdefault(route, {})
        buses[bus] = (lat, lon, ms)
        for other, (olat, olon, oms) in buses.items():
            if other == bus or abs(ms - oms) > stale:
                continue
            pair = (route, *sorted((bus, other)))
            if metres_between(lat, lon, olat, olon) <= metres:
                first, _, n = open_.get(pair, (ms, ms, 0))
                open_[pair] = (first, ms, n + 1)
            elif pair in open_:
                found.append((*pair, *open_.pop(pair)))
    return sorted(found + [(*pair, *contact) for pair, contact in open_.items()])
