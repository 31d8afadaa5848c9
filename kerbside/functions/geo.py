"""Distances and spatial cells as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean earth radius in metres, as the results to match use it.
EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def pair_key(a: Column, b: Column) -> Column:
    """Key of an unordered pair: smaller id first."""
    return F.concat_ws("::", F.least(a, b), F.greatest(a, b))


def earth_xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates in metres.

    A straight line is never longer than the arc above it, so two points within r metres of
    each other on the surface are within r metres here too, at every latitude and across the
    date line. A NaN position is near to nothing, whatever cell it gets.
    """
    across = F.cos(F.radians(lat)) * EARTH_RADIUS_M
    return tuple(
        F.nanvl(axis, F.lit(0.0))
        for axis in (
            across * F.cos(F.radians(lon)),
            across * F.sin(F.radians(lon)),
            F.sin(F.radians(lat)) * EARTH_RADIUS_M,
        )
    )
