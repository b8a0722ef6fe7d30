"""Distances on the sphere, as pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from drayline.functions._args import as_col

__all__ = [
    "EARTH_RADIUS_KM",
    "degrees_to_radians",
    "great_circle_distance",
    "haversine_distance",
]

# Radius used for kilometre distances, radius in miles and the
# mile-to-kilometre factor of the haversine form.
EARTH_RADIUS_KM = 6371.01
HAVERSINE_RADIUS_MI = 3961.0
KM_PER_MILE = 1.60934


def degrees_to_radians(degrees) -> Column:
    return F.radians(as_col(degrees).cast("double"))


def great_circle_distance(lat1, lon1, lat2, lon2) -> Column:
    """Kilometres between two points.

    Uses the arctangent form, which stays accurate for points that coincide or
    are antipodal, where an arccosine loses digits.
    """
    phi1, phi2 = degrees_to_radians(lat1), degrees_to_radians(lat2)
    delta = degrees_to_radians(lon1) - degrees_to_radians(lon2)
    east = F.cos(phi2) * F.sin(delta)
    north = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(delta)
    along = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(delta)
    return F.atan2(F.sqrt(east * east + north * north), along) * F.lit(EARTH_RADIUS_KM)


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Haversine distance in miles (``mi``) or kilometres (``km``)."""
    factors = {"mi": 1.0, "km": KM_PER_MILE}
    if unit not in factors:
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (as_col(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * HAVERSINE_RADIUS_MI) * F.asin(F.sqrt(chord)) * F.lit(factors[unit])
