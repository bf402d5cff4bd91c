"""Distances and coordinate tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    p, q = F.radians(lat1), F.radians(lat2)
    return haversine_by(p, F.cos(p), lon1, q, F.cos(q), lon2)


def haversine_by(p: Column, cos_p: Column, lon1: Column, q: Column, cos_q: Column, lon2: Column) -> Column:
    """The same from latitudes p and q in radians and their cosines, which many pairs can share."""
    a = F.sin((q - p) / 2) ** 2 + cos_p * cos_q * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def haversine_atan(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The same by atan2, which is steadier for antipodes."""
    p, q = F.radians(lat1), F.radians(lat2)
    a = F.sin((q - p) / 2) ** 2 + F.cos(p) * F.cos(q) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def at_centre(lat: Column, lon: Column, centre: tuple[float, float], by: float = 1e-6) -> Column:
    """Whether coordinates are the fallback of a city; null coordinates aren't."""
    return F.coalesce((F.abs(lat - centre[0]) < by) & (F.abs(lon - centre[1]) < by), F.lit(False))


def needs_geocoding(lat: Column, lon: Column, centre: tuple[float, float]) -> Column:
    return lat.isNull() | lon.isNull() | at_centre(lat, lon, centre)


def has_address(a: Column) -> Column:
    """Not null, blank or a word for unknown."""
    return F.coalesce(~F.lower(F.trim(a)).isin("", "unknown", "na", "n/a", "none"), F.lit(False))
