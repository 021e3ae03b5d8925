"""Distance and grid expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe.functions.aqi import _col

EARTH_RADIUS_M = 6371000.0
KM_PER_DEGREE = 111.0


def great_circle_m(lon1, lat1, lon2, lat2) -> Column:
    """Haversine distance in metres."""
    lon1, lat1, lon2, lat2 = (F.radians(_col(c)) for c in (lon1, lat1, lon2, lat2))
    s_lat = F.sin((lat2 - lat1) / 2)
    s_lon = F.sin((lon2 - lon1) / 2)
    h = s_lat * s_lat + F.cos(lat1) * F.cos(lat2) * s_lon * s_lon
    return F.asin(F.least(F.lit(1.0), F.sqrt(h))) * F.lit(2 * EARTH_RADIUS_M)


def planar_degrees(lon1, lat1, lon2, lat2) -> Column:
    d_lat = _col(lat1) - _col(lat2)
    d_lon = _col(lon1) - _col(lon2)
    return F.sqrt(d_lat * d_lat + d_lon * d_lon)


def grid_centre(coordinate, size: float) -> Column:
    """Coordinate snapped to a grid, half-even like the feed's own cell ids."""
    return F.bround(_col(coordinate) / size, 0) * size


def grid_key(lat, lon, size: float = 0.2) -> Column:
    return F.format_string("grid_%.1f_%.1f", grid_centre(lat, size), grid_centre(lon, size))
