"""Spherical geometry and the equal-angle grid used for spatial grouping."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
DEFAULT_CELL_DEG = 0.5
DEG_TO_RAD = math.pi / 180.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; null if any coordinate is null."""
    rad = F.lit(DEG_TO_RAD)
    p1, p2 = _c(lat1) * rad, _c(lat2) * rad
    dlat = p2 - p1
    dlon = _c(lon2) * rad - _c(lon1) * rad
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def grid_cell(lat="latitude", lon="longitude", deg: float = DEFAULT_CELL_DEG) -> Column:
    """Equal-angle cell id: row-major over (lat, lon) bands of ``deg`` degrees.

    Latitude 90 and longitude 180 are folded into the last band so every
    valid position maps to one of (180/deg) * (360/deg) cells.
    """
    rows = int(round(180 / deg))
    cols = int(round(360 / deg))
    r = F.least(F.floor((_c(lat) + 90.0) / deg), F.lit(rows - 1))
    c = F.least(F.floor((_c(lon) + 180.0) / deg), F.lit(cols - 1))
    return (r * F.lit(cols) + c).cast("bigint")


def cell_center_lat(cell="cell", deg: float = DEFAULT_CELL_DEG) -> Column:
    cols = int(round(360 / deg))
    return F.floor(_c(cell) / F.lit(cols)) * F.lit(deg) - 90.0 + deg / 2


def cell_center_lon(cell="cell", deg: float = DEFAULT_CELL_DEG) -> Column:
    cols = int(round(360 / deg))
    return F.pmod(_c(cell), F.lit(cols)) * F.lit(deg) - 180.0 + deg / 2


def in_bbox(min_lat: float, max_lat: float, min_lon: float, max_lon: float,
            lat="latitude", lon="longitude") -> Column:
    """Inclusive rectangle test; ``min_lon > max_lon`` means the box crosses 180."""
    lat_ok = _c(lat).between(min_lat, max_lat)
    if min_lon <= max_lon:
        lon_ok = _c(lon).between(min_lon, max_lon)
    else:
        lon_ok = (_c(lon) >= min_lon) | (_c(lon) <= max_lon)
    return lat_ok & lon_ok
