"""Point arithmetic and grid cells (X13, X17, D1, D2 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from valora.functions._col import as_col

# Fixed value: mean Earth radius in metres used for haversine distances.
EARTH_RADIUS_M = 6371008.8


def sq_planar_distance(x1, y1, x2, y2) -> Column:
    """(x1-x2)^2 + (y1-y2)^2 in input units: the reference's squared-degree
    'distance' (no square root, no cos(lat))  (X13)."""
    x1, y1, x2, y2 = map(as_col, (x1, y1, x2, y2))
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres."""
    lon1, lat1, lon2, lat2 = map(as_col, (lon1, lat1, lon2, lat2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    # not ``least``, which passes over NULL: no coordinate, no distance
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))


def point(lon, lat) -> Column:
    """STRUCT(lon, lat): a point from two coordinate columns  (X17)."""
    return F.struct(as_col(lon).cast("double").alias("lon"), as_col(lat).cast("double").alias("lat"))


def cell(v, size: float) -> Column:
    """Grid cell index of a coordinate for cells of ``size`` units."""
    return F.floor(as_col(v) / F.lit(float(size))).cast("long")
