"""Geodesy expressions, all native Catalyst expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres used by the distance rule.
EARTH_RADIUS_M = 6_371_000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres (haversine, atan2 form)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(radius) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def unit_xyz(lat, lon, radius: float = EARTH_RADIUS_M) -> tuple[Column, Column, Column]:
    """Earth-centred cartesian coordinates in metres.

    The straight-line (chord) distance never exceeds the great-circle
    distance, so a cubic grid of side ``d`` over these coordinates puts any
    two points within ``d`` metres of each other in the same or an adjacent
    cell on every axis -- at any latitude, poles and antimeridian included.
    """
    phi, lmb = F.radians(_c(lat)), F.radians(_c(lon))
    r = F.lit(radius)
    return (r * F.cos(phi) * F.cos(lmb), r * F.cos(phi) * F.sin(lmb), r * F.sin(phi))


def in_box(lat, lon, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> Column:
    """Inclusive bounding-box predicate."""
    return _c(lat).between(lat_min, lat_max) & _c(lon).between(lon_min, lon_max)


def haversine_m_np(lat1, lon1, lat2, lon2):
    """``haversine_m`` over NumPy arrays (for the stateful stream operators)."""
    import numpy as np

    p1, q1, p2, q2 = (np.radians(np.asarray(x, dtype="float64")) for x in (lat1, lon1, lat2, lon2))
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((q2 - q1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arctan2(np.sqrt(h), np.sqrt(1 - h))
