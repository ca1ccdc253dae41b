"""Numeric helpers whose meaning differs from the Spark built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    """``a / b``; null when ``b`` is zero."""
    return F.try_divide(a, b)


def round_down(c: Column) -> Column:
    """Towards zero."""
    return F.signum(c) * F.floor(F.abs(c))


def round_up(c: Column) -> Column:
    """Away from zero."""
    return F.signum(c) * F.ceil(F.abs(c))


def log_base(base: Column, x: Column) -> Column:
    return F.try_divide(F.ln(x), F.ln(base))


def row_average(*columns: Column) -> Column:
    """Mean across columns of one row; null if any of them is null."""
    if len(columns) < 2:
        raise ValueError("row_average needs at least two columns")
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total / F.lit(len(columns))


EARTH_RADIUS_KM = 6371.0
KM_PER_MILE = 1.609344


def geo_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "km") -> Column:
    """Great-circle distance by the haversine formula."""
    if unit not in ("km", "mi"):
        raise ValueError("unit must be km or mi")
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    km = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
    return km if unit == "km" else km / F.lit(KM_PER_MILE)
