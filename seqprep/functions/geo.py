"""Great-circle distances as native Spark math (no UDF).

Fixed values: Earth radius 6371.0 km for step distance; 6378137.0 m for the
point error report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqprep.functions.missing import NAN

EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6378137.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Step distance in km in the product form
    ``sin²(Δφ/2)cos²(Δλ/2) + cos²(φm)sin²(Δλ/2)`` (equal to the usual haversine).
    ``h`` above 1 by rounding is clamped; NaN stays NaN."""
    p1, l1, p2, l2 = F.radians(lat1), F.radians(lon1), F.radians(lat2), F.radians(lon2)
    dphi = p2 - p1
    dlam = l2 - l1
    h = F.pow(F.sin(dphi / 2), 2) * F.pow(F.cos(dlam / 2), 2) + F.pow(F.cos((p1 + p2) / 2), 2) * F.pow(
        F.sin(dlam / 2), 2
    )
    root = F.sqrt(h)
    root = F.when(F.isnan(root), NAN()).when(root > 1.0, F.lit(1.0)).otherwise(root)
    return F.asin(root) * 2 * EARTH_RADIUS_KM


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres, ``atan2`` form."""
    p1, l1, p2, l2 = F.radians(lat1), F.radians(lon1), F.radians(lat2), F.radians(lon2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * 2 * EARTH_RADIUS_M
