"""Geographic and name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres used by the haversine distance.
EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dl = F.radians(lng2 - lng1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dl / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(a))


def normalize_name(c: Column) -> Column:
    """lower case, '&' -> 'and', all whitespace removed, null -> ''."""
    return F.regexp_replace(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit("and")), r"\s+", "")
