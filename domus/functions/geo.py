"""H12 haversine_km and H13 centre_distance as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions.numeric import py_round, py_round_sql


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, R = 6371.0 km, 2*atan2(sqrt(a), sqrt(1 - a))."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    s1, s2 = F.sin(dlat / 2), F.sin(dlon / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * (s2 * s2)
    return F.lit(C.EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    dlat = f"({p2} - {p1})"
    dlon = f"(radians({lon2}) - radians({lon1}))"
    s1, s2 = f"sin({dlat} / 2)", f"sin({dlon} / 2)"
    a = f"({s1} * {s1} + cos({p1}) * cos({p2}) * ({s2} * {s2}))"
    return f"({C.EARTH_RADIUS_KM!r} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def centre_distance(lat: Column, lon: Column, c_lat: Column, c_lon: Column) -> Column:
    """Haversine to the city centre, rounded to 2 places (Python rounding)."""
    return py_round(haversine_km(c_lat, c_lon, lat, lon), 2)


def centre_distance_sql(lat: str, lon: str, c_lat: str, c_lon: str) -> str:
    return py_round_sql(haversine_sql(c_lat, c_lon, lat, lon), 2)
