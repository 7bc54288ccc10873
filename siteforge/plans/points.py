"""Derived coordinates: exact in integers, so that any engine gets the same doubles."""
from pyspark.sql import Column
from pyspark.sql import functions as F


def lat(k: Column) -> Column:
    return 30.0 + (k * 7919 % 15000) / 1000.0


def lon(k: Column) -> Column:
    return -120.0 + (k * 104729 % 45000) / 1000.0


LAT = "(30.0::DOUBLE + ({k} * 7919 % 15000) / 1000.0::DOUBLE)"
LON = "(-120.0::DOUBLE + ({k} * 104729 % 45000) / 1000.0::DOUBLE)"


def hav(a: str, b: str, c: str, d: str, r: str = "6371008.8") -> str:
    """DuckDB text of the haversine metres."""
    return f"(2 * {r} * asin(sqrt(least(1.0, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))))"
