"""Coordinate expressions: parsing, keys and distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def hemisphere_degrees(text: Column) -> Column:
    """``40.99N`` -> 40.99 and ``74.56W`` -> -74.56; unreadable text -> NULL."""
    degrees = F.left(text, F.length(text) - 1).try_cast("double")
    return F.when(F.right(text, F.lit(1)).isin("N", "E"), degrees).otherwise(-degrees)


def rounded(text: Column, places: int = 3) -> Column:
    """Number in a text, rounded half up."""
    return F.round(text.try_cast("double"), places)


def coordinate_key(latitude: Column, longitude: Column) -> Column:
    """``"lat,lon"``, NULL when either part is NULL."""
    return F.concat(latitude.cast("string"), F.lit(","), longitude.cast("string"))


def great_circle_km(
    lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column
) -> Column:
    """Haversine distance between two points given in degrees."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def unit_vector(latitude: Column, longitude: Column) -> list[Column]:
    """The point on a sphere of radius 1, as columns x, y and z."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    return [
        (F.cos(lat) * F.cos(lon)).alias("x"),
        (F.cos(lat) * F.sin(lon)).alias("y"),
        F.sin(lat).alias("z"),
    ]
