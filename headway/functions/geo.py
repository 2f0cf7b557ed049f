"""Distances and grid cells as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, metres per degree, congestion grid size.
EARTH_RADIUS_KM = 6371.0
METERS_PER_DEGREE = 111320.0
GRID_SIZE = 0.003


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def equirect_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat-map distance in metres; longitudes shrink with the first latitude."""
    return F.lit(METERS_PER_DEGREE) * F.sqrt(
        F.pow(lat2 - lat1, F.lit(2)) + F.pow((lon2 - lon1) * F.cos(F.radians(lat1)), F.lit(2))
    )


def grid_cell(degrees: Column, size: float = GRID_SIZE) -> Column:
    """Centre of the nearest grid line, halves going to the even one."""
    return F.bround(degrees / F.lit(size)) * F.lit(size)


def bucket(degrees: Column, size: float) -> Column:
    """Integer bucket of ``size`` degrees, for equi-joins in place of range joins."""
    return F.floor(degrees / F.lit(size)).cast("long")
