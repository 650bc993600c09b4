"""Distances on the globe, and the grid cells that make radius joins equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6_371_000.0
#: Metres in a degree of latitude, rounded down, so that a cell is never smaller than the radius.
DEGREE_M = 111_194.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def to_millimetres(m: Column) -> Column:
    """Metres to three places, halves up: without the decimal numbers of `round`, which take longer than the distance itself."""
    return F.floor(m * 1000 + 0.5) / 1000


def on_sphere(lat: Column, lon: Column) -> list[Column]:
    """The place as a point of the unit sphere: distances between such points need no trigonometry."""
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def chord_square(radius_m: float) -> float:
    """The square of the straight distance of places as far apart, on the unit sphere, and a hair more than that."""
    return (2 * math.sin(min(math.pi, radius_m / RADIUS_M) / 2)) ** 2 * (1 + 1e-9) + 1e-18


def surely_within(radius_m: float) -> float:
    """The square of a straight distance below which places are within the radius, whatever rounding does."""
    r = 2 * math.sin(min(math.pi, radius_m / RADIUS_M) / 2)
    return r * r * (1 - 4e-9) - r * 4e-15


def band(lat: Column, radius_m: float | Column) -> Column:
    """The number of the band of latitude, which is as high as the radius."""
    return F.floor((lat + 90) / (radius_m / DEGREE_M)).cast("int")


def cells_in_band(i: Column, radius_m: float | Column) -> Column:
    """How many cells a band's circle has: points within the radius of each other, in this band and the next ones, are in
    one cell or in neighbouring ones, at any latitude and across the date line."""
    d = radius_m / DEGREE_M
    # the most polar latitude that the band and its neighbours reach
    polar = F.least(F.greatest(F.abs((i - 1) * d - 90), F.abs((i + 2) * d - 90)), F.lit(90.0))
    if isinstance(radius_m, Column):
        reach = F.sin(F.least(F.lit(math.pi), radius_m / RADIUS_M) / 2) * (1 + 1e-9)
    else:
        reach = math.sin(min(math.pi, radius_m / RADIUS_M) / 2) * (1 + 1e-9)
    widest = F.degrees(2 * F.asin(F.least(F.lit(1.0), reach / F.greatest(F.cos(F.radians(polar)), F.lit(1e-12)))))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) / widest)).cast("int")


def cell(lon: Column, n: Column) -> Column:
    return F.least(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * n).cast("int"), n - 1)
