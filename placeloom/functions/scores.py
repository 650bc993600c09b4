"""Scores, rates and bands. The weights and steps are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bands(c: Column, uppers: Sequence[tuple[float, str]], above: str, right_closed: bool = True) -> Column:
    """The label of the first upper bound that is not below c (or, not right-closed, that is above it)."""
    fits = (lambda u: c <= u) if right_closed else (lambda u: c < u)
    out = F.when(c.isNull(), None)
    for upper, label in uppers:
        out = out.when(fits(upper), label)
    return out.otherwise(above)


def steps(distance: Column, points: Sequence[tuple[float, int]]) -> Column:
    """The points of the first distance that is not exceeded; 0 beyond all, or without a distance."""
    out = F.when(distance.isNull(), 0)
    for upper, p in points:
        out = out.when(distance <= upper, p)
    return out.otherwise(0)


def access_by_distance(rail: Column, tram: Column, bus: Column, n_lines: Column) -> Column:
    """0 to 100 from the nearest stop of each mode and the number of lines."""
    return F.least(F.lit(100), steps(rail, [(300, 40), (600, 25), (1000, 10)]) + steps(tram, [(300, 25), (600, 15)]) + steps(bus, [(200, 20), (400, 10)]) + F.least(F.floor(n_lines / 3), F.lit(10)))


def access_by_density(n500: Column, n1000: Column, bonus: Column) -> Column:
    return F.least(F.lit(100), F.least(5 * n500, F.lit(30)) + F.least(2 * n1000, F.lit(20)) + bonus)


def access_by_modes(n_stops: Column, n_modes: Column) -> Column:
    return F.least(F.lit(10.0), n_stops / 5 * 3 + 2.5 * n_modes)


def traffic_safety(fatal: Column, serious: Column, minor: Column, vulnerable: Column) -> Column:
    """100 without accidents, falling with an exponential penalty."""
    return 100 * F.exp(-(10 * fatal + 3 * serious + minor + 2 * vulnerable) / 40.0)


def academic(grade: Column, passed: Column) -> Column:
    """70 % grade from 1 to 10, 30 % pass rate; the one there is if the other is null."""
    g, p = (grade - 1) / 9 * 100, passed
    return F.when(g.isNotNull() & p.isNotNull(), 0.7 * g + 0.3 * p).otherwise(F.coalesce(g, p))


def capped_share(c: Column, most: float) -> Column:
    return F.least(F.lit(100.0), c / most * 100)


def rate(n: Column, of: Column, per: float, places: int = 2) -> Column:
    """n per `per` of `of`; null where there is none."""
    return F.round(F.try_divide(n * F.lit(float(per)), of.cast("double")), places)


def access_by_rail(n500: Column, n1000: Column, underground: Column, suburban: Column) -> Column:
    """As access_by_density, with a bonus for each of the two rail modes by its nearest stop."""
    return F.least(F.lit(100), F.least(5 * n500, F.lit(30)) + F.least(2 * n1000, F.lit(20)) + steps(underground, [(500, 25), (1000, 15)]) + steps(suburban, [(500, 25), (1000, 15)]))


def rail_bonus(rail: Column, tram: Column) -> Column:
    """One bonus: 25 for rail within 500 m, 15 within 1000; else 20 for a tram within 300, 10 within 500."""
    by_rail = steps(rail, [(500, 25), (1000, 15)])
    return F.when(by_rail > 0, by_rail).otherwise(steps(tram, [(300, 20), (500, 10)]))


def small_area(city_rate: Column, index: Column, population: Column, per: float = 100_000.0) -> Column:
    """Expected count of a district: the city's rate times the district's index, for the district's population."""
    return F.round(city_rate * index * population / per)
