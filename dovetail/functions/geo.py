"""Ellipsoid distance as built-in column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid axes (metres) and flattening.
WGS84_A = 6378137.0
WGS84_B = 6356752.314245
WGS84_F = 1 / 298.257223563

ROUNDS = 99
BLOCK = 9  # rounds between looks at whether a pair has settled for good
CLOSE = 1e-12


def _let(value: Callable[[], dict[str, Column]], then: Callable[[Column], Column]) -> Column:
    """``then`` of the named values, each computed once however often it is used."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(k) for k, c in value().items()])), then), F.lit(0))


def _sphere(p: Column, lam: Column, then: Callable[[Column], Column]) -> Column:
    """Quantities on the auxiliary sphere at longitude difference ``lam``."""
    def arc(t: Column) -> Column:
        cross = p.cu1 * p.su2 - p.su1 * p.cu2 * t.cos
        return _let(lambda: {"ss": F.sqrt((p.cu2 * t.sin) * (p.cu2 * t.sin) + cross * cross),
                             "cs": p.su1 * p.su2 + p.cu1 * p.cu2 * t.cos, "sin": t.sin}, angle)

    def angle(t: Column) -> Column:
        return _let(lambda: {"ss": t.ss, "cs": t.cs, "sigma": F.atan2(t.ss, t.cs),
                             "sa": F.when(t.ss == 0, 0.0).otherwise(p.cu1 * p.cu2 * t.sin / t.ss)}, azimuth)

    def azimuth(t: Column) -> Column:
        ca2 = 1 - t.sa * t.sa
        return _let(lambda: {"ss": t.ss, "cs": t.cs, "sigma": t.sigma, "sa": t.sa, "ca2": ca2,
                             "c2m": F.when(ca2 == 0, 0.0).otherwise(t.cs - 2 * p.su1 * p.su2 / ca2)}, then)

    return _let(lambda: {"sin": F.sin(lam), "cos": F.cos(lam)}, arc)


def _next(p: Column, q: Column) -> Column:
    f = WGS84_F
    c = f / 16 * q.ca2 * (4 + f * (4 - 3 * q.ca2))
    return _let(lambda: {"c": c}, lambda k: p.l + (1 - k.c) * f * q.sa * (
        q.sigma + k.c * q.ss * (q.c2m + k.c * q.cs * (-1 + 2 * q.c2m * q.c2m))))


def _length(q: Column) -> Column:
    def last(k: Column) -> Column:
        d = k.b * q.ss * (q.c2m + k.b / 4 * (q.cs * (-1 + 2 * q.c2m * q.c2m) - k.b / 6 * q.c2m
                                             * (-3 + 4 * q.ss * q.ss) * (-3 + 4 * q.c2m * q.c2m)))
        return WGS84_B * k.a * (q.sigma - d)
    u = q.ca2 * ((WGS84_A * WGS84_A - WGS84_B * WGS84_B) / (WGS84_B * WGS84_B))
    return _let(lambda: {"u": u}, lambda t: _let(
        lambda: {"a": 1 + t.u / 16384 * (4096 + t.u * (-768 + t.u * (320 - 175 * t.u))),
                 "b": t.u / 1024 * (256 + t.u * (-128 + t.u * (74 - 47 * t.u)))}, last))


def significant(x: Column, digits: int = 8) -> Column:
    """A number of zero or more, rounded to so many significant digits."""
    return F.when(x > 0, _let(lambda: {"x": x, "scale": F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(x)))},
                              lambda t: F.rint(t.x * t.scale) / t.scale)).otherwise(x)


def vincenty_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Inverse Vincenty distance in metres, 8 significant digits, by a fold over
    a literal array of rounds; settled pairs pass the rest untouched. Coincident
    points give 0, pairs that do not settle NaN, nulls null."""
    def reduced(lat: Column) -> Column:
        return F.atan((1 - WGS84_F) * F.tan(F.radians(lat)))

    def ends(t: Column) -> Column:
        return _let(lambda: {"l": t.l, "su1": F.sin(t.u1), "cu1": F.cos(t.u1), "su2": F.sin(t.u2), "cu2": F.cos(t.u2)}, solve)

    def solve(p: Column) -> Column:
        def again(s: Column, _: Column) -> Column:
            new = _let(lambda: {"lam": _sphere(p, s.lam, lambda q: _next(p, q))}, lambda n: F.struct(
                n.lam.alias("lam"), (F.abs(n.lam - s.lam) <= CLOSE).alias("done")))
            return F.when(s.done, s).otherwise(new)
        start = F.struct(p.l.alias("lam"), F.lit(False).alias("done"))

        def block(s: Column, _: Column) -> Column:
            return F.when(s.done, s).otherwise(F.aggregate(F.array(*[F.lit(0)] * BLOCK), s, again))
        return F.aggregate(F.array(*[F.lit(0)] * (ROUNDS // BLOCK)), start, block, lambda s: F.when(
            s.done, significant(_sphere(p, s.lam, _length))).when(s.lam.isNotNull(), F.lit(float("nan"))))

    return _let(lambda: {"l": F.radians(lon2 - lon1), "u1": reduced(lat1), "u2": reduced(lat2)}, ends)
