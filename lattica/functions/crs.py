"""Coordinate reference systems in closed form, once for columns and once for arrays.

Supported: EPSG:4326 (longitude, latitude), EPSG:6933 (cylindrical equal area)
and the UTM zones EPSG:32601-32660 and EPSG:32701-32760. Formulas are written
once, over a small set of math functions, and evaluated either as Spark column
expressions (planning, joins) or with NumPy (pixel kernels). x is always
longitude or easting, y latitude or northing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

WGS84 = "EPSG:4326"
EASE2 = "EPSG:6933"

# The WGS 84 ellipsoid and the UTM projection.
A, FLATTENING = 6378137.0, 1 / 298.257223563
K0, FALSE_EAST, FALSE_NORTH = 0.9996, 500000.0, 10000000.0


class UnsupportedCrs(ValueError):
    """No closed form is known for this code."""


class _Columns:
    """Math functions on columns."""

    sin, cos, tan, asin, atan2 = F.sin, F.cos, F.tan, F.asin, F.atan2
    sinh, cosh, log, sqrt = F.sinh, F.cosh, F.log, F.sqrt

    atanh = F.atanh

    @staticmethod
    def bind(p: Column, q: Column, then) -> tuple[Column, Column]:
        """``then(p, q)`` with both named once, so that expressions don't double with each use."""

        def named(at: Column) -> Column:
            x, y = then(at["p"], at["q"])
            return F.struct(x.alias("p"), y.alias("q"))

        out = F.transform(F.array(F.struct(p.alias("p"), q.alias("q"))), named).getItem(0)
        return out["p"], out["q"]


class _Arrays:
    """The same on NumPy arrays."""

    sin, cos, tan, asin, atan2 = np.sin, np.cos, np.tan, np.arcsin, np.arctan2
    sinh, cosh, log, sqrt, atanh = np.sinh, np.cosh, np.log, np.sqrt, np.arctanh

    @staticmethod
    def bind(p, q, then):
        return then(p, q)


def _series(n: float) -> tuple[float, list[float], list[float], list[float]]:
    """Krueger's rectifying radius and series, to the fourth power of the third flattening."""
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
    return radius, alpha, beta, delta


_N = FLATTENING / (2 - FLATTENING)
_RADIUS, _ALPHA, _BETA, _DELTA = _series(_N)
_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)
_RAD = math.pi / 180


@dataclass(frozen=True)
class Utm:
    """Zone and hemisphere are numbers, or columns: one formula for all zones."""

    zone: int | Column
    south: bool | Column

    @property
    def north_at(self):
        return F.when(self.south, FALSE_NORTH).otherwise(0.0) if isinstance(self.south, Column) else FALSE_NORTH if self.south else 0.0

    def forward(self, m, lon, lat):
        two = 2 * math.sqrt(_N) / (1 + _N)

        def conformal(sine, turn):
            return m.bind(m.sinh(m.atanh(sine) - m.atanh(sine * two) * two), turn, lambda t, turn: (m.atan2(t, m.cos(turn)), m.atanh(m.sin(turn) / m.sqrt(t * t + 1))))

        def rectified(xi, eta):
            east, north = eta, xi
            for j, a in enumerate(_ALPHA, 1):
                east = east + m.cos(xi * (2 * j)) * m.sinh(eta * (2 * j)) * a
                north = north + m.sin(xi * (2 * j)) * m.cosh(eta * (2 * j)) * a
            return east * (K0 * _RADIUS) + FALSE_EAST, north * (K0 * _RADIUS) + self.north_at

        sphere = m.bind(m.sin(lat * _RAD), lon * _RAD - (self.zone * 6 - 183) * _RAD, conformal)
        return m.bind(*sphere, rectified)

    def inverse(self, m, x, y):
        def unrectified(xi, eta):
            xi_, eta_ = xi, eta
            for j, b in enumerate(_BETA, 1):
                xi_ = xi_ - m.sin(xi * (2 * j)) * m.cosh(eta * (2 * j)) * b
                eta_ = eta_ - m.cos(xi * (2 * j)) * m.sinh(eta * (2 * j)) * b
            return m.bind(xi_, eta_, lambda u, v: (m.asin(m.sin(u) / m.cosh(v)), m.atan2(m.sinh(v), m.cos(u))))

        def geodetic(chi, turn):
            lat = chi
            for j, d in enumerate(_DELTA, 1):
                lat = lat + m.sin(chi * (2 * j)) * d
            return turn / _RAD + (self.zone * 6 - 183), lat / _RAD

        plane = m.bind((y - self.north_at) / (K0 * _RADIUS), (x - FALSE_EAST) / (K0 * _RADIUS), unrectified)
        return m.bind(*plane, geodetic)


@dataclass(frozen=True)
class EqualArea:
    """Lambert's cylindrical equal-area projection, true at 30 degrees."""

    scale: float = math.cos(30 * _RAD) / math.sqrt(1 - _E2 * math.sin(30 * _RAD) ** 2)

    def forward(self, m, lon, lat):
        s = m.sin(lat * _RAD)
        q = (s / (1 - s * s * _E2) - m.log((1 - s * _E) / (1 + s * _E)) / (2 * _E)) * (1 - _E2)
        return lon * (_RAD * A * self.scale), q * (A / (2 * self.scale))

    def inverse(self, m, x, y):
        pole = (1 - _E2) * (1 / (1 - _E2) - math.log((1 - _E) / (1 + _E)) / (2 * _E))
        b = m.asin(y * (2 * self.scale / (A * pole)))
        lat = b + m.sin(b * 2) * (_E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040) + m.sin(b * 4) * (23 * _E2**2 / 360 + 251 * _E2**3 / 3780) + m.sin(b * 6) * (761 * _E2**3 / 45360)
        return x / (_RAD * A * self.scale), lat / _RAD


@dataclass(frozen=True)
class Geographic:
    def forward(self, m, lon, lat):
        return lon, lat

    inverse = forward


@lru_cache(None)
def projection(code: str):
    """The projection of an EPSG code."""
    kind, _, digits = code.upper().partition(":")
    number = int(digits) if kind == "EPSG" and digits.isdigit() else 0
    if number == 4326:
        return Geographic()
    if number == 6933:
        return EqualArea()
    if number // 100 in (326, 327) and 1 <= number % 100 <= 60:
        return Utm(number % 100, number // 100 == 327)
    raise UnsupportedCrs(f"no closed form for {code!r}; supported are EPSG:4326, EPSG:6933 and the UTM zones EPSG:326zz, EPSG:327zz")


def definition(code: str) -> str | None:
    """The projection's definition string, or None for an unknown code."""
    try:
        p = projection(code)
    except UnsupportedCrs:
        return None
    if isinstance(p, Utm):
        return f"+proj=utm +zone={p.zone}{' +south' if p.south else ''} +datum=WGS84 +units=m +no_defs"
    return "+proj=cea +lon_0=0 +lat_ts=30 +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs" if isinstance(p, EqualArea) else "+proj=longlat +datum=WGS84 +no_defs"


def _point(m, x, y, source: str, target: str):
    if source == target:
        return x, y
    return projection(target).forward(m, *projection(source).inverse(m, x, y))


def point(x: Column, y: Column, source: str, target: str) -> tuple[Column, Column]:
    return _point(_Columns, x, y, source, target)


def points(x: np.ndarray, y: np.ndarray, source: str, target: str) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of points; what can't be projected becomes NaN."""
    with np.errstate(all="ignore"):
        return _point(_Arrays, np.asarray(x, float), np.asarray(y, float), source, target)


def bounds(b, source: str, target: str) -> tuple[Column, Column, Column, Column]:
    """Bounds of the four transformed corners, as columns."""
    if source == target:
        return tuple(b)
    corners = [point(x, y, source, target) for x, y in ((b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]))]
    xs, ys = zip(*corners)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def by_code(x: Column, y: Column, code: Column, codes: list[str], inverse: bool) -> Column:
    """Struct ``x, y`` of a point in the system of each row's ``code`` (``inverse``: from it) from geographic coordinates; null for a code without a closed form.

    ``codes`` are those that occur. They decide which of the three kinds of
    formula the plan holds, each once: zones are a column, so the plan is the
    same for one zone and for all.
    """
    n = F.when(F.upper(code).rlike("^EPSG:[0-9]{4,5}$"), F.substring_index(code, ":", -1).cast("int"))
    kinds = {type(projection(c)) for c in codes if definition(c)}
    forms = {Geographic: (n == 4326, Geographic()), EqualArea: (n == 6933, EqualArea()), Utm: (F.floor(n / 100).isin(326, 327) & (n % 100).between(1, 60), Utm(n % 100, F.floor(n / 100) == 327))}
    out = F.lit(None).cast("struct<x:double,y:double>")
    for kind, (test, form) in forms.items():
        if kind in kinds:
            px, py = (form.inverse if inverse else form.forward)(_Columns, x, y)
            out = F.when(test, F.struct(px.alias("x"), py.alias("y"))).otherwise(out)
    return out


def corners(b) -> Column:
    """The corners of bounds, as an array of struct ``x, y``, counter-clockwise from the south-west."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]))])


def bounds_by_code(b, code: Column, codes: list[str]) -> Column:
    """Bounds of the corners of geographic bounds in the system of each row's ``code``, as a struct."""
    points = F.transform(corners(b), lambda c: by_code(c["x"], c["y"], code, codes, False))
    edge = lambda p, pick, axis: pick(F.transform(p, lambda c: c[axis]))
    named = F.transform(F.array(points), lambda p: F.struct(edge(p, F.array_min, "x").alias("min_x"), edge(p, F.array_min, "y").alias("min_y"), edge(p, F.array_max, "x").alias("max_x"), edge(p, F.array_max, "y").alias("max_y")))
    return named[0]


def bounds_of(b, source: str, target: str, samples: int | None = None) -> tuple[float, float, float, float]:
    """Bounds of numbers: by their corners, or with ``samples`` steps along each edge; failing points are left out when sampled."""
    if source == target:
        return tuple(map(float, b))
    t = np.linspace(0, 1, (samples or 1) + 1)
    x, y = b[0] + t * (b[2] - b[0]), b[1] + t * (b[3] - b[1])
    px, py = points(np.concatenate([x, x, np.full_like(t, b[0]), np.full_like(t, b[2])]), np.concatenate([np.full_like(t, b[1]), np.full_like(t, b[3]), y, y]), source, target)
    good = np.isfinite(px) & np.isfinite(py)
    if not good.any() or (samples is None and not good.all()):
        raise ValueError(f"bounds {tuple(b)} can't be transformed from {source} to {target}")
    return float(px[good].min()), float(py[good].min()), float(px[good].max()), float(py[good].max())
