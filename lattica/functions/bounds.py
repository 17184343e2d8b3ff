"""Bounds, pixel windows, footprints and affines as column expressions.

Bounds are (west, south, east, north) tuples of columns or numbers, and every
function gives columns, so that all of it stays inside code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Bounds = Sequence


def col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(float(v))


def prefixed(prefix: str = "") -> tuple[Column, ...]:
    """The native bounds columns, or those of a prefix."""
    return tuple(F.col(f"{prefix}{c}") for c in ("min_x", "min_y", "max_x", "max_y"))


def geographic() -> tuple[Column, ...]:
    return tuple(map(F.col, ("min_lon", "min_lat", "max_lon", "max_lat")))


def overlaps(a: Bounds, b: Bounds) -> Column:
    """Strict overlap: bounds that only touch don't overlap."""
    a, b = map(col, a), map(col, b)
    (aw, as_, ae, an), (bw, bs, be, bn) = a, b
    return (aw < be) & (ae > bw) & (as_ < bn) & (an > bs)


def touches(a: Bounds, b: Bounds) -> Column:
    """Overlap that includes common edges and corners."""
    a, b = map(col, a), map(col, b)
    (aw, as_, ae, an), (bw, bs, be, bn) = a, b
    return (aw <= be) & (ae >= bw) & (as_ <= bn) & (an >= bs)


def intersection(a: Bounds, b: Bounds) -> Column:
    """The common bounds as a struct, or null without a common area."""
    a, b = list(map(col, a)), list(map(col, b))
    w, s, e, n = F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])
    return F.when((w < e) & (s < n), F.struct(w.alias("min_x"), s.alias("min_y"), e.alias("max_x"), n.alias("max_y")))


def centroid(b: Bounds) -> tuple[Column, Column]:
    b = list(map(col, b))
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def pixel_window(query: Bounds, tile: Bounds, width, height) -> Column:
    """The pixels of a north-up image over ``tile`` that ``query`` covers: struct x, y, width, height; one pixel at least."""
    q, t, w, h = list(map(col, query)), list(map(col, tile)), col(width), col(height)
    share = lambda v, low, high: F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0))
    left, right = share(q[0], t[0], t[2]), share(q[2], t[0], t[2])
    top, bottom = 1 - share(q[3], t[1], t[3]), 1 - share(q[1], t[1], t[3])
    x, y = F.floor(left * w).cast("long"), F.floor(top * h).cast("long")
    one = F.lit(1).cast("long")
    return F.struct(x.alias("x"), y.alias("y"), F.greatest(F.ceil(right * w).cast("long") - x, one).alias("width"), F.greatest(F.ceil(bottom * h).cast("long") - y, one).alias("height"))


def window_bounds(x, y, width, height, tile: Bounds, image_width, image_height) -> Column:
    """Bounds of a pixel window of a north-up image over ``tile``."""
    t = list(map(col, tile))
    px, py = (t[2] - t[0]) / col(image_width), (t[3] - t[1]) / col(image_height)
    x, y, width, height = map(col, (x, y, width, height))
    return F.struct((t[0] + x * px).alias("min_x"), (t[3] - (y + height) * py).alias("min_y"), (t[0] + (x + width) * px).alias("max_x"), (t[3] - y * py).alias("max_y"))


def ring(b: Bounds) -> Column:
    """Closed ring of a rectangle from its south-west corner, counter-clockwise."""
    w, s, e, n = map(col, b)
    corner = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    return F.array(corner(w, s), corner(e, s), corner(e, n), corner(w, n), corner(w, s))


def quad_touches(footprint: Column, rect: Bounds) -> Column:
    """Whether a convex counter-clockwise quadrilateral (a ring of lon, lat) meets a rectangle; touching counts.

    Separating axes: the rectangle's by the quadrilateral's extent, the quadrilateral's by its edges. The inputs
    are named once, in a lambda, as each is used many times.
    """
    sides = [v.alias(k) for k, v in zip("wsen", map(col, rect))]
    return F.exists(F.array(F.struct(footprint.alias("ring"), *sides)), _meets)


def _meets(v: Column) -> Column:
    w, s, e, n = (v[k] for k in "wsen")
    lon = [v["ring"][i]["lon"] for i in range(4)]
    lat = [v["ring"][i]["lat"] for i in range(4)]
    apart = (F.greatest(*lon) < w) | (F.least(*lon) > e) | (F.greatest(*lat) < s) | (F.least(*lat) > n)
    for i in range(4):
        j = (i + 1) % 4
        dx, dy = lon[j] - lon[i], lat[j] - lat[i]
        outside = F.lit(True)
        for x, y in ((w, s), (e, s), (e, n), (w, n)):
            outside &= (dx * (y - lat[i]) - dy * (x - lon[i])) < 0
        apart |= outside
    return ~apart


def affine(matrix: Column) -> Column:
    """A model transformation (16 doubles, row by row) as struct a, b, c, d, e, f; null below eight elements."""
    names = {"a": 0, "b": 1, "c": 3, "d": 4, "e": 5, "f": 7}
    return F.when(F.size(matrix) >= 8, F.struct(*[matrix.getItem(i).alias(k) for k, i in names.items()]))


def world_to_pixel(gt: Column, x, y) -> tuple[Column, Column]:
    """Column and row of a world point; rotation terms are not used."""
    return (col(x) - gt["c"]) / gt["a"], (col(y) - gt["f"]) / gt["e"]


def pixel_to_world(gt: Column, column, row) -> tuple[Column, Column]:
    c, r = col(column), col(row)
    return gt["a"] * c + gt["b"] * r + gt["c"], gt["d"] * c + gt["e"] * r + gt["f"]


def bottom_up(gt: Column) -> Column:
    return gt["e"] > 0
