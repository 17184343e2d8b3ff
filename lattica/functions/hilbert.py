"""Hilbert curve keys as column expressions: one fold over the curve's levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_WORLD = 16


def order_for(rows: int, cols: int) -> int:
    """Levels of a curve that covers a grid."""
    return max(1, (max(rows, cols) - 1).bit_length())


def key(x: Column, y: Column, order: int) -> Column:
    """Distance along the curve of cell (x, y) on a square of ``2 ** order`` cells."""
    long = lambda v: v.cast("long") if isinstance(v, Column) else F.lit(v).cast("long")
    levels = F.array(*[F.lit(1 << k).cast("long") for k in range(order - 1, -1, -1)])
    start = F.struct(long(x).alias("x"), long(y).alias("y"), F.lit(0).cast("long").alias("d"))

    def level(at: Column, k: Column) -> Column:
        in_x, in_y = at["x"].bitwiseAND(k) > 0, at["y"].bitwiseAND(k) > 0
        low_x, low_y = at["x"].bitwiseAND(k - 1), at["y"].bitwiseAND(k - 1)
        quadrant = F.when(in_x & in_y, long(2)).when(in_x, long(3)).when(in_y, long(1)).otherwise(long(0))
        turned_x = F.when(in_y, low_x).when(in_x, k - 1 - low_y).otherwise(low_y)
        turned_y = F.when(in_y, low_y).when(in_x, k - 1 - low_x).otherwise(low_x)
        return F.struct(turned_x.alias("x"), turned_y.alias("y"), (at["d"] + k * k * quadrant).alias("d"))

    return F.aggregate(levels, start, level, lambda at: at["d"])


def world_key(lon: Column, lat: Column) -> Column:
    """Key of a geographic point on a curve of order 16 over the whole globe."""
    cells = 1 << ORDER_WORLD
    cell = lambda v: F.least(F.greatest(v * float(cells), F.lit(0.0)), F.lit(float(cells - 1))).cast("long")
    return key(cell((lon + 180.0) / 360.0), cell((lat + 90.0) / 180.0), ORDER_WORLD)
