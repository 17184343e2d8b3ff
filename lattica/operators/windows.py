"""Pixel windows: which pixels of a tile a chunk needs, as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions import bounds as B
from lattica.functions import crs as C
from lattica.operators.grid import OutputGrid


def planned(pairs: DataFrame, grid: OutputGrid, codes: list[str], image_width=None, image_height=None, compat: bool = False) -> DataFrame:
    """``pairs`` with ``window`` and ``window_box``, the bounds of its pixels; pairs that don't overlap are left out.

    ``pairs`` are (chunk, tile) rows with the tile's ``gt``; ``codes`` the
    systems that occur. Rows count from the affine's origin, whatever its
    direction. Windows end at the image's edge where its size is known. With
    ``compat`` the bounds are the plain intersection, else those of the pixels.
    """
    box = grid.chunk_bounds_wgs84(F.col("row_idx"), F.col("col_idx"))
    asked = pairs.withColumn("_native", C.bounds_by_code(box, F.col("crs"), codes))
    cut = B.intersection([F.col(f"_native.{k}") for k in ("min_x", "min_y", "max_x", "max_y")], B.prefixed())
    asked = asked.withColumn("_cut", cut).filter("_cut is not null and gt is not null")
    gt = F.col("gt")
    c0, r0 = B.world_to_pixel(gt, F.col("_cut.min_x"), F.col("_cut.min_y"))
    c1, r1 = B.world_to_pixel(gt, F.col("_cut.max_x"), F.col("_cut.max_y"))
    # Edges that fall on a pixel's edge up to rounding don't open another pixel.
    low = lambda v: F.greatest(F.floor(F.round(v, 6)), F.lit(0)).cast("long")
    high = lambda v, n: F.least(F.greatest(F.ceil(F.round(v, 6)), F.lit(0)), F.lit(n) if n is not None and not hasattr(n, "alias") else n if n is not None else F.lit(1 << 40)).cast("long")
    x, y = low(F.least(c0, c1)), low(F.least(r0, r1))
    one = F.lit(1).cast("long")
    window = F.struct(x.alias("x"), y.alias("y"), F.greatest(high(F.greatest(c0, c1), image_width) - x, one).alias("width"), F.greatest(high(F.greatest(r0, r1), image_height) - y, one).alias("height"))
    asked = asked.withColumn("window", window)
    if compat:
        return asked.withColumn("window_box", F.col("_cut")).drop("_native", "_cut")
    wx0, wy0 = B.pixel_to_world(gt, F.col("window.x").cast("double"), F.col("window.y").cast("double"))
    wx1, wy1 = B.pixel_to_world(gt, (F.col("window.x") + F.col("window.width")).cast("double"), (F.col("window.y") + F.col("window.height")).cast("double"))
    snapped = F.struct(F.least(wx0, wx1).alias("min_x"), F.least(wy0, wy1).alias("min_y"), F.greatest(wx0, wx1).alias("max_x"), F.greatest(wy0, wy1).alias("max_y"))
    return asked.withColumn("window_box", snapped).drop("_native", "_cut")
