"""Reprojection of one tile on an adaptive grid, in NumPy.

Blocks of the target start coarse; in each round the centres of all blocks
are projected at once, and those whose interpolated centre is off by more than
``MAX_ERROR`` source pixels are quartered. Inside a block coordinates are
bilinear. A block with a corner that can't be projected stays nodata.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lattica.functions import crs as C
from lattica.functions.scalars import NODATA
from lattica.operators.mosaic import round_half_away

FIRST_BLOCK, LEAST_BLOCK, MAX_ERROR = 128, 16, 0.75


@dataclass(frozen=True)
class Target:
    crs: str
    bounds: tuple[float, float, float, float]
    resolution: float
    shape: tuple[int, int]


def blocks(target: Target, source_crs: str, pixel: tuple[float, float]) -> np.ndarray:
    """Rows (x0, y0, x1, y1, four corners' x, four corners' y), corners top left, top right, bottom left, bottom right, in the source's system."""
    height, width = target.shape

    def project(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return C.points(target.bounds[0] + (x + 0.5) * target.resolution, target.bounds[3] - (y + 0.5) * target.resolution, target.crs, source_crs)

    xs, ys = np.meshgrid(np.arange(0, width, FIRST_BLOCK), np.arange(0, height, FIRST_BLOCK))
    todo = np.stack([xs.ravel(), ys.ravel(), np.minimum(xs + FIRST_BLOCK, width).ravel(), np.minimum(ys + FIRST_BLOCK, height).ravel()], 1)
    done = []
    while len(todo):
        x0, y0, x1, y1 = todo.T
        cx, cy = project(np.stack([x0, x1, x0, x1], 1), np.stack([y0, y0, y1, y1], 1))
        mx, my = (x0 + x1) // 2, (y0 + y1) // 2
        px, py = project(mx, my)
        with np.errstate(invalid="ignore"):
            error = np.maximum(np.abs(px - cx.mean(1)) / pixel[0], np.abs(py - cy.mean(1)) / pixel[1])
            split = np.isfinite(cx).all(1) & np.isfinite(cy).all(1) & (np.minimum(x1 - x0, y1 - y0) > LEAST_BLOCK) & (error > MAX_ERROR)
        done.append(np.concatenate([todo[~split], cx[~split], cy[~split]], 1))
        a, b, c, d, mx, my = (v[split] for v in (x0, y0, x1, y1, mx, my))
        todo = np.concatenate([np.stack(q, 1) for q in ((a, b, mx, my), (mx, b, c, my), (a, my, mx, d), (mx, my, c, d))])
    return np.concatenate(done) if done else np.zeros((0, 12))


def reproject(data: np.ndarray, source_crs: str, source_bounds, target: Target) -> np.ndarray:
    """``data`` (bands, height, width), row 0 at the south, onto the target, row 0 at the north."""
    bands, h, w = data.shape
    west, south, east, north = source_bounds
    px, py = (east - west) / w, (north - south) / h
    out = np.full((bands, *target.shape), NODATA, np.int8)
    for x0, y0, x1, y1, *corners in blocks(target, source_crs, (px, py)):
        cx, cy = np.array(corners[:4]).reshape(2, 2), np.array(corners[4:]).reshape(2, 2)
        if not (np.isfinite(cx).all() and np.isfinite(cy).all()):
            continue
        rows, cols = np.arange(int(y0), int(y1)), np.arange(int(x0), int(x1))
        fr, fc = ((rows - y0) / (y1 - y0))[:, None], ((cols - x0) / (x1 - x0))[None]
        spread = lambda v: (v[0, 0] * (1 - fc) + v[0, 1] * fc) * (1 - fr) + (v[1, 0] * (1 - fc) + v[1, 1] * fc) * fr
        c, r = round_half_away((spread(cx) - west) / px - 0.5).astype(int), round_half_away((spread(cy) - south) / py - 0.5).astype(int)
        inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
        at_r, at_c = np.nonzero(inside)
        out[:, rows[at_r], cols[at_c]] = data[:, r[inside], c[inside]]
    return out


def reproject_tiles(windows: DataFrame, target: Target) -> DataFrame:
    """``(tile_id, data, valid_pixels)`` from rows ``(tile_id, crs, min_x, min_y, max_x, max_y, bands, height, width, data)``."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["data"], np.int8).reshape(r["bands"], r["height"], r["width"])
                made = reproject(data, r["crs"], (r["min_x"], r["min_y"], r["max_x"], r["max_y"]), target)
                yield pa.RecordBatch.from_arrays([pa.array([r["tile_id"]]), pa.array([made.tobytes()], pa.binary()), pa.array([int((made != NODATA).sum())], pa.int64())], ["tile_id", "data", "valid_pixels"])

    return windows.select("tile_id", "crs", "min_x", "min_y", "max_x", "max_y", "bands", "height", "width", "data").mapInArrow(run, "tile_id string, data binary, valid_pixels long")
