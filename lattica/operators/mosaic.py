"""Mean mosaics: overlapping sources averaged pixel by pixel, nodata aware.

``mean_long`` works on one row per (source, pixel, band) and is plain SQL;
``mean_blocks`` works on binary windows with NumPy in grouped Arrow tasks, one
output block at a time, so a task's memory is a block and its windows.

The count of a pixel is by pixel, not by band: a source counts if any of its
bands is valid there. A band without a valid value in a counted pixel adds 0.
With ``per_band`` each band has a count of its own.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattica.functions import crs as C
from lattica.functions.scalars import NODATA

#: Pixels of an output block and of an interpolation cell, each way.
BLOCK, CELL = 256, 32


def mean_long(pixels: DataFrame, per_band: bool = False) -> DataFrame:
    """``(pixel_id, row, col, band, value, n)`` from ``(pixel_id, src, row, col, band, value)``; halves round away from zero."""
    good = F.when(F.col("value") != NODATA, 1).otherwise(0)
    seen = good if per_band else F.max(good).over(Window.partitionBy("pixel_id", "src"))
    flagged = pixels.withColumn("_ok", seen).withColumn("_v", F.when(F.col("value") != NODATA, F.col("value")).otherwise(0))
    out = flagged.groupBy("pixel_id", "row", "col", "band").agg(F.sum("_v").alias("s"), F.sum("_ok").alias("n"))
    return out.select("pixel_id", "row", "col", "band", F.when(F.col("n") == 0, NODATA).otherwise(F.round(F.col("s") / F.col("n"))).cast("int").alias("value"), F.col("n").cast("long").alias("n"))


def round_half_away(v: np.ndarray) -> np.ndarray:
    return np.sign(v) * np.floor(np.abs(v) + 0.5)


@dataclass(frozen=True)
class Window_:
    """Pixels of one source: (bands, height, width) int8, row 0 at the south, over native bounds."""

    data: np.ndarray
    bounds: tuple[float, float, float, float]
    crs: str


class Accumulator:
    """Sums by band and counts by pixel of one block."""

    def __init__(self, bands: int, height: int, width: int):
        self.sum = np.zeros((bands, height, width), np.int64)
        self.count = np.zeros((height, width), np.int64)

    def add(self, values: np.ndarray, where: np.ndarray) -> None:
        """``values`` (bands, pixels) at the places that ``where`` marks."""
        good = values != NODATA
        self.sum[:, where] += np.where(good, values, 0)
        self.count[where] += good.any(0)

    def result(self) -> np.ndarray:
        mean = round_half_away(self.sum / np.maximum(self.count, 1))
        return np.where(self.count > 0, mean, NODATA).astype(np.int8)


def inverse_grid(rows: slice, cols: slice, bounds, resolution: float, crs: str, source: Window_) -> tuple[np.ndarray, np.ndarray]:
    """Source row and column, as floats, of each pixel of a block: projected at cell corners, interpolated between."""
    _, h, w = source.data.shape
    west, south, east, north = source.bounds
    step_x, step_y = (east - west) / w, (north - south) / h
    height, width = rows.stop - rows.start, cols.stop - cols.start
    edges = lambda n: np.unique(np.append(np.arange(0, n, CELL), n))
    er, ec = edges(height), edges(width)
    gx = bounds[0] + (cols.start + ec + 0.5) * resolution
    gy = bounds[3] - (rows.start + er + 0.5) * resolution
    x, y = C.points(*np.meshgrid(gx, gy), crs, source.crs)
    at_col, at_row = (x - west) / step_x - 0.5, (y - south) / step_y - 0.5

    def spread(v: np.ndarray) -> np.ndarray:
        r, c = np.arange(height), np.arange(width)
        i, j = np.searchsorted(er, r, "right") - 1, np.searchsorted(ec, c, "right") - 1
        fr, fc = ((r - er[i]) / (er[i + 1] - er[i]))[:, None], ((c - ec[j]) / (ec[j + 1] - ec[j]))[None]
        top = v[i][:, j] * (1 - fc) + v[i][:, j + 1] * fc
        return top * (1 - fr) + (v[i + 1][:, j] * (1 - fc) + v[i + 1][:, j + 1] * fc) * fr

    return spread(at_row), spread(at_col)


def accumulate(acc: Accumulator, sources: list[Window_], rows: slice, cols: slice, bounds, resolution: float, crs: str, clock: list[float] | None = None) -> Accumulator:
    """Add to one block of the output what the sources have for it; ``bounds`` are the whole target's, row 0 at its top. ``clock`` adds up the seconds of projection."""
    box = (bounds[0] + cols.start * resolution, bounds[3] - rows.stop * resolution, bounds[0] + cols.stop * resolution, bounds[3] - rows.start * resolution)
    for source in sources:
        try:
            own = C.bounds_of(source.bounds, source.crs, crs, 1)
        except ValueError:
            continue
        if not (own[0] < box[2] and own[2] > box[0] and own[1] < box[3] and own[3] > box[1]):
            continue
        began = time.perf_counter()
        row, col = inverse_grid(rows, cols, bounds, resolution, crs, source)
        if clock:
            clock[0] += time.perf_counter() - began
        _, h, w = source.data.shape
        with np.errstate(invalid="ignore"):
            r, c = round_half_away(row), round_half_away(col)
            inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
        acc.add(source.data[:, r[inside].astype(int), c[inside].astype(int)].astype(np.int64), inside)
    return acc


def _blocks(shape: tuple[int, int]):
    for r in range(0, shape[0], BLOCK):
        for c in range(0, shape[1], BLOCK):
            yield slice(r, min(r + BLOCK, shape[0])), slice(c, min(c + BLOCK, shape[1]))


def mosaic(sources: list[Window_], bounds, shape: tuple[int, int], resolution: float, crs: str, bands: int, clock: list[float] | None = None) -> np.ndarray:
    """A whole chunk, (1, bands, height, width), block by block; all nodata without sources."""
    out = np.full((1, bands, *shape), NODATA, np.int8)
    for rows, cols in _blocks(shape) if sources else ():
        acc = Accumulator(bands, rows.stop - rows.start, cols.stop - cols.start)
        out[0, :, rows, cols] = accumulate(acc, sources, rows, cols, bounds, resolution, crs, clock).result()
    return out


KEY = ("time_idx", "row_idx", "col_idx")


#: What each chunk's row tells of its making: failed windows, and counts and seconds to be added up.
STATS = "failed array<string>, tiles long, bytes_read long, read_secs double, requests long, request_secs double, header_hits long, reproject_secs double, mosaic_secs double"
_STATS_SCHEMA = [("failed", pa.list_(pa.string())), ("tiles", pa.int64()), ("bytes_read", pa.int64()), ("read_secs", pa.float64()), ("requests", pa.int64()), ("request_secs", pa.float64()), ("header_hits", pa.int64()), ("reproject_secs", pa.float64()), ("mosaic_secs", pa.float64())]
_SMALL = ("tile_id", "crs", "min_x", "min_y", "max_x", "max_y", "bands", "height", "width", "error", "read_secs", "requests", "request_secs", "header_hit")


def _sources(table: pa.Table) -> tuple[list[Window_], dict]:
    """The windows of a group that were read, in order of tiles, over the table's own memory; and what there is to tell of them."""
    rows, data = table.select([c for c in _SMALL if c in table.column_names]).to_pylist(), table["data"]
    order = sorted((i for i, r in enumerate(rows) if data[i].is_valid), key=lambda i: rows[i]["tile_id"])
    windows = [Window_(np.frombuffer(data[i].as_buffer(), np.int8).reshape(r["bands"], r["height"], r["width"]), (r["min_x"], r["min_y"], r["max_x"], r["max_y"]), r["crs"]) for i in order for r in [rows[i]]]
    add = lambda k: sum(r.get(k) or 0 for r in rows)
    told = {"failed": sorted(f"tile {r['tile_id']}: {r['error']}" for r in rows if r.get("error")), "tiles": len(windows), "bytes_read": sum(w.data.nbytes for w in windows)}
    return windows, told | {"read_secs": float(add("read_secs")), "requests": add("requests"), "request_secs": float(add("request_secs")), "header_hits": add("header_hit"), "reproject_secs": 0.0, "mosaic_secs": 0.0}


def _bounds(grid, row_idx: int, col_idx: int) -> tuple[float, float, float, float]:
    s, res = grid.chunk_shape, grid.resolution
    west, north = grid.bounds[0] + col_idx * s.width * res, grid.bounds[3] - row_idx * s.height * res
    return west, north - s.height * res, west + s.width * res, north


CHUNK_FIELDS = f"time_idx int, row_idx int, col_idx int, data binary, valid_pixels long, {STATS}"
_CHUNK_SCHEMA = pa.schema([(k, pa.int32()) for k in KEY] + [("data", pa.binary()), ("valid_pixels", pa.int64()), *_STATS_SCHEMA])


def partial_sums(windows: DataFrame, grid) -> DataFrame:
    """Sums and counts of the blocks of chunks, from ``windows`` with a ``part``: a task holds one part of a chunk's windows.

    For chunks whose windows are too many or too large for one task; ``merged`` makes them chunks.
    """
    shape, bands = (grid.chunk_shape.height, grid.chunk_shape.width), grid.num_bands
    schema = pa.schema([(k, pa.int32()) for k in (*KEY, "block")] + [("sums", pa.binary()), ("counts", pa.binary()), *_STATS_SCHEMA])

    def run(table: pa.Table) -> pa.Table:
        sources, told = _sources(table)
        key = {k: table[k][0].as_py() for k in KEY}
        bounds, clock, began, out = _bounds(grid, key["row_idx"], key["col_idx"]), [0.0], time.perf_counter(), []
        for n, (r, c) in enumerate(_blocks(shape)):
            acc = accumulate(Accumulator(bands, r.stop - r.start, c.stop - c.start), sources, r, c, bounds, grid.resolution, grid.crs, clock)
            if acc.count.any():
                out.append(pa.RecordBatch.from_pylist([key | {"block": n, "sums": acc.sum.astype("<i4").tobytes(), "counts": acc.count.astype("<i4").tobytes()}], schema=schema))
        told |= {"reproject_secs": clock[0], "mosaic_secs": time.perf_counter() - began - clock[0]}
        out.append(pa.RecordBatch.from_pylist([key | {"block": -1, "sums": None, "counts": None} | told], schema=schema))
        return pa.Table.from_batches(out)

    return windows.groupBy(*KEY, "part").applyInArrow(run, f"time_idx int, row_idx int, col_idx int, block int, sums binary, counts binary, {STATS}")


def merged(partial: DataFrame, grid) -> DataFrame:
    """Chunks as ``mean_blocks`` makes them, from partial sums: first block by block, then each chunk from its blocks."""
    shape, bands = (grid.chunk_shape.height, grid.chunk_shape.width), grid.num_bands
    places = list(_blocks(shape))
    schema = pa.schema([(k, pa.int32()) for k in (*KEY, "block")] + [("data", pa.binary()), *_STATS_SCHEMA])
    told = [f.name for f in schema][5:]

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1)

    def block(batches):
        at, acc = None, None
        done = lambda: pa.RecordBatch.from_pylist([dict(zip((*KEY, "block"), at)) | {"data": acc.result().tobytes()}], schema=schema)
        for r in rows(batches):
            key = tuple(r[k][0].as_py() for k in (*KEY, "block"))
            if key != at and acc is not None:
                yield done()
                acc = None
            at = key
            if key[3] < 0:
                yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "block"), key)) | {k: r[k][0].as_py() for k in told}], schema=schema)
                continue
            a, b = places[key[3]]
            acc = acc or Accumulator(bands, a.stop - a.start, b.stop - b.start)
            acc.sum += np.frombuffer(r["sums"][0].as_buffer(), "<i4").reshape(acc.sum.shape)
            acc.count += np.frombuffer(r["counts"][0].as_buffer(), "<i4").reshape(acc.count.shape)
        if acc is not None:
            yield done()

    def chunk(batches):
        at, data, notes = None, None, None

        def done():
            out = dict(zip(KEY, at)) | {"data": data.tobytes() if notes["tiles"] else None, "valid_pixels": int((data != NODATA).sum())} | notes
            return pa.RecordBatch.from_pylist([out], schema=_CHUNK_SCHEMA)

        for r in rows(batches):
            key = tuple(r[k][0].as_py() for k in KEY)
            if key != at:
                if at is not None:
                    yield done()
                at, data, notes = key, np.full((bands, *shape), NODATA, np.int8), {k: [] if k == "failed" else 0 for k in told}
            n = r["block"][0].as_py()
            if n < 0:
                notes = {k: v + r[k][0].as_py() for k, v in notes.items()}
            else:
                a, b = places[n]
                data[:, a, b] = np.frombuffer(r["data"][0].as_buffer(), np.int8).reshape(bands, a.stop - a.start, b.stop - b.start)
        if at is not None:
            yield done()

    fields = f"time_idx int, row_idx int, col_idx int, block int, data binary, {STATS}"
    whole = partial.repartition(*KEY, "block").sortWithinPartitions(*KEY, "block").mapInArrow(block, fields)
    return whole.repartition(*KEY).sortWithinPartitions(*KEY, "block").mapInArrow(chunk, CHUNK_FIELDS)


def mean_blocks(windows: DataFrame, grid) -> DataFrame:
    """``(time_idx, row_idx, col_idx, data, valid_pixels)`` and ``STATS``: chunks from windows.

    ``windows(time_idx, row_idx, col_idx, tile_id, crs, min_x, min_y, max_x, max_y, bands, height, width, data, error)``
    has the pixels of a tile that a chunk needs, row 0 at the south; a chunk of which no window was read has no data.
    """
    shape, bands = (grid.chunk_shape.height, grid.chunk_shape.width), grid.num_bands

    def run(table: pa.Table) -> pa.Table:
        sources, told = _sources(table)
        key, clock, began = {k: table[k][0].as_py() for k in KEY}, [0.0], time.perf_counter()
        data = mosaic(sources, _bounds(grid, key["row_idx"], key["col_idx"]), shape, grid.resolution, grid.crs, bands, clock) if sources else None
        told |= {"reproject_secs": clock[0], "mosaic_secs": time.perf_counter() - began - clock[0]}
        return pa.Table.from_pylist([key | {"data": None if data is None else data.tobytes(), "valid_pixels": 0 if data is None else int((data != NODATA).sum())} | told], schema=_CHUNK_SCHEMA)

    return windows.groupBy(*KEY).applyInArrow(run, CHUNK_FIELDS)
