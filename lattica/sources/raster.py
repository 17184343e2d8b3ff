"""Raster tiles as DataFrames: headers, and the pixel windows that chunks ask for.

Each file's header is read once, each window's pixels once; both run in Arrow
tasks, so files are spread over the cluster. An unreadable file or window is a
row with an ``error``, never a failed job. ``TileSource`` offers the same as a
Spark data source.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lattica.sources import tiff

HEADER_FIELDS = "s3_path string, image_width int, image_height int, bands int, planar boolean, tile_width int, tile_height int, gt struct<a:double,b:double,c:double,d:double,e:double,f:double>, error string"


def _header_row(path: str) -> dict:
    row = dict.fromkeys(["image_width", "image_height", "bands", "planar", "tile_width", "tile_height", "gt", "error"]) | {"s3_path": path}
    try:
        h = tiff.header(tiff.reader(path))
        row |= {"image_width": h.width, "image_height": h.height, "bands": h.bands, "planar": h.planar, "tile_width": h.tile_width, "tile_height": h.tile_height}
        row["gt"] = dict(zip("abcdef", h.affine)) if h.affine else None
        row["error"] = None if h.affine else "no georeference"
    except Exception as e:  # noqa: BLE001 - any fault of a file is data
        row["error"] = f"{type(e).__name__}: {e}"
    return row


def headers(tiles: DataFrame) -> DataFrame:
    """One row for each distinct path."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from pa.Table.from_pylist([_header_row(p) for p in batch.column(0).to_pylist()], schema=_HEADER_SCHEMA).to_batches()

    return tiles.select("s3_path").distinct().mapInArrow(run, HEADER_FIELDS)


_HEADER_SCHEMA = pa.schema(
    [("s3_path", pa.string()), ("image_width", pa.int32()), ("image_height", pa.int32()), ("bands", pa.int32()), ("planar", pa.bool_()), ("tile_width", pa.int32()), ("tile_height", pa.int32()), ("gt", pa.struct([(k, pa.float64()) for k in "abcdef"])), ("error", pa.string())]
)

WINDOW_FIELDS = "time_idx int, row_idx int, col_idx int, part int, tile_id string, crs string, min_x double, min_y double, max_x double, max_y double, bands int, height int, width int, data binary, error string, read_secs double, requests long, request_secs double, header_hit int"


class _Counted:
    """A reader that counts its requests and their time."""

    def __init__(self, read: tiff.Reader):
        self.read, self.requests, self.seconds = read, 0, 0.0

    def __call__(self, offset: int, size: int) -> bytes:
        began = time.perf_counter()
        try:
            return self.read(offset, size)
        finally:
            self.requests, self.seconds = self.requests + 1, self.seconds + time.perf_counter() - began


def read_windows(planned: DataFrame) -> DataFrame:
    """Pixels of planned windows, row 0 at the south; ``planned`` is as ``windows.planned`` makes it, with ``image_width``.

    ``part``, if there is one, is carried along. A file's windows stay together, so that its header is read once a task.
    """
    part = F.col("part") if "part" in planned.columns else F.lit(0)
    asked = planned.select("time_idx", "row_idx", "col_idx", part.cast("int").alias("part"), "tile_id", "crs", "s3_path", (F.col("gt.e") < 0).alias("top_down"), *[F.col(f"window_box.{k}").alias(k) for k in ("min_x", "min_y", "max_x", "max_y")], *[F.col(f"window.{k}").cast("int").alias(a) for k, a in (("x", "x"), ("y", "y"), ("width", "w"), ("height", "h"))])

    def run(batches):
        path, read, head = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                out = {k: r[k] for k in ("time_idx", "row_idx", "col_idx", "part", "tile_id", "crs", "min_x", "min_y", "max_x", "max_y")} | {"bands": None, "height": r["h"], "width": r["w"], "data": None, "error": None}
                began, hit = time.perf_counter(), int(r["s3_path"] == path)
                if not hit:
                    path, read = None, None
                try:
                    if not hit:
                        read = _Counted(tiff.reader(r["s3_path"]))
                        head = tiff.header(read)
                        path = r["s3_path"]
                    data = tiff.window(read, head, r["x"], r["y"], r["w"], r["h"])
                    data = data[:, ::-1] if r["top_down"] else data
                    out |= {"bands": head.bands, "data": np.ascontiguousarray(data).tobytes()}
                except Exception as e:  # noqa: BLE001
                    out["error"] = f"{r['s3_path']}: {type(e).__name__}: {e}"
                out |= {"read_secs": time.perf_counter() - began, "requests": read.requests if read else 0, "request_secs": read.seconds if read else 0.0, "header_hit": hit}
                if read:
                    read.requests, read.seconds = 0, 0.0
                yield pa.RecordBatch.from_pylist([out], schema=_WINDOW_SCHEMA)

    return asked.repartition("s3_path").sortWithinPartitions("s3_path", "y", "x").mapInArrow(run, WINDOW_FIELDS)


_WINDOW_SCHEMA = pa.schema(
    [(k, pa.int32()) for k in ("time_idx", "row_idx", "col_idx", "part")] + [("tile_id", pa.string()), ("crs", pa.string())] + [(k, pa.float64()) for k in ("min_x", "min_y", "max_x", "max_y")] + [(k, pa.int32()) for k in ("bands", "height", "width")]
    + [("data", pa.binary()), ("error", pa.string()), ("read_secs", pa.float64()), ("requests", pa.int64()), ("request_secs", pa.float64()), ("header_hit", pa.int32())]
)


class TileSource(DataSource):
    """``spark.read.format("lattica_tile")``: a file's pixels, a row for each internal row of tiles.

    Options: ``path``; ``x``, ``y``, ``width``, ``height`` for a window.
    """

    @classmethod
    def name(cls) -> str:
        return "lattica_tile"

    def schema(self) -> str:
        return "x int, y int, width int, height int, bands int, data binary"

    def reader(self, schema) -> TileReader:
        return TileReader(dict(self.options))


class _Rows(InputPartition):
    def __init__(self, y: int, height: int):
        self.y, self.height = y, height


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.head = tiff.header(tiff.reader(self.path))
        low = {k.lower(): v for k, v in options.items()}
        self.x, self.y = int(low.get("x", 0)), int(low.get("y", 0))
        self.w, self.h = int(low.get("width", self.head.width - self.x)), int(low.get("height", self.head.height - self.y))

    def partitions(self) -> list[_Rows]:
        step, end = self.head.tile_height, self.y + self.h
        starts = [self.y, *range((self.y // step + 1) * step, end, step)]
        return [_Rows(a, b - a) for a, b in zip(starts, [*starts[1:], end])]

    def read(self, part: _Rows):
        data = tiff.window(tiff.reader(self.path), self.head, self.x, part.y, self.w, part.height)
        yield self.x, part.y, self.w, part.height, self.head.bands, data.tobytes()
