"""The output grid: chunks of pixels in one coordinate system, by year.

The grid's description is a handful of numbers on the driver; chunks, their
bounds and coordinates are DataFrames made from ``range`` and literals. Row 0
is at the top; the grid grows north and east to whole chunks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import crs as C
from lattica.functions import hilbert

DENSIFY = 10
DEFAULT_YEAR = 2024


@dataclass(frozen=True)
class ChunkShape:
    time: int = 1
    embedding: int = 64
    height: int = 256
    width: int = 256


@dataclass(frozen=True)
class OutputGrid:
    bounds: tuple[float, float, float, float]
    crs: str
    resolution: float
    years: tuple[int, ...]
    num_bands: int
    height: int
    width: int
    chunk_shape: ChunkShape = field(default_factory=ChunkShape)

    @classmethod
    def over(cls, bounds_wgs84, crs: str, resolution: float, years, num_bands: int = 64, chunk_shape: ChunkShape = ChunkShape()) -> OutputGrid:
        """A grid that covers geographic bounds, of whole chunks from its south-west corner."""
        west, south, east, north = C.bounds_of(bounds_wgs84, C.WGS84, crs, DENSIFY)
        whole = lambda extent, size: math.ceil(math.ceil(extent / resolution) / size) * size
        width, height = whole(east - west, chunk_shape.width), whole(north - south, chunk_shape.height)
        return cls((west, south, west + width * resolution, south + height * resolution), crs, resolution, tuple(sorted(years)), num_bands, height, width, chunk_shape)

    # Sizes.
    @property
    def chunk_counts(self) -> tuple[int, int, int, int]:
        """Chunks by time, band, row and column."""
        s = self.chunk_shape
        return -(-len(self.years) // s.time), -(-self.num_bands // s.embedding), -(-self.height // s.height), -(-self.width // s.width)

    @property
    def array_shape(self) -> tuple[int, int, int, int]:
        return len(self.years), self.num_bands, self.height, self.width

    @property
    def num_chunks(self) -> int:
        return math.prod(self.chunk_counts)

    @property
    def num_spatial_chunks(self) -> int:
        return self.chunk_counts[2] * self.chunk_counts[3]

    @property
    def start_year(self) -> int:
        return self.years[0] if self.years else DEFAULT_YEAR

    @property
    def hilbert_order(self) -> int:
        return hilbert.order_for(*self.chunk_counts[2:])

    def time_idx(self, year: int) -> int | None:
        return self.years.index(year) if year in self.years else None

    # Columns.
    def year_of(self, time_idx: Column) -> Column:
        """The year of a time index; beyond the list it counts on from the first."""
        listed = F.get(F.array(*map(F.lit, self.years)), time_idx) if self.years else F.lit(None).cast("int")
        return F.coalesce(listed, (F.lit(self.start_year) + time_idx).cast("int"))

    def time_of(self, year: Column) -> Column:
        """The time index of a year, or null."""
        return F.nullif(F.array_position(F.array(*map(F.lit, self.years)), year).cast("int"), F.lit(0)) - 1 if self.years else F.lit(None).cast("int")

    def chunk_bounds(self, row_idx: Column, col_idx: Column) -> tuple[Column, ...]:
        """Bounds in the grid's system, cut at the grid's own."""
        step_x, step_y = self.chunk_shape.width * self.resolution, self.chunk_shape.height * self.resolution
        west, top = self.bounds[0] + col_idx * step_x, self.bounds[3] - row_idx * step_y
        return west, F.greatest(top - step_y, F.lit(self.bounds[1])), F.least(west + step_x, F.lit(self.bounds[2])), top

    def chunk_bounds_wgs84(self, row_idx: Column, col_idx: Column) -> tuple[Column, ...]:
        return C.bounds(self.chunk_bounds(row_idx, col_idx), self.crs, C.WGS84)

    def chunk_pixels(self, row_idx: Column, col_idx: Column) -> tuple[Column, ...]:
        """First row and column of a chunk's pixels, and one past the last."""
        h, w = self.chunk_shape.height, self.chunk_shape.width
        return row_idx * h, col_idx * w, F.least((row_idx + 1) * h, F.lit(self.height)), F.least((col_idx + 1) * w, F.lit(self.width))

    def pixel_of(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column of the pixel at a point, clamped to the grid."""
        clamp = lambda v, n: F.least(F.greatest(v.cast("long"), F.lit(0).cast("long")), F.lit(n - 1).cast("long"))
        return clamp((self.bounds[3] - y) / self.resolution, self.height), clamp((x - self.bounds[0]) / self.resolution, self.width)

    def point_of(self, row: Column, column: Column) -> tuple[Column, Column]:
        """Centre of a pixel."""
        return self.bounds[0] + (column + 0.5) * self.resolution, self.bounds[3] - (row + 0.5) * self.resolution

    def hilbert_key(self, row_idx: Column, col_idx: Column) -> Column:
        return hilbert.key(col_idx, row_idx, self.hilbert_order)

    # DataFrames.
    def chunks(self, spark: SparkSession) -> DataFrame:
        """``(time_idx, row_idx, col_idx)`` of every chunk, made where it is needed."""
        times, _, rows, cols = self.chunk_counts
        at = F.col("id")
        return spark.range(times * rows * cols).select(
            F.floor(at / (rows * cols)).cast("int").alias("time_idx"), (F.floor(at / cols) % rows).cast("int").alias("row_idx"), (at % cols).cast("int").alias("col_idx")
        )

    def chunk_order(self, chunks: DataFrame) -> DataFrame:
        """By time, then along the Hilbert curve; equal keys by row and column."""
        return chunks.withColumn("hilbert", self.hilbert_key(F.col("row_idx"), F.col("col_idx"))).orderBy("time_idx", "hilbert", "row_idx", "col_idx")

    def coordinates(self, spark: SparkSession, axis: str) -> DataFrame:
        """``(id, value)`` of the x, y, time or band axis."""
        i = F.col("id")
        if axis == "x":
            return spark.range(self.width).select("id", (self.bounds[0] + (i + 0.5) * self.resolution).alias("value"))
        if axis == "y":
            return spark.range(self.height).select("id", (self.bounds[3] - (i + 0.5) * self.resolution).alias("value"))
        if axis == "time":
            return spark.range(len(self.years)).select("id", self.year_of(i.cast("int")).alias("value"))
        if axis == "band":
            return spark.range(self.num_bands).select("id", F.format_string("A%02d", i).alias("value"))
        raise ValueError(f"no axis {axis!r}: x, y, time or band")
