"""Tiles and chunks matched in space and time.

The grid is regular, so the spatial join needs no index and no nested loop: a
tile's bounds give a range of rows and columns by arithmetic, the range is
exploded, and each pair is tested exactly. The work is in proportion to the
pairs, and nothing is broadcast that grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import bounds as B
from lattica.functions import crs as C
from lattica.functions import hilbert
from lattica.operators.grid import OutputGrid

CHUNK = ["time_idx", "row_idx", "col_idx"]
GIB = float(1 << 30)
#: Assumptions of the size and time estimates.
COMPRESSION, TARGET_GIB_S = 3.0, 25.0


def _cells(tiles: DataFrame, grid: OutputGrid, margin: int) -> DataFrame:
    """Each tile beside the chunks that its bounds may meet, ``margin`` chunks wider."""
    west, south, east, north = C.bounds(B.geographic(), C.WGS84, grid.crs)
    step_x, step_y = grid.chunk_shape.width * grid.resolution, grid.chunk_shape.height * grid.resolution
    _, _, rows, cols = grid.chunk_counts
    low = lambda v: F.greatest(F.floor(v) - margin, F.lit(0)).cast("int")
    high = lambda v, n: F.least(F.ceil(v) + margin, F.lit(n)).cast("int") - 1
    c0, c1 = low((west - grid.bounds[0]) / step_x), high((east - grid.bounds[0]) / step_x, cols)
    r0, r1 = low((grid.bounds[3] - north) / step_y), high((grid.bounds[3] - south) / step_y, rows)
    span = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    timed = tiles.withColumn("time_idx", grid.time_of(F.col("year"))).filter("time_idx is not null")
    return timed.withColumn("row_idx", F.explode(span(r0, r1))).withColumn("col_idx", F.explode(span(c0, c1)))


def tiles_for_chunks(tiles: DataFrame, grid: OutputGrid) -> DataFrame:
    """Every (chunk, tile) pair of the same year whose bounds touch; with ``footprint``, whose footprint meets the chunk."""
    near = _cells(tiles, grid, 1)
    box = grid.chunk_bounds_wgs84(F.col("row_idx"), F.col("col_idx"))
    out = near.filter(B.touches(B.geographic(), box))
    return out.filter(B.quad_touches(F.col("footprint"), box)) if "footprint" in tiles.columns else out


def chunks_for_tiles(tiles: DataFrame, grid: OutputGrid) -> DataFrame:
    """Every (tile, chunk) pair of the same year that strictly overlaps."""
    near = _cells(tiles, grid, 0)
    own = C.bounds(B.geographic(), C.WGS84, grid.crs)
    return near.filter(B.overlaps(own, grid.chunk_bounds(F.col("row_idx"), F.col("col_idx"))))


def tiles_for_bounds(tiles: DataFrame, bounds) -> DataFrame:
    """Tiles of any year whose bounds touch the given ones; with ``footprint``, whose footprint does."""
    out = tiles.filter(B.touches(B.geographic(), bounds))
    return out.filter(B.quad_touches(F.col("footprint"), bounds)) if "footprint" in tiles.columns else out


def nonempty(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    return chunks.join(pairs.select(*CHUNK), CHUNK, "left_semi")


def pending(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    return chunks.join(completed.select(*CHUNK), CHUNK, "left_anti")


def of_years(chunks: DataFrame, grid: OutputGrid, years) -> DataFrame:
    """Chunks of the years to process; years that the grid lacks are passed over."""
    return chunks.filter(F.col("time_idx").isin([i for y in years if (i := grid.time_idx(y)) is not None]))


def work_list(spark: SparkSession, tiles: DataFrame, grid: OutputGrid, years, completed: DataFrame | None = None) -> DataFrame:
    """Chunks to do, in order: of the years, with data, not yet completed. One lazy plan."""
    out = nonempty(of_years(grid.chunks(spark), grid, years), tiles_for_chunks(tiles, grid))
    return (pending(out, completed) if completed is not None else out).orderBy(*CHUNK)


def tile_order(tiles: DataFrame) -> DataFrame:
    """Tiles along the Hilbert curve of their centres; equal keys by id."""
    return tiles.withColumn("hilbert", hilbert.world_key(*B.centroid(B.geographic()))).orderBy("hilbert", "tile_id")


def publish_order(tiles: DataFrame, grid: OutputGrid, todo: DataFrame) -> DataFrame:
    """Each pending chunk once, with the curve key of the first tile that reaches it and its own within that."""
    keyed = tiles.withColumn("tile_hilbert", hilbert.world_key(*B.centroid(B.geographic())))
    first = chunks_for_tiles(keyed, grid).groupBy(*CHUNK).agg(F.min("tile_hilbert").alias("tile_hilbert"))
    ready = first.join(todo.select(*CHUNK), CHUNK, "left_semi")
    return ready.withColumn("chunk_hilbert", grid.hilbert_key(F.col("row_idx"), F.col("col_idx"))).orderBy("tile_hilbert", "time_idx", "chunk_hilbert", "row_idx", "col_idx")


def coverage(pairs: DataFrame, grid: OutputGrid, tiles: DataFrame) -> DataFrame:
    """One row: chunks in all, with data and empty; most and mean tiles of those with data; tiles."""
    each = pairs.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("n"))
    found = each.agg(F.count(F.lit(1)).alias("chunks_with_data"), F.coalesce(F.max("n"), F.lit(0)).alias("max_tiles_per_chunk"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_tiles_per_chunk"))
    total = grid.chunk_counts[0] * grid.num_spatial_chunks
    counted = tiles.agg(F.count(F.lit(1)).alias("total_input_tiles"))
    # Two aggregates of one row each, put into one row.
    both = found.withColumn("total_input_tiles", F.lit(0).cast("long")).unionByName(counted, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return one.select(F.lit(total).cast("long").alias("total_chunks"), "chunks_with_data", (total - F.col("chunks_with_data")).alias("empty_chunks"), "max_tiles_per_chunk", "avg_tiles_per_chunk", "total_input_tiles")


def coverage_text() -> Column:
    share = F.when(F.col("total_chunks") > 0, F.col("chunks_with_data") / F.col("total_chunks") * 100).otherwise(0.0)
    return F.format_string("Coverage: %d/%d chunks (%.1f%%), max overlap: %d, avg overlap: %.1f, input tiles: %d", "chunks_with_data", "total_chunks", share, "max_tiles_per_chunk", "avg_tiles_per_chunk", "total_input_tiles")


def estimate_columns(grid: OutputGrid) -> dict[str, Column]:
    """Bytes to read and write, and seconds at the target rate, from the columns of ``coverage``."""
    s = grid.chunk_shape
    size = s.time * s.embedding * s.height * s.width
    read = F.floor(F.col("chunks_with_data") * F.col("avg_tiles_per_chunk") * size + F.lit(1e-6)).cast("long")
    write = F.col("chunks_with_data") * F.lit(size).cast("long")
    return {"chunk_bytes": F.lit(size).cast("long"), "input_bytes": read, "output_bytes": write, "compressed_gib": F.round(write / GIB / COMPRESSION, 6), "seconds": F.round(read / (TARGET_GIB_S * GIB), 6)}


def estimates(covered: DataFrame, grid: OutputGrid) -> DataFrame:
    return covered.select(*[v.alias(k) for k, v in estimate_columns(grid).items()])
