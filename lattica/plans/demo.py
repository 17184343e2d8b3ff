"""Relations derived from the driver's tables, with the same arithmetic in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars
from lattica.operators.grid import ChunkShape, OutputGrid

BOUNDS = (-170.0, -75.0, 172.0, 77.0)
GRID = OutputGrid.over(BOUNDS, "EPSG:4326", 0.025, range(2020, 2025), 64, ChunkShape(1, 64, 256, 256))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile for each customer, of 5 to 20 degrees."""
    k = F.col("c_custkey")
    lon, lat, size = (k * 7919 % 3400) / 10.0 - 170, (k * 104729 % 1500) / 10.0 - 75, (5 + k % 15) / 10.0
    base = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("T"), k.cast("string")).alias("tile_id"), F.concat(F.lit("s3://tiles/y"), (2020 + k % 5).cast("string"), F.lit("/t"), k.cast("string"), F.lit(".tif")).alias("s3_path"), F.lit("EPSG:4326").alias("crs"),
        lon.alias("min_lon"), lat.alias("min_lat"), (lon + size).alias("max_lon"), (lat + size).alias("max_lat"), (2020 + k % 5).cast("int").alias("year"),
    )
    return base.select(
        "tile_id", "s3_path", "crs", F.col("min_lon").alias("min_x"), F.col("min_lat").alias("min_y"), F.col("max_lon").alias("max_x"), F.col("max_lat").alias("max_y"),
        "min_lon", "min_lat", "max_lon", "max_lat", F.lit(10.0).alias("resolution"), "year",
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four overlapping sources of 64-band pixels from the embeddings, with nodata bands, pixels and sources."""
    v = F.col("vec_id")
    each = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(v, F.posexplode("embedding").alias("band", "x"))
    pixel = F.floor(v / 4)
    value = F.when(((v * 64 + F.col("band")) % 97 == 0) | (v % 31 == 0) | (pixel % 17 == 0), scalars.NODATA).otherwise(scalars.quantise(F.col("x").cast("double")))
    return each.select(pixel.alias("pixel_id"), (v % 4).cast("int").alias("src"), F.floor(pixel / 8).cast("int").alias("row"), (pixel % 8).cast("int").alias("col"), F.col("band").cast("int").alias("band"), value.alias("value"))


def completed(chunks: DataFrame) -> DataFrame:
    """About a fifth of the chunks."""
    return chunks.filter((F.col("row_idx") * 7 + F.col("col_idx") * 13 + F.col("time_idx")) % 5 == 0)


TILES_SQL = """
SELECT 'T' || c_custkey AS tile_id, 's3://tiles/y' || (2020 + c_custkey % 5) || '/t' || c_custkey || '.tif' AS s3_path, 'EPSG:4326' AS crs,
       lon AS min_x, lat AS min_y, lon + size AS max_x, lat + size AS max_y, lon AS min_lon, lat AS min_lat, lon + size AS max_lon, lat + size AS max_lat,
       CAST(10 AS DOUBLE) AS resolution, CAST(2020 + c_custkey % 5 AS INTEGER) AS year
FROM (SELECT c_custkey, (c_custkey * 7919 % 3400) / CAST(10 AS DOUBLE) - 170 AS lon, (c_custkey * 104729 % 1500) / CAST(10 AS DOUBLE) - 75 AS lat, (5 + c_custkey % 15) / CAST(10 AS DOUBLE) AS size FROM customer) k
"""

_ROWS, _COLS = GRID.chunk_counts[2:]
_STEP = 256 * 0.025
CHUNKS_SQL = f"""
SELECT CAST(i // {_ROWS * _COLS} AS INTEGER) AS time_idx, CAST((i // {_COLS}) % {_ROWS} AS INTEGER) AS row_idx, CAST(i % {_COLS} AS INTEGER) AS col_idx FROM range({GRID.chunk_counts[0] * _ROWS * _COLS}) r(i)
"""
_F = lambda v: f"CAST({v!r} AS DOUBLE)"
BOUNDS_SQL = f"""
SELECT time_idx, row_idx, col_idx, x0, greatest(y1 - {_F(_STEP)}, {_F(GRID.bounds[1])}) AS y0, least(x0 + {_F(_STEP)}, {_F(GRID.bounds[2])}) AS x1, y1
FROM (SELECT *, {_F(GRID.bounds[0])} + col_idx * {_F(_STEP)} AS x0, {_F(GRID.bounds[3])} - row_idx * {_F(_STEP)} AS y1 FROM ({CHUNKS_SQL}) c) d
"""
PIXELS_SQL = """
SELECT vec_id // 4 AS pixel_id, CAST(vec_id % 4 AS INTEGER) AS src, CAST(vec_id // 4 // 8 AS INTEGER) AS row, CAST(vec_id // 4 % 8 AS INTEGER) AS col, CAST(band AS INTEGER) AS band,
       CASE WHEN (vec_id * 64 + band) % 97 = 0 OR vec_id % 31 = 0 OR vec_id // 4 % 17 = 0 THEN -128
            ELSE CAST(least(greatest(round(sqrt(abs(x)) * sign(x) * CAST(127.5 AS DOUBLE)), -127), 127) AS INTEGER) END AS value
FROM (SELECT vec_id, b - 1 AS band, CAST(embedding[b] AS DOUBLE) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS b FROM embeddings) u) e
"""
