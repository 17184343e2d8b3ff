"""The tile catalogue: Parquet of any naming, mapped to one schema.

Bounds stay flat double columns, so that Parquet statistics prune row groups
and column pruning reads what a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.functions import bounds as B
from lattica.functions import crs as C

# Accepted column names, in order of preference.
ALIASES = {
    "tile_id": ["tile_id", "id", "name", "fid"],
    "s3_path": ["s3_path", "path", "uri", "url", "location"],
    "crs": ["crs", "epsg", "srs"],
    "min_x": ["min_x", "xmin", "left", "utm_west"],
    "min_y": ["min_y", "ymin", "bottom", "utm_south"],
    "max_x": ["max_x", "xmax", "right", "utm_east"],
    "max_y": ["max_y", "ymax", "top", "utm_north"],
    "min_lon": ["min_lon", "lon_min", "west", "wgs84_west"],
    "min_lat": ["min_lat", "lat_min", "south", "wgs84_south"],
    "max_lon": ["max_lon", "lon_max", "east", "wgs84_east"],
    "max_lat": ["max_lat", "lat_max", "north", "wgs84_north"],
    "resolution": ["resolution", "res", "pixel_size"],
    "year": ["year", "date_year"],
}
DEFAULT_RESOLUTION, DEFAULT_YEAR = 10.0, 2024
DOUBLES = ["min_x", "min_y", "max_x", "max_y", "min_lon", "min_lat", "max_lon", "max_lat"]
OPTIONAL = ("resolution", "year")


class CatalogueError(ValueError):
    """The catalogue lacks a column, or one has a type that isn't accepted."""


def resolve(df: DataFrame, logical: str) -> str | None:
    """The first accepted name that the table has; names are case-sensitive."""
    return next((a for a in ALIASES[logical] if a in df.columns), None)


def _typed(df: DataFrame, logical: str) -> Column:
    name = resolve(df, logical)
    if name is None:
        if logical in OPTIONAL:
            return F.lit(DEFAULT_RESOLUTION if logical == "resolution" else DEFAULT_YEAR)
        raise CatalogueError(f"no column for {logical}: one of {', '.join(ALIASES[logical])} is needed")
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if logical == "tile_id":
        if not isinstance(kind, (T.StringType, T.IntegerType, T.LongType)):
            raise CatalogueError(f"{name} must be text or an integer, not {kind.simpleString()}")
        return value.cast("string")
    if logical in ("s3_path", "crs"):
        if not isinstance(kind, T.StringType):
            raise CatalogueError(f"{name} must be text, not {kind.simpleString()}")
        return value
    if logical == "year":
        return F.coalesce(value.cast("int"), F.lit(DEFAULT_YEAR)) if isinstance(kind, (T.IntegerType, T.LongType)) else F.lit(DEFAULT_YEAR)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(value.cast("double"), F.lit(DEFAULT_RESOLUTION)) if logical == "resolution" else value.cast("double")
    if logical == "resolution":
        return F.lit(DEFAULT_RESOLUTION)
    raise CatalogueError(f"{name} must be a float, not {kind.simpleString()}")


def mapped(df: DataFrame) -> DataFrame:
    """``df`` in the catalogue's schema."""
    return df.select(*[_typed(df, k).alias(k) for k in ALIASES])


def load(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue from Parquet at any address that Spark reads."""
    return mapped(spark.read.parquet(path))


def load_bytes(spark: SparkSession, data: bytes) -> DataFrame:
    """A catalogue from the bytes of one Parquet file that the driver holds."""
    import io

    import pyarrow.parquet as pq

    return mapped(spark.createDataFrame(pq.read_table(io.BytesIO(data))))


def checked(tiles: DataFrame) -> DataFrame:
    """``tiles``; a null in a required column ends the query that meets it."""
    required = [c for c in ALIASES if c not in OPTIONAL]
    bad = F.lit(False)
    for c in required:
        bad |= F.col(c).isNull()
    return tiles.filter(F.when(bad, F.raise_error(F.concat(F.lit("null in a required column of tile "), F.coalesce("tile_id", F.lit("?"))))).otherwise(F.lit(True)))


def with_footprint(tiles: DataFrame, codes: list[str]) -> DataFrame:
    """``tiles`` with ``footprint``: the native corners as a closed geographic ring, or the geographic rectangle where that fails."""
    points = F.transform(C.corners(B.prefixed()), lambda c: C.by_code(c["x"], c["y"], F.col("crs"), codes, True))
    failed = lambda c: c.isNull() | F.isnan(c["x"]) | F.isnan(c["y"])
    corner = lambda c: F.struct(c["x"].alias("lon"), c["y"].alias("lat"))
    ring = lambda p: F.when(~F.exists(p, failed), F.transform(F.concat(p, F.slice(p, 1, 1)), corner)).otherwise(B.ring(B.geographic()))
    return tiles.withColumn("footprint", F.transform(F.array(points), ring)[0])


def filtered(tiles: DataFrame, bounds=None, years=None) -> DataFrame:
    """Tiles that strictly overlap geographic bounds, of the given years; no years means all."""
    if bounds is not None:
        tiles = tiles.filter(B.overlaps(B.geographic(), bounds))
    return tiles.filter(F.col("year").isin(list(years))) if years else tiles


def extent(tiles: DataFrame) -> DataFrame:
    """One row of geographic bounds, null without tiles."""
    return tiles.agg(F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"), F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"))


def unique_years(tiles: DataFrame) -> DataFrame:
    return tiles.select("year").distinct().orderBy("year")
