"""Catalogue rows as a stream: chunks that new tiles touch, and mosaics of each micro-batch.

An extension: batch runs don't need it. State is the chunk keys that were seen
within the watermark; each micro-batch is an ordinary run over its tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators import catalog, lookup
from lattica.operators.grid import OutputGrid


def tile_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files of a folder, in the catalogue's schema."""
    return catalog.mapped(spark.readStream.schema(schema).parquet(path))


def touched_chunks(tiles: DataFrame, grid: OutputGrid) -> DataFrame:
    """Each chunk once, when a first tile reaches it."""
    return lookup.chunks_for_tiles(tiles, grid).select(*lookup.CHUNK).dropDuplicates(lookup.CHUNK)


def tile_rates(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tiles by event-time window, closed by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("tiles"))


def mosaic_each_batch(tiles: DataFrame, settings, checkpoint: str):
    """A started query that mosaics each micro-batch's tiles; chunks already done stay."""
    from lattica.plans import run

    def one(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            run.run(batch.sparkSession, settings, batch)

    return tiles.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
