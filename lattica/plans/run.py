"""Whole runs: the mosaic pipeline and the analysis of what it would do.

From catalogue to work list a run is one lazy plan. Chunks are then done in
batches along the time, row and column order; each batch is one plan from
windows to written chunks, and its chunks are checkpointed when it ends.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import crs as C
from lattica.operators import catalog, lookup, mosaic, windows
from lattica.operators.grid import OutputGrid
from lattica.plans.checkpoint import CheckpointFile
from lattica.plans.metrics import Reporter, Snapshot
from lattica.sources import raster, zarr
from lattica.sources.settings import Settings

log = logging.getLogger(__name__)
CHUNK = lookup.CHUNK
#: Chunks of one batch, the unit of checkpointing; a run has at most so many batches.
BATCH_CHUNKS, MOST_BATCHES = 4096, 64
#: Windows of a chunk that one task holds, and bytes of their pixels.
PART_WINDOWS, PART_BYTES = 64, 256 << 20


class NothingToDo(ValueError):
    """No tile is left after filtering."""


@dataclass
class Stats:
    total: int
    processed: int
    skipped: int
    failures: int
    metrics: Snapshot

    def __str__(self) -> str:
        return f"Total: {self.total}, Processed: {self.processed}, Skipped: {self.skipped}, Failures: {self.failures}"


@dataclass
class Bound:
    """A run's tiles, grid and years, found out on the driver from small aggregates."""

    tiles: DataFrame
    grid: OutputGrid
    years: list[int]
    codes: list[str]


def bind(spark: SparkSession, settings: Settings, tiles: DataFrame | None = None) -> Bound:
    """Years are the output's, else the filter's, else the catalogue's; a grid covers the filter's bounds, else the tiles'."""
    every = catalog.checked(catalog.load(spark, settings.input.index_path) if tiles is None else catalog.mapped(tiles))
    f, o = settings.filter, settings.output
    kept = catalog.filtered(every, f.bounds, f.years)
    box = catalog.extent(kept).first()
    if box["min_lon"] is None:
        raise NothingToDo("no tile is within the filter")
    found = [r["year"] for r in catalog.unique_years(kept).collect()]
    codes = sorted(r["crs"] for r in kept.select("crs").distinct().collect())
    for code in codes:
        C.projection(code)
    listed = sorted(o.years or f.years or found)
    process = [y for y in (f.years or found) if y in listed]
    grid = OutputGrid.over(f.bounds or tuple(box), o.crs, o.resolution, listed, o.num_bands, o.chunk_shape)
    return Bound(catalog.with_footprint(kept, codes), grid, process, codes)


def analyze(spark: SparkSession, settings: Settings, tiles: DataFrame | None = None) -> DataFrame:
    """One row: coverage and size estimates, with the coverage line."""
    b = bind(spark, settings, tiles)
    covered = lookup.coverage(lookup.tiles_for_chunks(b.tiles, b.grid), b.grid, b.tiles)
    return covered.select("*", lookup.coverage_text().alias("line"), *[v.alias(k) for k, v in lookup.estimate_columns(b.grid).items()])


def chunks_of(b: Bound, todo: DataFrame, heads: DataFrame, part_windows: int = PART_WINDOWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """The chunks of ``todo``, each a row, from the windows that could be read; the others are named in ``failed``.

    A chunk that more than ``part_windows`` windows or ``part_bytes`` of pixels cover is
    summed up in parts of so many, each in a task of its own.
    """
    pairs = lookup.tiles_for_chunks(b.tiles, b.grid).join(todo.select(*CHUNK), CHUNK, "left_semi")
    asked = pairs.join(heads.select("s3_path", "gt", "image_width", "image_height", F.col("bands").alias("image_bands"), F.col("error").alias("fault")), "s3_path", "left")
    planned = windows.planned(asked.filter("gt is not null"), b.grid, b.codes, F.col("image_width"), F.col("image_height"))
    size = F.col("window.width") * F.col("window.height") * F.col("image_bands")
    parts = planned.groupBy(*CHUNK).agg(F.greatest(F.ceil(F.count(F.lit(1)) / part_windows), F.ceil(F.sum(size) / part_bytes), F.lit(1)).cast("int").alias("parts"))
    parts = todo.select(*CHUNK).join(parts, CHUNK, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    whole, many = parts.filter("parts = 1"), parts.filter("parts > 1")
    # A file without a header fails every window; a chunk that its tiles only touch has no window and is done with nothing.
    lost = asked.filter("gt is null").select(*CHUNK, F.lit(0).alias("part"), "tile_id", F.concat_ws(": ", "s3_path", F.coalesce("fault", F.lit("no header"))).alias("error"))

    def read(of: DataFrame) -> DataFrame:
        found = raster.read_windows(planned.join(of, CHUNK).withColumn("part", F.pmod(F.xxhash64("tile_id"), F.col("parts"))))
        return found.unionByName(lost.join(of, CHUNK, "left_semi"), allowMissingColumns=True)

    plain = mosaic.mean_blocks(read(whole).unionByName(whole.select(*CHUNK), allowMissingColumns=True), b.grid)
    return plain if many.isEmpty() else plain.union(mosaic.merged(mosaic.partial_sums(read(many), b.grid), b.grid))


def run(spark: SparkSession, settings: Settings, tiles: DataFrame | None = None, dry_run: bool = False, batch_chunks: int = BATCH_CHUNKS) -> Stats:
    """Mosaic everything that the settings ask for and isn't done yet."""
    settings.validate()
    began, o = time.time(), settings.output
    b = bind(spark, settings, tiles)
    keep = CheckpointFile.open(o.base, settings) if settings.processing.checkpoint.enabled else None
    done = keep.frame(spark) if keep and keep.completed else None
    work = lookup.work_list(spark, b.tiles, b.grid, b.years, done).select(*CHUNK).persist()
    total = work.count()
    metrics = Snapshot(chunks_skipped=len(keep.completed) if keep else 0)
    if dry_run:
        work.unpersist()
        return Stats(total, 0, 0, 0, metrics)
    zarr.create(b.grid, o, resume=bool(keep and keep.completed), years=b.years)
    heads = raster.headers(b.tiles).persist()
    batches = min(MOST_BATCHES, max(1, -(-total // batch_chunks)))
    # Chunks near each other share tiles: batches are stretches of the order, not a draw, and end where a shard ends.
    high, wide = o.sharding.shard_shape if o.sharding.enabled else (1, 1)
    down, across = -(-b.grid.chunk_counts[2] // high), -(-b.grid.chunk_counts[3] // wide)
    numbered = work.withColumn("_n", ((F.col("time_idx").cast("long") * down + F.floor(F.col("row_idx") / high)) * across + F.floor(F.col("col_idx") / wide)).cast("long"))
    edges = sorted(set(numbered.approxQuantile("_n", [k / batches for k in range(1, batches)], 0.001))) if batches > 1 else []
    reporter = Reporter(metrics, settings.processing.metrics_interval_secs, began) if settings.processing.enable_metrics else None
    processed = 0
    try:
        for low, high in zip([None, *edges], [*edges, None]):
            todo = numbered
            todo = todo if low is None else todo.filter(F.col("_n") > low)
            todo = todo if high is None else todo.filter(F.col("_n") <= high)
            written = zarr.write(chunks_of(b, todo, heads), b.grid, o)
            rows = written.collect()  # keys, sizes and failures of one batch
            for r in rows:
                for fault in [*r["failed"], *([r["error"]] if r["error"] else [])]:
                    log.warning("chunk %d:%d:%d: %s", r["time_idx"], r["row_idx"], r["col_idx"], fault)
                metrics.add(r)
            # A chunk with a failure has what could be read, but isn't done: a later run makes it anew.
            good = {f"{r['time_idx']}:{r['row_idx']}:{r['col_idx']}" for r in rows if r["error"] is None and not r["failed"]}
            processed += len(good)
            metrics.chunks_processed = processed
            if keep:
                keep.completed |= good
                keep.flush(due_only=True)
            metrics.elapsed = time.time() - began
    finally:
        if reporter:
            reporter.stop()
        if keep:
            keep.flush()
        heads.unpersist()
        work.unpersist()
    metrics.chunks_skipped += total - processed
    if settings.processing.metrics_output_path:
        metrics.save(settings.processing.metrics_output_path)
    return Stats(total, processed, total - processed, metrics.failures, metrics)
