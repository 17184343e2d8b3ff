"""Run metrics: rates, hit rates, a snapshot and its sinks.

Counts and seconds come with the rows of written chunks, so they cost no extra pass.
"""

from __future__ import annotations

import json
import logging
import threading
import time
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
GIB = float(1 << 30)


def rate(count: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))


def gib_rate(size: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, size / GIB / seconds).otherwise(F.lit(0.0))


def hit_rate(hits: Column, misses: Column, coalesced: Column | None = None) -> Column:
    """Per cent of look-ups that were served, coalesced ones included."""
    served = hits if coalesced is None else hits + coalesced
    return F.when(served + misses > 0, served / (served + misses) * 100).otherwise(F.lit(0.0))


@dataclass
class Snapshot:
    bytes_read: int = 0
    bytes_written: int = 0
    chunks_processed: int = 0
    chunks_skipped: int = 0
    tiles_read: int = 0
    failures: int = 0
    elapsed: float = 0.0
    cog_read_secs: float = 0.0
    reproject_secs: float = 0.0
    mosaic_secs: float = 0.0
    zarr_write_secs: float = 0.0
    metadata_cache_hits: int = 0
    metadata_cache_misses: int = 0
    tile_cache_hits: int = 0
    tile_cache_misses: int = 0
    tile_cache_coalesced: int = 0
    tile_cache_bytes: int = 0
    http_requests: int = 0
    http_request_secs: float = 0.0

    def add(self, row) -> None:
        """Count what a written chunk's row tells."""
        self.failures += len(row["failed"]) + (row["error"] is not None)
        self.tiles_read += row["tiles"]
        self.bytes_read += row["bytes_read"]
        self.bytes_written += row["bytes_written"]
        self.cog_read_secs += row["read_secs"]
        self.reproject_secs += row["reproject_secs"]
        self.mosaic_secs += row["mosaic_secs"]
        self.zarr_write_secs += row["write_secs"]
        self.http_requests += row["requests"]
        self.http_request_secs += row["request_secs"]
        self.metadata_cache_hits += row["header_hits"]
        self.metadata_cache_misses += row["tiles"] - row["header_hits"]

    def _per_second(self, v: float) -> float:
        return v / self.elapsed if self.elapsed > 0 else 0.0

    @property
    def read_throughput_gbps(self) -> float:
        return self._per_second(self.bytes_read / GIB)

    @property
    def write_throughput_gbps(self) -> float:
        return self._per_second(self.bytes_written / GIB)

    @property
    def chunks_per_second(self) -> float:
        return self._per_second(self.chunks_processed)

    @property
    def http_avg_latency_ms(self) -> float:
        return self.http_request_secs / self.http_requests * 1000 if self.http_requests else 0.0

    def hit_rates(self) -> tuple[float, float]:
        """Per cent of header and of tile look-ups."""
        share = lambda served, missed: served / (served + missed) * 100 if served + missed else 0.0
        return share(self.metadata_cache_hits, self.metadata_cache_misses), share(self.tile_cache_hits + self.tile_cache_coalesced, self.tile_cache_misses)

    def as_dict(self) -> dict:
        derived = ("read_throughput_gbps", "write_throughput_gbps", "chunks_per_second", "http_avg_latency_ms")
        return asdict(self) | {k: getattr(self, k) for k in derived}

    def save(self, path: str) -> None:
        with open(path, "w") as f:
            json.dump(self.as_dict(), f, indent=2)

    def __str__(self) -> str:
        parts = {"COG": self.cog_read_secs, "Reproj": self.reproject_secs, "Mosaic": self.mosaic_secs, "Zarr": self.zarr_write_secs}
        total, (meta, tile) = sum(parts.values()), self.hit_rates()
        times = " | ".join(f"{k} {v / total * 100 if total else 0:.0f}%" for k, v in parts.items())
        return (
            f"Chunks: {self.chunks_processed} processed, {self.chunks_skipped} skipped | Tiles: {self.tiles_read} | "
            f"Read: {self.bytes_read / GIB:.2f} GB @ {self.read_throughput_gbps:.2f} GB/s | Write: {self.bytes_written / GIB:.2f} GB @ {self.write_throughput_gbps:.2f} GB/s | "
            f"Rate: {self.chunks_per_second:.1f} chunks/s | Failures: {self.failures} | Elapsed: {self.elapsed:.1f}s | Time: {times} | Cache: meta {meta:.0f}% tile {tile:.0f}%"
        )


class Reporter:
    """Logs a snapshot every ``interval`` seconds, and a last time when it is stopped."""

    def __init__(self, metrics: Snapshot, interval: float, began: float):
        self.metrics, self.interval, self.began, self.over = metrics, max(interval, 0.1), began, threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)
        self.thread.start()

    def _log(self) -> None:
        self.metrics.elapsed = time.time() - self.began
        log.info("%s", self.metrics)

    def _run(self) -> None:
        while not self.over.wait(self.interval):
            self._log()

    def stop(self) -> None:
        self.over.set()
        self.thread.join()
        self._log()
