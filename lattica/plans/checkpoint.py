"""Resumable runs: which chunks are done, as a JSON document and as a DataFrame."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lattica.sources.settings import Settings
from lattica.sources.zarr import Store

VERSION = 1


class CheckpointMismatch(ValueError):
    """The checkpoint belongs to a run with other settings."""


@dataclass
class CheckpointFile:
    """A JSON document beside the output, on whatever store that is."""

    store: Store
    name: str
    config_hash: str
    interval_secs: float = 60.0
    completed: set[str] = field(default_factory=set)
    _written: float = field(default_factory=time.monotonic)

    @classmethod
    def open(cls, base: str, settings: Settings) -> CheckpointFile:
        """The one at ``base``, or a new one; settings that don't match end the run."""
        c = settings.processing.checkpoint
        out = cls(Store(base), c.filename, settings.fingerprint(), c.interval_secs)
        raw = out.store.get(out.name)
        if raw is None:
            return out
        data = json.loads(raw)
        if data["config_hash"] not in (out.config_hash, settings.fingerprint(1)):
            raise CheckpointMismatch(f"{out.name} was made with other settings; remove it, or use another prefix")
        out.completed = set(data["completed_chunks"])
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(time_idx, row_idx, col_idx)`` of the chunks that are done."""
        rows = [tuple(map(int, k.split(":"))) for k in sorted(self.completed)]
        return spark.createDataFrame(rows, "time_idx int, row_idx int, col_idx int")

    def flush(self, due_only: bool = False) -> None:
        """Written aside and renamed where the store is local, so that a crash leaves the old one; with ``due_only`` only if the interval has passed."""
        if due_only and time.monotonic() - self._written < self.interval_secs:
            return
        document = {"version": VERSION, "config_hash": self.config_hash, "completed_chunks": sorted(self.completed), "last_checkpoint": int(time.time())}
        self.store.put(self.name, json.dumps(document, indent=2).encode())
        self._written = time.monotonic()
