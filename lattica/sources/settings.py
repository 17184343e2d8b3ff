"""Run settings: YAML or JSON to dataclasses, checked; every section has defaults."""

from __future__ import annotations

import hashlib
import json
import logging
import struct
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

from lattica.operators.grid import ChunkShape

log = logging.getLogger(__name__)


class SettingsError(ValueError):
    """A setting is missing, of the wrong kind or out of range."""


@dataclass
class Input:
    index_path: str = ""
    cog_bucket: str = ""


@dataclass
class Sharding:
    enabled: bool = True
    shard_shape: list[int] = field(default_factory=lambda: [16, 16])


@dataclass
class Output:
    local_path: str | None = None
    bucket: str | None = None
    prefix: str | None = None
    crs: str = "EPSG:4326"
    resolution: float = 10.0 / 111320.0
    num_bands: int = 64
    chunk_shape: ChunkShape = field(default_factory=ChunkShape)
    sharding: Sharding = field(default_factory=Sharding)
    compression_level: int = 3
    years: list[int] | None = None
    #: The model and the source of the pixels, for the output group's metadata.
    model: str | None = None
    source_data: str | None = None
    #: Further attributes of the output group.
    attributes: dict = field(default_factory=dict)

    @property
    def is_local(self) -> bool:
        return self.local_path is not None

    @property
    def display(self) -> str:
        return self.local_path if self.is_local else f"s3://{self.bucket}/{self.prefix}"

    @property
    def base(self) -> str:
        """Where the array goes, as an address."""
        return self.local_path if self.is_local else f"s3a://{self.bucket}/{self.prefix}"

    @property
    def stored_chunk(self) -> tuple[int, int, int, int]:
        """Pixels of one stored object: a shard's if shards are on, else a chunk's."""
        c, (rows, cols) = self.chunk_shape, self.sharding.shard_shape if self.sharding.enabled else (1, 1)
        return c.time, c.embedding, c.height * rows, c.width * cols


#: Requests that one fetch worker issues at once, at least.
REQUESTS_EACH = 8


@dataclass
class Checkpoint:
    enabled: bool = True
    interval_secs: int = 60
    prefix: str | None = None

    @property
    def filename(self) -> str:
        return f"checkpoint.{self.prefix}.json" if self.prefix else "checkpoint.json"


@dataclass
class Processing:
    fetch_concurrency: int = 8
    mosaic_concurrency: int = 8
    write_concurrency: int = 8
    max_concurrent_http: int = 128
    enable_metrics: bool = True
    metrics_interval_secs: int = 10
    metrics_output_path: str | None = None
    tile_cache_enabled: bool = True
    tile_cache_gb: float = 32.0
    metadata_cache_entries: int = 50_000
    checkpoint: Checkpoint = field(default_factory=Checkpoint)


@dataclass
class Filter:
    bounds: list[float] | None = None
    years: list[int] | None = None


@dataclass
class Settings:
    input: Input = field(default_factory=Input)
    output: Output = field(default_factory=Output)
    processing: Processing = field(default_factory=Processing)
    filter: Filter = field(default_factory=Filter)

    @classmethod
    def load(cls, path: str) -> Settings:
        """From a file; ``.json`` is JSON, anything else YAML."""
        text = Path(path).read_text()
        return cls.from_json(text) if path.endswith(".json") else cls.from_yaml(text)

    @classmethod
    def from_json(cls, text: str) -> Settings:
        return _filled(cls, json.loads(text) or {}, "")

    @classmethod
    def from_yaml(cls, text: str) -> Settings:
        import yaml

        return _filled(cls, yaml.safe_load(text) or {}, "")

    def to_yaml(self) -> str:
        import yaml

        return yaml.safe_dump(asdict(self), sort_keys=False)

    def validate(self) -> Settings:
        """Itself, if every rule holds."""
        o, p = self.output, self.processing
        cloud = o.bucket is not None or o.prefix is not None
        if o.is_local == cloud:
            raise SettingsError("give either output.local_path, or output.bucket and output.prefix")
        if cloud and not (o.bucket and o.prefix is not None):
            raise SettingsError("output.bucket and output.prefix go together")
        c = o.chunk_shape
        if c.time != 1:
            raise SettingsError("output.chunk_shape.time must be 1")
        for name, value in (("embedding", c.embedding), ("height", c.height), ("width", c.width), ("num_bands", o.num_bands)):
            if value <= 0:
                raise SettingsError(f"{name} must be above 0")
        if c.embedding != o.num_bands:
            raise SettingsError("output.chunk_shape.embedding must equal output.num_bands: a chunk holds all bands")
        if not o.resolution > 0:
            raise SettingsError("output.resolution must be above 0")
        for name in ("fetch_concurrency", "mosaic_concurrency", "write_concurrency", "max_concurrent_http"):
            if getattr(p, name) <= 0:
                raise SettingsError(f"processing.{name} must be above 0")
        if p.fetch_concurrency * REQUESTS_EACH > 1.5 * p.max_concurrent_http:
            log.warning("fetch_concurrency=%d may issue %d requests at once, over 1.5 times max_concurrent_http=%d: requests will queue", p.fetch_concurrency, p.fetch_concurrency * REQUESTS_EACH, p.max_concurrent_http)
        if not 0 <= o.compression_level <= 22:
            raise SettingsError("output.compression_level must be from 0 to 22")
        if o.sharding.enabled and (len(o.sharding.shard_shape) != 2 or min(o.sharding.shard_shape) <= 0):
            raise SettingsError("output.sharding.shard_shape must be two numbers above 0")
        if self.filter.bounds is not None and len(self.filter.bounds) != 4:
            raise SettingsError("filter.bounds must be west, south, east, north")
        return self

    def fingerprint(self, version: int = 2) -> str:
        """Hash of what decides the output; version 1 leaves out index, years, shards and compression."""
        o, c = self.output, self.output.chunk_shape
        parts = [o.crs.encode(), struct.pack("<d", o.resolution), *(struct.pack("<Q", v) for v in (c.height, c.width, c.embedding, o.num_bands))]
        parts += [struct.pack("<d", b) for b in self.filter.bounds or ()]
        if version >= 2:
            rest = [self.input.index_path, o.years, self.filter.years, asdict(o.sharding), o.compression_level]
            parts.append(json.dumps(rest, sort_keys=True).encode())
        return "sha256:" + hashlib.sha256(b"".join(parts)).hexdigest()


def _filled(kind: type, values: Any, where: str):
    if not isinstance(values, dict):
        raise SettingsError(f"{where or 'the settings'} must be a mapping")
    known = {f.name: f for f in fields(kind)}
    for k in values.keys() - known.keys():
        log.warning("unknown setting %s%s", where, k)
    made = kind()
    out = {}
    for name in known.keys() & values.keys():
        default = getattr(made, name)
        value = values[name]
        out[name] = default if value is None and default is not None else _filled(type(default), value, f"{where}{name}.") if is_dataclass(default) else value
    return kind(**{f: out.get(f, getattr(made, f)) for f in known})


def storage_conf(output: Output | None = None) -> dict[str, str]:
    """Hadoop settings: unsigned reads of public buckets, signed writes, time-outs."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint.region": "us-west-2",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
        "spark.hadoop.fs.s3a.connection.request.timeout": "120s",
        "spark.hadoop.fs.s3a.connection.establish.timeout": "5s",
        "spark.hadoop.fs.s3a.connection.idle.time": "15s",
    }
    if output is not None and not output.is_local:
        bucket = f"spark.hadoop.fs.s3a.bucket.{output.bucket}"
        conf[f"{bucket}.aws.credentials.provider"] = "software.amazon.awssdk.auth.credentials.EnvironmentVariableCredentialsProvider"
        conf[f"{bucket}.path.style.access"] = str("." in (output.bucket or "")).lower()
    return conf


SAMPLE = """\
# Settings of a mosaic run. Every key has a default except where the output goes.
input:
  index_path: catalogue.parquet
output:
  local_path: ./mosaic.zarr
  crs: EPSG:4326
  resolution: 0.0000898
  num_bands: 64
  chunk_shape: {time: 1, embedding: 64, height: 1024, width: 1024}
  sharding: {enabled: true, shard_shape: [4, 4]}
  compression_level: 3
processing:
  enable_metrics: true
  checkpoint: {enabled: true, interval_secs: 60}
filter:
  bounds: [-122.6, 37.2, -121.7, 38.0]
  years: [2024]
"""
