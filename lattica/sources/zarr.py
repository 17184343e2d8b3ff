"""A chunked array (time, band, y, x) in Zarr version 3: metadata, chunk sink, reader.

The driver writes metadata and coordinates; executors write chunks. With
shards, chunks are compressed where they are made and only compressed bytes
are shuffled to the task that writes their shard. A chunk is written under a
temporary name and renamed, so a repeated task leaves the same file.
"""

from __future__ import annotations

import json
import os
import shutil
import struct
import time
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.scalars import NODATA
from lattica.operators.grid import OutputGrid
from lattica.sources.settings import Output

ARRAY = "embeddings"
EMPTY = (1 << 64) - 1

# The conventions that the group declares.
CONVENTIONS = [
    {"uuid": "f17cb550-5864-4468-aeb7-f3180cfb622f", "name": "proj:", "description": "Coordinate reference system information for geospatial data", "spec_url": "https://github.com/zarr-experimental/geo-proj/blob/v1/README.md", "schema_url": "https://raw.githubusercontent.com/zarr-experimental/geo-proj/refs/tags/v1/schema.json"},
    {"uuid": "689b58e2-cf7b-45e0-9fff-9cfc0883d6b4", "name": "spatial:", "description": "Spatial coordinate information", "spec_url": "https://github.com/zarr-conventions/spatial/blob/v1/README.md", "schema_url": "https://raw.githubusercontent.com/zarr-conventions/spatial/refs/tags/v1/schema.json"},
    {"uuid": "61c12cc5-0e28-4056-999a-480cf3fb7e4c", "name": "geoemb:", "description": "Geo-embeddings metadata for machine learning embeddings stored in Zarr", "spec_url": "https://github.com/geo-embeddings/embeddings-zarr-convention/tree/add-convention"},
]
QUANTIZATION = {"method": "signed_square", "original_dtype": "float32", "quantized_dtype": "int8", "formula": "(x / 127.5) ** 2 * sign(x)", "valid_range": [-127, 127], "nodata": NODATA}


class Store:
    """Objects under a local folder or an address that Arrow's file systems know."""

    def __init__(self, base: str):
        self.base = base

    def _remote(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.base.replace("s3a://", "s3://"))

    @property
    def local(self) -> bool:
        return "://" not in self.base

    def put(self, key: str, data: bytes) -> int:
        if self.local:
            path = Path(self.base, key)
            path.parent.mkdir(parents=True, exist_ok=True)
            temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
            temporary.write_bytes(data)
            os.replace(temporary, path)
        else:
            system, root = self._remote()
            with system.open_output_stream(f"{root}/{key}") as out:
                out.write(data)
        return len(data)

    def get(self, key: str) -> bytes | None:
        if self.local:
            path = Path(self.base, key)
            return path.read_bytes() if path.exists() else None
        system, root = self._remote()
        try:
            return system.open_input_file(f"{root}/{key}").readall()
        except FileNotFoundError:
            return None

    def remove(self, key: str) -> None:
        if self.local:
            shutil.rmtree(Path(self.base, key), ignore_errors=True)
        else:
            from pyarrow import fs

            system, root = self._remote()
            if system.get_file_info(f"{root}/{key}").type != fs.FileType.NotFound:
                system.delete_dir(f"{root}/{key}")


def crc32c(data: bytes) -> int:
    table = crc32c.table
    if table is None:
        table = []
        for v in range(256):
            for _ in range(8):
                v = v >> 1 ^ (0x82F63B78 if v & 1 else 0)
            table.append(v)
        crc32c.table = table
    crc = 0xFFFFFFFF
    for b in data:
        crc = table[(crc ^ b) & 255] ^ crc >> 8
    return crc ^ 0xFFFFFFFF


crc32c.table = None


def group_metadata(grid: OutputGrid, output: Output) -> dict:
    attributes = {
        "proj:code": grid.crs, "spatial:dimensions": ["y", "x"], "spatial:transform": [grid.resolution, 0.0, grid.bounds[0], 0.0, -grid.resolution, grid.bounds[3]], "spatial:transform_type": "affine",
        "spatial:bbox": list(grid.bounds), "spatial:shape": [grid.height, grid.width], "spatial:registration": "pixel",
        "geoemb:type": "pixel", "geoemb:dimensions": grid.num_bands, "geoemb:data_type": "int8", "geoemb:gsd": grid.resolution, "geoemb:quantization": QUANTIZATION, "zarr_conventions": CONVENTIONS,
    }
    named = {f"geoemb:{k}": v for k, v in (("model", output.model), ("source_data", output.source_data)) if v}
    return {"zarr_format": 3, "node_type": "group", "attributes": attributes | named | output.attributes}


def array_metadata(shape, chunk, kind: str, fill, names, codecs) -> dict:
    return {
        "zarr_format": 3, "node_type": "array", "shape": list(shape), "data_type": kind, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(chunk)}},
        "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}}, "fill_value": fill, "codecs": codecs, "dimension_names": list(names), "attributes": {},
    }


def _zstd(level: int) -> dict:
    return {"name": "zstd", "configuration": {"level": level, "checksum": False}}


def pixel_metadata(grid: OutputGrid, output: Output) -> dict:
    s = grid.chunk_shape
    inner = [{"name": "bytes"}, _zstd(output.compression_level)]
    little = {"name": "bytes", "configuration": {"endian": "little"}}
    sharded = [{"name": "sharding_indexed", "configuration": {"chunk_shape": [s.time, s.embedding, s.height, s.width], "codecs": inner, "index_codecs": [little, {"name": "crc32c"}], "index_location": "end"}}]
    return array_metadata(grid.array_shape, output.stored_chunk, "int8", NODATA, ("time", "band", "y", "x"), sharded if output.sharding.enabled else inner)


def _text(values: list[str]) -> bytes:
    return struct.pack("<I", len(values)) + b"".join(struct.pack("<I", len(v.encode())) + v.encode() for v in values)


def create(grid: OutputGrid, output: Output, resume: bool = False, years=None) -> Store:
    """Metadata and coordinates; without ``resume`` the chunks of the years to process are deleted, all if none are named."""
    store = Store(output.base)
    if not resume:
        named = [t for y in years or () if (t := grid.time_idx(y)) is not None]
        for key in [f"{ARRAY}/c/{t}" for t in named] if years else [ARRAY]:
            store.remove(key)
    put = lambda key, value: store.put(key, json.dumps(value, indent=2).encode())
    put("zarr.json", group_metadata(grid, output))
    put(f"{ARRAY}/zarr.json", pixel_metadata(grid, output))
    little = [{"name": "bytes", "configuration": {"endian": "little"}}]
    x = grid.bounds[0] + (np.arange(grid.width) + 0.5) * grid.resolution
    y = grid.bounds[3] - (np.arange(grid.height) + 0.5) * grid.resolution
    for name, kind, fill, raw, n, codecs in (
        ("x", "float64", 0.0, x.astype("<f8").tobytes(), grid.width, little),
        ("y", "float64", 0.0, y.astype("<f8").tobytes(), grid.height, little),
        ("time", "int32", 0, np.array(grid.years, "<i4").tobytes(), len(grid.years), little),
        ("band", "string", "", _text([f"A{i:02d}" for i in range(grid.num_bands)]), grid.num_bands, [{"name": "vlen-utf8"}]),
    ):
        put(f"{name}/zarr.json", array_metadata([n], [max(1, n)], kind, fill, [name], codecs))
        store.put(f"{name}/c/0", raw)
    return store


def _packed(data: bytes, size: int, level: int) -> bytes:
    import zstandard

    if len(data) != size:
        raise ValueError(f"a chunk has {len(data)} bytes; {size} are needed")
    return zstandard.ZstdCompressor(level=level).compress(data)


def write(chunks: DataFrame, grid: OutputGrid, output: Output) -> DataFrame:
    """Store ``chunks(time_idx, row_idx, col_idx, data, ...)``: a row for each with the bytes written and the seconds, or an ``error``; chunks without data store nothing, other columns are carried along."""
    s, base, level = grid.chunk_shape, output.base, output.compression_level
    size = s.time * grid.num_bands * s.height * s.width
    key = ("time_idx", "row_idx", "col_idx")
    carried = chunks.select(*[F.col(k).cast("int").alias(k) for k in key], *[c for c in chunks.columns if c not in (*key, "data")])
    fields = ", ".join(f"{n} {t}" for n, t in carried.dtypes) + ", bytes_written long, write_secs double, error string"
    added = [("bytes_written", pa.int64()), ("write_secs", pa.float64()), ("error", pa.string())]

    def compress(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                out, began = {"blob": None, "bytes_written": 0, "error": None}, time.perf_counter()
                try:
                    data = row["data"][0]
                    if data.is_valid:
                        out["blob"] = _packed(data.as_buffer(), size, level)
                    if data.is_valid and not output.sharding.enabled:
                        t, i, j = (row[k][0].as_py() for k in key)
                        out["bytes_written"] = Store(base).put(f"{ARRAY}/c/{t}/0/{i}/{j}", out["blob"])
                        out["blob"] = None
                except Exception as e:  # noqa: BLE001
                    out |= {"blob": None, "error": f"{type(e).__name__}: {e}"}
                out["write_secs"] = time.perf_counter() - began
                rest = row.drop_columns(["data"])
                yield pa.RecordBatch.from_arrays([*rest.columns, *[pa.array([out[k]], t) for k, t in (*added, ("blob", pa.binary()))]], [*rest.schema.names, *[k for k, _ in added], "blob"])

    packed = chunks.select(*carried.columns, "data").withColumns({k: F.col(k).cast("int") for k in key}).mapInArrow(compress, fields + ", blob binary")
    if not output.sharding.enabled:
        return packed.drop("blob")
    rows, cols = output.sharding.shard_shape

    def shard(table: pa.Table) -> pa.Table:
        began, small = time.perf_counter(), table.select([*key, "error"]).to_pylist()
        t, i, j = small[0]["time_idx"], small[0]["row_idx"] // rows, small[0]["col_idx"] // cols
        name = f"{ARRAY}/c/{t}/0/{i}/{j}"
        good = {(r["row_idx"] % rows, r["col_idx"] % cols): table["blob"][n].as_py() for n, r in enumerate(small) if table["blob"][n].is_valid}
        error = None
        try:
            # A resumed run adds to what the shard already has.
            kept = unpack_shard(old, rows, cols) if good and (old := Store(base).get(name)) else {}
            Store(base).put(name, pack_shard(kept | good, rows, cols)) if good else 0
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
        took = (time.perf_counter() - began) / len(small)
        made = {"bytes_written": [0 if error else len(good.get((r["row_idx"] % rows, r["col_idx"] % cols), b"")) for r in small], "write_secs": [v + took for v in table["write_secs"].to_pylist()], "error": [r["error"] or error for r in small]}
        rest = table.drop_columns(["blob", *made])
        return pa.Table.from_arrays([*rest.columns, *[pa.array(made[k], t) for k, t in added]], [*rest.column_names, *[k for k, _ in added]])

    by = [F.col("time_idx"), F.floor(F.col("row_idx") / rows).alias("_i"), F.floor(F.col("col_idx") / cols).alias("_j")]
    return packed.groupBy(*by).applyInArrow(shard, fields)


def pack_shard(blobs: dict[tuple[int, int], bytes], rows: int, cols: int) -> bytes:
    """Chunks one after another and, at the end, their places with a checksum."""
    index, body, at = [], [], 0
    for i in range(rows):
        for j in range(cols):
            blob = blobs.get((i, j))
            index += [EMPTY, EMPTY] if blob is None else [at, len(blob)]
            if blob is not None:
                body.append(blob)
                at += len(blob)
    raw = struct.pack(f"<{len(index)}Q", *index)
    return b"".join(body) + raw + struct.pack("<I", crc32c(raw))


def unpack_shard(data: bytes, rows: int, cols: int) -> dict[tuple[int, int], bytes]:
    raw = data[-16 * rows * cols - 4 : -4]
    if struct.unpack("<I", data[-4:])[0] != crc32c(raw):
        raise ValueError("a shard's index doesn't match its checksum")
    index = struct.unpack(f"<{2 * rows * cols}Q", raw)
    return {(n // cols, n % cols): data[index[2 * n] : index[2 * n] + index[2 * n + 1]] for n in range(rows * cols) if index[2 * n] != EMPTY}


def read_chunk(base: str, time_idx: int, row_idx: int, col_idx: int) -> np.ndarray:
    """One chunk, (time, band, height, width); all nodata if it isn't stored."""
    import zstandard

    store = Store(base)
    meta = json.loads(store.get(f"{ARRAY}/zarr.json"))
    shape = meta["chunk_grid"]["configuration"]["chunk_shape"]
    first = meta["codecs"][0]
    if first["name"] == "sharding_indexed":
        inner = first["configuration"]["chunk_shape"]
        rows, cols = shape[2] // inner[2], shape[3] // inner[3]
        data = store.get(f"{ARRAY}/c/{time_idx}/0/{row_idx // rows}/{col_idx // cols}")
        blob = unpack_shard(data, rows, cols).get((row_idx % rows, col_idx % cols)) if data else None
        shape = inner
    else:
        blob = store.get(f"{ARRAY}/c/{time_idx}/0/{row_idx}/{col_idx}")
    if blob is None:
        return np.full(shape, NODATA, np.int8)
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int8).reshape(shape)
