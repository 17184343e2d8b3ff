"""Files: TIFF windows, array sink, settings, checkpoints, whole runs, streams."""

from __future__ import annotations

import json

import numpy as np
import pytest

from lattica.functions import crs as C
from lattica.operators.grid import ChunkShape, OutputGrid
from lattica.plans import checkpoint, cli, metrics, run
from lattica.sources import raster, tiff, zarr
from lattica.sources.settings import SAMPLE, Settings, SettingsError


@pytest.mark.parametrize("planar", [True, False])
@pytest.mark.parametrize("kind", [np.int8, np.uint8])
@pytest.mark.parametrize("compression", [tiff.NONE, tiff.DEFLATE, tiff.ZSTD])
def test_tiff_windows(tmp_path, planar, kind, compression):
    data = np.random.default_rng(0).integers(0, 256, (3, 37, 50)).astype(np.uint8).view(kind)
    path = str(tmp_path / "a.tif")
    tiff.write(path, data, (10.0, 0.0, 500000.0, 0.0, 10.0, 4000000.0), 16, planar, compression)
    read = tiff.file_reader(path)
    h = tiff.header(read)
    assert (h.width, h.height, h.bands, h.planar, h.affine) == (50, 37, 3, planar, (10.0, 0.0, 500000.0, 0.0, 10.0, 4000000.0))
    for x, y, w, k in ((0, 0, 50, 37), (5, 7, 20, 22), (49, 36, 1, 1)):
        assert (tiff.window(read, h, x, y, w, k) == data.view(np.int8)[:, y : y + k, x : x + w]).all()
    with pytest.raises(tiff.TiffError, match="outside"):
        tiff.window(read, h, 45, 0, 10, 1)


def test_tile_source(spark, tmp_path):
    data = np.random.default_rng(1).integers(-127, 127, (2, 40, 33)).astype(np.int8)
    tiff.write(str(tmp_path / "a.tif"), data, None)
    spark.dataSource.register(raster.TileSource)
    rows = sorted(spark.read.format("lattica_tile").option("path", str(tmp_path / "a.tif")).option("y", "5").load().collect(), key=lambda r: r["y"])
    got = np.concatenate([np.frombuffer(r["data"], np.int8).reshape(r["bands"], r["height"], r["width"]) for r in rows], 1)
    assert len(rows) == 3 and (got == data[:, 5:]).all()


def settings(tmp_path, **output) -> Settings:
    s = Settings()
    s.output.local_path = str(tmp_path / "out.zarr")
    s.output.num_bands, s.output.chunk_shape = 2, ChunkShape(1, 2, 16, 16)
    s.output.sharding.shard_shape = [2, 2]
    for k, v in output.items():
        setattr(s.output, k, v)
    return s


@pytest.mark.parametrize("sharded", [True, False])
def test_array_round_trip(spark, tmp_path, sharded):
    s = settings(tmp_path)
    s.output.sharding.enabled = sharded
    grid = OutputGrid.over((0, 0, 48, 32), C.WGS84, 1.0, [2023, 2024], 2, s.output.chunk_shape)
    zarr.create(grid, s.output)
    rng = np.random.default_rng(2)
    data = {(0, 0, 0): rng.integers(-127, 127, (1, 2, 16, 16)).astype(np.int8), (1, 1, 2): rng.integers(-127, 127, (1, 2, 16, 16)).astype(np.int8)}
    frame = lambda d: spark.createDataFrame([(*k, v.tobytes()) for k, v in d.items()], "time_idx int, row_idx int, col_idx int, data binary")
    assert all(r["error"] is None and r["bytes_written"] > 0 for r in zarr.write(frame(data), grid, s.output).collect())
    for k, v in data.items():
        assert (zarr.read_chunk(s.output.base, *k) == v).all()
    assert (zarr.read_chunk(s.output.base, 0, 1, 1) == -128).all()
    # A later write adds to a shard.
    more = {(0, 1, 1): np.ones((1, 2, 16, 16), np.int8)}
    zarr.write(frame(more), grid, s.output).collect()
    assert (zarr.read_chunk(s.output.base, 0, 1, 1) == 1).all() and (zarr.read_chunk(s.output.base, 0, 0, 0) == data[0, 0, 0]).all()
    bad = zarr.write(frame({(0, 0, 1): np.ones((1, 2, 17, 16), np.int8)}), grid, s.output).collect()
    assert "are needed" in bad[0]["error"]
    meta = json.loads((tmp_path / "out.zarr/embeddings/zarr.json").read_text())
    assert meta["shape"] == [2, 2, 32, 48] and meta["fill_value"] == -128 and meta["dimension_names"] == ["time", "band", "y", "x"]
    assert meta["chunk_grid"]["configuration"]["chunk_shape"] == ([1, 2, 32, 32] if sharded else [1, 2, 16, 16])
    group = json.loads((tmp_path / "out.zarr/zarr.json").read_text())["attributes"]
    assert group["spatial:transform"] == [1.0, 0.0, 0.0, 0.0, -1.0, 32.0] and group["geoemb:quantization"]["method"] == "signed_square"
    assert np.frombuffer((tmp_path / "out.zarr/y/c/0").read_bytes(), "<f8")[0] == 31.5
    if sharded:
        assert (tmp_path / "out.zarr/embeddings/c/0/0/0/0").exists()
    # A fresh start for one year leaves the other's chunks.
    zarr.create(grid, s.output, years=[2023])
    assert (zarr.read_chunk(s.output.base, 0, 0, 0) == -128).all() and (zarr.read_chunk(s.output.base, 1, 1, 2) == data[1, 1, 2]).all()


def test_crc32c():
    assert zarr.crc32c(b"123456789") == 0xE3069283


def test_settings(tmp_path):
    s = Settings.from_yaml(SAMPLE).validate()
    assert s.output.chunk_shape.height == 1024 and s.output.stored_chunk == (1, 64, 4096, 4096) and s.filter.years == [2024]
    assert Settings.from_yaml(s.to_yaml()) == s and s.processing.metadata_cache_entries == 50_000
    cloud = Settings.from_json('{"output": {"bucket": "b", "prefix": "p"}}').validate()
    assert cloud.output.display == "s3://b/p" and not cloud.output.is_local
    for text in ("{}", '{"output": {"local_path": "x", "bucket": "b", "prefix": "p"}}', '{"output": {"bucket": "b"}}', '{"output": {"local_path": "x", "compression_level": 23}}', '{"output": {"local_path": "x", "sharding": {"shard_shape": [0, 1]}}}', '{"output": {"local_path": "x", "chunk_shape": {"time": 2}}}', '{"output": {"local_path": "x", "num_bands": 3}}', '{"output": {"local_path": "x"}, "processing": {"fetch_concurrency": 0}}'):
        with pytest.raises(SettingsError):
            Settings.from_json(text).validate()
    other = Settings.from_yaml(SAMPLE)
    other.output.resolution = 1.0
    assert s.fingerprint() == Settings.from_yaml(SAMPLE).fingerprint() != other.fingerprint() and s.fingerprint(1) != s.fingerprint(2)


def test_cli(tmp_path, capsys):
    path = str(tmp_path / "c.yaml")
    assert cli.main(["generate-config", "-o", path]) == 0 and cli.main(["validate", "-c", path]) == 0
    assert "valid" in capsys.readouterr().out
    assert cli.main(["validate", "-c", str(tmp_path / "none.yaml")]) == 2
    assert cli.parser().parse_args(["-c", "x"]).command is None and cli.parser().parse_args(["run", "--dry-run"]).dry_run


def test_metrics():
    m = metrics.Snapshot(metadata_cache_hits=80, metadata_cache_misses=20, tile_cache_hits=50, tile_cache_coalesced=20, tile_cache_misses=30, bytes_read=2**31, elapsed=2.0, chunks_processed=10, http_requests=4, http_request_secs=0.2)
    assert m.hit_rates() == (80.0, 70.0) and m.read_throughput_gbps == 1.0 and m.chunks_per_second == 5.0 and m.http_avg_latency_ms == 50.0
    assert "meta 80% tile 70%" in str(m) and metrics.Snapshot().chunks_per_second == 0 and len(m.as_dict()) == 23


@pytest.fixture
def scene(spark, tmp_path):
    """Two overlapping tiles of 2 bands, bottom-up and top-down."""
    rows = []
    for name, west, value, down in (("a", 0.0, 10, False), ("b", 16.0, 20, True)):
        data = np.full((2, 32, 32), value, np.int8)
        data[1] = np.arange(32, dtype=np.int8)[:, None] if not down else np.arange(31, -1, -1, dtype=np.int8)[:, None]
        path = str(tmp_path / f"{name}.tif")
        tiff.write(path, data, (1.0, 0.0, west, 0.0, -1.0, 32.0) if down else (1.0, 0.0, west, 0.0, 1.0, 0.0))
        rows.append((name, path, "EPSG:4326", west, 0.0, west + 32, 32.0, west, 0.0, west + 32, 32.0, 1.0, 2024))
    return spark.createDataFrame(rows, "tile_id string, s3_path string, crs string, min_x double, min_y double, max_x double, max_y double, min_lon double, min_lat double, max_lon double, max_lat double, resolution double, year int")


@pytest.fixture
def broken(spark, tmp_path, scene):
    """The scene, with a tile whose file is missing and one whose pixels are damaged."""
    rows = []
    for name, box in (("none", (0.0, 16.0, 16.0, 32.0)), ("cut", (16.0, 16.0, 32.0, 32.0))):
        rows.append((name, str(tmp_path / f"{name}.tif"), "EPSG:4326", *box, *box, 1.0, 2024))
    tiff.write(str(tmp_path / "cut.tif"), np.full((2, 16, 16), 9, np.int8), (1.0, 0.0, 16.0, 0.0, -1.0, 32.0))
    head = tiff.header(tiff.reader(str(tmp_path / "cut.tif")))
    raw = bytearray((tmp_path / "cut.tif").read_bytes())
    raw[head.offsets[0] : head.offsets[0] + head.counts[0]] = b"x" * head.counts[0]
    (tmp_path / "cut.tif").write_bytes(bytes(raw))
    return scene.union(spark.createDataFrame(rows, scene.schema))


@pytest.mark.parametrize("many", (False, True))
def test_failures_are_counted_and_redone(spark, tmp_path, broken, many, monkeypatch, caplog):
    """Missing and damaged files: counted alike on both ways of reading, logged, and their chunks made anew by a later run."""
    original = run.chunks_of
    monkeypatch.setattr(run, "chunks_of", lambda b, todo, heads: original(b, todo, heads, part_windows=1 if many else 64))
    s = settings(tmp_path, resolution=1.0)
    s.filter.bounds = [0.0, 0.0, 48.0, 32.0]
    stats = run.run(spark, s, broken)
    # Tiles that touch a chunk's edge belong to it: the missing file fails in each of them, the damaged one only where it has pixels.
    done = json.loads((tmp_path / "out.zarr/checkpoint.json").read_text())["completed_chunks"]
    assert stats.total == 6 and stats.failures > 0 and stats.processed == len(done) == 6 - stats.skipped and "0:0:0" not in done and "0:0:1" not in done and "0:1:2" in done
    assert "none.tif" in caplog.text and "cut.tif" in caplog.text
    assert (zarr.read_chunk(s.output.base, 0, 0, 0)[0, 0] == 10).all()
    again = run.run(spark, s, broken)
    assert again.total == stats.skipped > 0 and again.failures == stats.failures and again.processed == 0
    assert stats.metrics.cog_read_secs > 0 and stats.metrics.zarr_write_secs > 0 and stats.metrics.mosaic_secs > 0 and stats.metrics.http_requests > 0


def test_a_chunk_without_windows_is_done(spark, tmp_path, scene):
    """A tile that only touches a chunk gives it nothing to read; the chunk isn't done again and again."""
    s = settings(tmp_path, resolution=1.0)
    s.filter.bounds = [0.0, 0.0, 64.0, 32.0]
    stats = run.run(spark, s, scene)
    assert stats.total == 8 and stats.processed == 8 and stats.failures == 0 and run.run(spark, s, scene).total == 0


def test_run_and_resume(spark, tmp_path, scene):
    s = settings(tmp_path, resolution=1.0)
    s.filter.bounds = [0.0, 0.0, 48.0, 32.0]
    assert run.run(spark, s, scene, dry_run=True).total == 6
    row = run.analyze(spark, s, scene).first()
    assert row["chunks_with_data"] == 6 and row["output_bytes"] == 6 * 512
    stats = run.run(spark, s, scene, batch_chunks=4)
    assert (stats.total, stats.processed) == (6, 6) and stats.metrics.tiles_read > 0
    whole = np.block([[zarr.read_chunk(s.output.base, 0, i, j)[0] for j in range(3)] for i in range(2)])
    assert (whole[0, :, :16] == 10).all() and (whole[0, :, 16:32] == 15).all() and (whole[0, :, 32:] == 20).all()
    assert (whole[1, :, 0] == np.arange(31, -1, -1)).all() and (whole[1, :, 47] == np.arange(31, -1, -1)).all()
    done = json.loads((tmp_path / "out.zarr/checkpoint.json").read_text())
    assert len(done["completed_chunks"]) == 6 and done["completed_chunks"] == sorted(done["completed_chunks"])
    assert run.run(spark, s, scene).total == 0
    s.output.resolution = 2.0
    with pytest.raises(checkpoint.CheckpointMismatch):
        run.run(spark, s, scene)
    s.filter.bounds = [100.0, 0.0, 101.0, 1.0]
    with pytest.raises(run.NothingToDo):
        run.bind(spark, s, scene)


def test_chunks_in_parts(spark, tmp_path, scene):
    """Windows of a chunk summed in parts give what they give together."""
    s = settings(tmp_path, resolution=1.0)
    s.filter.bounds = [0.0, 0.0, 48.0, 32.0]
    b = run.bind(spark, s, scene)
    heads, todo = raster.headers(b.tiles), b.grid.chunks(spark)
    one, parts = ({tuple(r[k] for k in ("row_idx", "col_idx")): bytes(r["data"]) for r in run.chunks_of(b, todo, heads, part_windows=n).collect()} for n in (64, 1))
    assert len(one) == 6 and one == parts


def test_headers_tell_faults(spark, broken):
    rows = {r["s3_path"][-6:]: r for r in raster.headers(broken.union(broken)).collect()}
    assert len(rows) == 4 and rows["/a.tif"]["gt"]["e"] == 1.0 and "Error" in rows["ne.tif"]["error"]


def test_stream(spark, tmp_path, scene):
    from lattica.streaming import incremental

    scene.write.parquet(str(tmp_path / "in"))
    grid = OutputGrid.over((0, 0, 48, 32), C.WGS84, 1.0, [2024], 2, ChunkShape(1, 2, 16, 16))
    found = incremental.touched_chunks(incremental.tile_stream(spark, str(tmp_path / "in"), scene.schema), grid)
    q = found.writeStream.format("memory").queryName("touched").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("touched").count() == 6


def test_metadata_and_warnings(tmp_path, caplog):
    s = Settings.from_json(json.dumps({"output": {"local_path": str(tmp_path), "model": "m", "source_data": "d"}, "processing": {"fetch_concurrency": 100, "max_concurrent_http": 8}})).validate()
    assert "queue" in caplog.text
    grid = OutputGrid.over((0, 0, 48, 32), C.WGS84, 1.0, [2024], 2, ChunkShape(1, 2, 16, 16))
    group = zarr.group_metadata(grid, s.output)["attributes"]
    assert group["geoemb:model"] == "m" and group["geoemb:source_data"] == "d" and all("spec_url" in c for c in group["zarr_conventions"])


def test_checkpoint_interval(tmp_path):
    s = Settings.from_json(json.dumps({"output": {"local_path": str(tmp_path)}, "processing": {"checkpoint": {"interval_secs": 3600}}}))
    keep = checkpoint.CheckpointFile.open(str(tmp_path), s)
    keep.completed.add("0:0:0")
    keep.flush(due_only=True)
    assert not (tmp_path / "checkpoint.json").exists()
    keep.flush()
    assert checkpoint.CheckpointFile.open(str(tmp_path), s).completed == {"0:0:0"}


def test_reporter(caplog):
    import logging
    import time

    caplog.set_level(logging.INFO)
    r = metrics.Reporter(metrics.Snapshot(chunks_processed=3), 0.1, time.time())
    time.sleep(0.35)
    r.stop()
    assert caplog.text.count("3 processed") >= 3
