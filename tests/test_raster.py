"""Grid, catalogue, joins, projections and kernels against worked examples and NumPy twins."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.functions import bounds as B
from lattica.functions import crs as C
from lattica.functions import hilbert, scalars
from lattica.operators import catalog, lookup, mosaic, reproject
from lattica.operators.grid import ChunkShape, OutputGrid

TILES = [("t1", -122.5, 37.5, -122.0, 38.0, 2023), ("t2", -122.0, 37.5, -121.5, 38.0, 2023), ("t3", -123.0, 38.0, -122.5, 38.5, 2024), ("t4", -121.5, 37.0, -121.0, 37.5, 2024)]


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


@pytest.fixture(scope="module")
def tiles(spark):
    rows = [(i, f"s3://bucket/{i}.tif", "EPSG:32610", 0.0, 0.0, 10000.0, 10000.0, w, s, e, n, 10.0, y) for i, w, s, e, n, y in TILES]
    return catalog.mapped(spark.createDataFrame(rows, "tile_id string, s3_path string, crs string, min_x double, min_y double, max_x double, max_y double, min_lon double, min_lat double, max_lon double, max_lat double, resolution double, year int"))


def ids(df):
    return sorted(r["tile_id"] for r in df.select("tile_id").collect())


def test_filters_and_extent(tiles):
    assert ids(catalog.filtered(tiles, (-122.6, 37.6, -121.4, 37.9))) == ["t1", "t2"]
    assert ids(catalog.filtered(tiles, None, [2024])) == ["t3", "t4"]
    assert ids(catalog.filtered(tiles, (-123, 37, -121, 39), [2023])) == ["t1", "t2"]
    assert ids(catalog.filtered(tiles, (0, 0, 1, 1))) == ids(catalog.filtered(tiles, None, [2020])) == []
    assert len(ids(catalog.filtered(tiles, None, []))) == 4
    assert tuple(catalog.extent(tiles).first()) == (-123.0, 37.0, -121.0, 38.5)
    assert [r["year"] for r in catalog.unique_years(tiles).collect()] == [2023, 2024]
    assert ids(lookup.tiles_for_bounds(tiles, (-122.3, 37.6, -121.8, 37.9))) == ["t1", "t2"]
    assert catalog.extent(tiles.limit(0)).first()["min_lon"] is None


def test_aliases_types_and_nulls(spark, tiles):
    renamed = tiles.select(F.expr("cast(substr(tile_id, 2) as bigint)").alias("id"), F.col("s3_path").alias("uri"), F.col("crs").alias("epsg"), *[F.col(a).cast("float").alias(b) for a, b in zip(catalog.DOUBLES, ("left", "bottom", "right", "top", "west", "south", "east", "north"))])
    row = catalog.mapped(renamed).orderBy("tile_id").first()
    assert (row["tile_id"], row["year"], row["resolution"], row["min_lon"]) == ("1", 2024, 10.0, -122.5)
    with pytest.raises(catalog.CatalogueError, match="no column for crs"):
        catalog.mapped(renamed.drop("epsg"))
    with pytest.raises(catalog.CatalogueError, match="must be a float"):
        catalog.mapped(renamed.withColumn("left", F.lit("x")))
    with pytest.raises(Exception, match="null in a required column"):
        catalog.checked(tiles.withColumn("crs", F.lit(None).cast("string"))).collect()


def test_catalogue_from_bytes(spark, tiles, tmp_path):
    tiles.coalesce(1).write.parquet(str(tmp_path / "c"))
    data = next((tmp_path / "c").glob("*.parquet")).read_bytes()
    assert ids(catalog.load_bytes(spark, data)) == ids(catalog.load(spark, str(tmp_path / "c"))) == ["t1", "t2", "t3", "t4"]


def test_grid_sizes():
    g = OutputGrid.over((-124, 32, -114, 42), C.WGS84, 1e-4, [2024])
    assert g.chunk_counts == (1, 1, 391, 391) and (g.height, g.width) == (100096, 100096)
    assert OutputGrid.over((0, 0, 1, 1), C.WGS84, 0.5, [2024], 64, ChunkShape(1, 64, 1, 1)).num_chunks == 4
    utm = OutputGrid.over((-122.5, 37.7, -122.3, 37.85), "EPSG:32610", 10.0, [2024], 64, ChunkShape(1, 64, 1024, 1024))
    assert utm.bounds[3] > 4185000 and abs(utm.bounds[3] - 4193127.86) < 1
    assert (g.start_year, g.time_idx(2024), g.time_idx(2020)) == (2024, 0, None)


def test_chunk_bounds_and_pixels(spark):
    g = OutputGrid.over((0, 0, 2, 2), C.WGS84, 1.0, [2024], 64, ChunkShape(1, 64, 1, 1))
    r = one(spark, *g.chunk_bounds(F.lit(0), F.lit(0)), *g.chunk_bounds(F.lit(1), F.lit(1)))
    assert tuple(r) == (0, 1, 1, 2, 1, 0, 2, 1)
    g = OutputGrid.over((0, 0, 10, 10), C.WGS84, 0.01, [2024], 64, ChunkShape(1, 64, 1024, 1024))
    x, y = g.point_of(F.lit(10), F.lit(20))
    r = one(spark, *g.pixel_of(F.lit(-1.0), F.lit(-1.0)), *g.pixel_of(F.lit(100.0), F.lit(100.0)), *g.pixel_of(x, y))
    assert tuple(r) == (g.height - 1, 0, 0, g.width - 1, 10, 20)


def test_chunks_of_a_tile(spark):
    g = OutputGrid.over((0, 0, 4, 4), C.WGS84, 1.0, [2024, 2025], 64, ChunkShape(1, 64, 1, 1))
    box = lambda b, y: spark.createDataFrame([("t", *map(float, b), y)], "tile_id string, min_lon double, min_lat double, max_lon double, max_lat double, year int")
    found = lambda b, y: {(r["time_idx"], r["row_idx"], r["col_idx"]) for r in lookup.chunks_for_tiles(box(b, y), g).collect()}
    inner = {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert found((1.5, 1.5, 2.5, 2.5), 2024) == {(0, *c) for c in inner}
    assert found((1.5, 1.5, 2.5, 2.5), 2025) == {(1, *c) for c in inner}
    assert found((9, 9, 10, 10), 2024) == found((1, 1, 2, 2), 2020) == set()
    assert found((1, 1, 2, 2), 2024) == {(0, 2, 1)}
    assert len(lookup.tiles_for_chunks(box((1, 1, 2, 2), 2024), g).collect()) == 9


def test_diagonal_tiles(spark):
    rows = [(f"t{i}", float(i - 2), float(i - 2), float(i - 1), float(i - 1), 2024) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "tile_id string, min_lon double, min_lat double, max_lon double, max_lat double, year int")
    assert ids(lookup.tiles_for_bounds(df, (0.5, 0.5, 0.6, 0.6))) == ["t2"]


def test_hilbert(spark):
    table = [[0, 1, 14, 15], [3, 2, 13, 12], [4, 7, 8, 11], [5, 6, 9, 10]]
    rows = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y")).withColumn("d", hilbert.key(F.col("x"), F.col("y"), 2)).collect()
    assert all(r["d"] == table[r["y"]][r["x"]] for r in rows)
    assert [hilbert.order_for(*s) for s in ((1, 1), (2, 2), (5, 3), (24, 54))] == [1, 1, 3, 6]
    g = OutputGrid.over((0, 0, 8, 8), C.WGS84, 1.0, [2024], 64, ChunkShape(1, 64, 1, 1))
    path = [(r["row_idx"], r["col_idx"]) for r in g.chunk_order(g.chunks(spark)).collect()]
    assert len(set(path)) == 64 and all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(path, path[1:]))


def test_windows_and_affine(spark):
    t = (500000.0, 4000000.0, 581920.0, 4081920.0)
    wb = B.window_bounds(1024.0, 2048.0, 512.0, 512.0, t, 8192, 8192)
    r = one(spark, B.pixel_window((250.0, 250.0, 750.0, 750.0), (0.0, 0.0, 1000.0, 1000.0), 100, 100), B.pixel_window([wb[k] for k in ("min_x", "min_y", "max_x", "max_y")], t, 8192, 8192), B.intersection((0.0, 0.0, 10.0, 10.0), (5.0, 5.0, 15.0, 15.0)), B.intersection((0.0, 0.0, 1.0, 1.0), (1.0, 0.0, 2.0, 1.0)))
    assert tuple(r[0]) == (25, 25, 50, 50) and tuple(r[1]) == (1024, 2048, 512, 512) and tuple(r[2]) == (5, 5, 10, 10) and r[3] is None
    m = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    up, down = B.affine(m(10, 0, 0, 500000, 0, 10, 0, 4177920, *[0] * 8)), B.affine(m(10, 0, 0, 500000, 0, -10, 0, 4259840, *[0] * 8))
    r = one(spark, *B.world_to_pixel(up, 581920.0, 4259840.0), *B.world_to_pixel(up, 552853.07, 4181018.26), *B.world_to_pixel(down, 500100.0, 4259790.0), B.bottom_up(up), B.bottom_up(down), B.affine(m(1, 2, 3, 4)))
    assert tuple(r)[:2] == (8192, 8192) and math.isclose(r[2], 5285.307, abs_tol=1e-3) and math.isclose(r[3], 309.826, abs_tol=1e-3) and tuple(r)[4:] == (10, 5, True, False, None)


def test_quad_touches(spark):
    ring = lambda *p: F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in p])
    diamond = ring((0, -1), (1, 0), (0, 1), (-1, 0), (0, -1))
    r = one(spark, B.quad_touches(diamond, (0.6, 0.6, 2.0, 2.0)), B.quad_touches(diamond, (0.5, 0.5, 2.0, 2.0)), B.quad_touches(diamond, (-0.1, -0.1, 0.1, 0.1)), B.quad_touches(diamond, (-5.0, -5.0, 5.0, 5.0)))
    assert tuple(r) == (False, True, True, True)


def test_projections(spark):
    w, s, e, n = C.bounds_of((500000, 4096000, 581920, 4177920), "EPSG:32610", C.WGS84)
    assert np.allclose((w, s, e, n), (-123.0, 37.0066, -122.0702, 37.7486), atol=1e-4)
    x, y = C.points(np.array([180.0]), np.array([60.0]), C.WGS84, C.EASE2)
    assert np.allclose((x[0], y[0]), (17367530.445, 6351419.998), atol=1e-3)
    draw = np.random.default_rng(1)
    for code, lon in (("EPSG:32610", draw.uniform(-126, -120, 500)), ("EPSG:32733", draw.uniform(12, 18, 500)), (C.EASE2, draw.uniform(-180, 180, 500))):
        lat = draw.uniform(-80, 80, 500)
        px, py = C.points(lon, lat, C.WGS84, code)
        bx, by = C.points(px, py, code, C.WGS84)
        assert np.allclose(bx, lon, atol=1e-7) and np.allclose(by, lat, atol=1e-7)
    cx, cy = C.point(F.lit(-122.3), F.lit(37.8), C.WGS84, "EPSG:32610")
    assert np.allclose(tuple(one(spark, cx, cy)), [v[0] for v in C.points([-122.3], [37.8], C.WGS84, "EPSG:32610")], atol=1e-6)
    assert "+zone=10" in C.definition("EPSG:32610") and C.definition("EPSG:2154") is None
    with pytest.raises(C.UnsupportedCrs):
        C.projection("EPSG:3857")


def test_all_zones_in_one_plan(spark):
    """A catalogue in 120 zones: planned in seconds, and equal to the same formulas on arrays."""
    import time

    from lattica.operators import catalog, lookup, windows
    from lattica.operators.grid import ChunkShape, OutputGrid
    from lattica.plans.catalogue_queries import UTM_CODES

    rows = []
    for i, code in enumerate(UTM_CODES):
        x, y = (float(v[0]) for v in C.points([6 * (i % 60) - 176.7], [47.0 if i < 60 else -35.0], C.WGS84, code))
        box = (x, y, x + 10240, y + 10240)
        rows.append((f"t{i}", f"p{i}", code, *box, *C.bounds_of(box, code, C.WGS84, 1), 10.0, 2024))
    tiles = spark.createDataFrame(rows, "tile_id string, s3_path string, crs string, min_x double, min_y double, max_x double, max_y double, min_lon double, min_lat double, max_lon double, max_lat double, resolution double, year int")
    codes, began = [*UTM_CODES, C.WGS84, C.EASE2], time.time()
    marked = catalog.with_footprint(tiles, codes)
    rings = {r["tile_id"]: r["footprint"] for r in marked.collect()}
    for r in rows:
        lon, lat = C.points(np.array([r[3], r[5], r[5], r[3]]), np.array([r[4], r[4], r[6], r[6]]), r[2], C.WGS84)
        assert np.allclose([(p["lon"], p["lat"]) for p in rings[r[0]]], np.stack([lon, lat], 1)[[0, 1, 2, 3, 0]], atol=1e-9)
    gt = F.struct(F.lit(10.0).alias("a"), F.lit(0.0).alias("b"), F.col("min_x").alias("c"), F.lit(0.0).alias("d"), F.lit(-10.0).alias("e"), F.col("max_y").alias("f"))
    for crs, resolution in ((C.WGS84, 0.01), (C.EASE2, 1000.0)):
        grid = OutputGrid.over((-180, -60, 180, 60), crs, resolution, [2024], 4, ChunkShape(1, 4, 256, 256))
        found = windows.planned(lookup.tiles_for_chunks(marked, grid).withColumn("gt", gt), grid, codes, F.lit(1024), F.lit(1024)).collect()
        assert {r["tile_id"] for r in found} == {r[0] for r in rows}
        whole = {}
        for r in found:
            whole[r["tile_id"]] = whole.get(r["tile_id"], 0) + r["window"]["width"] * r["window"]["height"]
        assert all(v >= 1024 * 1024 for v in whole.values())
    assert time.time() - began < 60


def test_scalars(spark):
    r = one(spark, scalars.object_path(F.lit("s3://b/k/x.tif")), scalars.object_path(F.lit("/a/x.tif")), scalars.object_path(F.lit("s3://bucket-only")), scalars.bucket(F.lit("s3://b/k")), scalars.chunk_key(F.lit(1), F.lit(2), F.lit(3)), scalars.quantise(F.lit(-0.25)), scalars.dequantise(F.lit(127)), scalars.dequantise(F.lit(-128)))
    assert tuple(r)[:5] == ("k/x.tif", "/a/x.tif", None, "b", "1:2:3")
    assert r[5] == -64 and math.isclose(r[6], (127 / 127.5) ** 2) and r[7] is None


def test_mean_rules(spark):
    acc = mosaic.Accumulator(2, 1, 1)
    for v in ((10, 50), (20, -128), (-128, -128)):
        acc.add(np.array(v).reshape(2, 1), np.ones((1, 1), bool))
    assert acc.count[0, 0] == 2 and acc.result()[:, 0, 0].tolist() == [15, 25]
    assert mosaic.Accumulator(2, 1, 1).result()[:, 0, 0].tolist() == [-128, -128]
    assert mosaic.round_half_away(np.array([0.5, -0.5, 1.5, -2.5])).tolist() == [1, -1, 2, -3]
    rows = [(0, 0, 0, 0, b, v) for b, v in enumerate((10, 50))] + [(0, 1, 0, 0, b, v) for b, v in enumerate((20, -128))] + [(1, 0, 0, 1, b, -128) for b in range(2)]
    df = spark.createDataFrame(rows, "pixel_id long, src int, row int, col int, band int, value int")
    assert sorted((r["pixel_id"], r["band"], r["value"], r["n"]) for r in mosaic.mean_long(df).collect()) == [(0, 0, 15, 2), (0, 1, 25, 2), (1, 0, -128, 0), (1, 1, -128, 0)]
    assert sorted((r["pixel_id"], r["band"], r["value"]) for r in mosaic.mean_long(df, per_band=True).collect())[:2] == [(0, 0, 15), (0, 1, 50)]


def test_mosaic_of_one_system():
    data = np.full((4, 64, 64), 42, np.int8)
    out = mosaic.mosaic([mosaic.Window_(data, (0, 0, 64, 64), C.WGS84)], (0, 0, 64, 64), (64, 64), 1.0, C.WGS84, 4)
    assert out.shape == (1, 4, 64, 64) and (out == 42).all()
    # Row 0 of a source is its south, row 0 of the target its north.
    rising = np.broadcast_to(np.arange(64, dtype=np.int8)[None, :, None], (1, 64, 64))
    out = mosaic.mosaic([mosaic.Window_(rising, (0, 0, 64, 64), C.WGS84)], (0, 0, 64, 64), (64, 64), 1.0, C.WGS84, 1)
    assert (out[0, 0, :, 5] == np.arange(63, -1, -1)).all()
    assert (mosaic.mosaic([], (0, 0, 1, 1), (4, 4), 0.25, C.WGS84, 2) == -128).all()


def test_reprojection_meets_exact_projection():
    rng = np.random.default_rng(2)
    data = rng.integers(-100, 100, (2, 200, 200)).astype(np.int8)
    bounds = (500000.0, 4100000.0, 502000.0, 4102000.0)
    w, s, e, n = C.bounds_of(bounds, "EPSG:32610", C.WGS84, 10)
    target = reproject.Target(C.WGS84, (w, s, w + 240 * 1e-4, n), 1e-4, (190, 240))
    out = reproject.reproject(data, "EPSG:32610", bounds, target)
    rows, cols = np.indices(target.shape)
    x, y = C.points(w + (cols + 0.5) * 1e-4, n - (rows + 0.5) * 1e-4, C.WGS84, "EPSG:32610")
    c, r = mosaic.round_half_away((x - bounds[0]) / 10 - 0.5).astype(int), mosaic.round_half_away((y - bounds[1]) / 10 - 0.5).astype(int)
    inside = (r >= 0) & (r < 200) & (c >= 0) & (c < 200)
    exact = np.full(out.shape, -128, np.int8)
    exact[:, inside] = data[:, r[inside], c[inside]]
    assert (exact == out).mean() > 0.97
    same = reproject.reproject(data, C.WGS84, (0, 0, 200, 200), reproject.Target(C.WGS84, (0, 0, 200, 200), 1.0, (200, 200)))
    assert (same == data[:, ::-1]).all()


def test_adaptive_blocks_subdivide():
    flat = reproject.blocks(reproject.Target(C.WGS84, (0, 0, 256, 256), 1.0, (256, 256)), C.WGS84, (1, 1))
    bent = reproject.blocks(reproject.Target(C.WGS84, (-126.0, 0.0, -120.0, 60.0), 0.02, (3000, 300)), "EPSG:32610", (10.0, 10.0))
    assert len(flat) == 4 and len(bent) > 24 * 3
    area = ((bent[:, 2] - bent[:, 0]) * (bent[:, 3] - bent[:, 1])).sum()
    assert area == 3000 * 300


def test_coverage(spark):
    g = OutputGrid.over((0, 0, 4, 4), C.WGS84, 1.0, [2024, 2025], 1, ChunkShape(1, 1, 1, 1))
    df = spark.createDataFrame([("a", 0.2, 0.2, 0.8, 0.8, 2024), ("b", 0.2, 0.2, 1.8, 0.8, 2024)], "tile_id string, min_lon double, min_lat double, max_lon double, max_lat double, year int")
    r = lookup.coverage(lookup.tiles_for_chunks(df, g), g, df).withColumn("line", lookup.coverage_text()).first()
    assert (r["total_chunks"], r["chunks_with_data"], r["empty_chunks"], r["max_tiles_per_chunk"], r["avg_tiles_per_chunk"], r["total_input_tiles"]) == (32, 2, 30, 2, 1.5, 2)
    assert r["line"] in {f"Coverage: 2/32 chunks ({p}%), max overlap: 2, avg overlap: 1.5, input tiles: 2" for p in ("6.2", "6.3")}
    empty = lookup.coverage(lookup.tiles_for_chunks(df.limit(0), g), g, df.limit(0)).first()
    assert (empty["chunks_with_data"], empty["avg_tiles_per_chunk"]) == (0, 0.0)


def test_no_nested_loop(spark, tiles):
    g = OutputGrid.over((-123, 37, -121, 38.5), C.WGS84, 1e-3, [2023, 2024])
    plan = lookup.work_list(spark, tiles, g, [2023], g.chunks(spark).limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
