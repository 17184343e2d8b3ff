"""Named queries of the raster engine over derived relations, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import bounds as B
from lattica.functions import crs as C
from lattica.functions import hilbert, scalars
from lattica.operators import catalog, lookup, mosaic
from lattica.operators.grid import ChunkShape, OutputGrid
from lattica.plans.demo import BOUNDS_SQL, CHUNKS_SQL, GRID, PIXELS_SQL, TILES_SQL, completed, pixels, tiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BOX = (-100.0, -30.0, 60.0, 45.0)
YEARS = (2021, 2023)
CHUNK = lookup.CHUNK
ORDER = GRID.hilbert_order


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def hilbert_sql(inner: str, x: str, y: str, order: int) -> str:
    """``inner`` with ``hx, hy, hd`` replaced level by level; hd is the key."""
    out = f"SELECT *, CAST({x} AS BIGINT) AS hx, CAST({y} AS BIGINT) AS hy, CAST(0 AS BIGINT) AS hd FROM ({inner}) h0"
    for level in range(order - 1, -1, -1):
        k = 1 << level
        bx, by, lx, ly = f"(hx & {k}) > 0", f"(hy & {k}) > 0", f"(hx & {k - 1})", f"(hy & {k - 1})"
        out = (
            f"SELECT * REPLACE (CASE WHEN {by} THEN {lx} WHEN {bx} THEN {k - 1} - {ly} ELSE {ly} END AS hx, CASE WHEN {by} THEN {ly} WHEN {bx} THEN {k - 1} - {lx} ELSE {lx} END AS hy, "
            f"hd + CAST({k * k} AS BIGINT) * CASE WHEN {bx} AND {by} THEN 2 WHEN {bx} THEN 3 WHEN {by} THEN 1 ELSE 0 END AS hd) FROM ({out}) h"
        )
    return out


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.tiles_for_chunks(tiles(spark, sf_dir), GRID)


_T = f"({TILES_SQL}) t"
_TOUCH = "t.min_lon <= c.x1 AND t.max_lon >= c.x0 AND t.min_lat <= c.y1 AND t.max_lat >= c.y0 AND t.year = 2020 + c.time_idx"
_W, _S, _E, _N = (f"CAST({v!r} AS DOUBLE)" for v in GRID.bounds)
_STEP = f"CAST({GRID.chunk_shape.width * GRID.resolution!r} AS DOUBLE)"
#: Strict overlap, within the rows and columns that arithmetic on the tile's bounds gives.
_INSIDE = (
    f"t.min_lon < c.x1 AND t.max_lon > c.x0 AND t.min_lat < c.y1 AND t.max_lat > c.y0 AND t.year = 2020 + c.time_idx AND c.col_idx >= floor((t.min_lon - {_W}) / {_STEP}) AND c.col_idx < ceil((t.max_lon - {_W}) / {_STEP}) "
    f"AND c.row_idx >= floor(({_N} - t.max_lat) / {_STEP}) AND c.row_idx < ceil(({_N} - t.min_lat) / {_STEP})"
)
PAIRS_SQL = f"SELECT c.time_idx, c.row_idx, c.col_idx, t.tile_id FROM {_T} JOIN ({BOUNDS_SQL}) c ON {_TOUCH}"
EACH_SQL = f"SELECT time_idx, row_idx, col_idx, count(*) AS n FROM ({PAIRS_SQL}) p GROUP BY 1, 2, 3"


# Catalogue.
@query(TILES_SQL)
def tile_catalog(spark, sf_dir):
    return catalog.checked(catalog.mapped(tiles(spark, sf_dir)))


@query(f"SELECT tile_id, year FROM {_T} WHERE min_lon < {BOX[2]} AND max_lon > {BOX[0]} AND min_lat < {BOX[3]} AND max_lat > {BOX[1]} AND year IN (2021, 2023)")
def tile_filter(spark, sf_dir):
    return catalog.filtered(tiles(spark, sf_dir), BOX, YEARS).select("tile_id", "year")


@query(f"SELECT min(min_lon) AS min_lon, min(min_lat) AS min_lat, max(max_lon) AS max_lon, max(max_lat) AS max_lat FROM {_T}")
def tile_extent(spark, sf_dir):
    return catalog.extent(tiles(spark, sf_dir))


@query(f"SELECT DISTINCT year FROM {_T} ORDER BY year")
def unique_years(spark, sf_dir):
    return catalog.unique_years(tiles(spark, sf_dir))


@query(f"SELECT count(*) AS tiles, count(*) = 0 AS is_empty FROM {_T}")
def tile_count(spark, sf_dir):
    return tiles(spark, sf_dir).agg(F.count(F.lit(1)).alias("tiles"), (F.count(F.lit(1)) == 0).alias("is_empty"))


@query(f"SELECT tile_id, regexp_extract(s3_path, '^s3://([^/]*)/', 1) AS bucket, regexp_extract(s3_path, '^s3://[^/]*/(.*)$', 1) AS object_key FROM {_T}")
def uri_split(spark, sf_dir):
    return tiles(spark, sf_dir).select("tile_id", scalars.bucket(F.col("s3_path")).alias("bucket"), scalars.object_path(F.col("s3_path")).alias("object_key"))


@query(f"SELECT tile_id, min_lon AS sw_lon, min_lat AS sw_lat, max_lon AS ne_lon, max_lat AS ne_lat, 5 AS points FROM {_T}")
def tile_footprint(spark, sf_dir):
    ring = F.col("footprint")
    return catalog.with_footprint(tiles(spark, sf_dir), [C.WGS84]).select(
        "tile_id", ring[0]["lon"].alias("sw_lon"), ring[0]["lat"].alias("sw_lat"), ring[2]["lon"].alias("ne_lon"), ring[2]["lat"].alias("ne_lat"), F.size(ring).alias("points")
    )


# Grid.
@query(f"SELECT time_idx, row_idx, col_idx, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, 2020 + time_idx AS year FROM ({BOUNDS_SQL}) c")
def chunk_enumeration(spark, sf_dir):
    box = GRID.chunk_bounds(F.col("row_idx"), F.col("col_idx"))
    return GRID.chunks(spark).select(*CHUNK, *[F.round(v, 6).alias(k) for k, v in zip(("x0", "y0", "x1", "y1"), box)], GRID.year_of(F.col("time_idx")).alias("year"))


@query(f"SELECT time_idx, row_idx, col_idx, hd AS hilbert FROM ({hilbert_sql(CHUNKS_SQL, 'col_idx', 'row_idx', ORDER)}) h")
def chunk_hilbert(spark, sf_dir):
    return GRID.chunk_order(GRID.chunks(spark))


@query(
    f"SELECT time_idx, row_idx, col_idx, time_idx || ':' || row_idx || ':' || col_idx AS chunk_key, row_idx * 256 AS row0, col_idx * 256 AS col0, least((row_idx + 1) * 256, {GRID.height}) AS row1, least((col_idx + 1) * 256, {GRID.width}) AS col1 FROM ({CHUNKS_SQL}) c"
)
def chunk_keys(spark, sf_dir):
    box = GRID.chunk_pixels(F.col("row_idx"), F.col("col_idx"))
    return GRID.chunks(spark).select(*CHUNK, scalars.chunk_key(*map(F.col, CHUNK)).alias("chunk_key"), *[v.alias(k) for k, v in zip(("row0", "col0", "row1", "col1"), box)])


@query("SELECT i AS time_idx, CAST(2020 + i AS INTEGER) AS year, CAST(CASE WHEN i < 5 THEN i ELSE -1 END AS INTEGER) AS found FROM range(8) r(i)")
def time_index(spark, sf_dir):
    """Years of time indices, beyond the list as well, and back."""
    rows = spark.range(8).select(F.col("id").alias("time_idx"), GRID.year_of(F.col("id").cast("int")).alias("year"))
    return rows.withColumn("found", F.coalesce(GRID.time_of(F.col("year")), F.lit(-1)))


@query(
    f"SELECT 5 AS times, 64 AS bands, {GRID.height} AS height, {GRID.width} AS width, {GRID.num_chunks} AS chunks, {GRID.num_spatial_chunks} AS spatial_chunks, CAST(ceil(log2(greatest(max(row_idx), max(col_idx)) + 1)) AS INTEGER) AS hilbert_order FROM ({CHUNKS_SQL}) c"
)
def grid_summary(spark, sf_dir):
    times, bands, height, width = GRID.array_shape
    values = {"times": times, "bands": bands, "height": height, "width": width, "chunks": GRID.num_chunks, "spatial_chunks": GRID.num_spatial_chunks, "hilbert_order": GRID.hilbert_order}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


_CLAMP = "least(greatest(CAST(trunc({v}) AS BIGINT), 0), {n})"
_PX_COL = _CLAMP.format(v=f"(lon - CAST({GRID.bounds[0]!r} AS DOUBLE)) / CAST(0.025 AS DOUBLE)", n=GRID.width - 1)
_PX_ROW = _CLAMP.format(v=f"(CAST({GRID.bounds[3]!r} AS DOUBLE) - lat) / CAST(0.025 AS DOUBLE)", n=GRID.height - 1)
_CENTRES = f"SELECT tile_id, (min_lon + max_lon) / 2 AS lon, (min_lat + max_lat) / 2 AS lat FROM {_T}"


def _centres(spark, sf_dir):
    lon, lat = B.centroid(B.geographic())
    return tiles(spark, sf_dir).select("tile_id", lon.alias("lon"), lat.alias("lat"))


@query(f"SELECT tile_id, {_PX_ROW} AS pixel_row, {_PX_COL} AS pixel_col FROM ({_CENTRES}) c")
def crs_to_pixel(spark, sf_dir):
    row, column = GRID.pixel_of(F.col("lon"), F.col("lat"))
    return _centres(spark, sf_dir).select("tile_id", row.alias("pixel_row"), column.alias("pixel_col"))


@query(
    f"SELECT tile_id, round(CAST({GRID.bounds[0]!r} AS DOUBLE) + (c + CAST(0.5 AS DOUBLE)) * CAST(0.025 AS DOUBLE), 6) AS x, round(CAST({GRID.bounds[3]!r} AS DOUBLE) - (r + CAST(0.5 AS DOUBLE)) * CAST(0.025 AS DOUBLE), 6) AS y FROM (SELECT tile_id, {_PX_ROW} AS r, {_PX_COL} AS c FROM ({_CENTRES}) c) p"
)
def pixel_to_crs(spark, sf_dir):
    x, y = GRID.point_of(F.col("pixel_row"), F.col("pixel_col"))
    return crs_to_pixel(spark, sf_dir).select("tile_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


def _axis(name: str, sql: str, digits: int | None = None) -> None:
    def f(spark, sf_dir):
        out = GRID.coordinates(spark, name)
        return out.withColumn("value", F.round("value", digits)) if digits else out

    f.__name__ = f"coord_{name}"
    query(sql)(f)


_axis("x", f"SELECT i AS id, round(CAST({GRID.bounds[0]!r} AS DOUBLE) + (i + CAST(0.5 AS DOUBLE)) * CAST(0.025 AS DOUBLE), 6) AS value FROM range({GRID.width}) r(i)", 6)
_axis("y", f"SELECT i AS id, round(CAST({GRID.bounds[3]!r} AS DOUBLE) - (i + CAST(0.5 AS DOUBLE)) * CAST(0.025 AS DOUBLE), 6) AS value FROM range({GRID.height}) r(i)", 6)
_axis("time", f"SELECT i AS id, CAST(2020 + i AS INTEGER) AS value FROM range({len(GRID.years)}) r(i)")
_axis("band", f"SELECT i AS id, 'A' || lpad(CAST(i AS VARCHAR), 2, '0') AS value FROM range({GRID.num_bands}) r(i)")


# Joins.
@query(f"SELECT tile_id FROM {_T} WHERE min_lon <= {BOX[2]} AND max_lon >= {BOX[0]} AND min_lat <= {BOX[3]} AND max_lat >= {BOX[1]}")
def tiles_for_bounds(spark, sf_dir):
    return lookup.tiles_for_bounds(catalog.with_footprint(tiles(spark, sf_dir), [C.WGS84]), BOX).select("tile_id")


_EDGES = [("x", "y - h", "x + h", "y"), ("x + h", "y", "x", "y + h"), ("x", "y + h", "x - h", "y"), ("x - h", "y", "x", "y - h")]
_OUTSIDE = " OR ".join("(" + " AND ".join(f"(({bx}) - ({ax})) * ({cy} - ({ay})) - (({by}) - ({ay})) * ({cx} - ({ax})) < 0" for cx in (BOX[0], BOX[2]) for cy in (BOX[1], BOX[3])) + ")" for ax, ay, bx, by in _EDGES)


@query(f"SELECT tile_id FROM (SELECT tile_id, (min_lon + max_lon) / 2 AS x, (min_lat + max_lat) / 2 AS y, (max_lon - min_lon) * 8 AS h FROM {_T}) q WHERE NOT (x + h < {BOX[0]} OR x - h > {BOX[2]} OR y + h < {BOX[1]} OR y - h > {BOX[3]} OR {_OUTSIDE})")
def footprint_intersects(spark, sf_dir):
    """Diamonds around the tiles' centres that meet a rectangle, by separating axes."""
    rows = tiles(spark, sf_dir).select("tile_id", *[v.alias(k) for k, v in zip("xy", B.centroid(B.geographic()))], ((F.col("max_lon") - F.col("min_lon")) * 8).alias("h"))
    x, y, h = map(F.col, "xyh")
    ring = F.array(*[F.struct(a.alias("lon"), b.alias("lat")) for a, b in ((x, y - h), (x + h, y), (x, y + h), (x - h, y), (x, y - h))])
    return rows.filter(B.quad_touches(ring, BOX)).select("tile_id")


@query(PAIRS_SQL)
def tiles_for_chunk(spark, sf_dir):
    return lookup.tiles_for_chunks(catalog.with_footprint(tiles(spark, sf_dir), [C.WGS84]), GRID).select(*CHUNK, "tile_id")


@query(f"SELECT time_idx, row_idx, col_idx, CAST(n AS BIGINT) AS n_tiles FROM ({EACH_SQL}) e")
def tiles_per_chunk(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("n_tiles"))


@query(
    f"SELECT t.tile_id, c.time_idx, c.row_idx, c.col_idx, c.hd AS hilbert FROM {_T} JOIN ({hilbert_sql(BOUNDS_SQL, 'col_idx', 'row_idx', ORDER)}) c ON {_INSIDE}"
)
def chunks_for_tile(spark, sf_dir):
    return lookup.chunks_for_tiles(tiles(spark, sf_dir), GRID).select("tile_id", *CHUNK, GRID.hilbert_key(F.col("row_idx"), F.col("col_idx")).alias("hilbert"))


@query(f"SELECT time_idx, row_idx, col_idx FROM ({EACH_SQL}) e")
def nonempty_chunks(spark, sf_dir):
    return lookup.nonempty(GRID.chunks(spark), _pairs(spark, sf_dir))


_PENDING = f"SELECT time_idx, row_idx, col_idx FROM ({EACH_SQL}) e WHERE (row_idx * 7 + col_idx * 13 + time_idx) % 5 <> 0"


@query(_PENDING)
def pending_chunks(spark, sf_dir):
    return lookup.pending(nonempty_chunks(spark, sf_dir), completed(GRID.chunks(spark)))


@query(f"SELECT time_idx, row_idx, col_idx FROM ({_PENDING}) p WHERE time_idx IN (1, 3)")
def work_list(spark, sf_dir):
    return lookup.work_list(spark, tiles(spark, sf_dir), GRID, [*YEARS, 1999], completed(GRID.chunks(spark)))


_WORLD = "least(greatest((({v}) + {half}) / CAST({full} AS DOUBLE) * CAST(65536 AS DOUBLE), 0), 65535)"
_WX = "CAST(trunc(" + _WORLD.format(v="(min_lon + max_lon) / 2", half=180, full=360) + ") AS BIGINT)"
_WY = "CAST(trunc(" + _WORLD.format(v="(min_lat + max_lat) / 2", half=90, full=180) + ") AS BIGINT)"
_KEYED = f"SELECT *, hd AS hilbert FROM ({hilbert_sql(TILES_SQL, _WX, _WY, 16)}) w"


@query(f"SELECT tile_id, hilbert FROM ({_KEYED}) k")
def tile_hilbert_order(spark, sf_dir):
    return lookup.tile_order(tiles(spark, sf_dir)).select("tile_id", "hilbert")


@query(
    f"SELECT time_idx, row_idx, col_idx, tile_hilbert, hd AS chunk_hilbert FROM ("
    + hilbert_sql(
        f"SELECT c.time_idx, c.row_idx, c.col_idx, min(t.hilbert) AS tile_hilbert FROM ({_KEYED}) t JOIN ({BOUNDS_SQL}) c ON {_INSIDE} WHERE (c.row_idx * 7 + c.col_idx * 13 + c.time_idx) % 5 <> 0 GROUP BY 1, 2, 3",
        "col_idx", "row_idx", ORDER,
    )
    + ") h"
)
def tile_publish_order(spark, sf_dir):
    todo = lookup.pending(GRID.chunks(spark), completed(GRID.chunks(spark)))
    return lookup.publish_order(tiles(spark, sf_dir), GRID, todo)


# Coverage and estimates.
COVERAGE_SQL = f"""
SELECT CAST({GRID.num_spatial_chunks * len(GRID.years)} AS BIGINT) AS total_chunks, count(*) AS chunks_with_data, {GRID.num_spatial_chunks * len(GRID.years)} - count(*) AS empty_chunks,
       coalesce(max(n), 0) AS max_tiles_per_chunk, coalesce(avg(n), 0) AS avg_tiles_per_chunk, (SELECT count(*) FROM customer) AS total_input_tiles FROM ({EACH_SQL}) e
"""
_SIZE = 64 * 256 * 256


@query(COVERAGE_SQL)
def coverage_stats(spark, sf_dir):
    return lookup.coverage(_pairs(spark, sf_dir), GRID, tiles(spark, sf_dir))


@query(
    f"SELECT printf('Coverage: %d/%d chunks (%.1f%%), max overlap: %d, avg overlap: %.1f, input tiles: %d', chunks_with_data, total_chunks, chunks_with_data / CAST(total_chunks AS DOUBLE) * 100, max_tiles_per_chunk, avg_tiles_per_chunk, total_input_tiles) AS line FROM ({COVERAGE_SQL}) c"
)
def coverage_text(spark, sf_dir):
    return coverage_stats(spark, sf_dir).select(lookup.coverage_text().alias("line"))


@query(
    f"SELECT CAST({_SIZE} AS BIGINT) AS chunk_bytes, r AS input_bytes, w AS output_bytes, round(w / CAST(1073741824 AS DOUBLE) / CAST(3 AS DOUBLE), 6) AS compressed_gib, round(r / CAST({25 * 2**30} AS DOUBLE), 6) AS seconds "
    f"FROM (SELECT CAST(floor(chunks_with_data * avg_tiles_per_chunk * {_SIZE} + CAST(0.000001 AS DOUBLE)) AS BIGINT) AS r, CAST(chunks_with_data * {_SIZE} AS BIGINT) AS w FROM ({COVERAGE_SQL}) c) e"
)
def size_estimate(spark, sf_dir):
    return lookup.estimates(coverage_stats(spark, sf_dir), GRID)


# Windows and affines.
_OVER = f"SELECT t.tile_id, c.time_idx, c.row_idx, c.col_idx, greatest(c.x0, t.min_lon) AS w, greatest(c.y0, t.min_lat) AS s, least(c.x1, t.max_lon) AS e, least(c.y1, t.max_lat) AS n, t.min_lon AS tw, t.min_lat AS ts, t.max_lon AS te, t.max_lat AS tn FROM {_T} JOIN ({BOUNDS_SQL}) c ON {_TOUCH}"


@query(f"SELECT tile_id, time_idx, row_idx, col_idx, round(w, 6) AS min_x, round(s, 6) AS min_y, round(e, 6) AS max_x, round(n, 6) AS max_y FROM ({_OVER}) o WHERE w < e AND s < n")
def intersect_bounds(spark, sf_dir):
    box = B.intersection(GRID.chunk_bounds(F.col("row_idx"), F.col("col_idx")), B.prefixed())
    cut = _pairs(spark, sf_dir).select("tile_id", *CHUNK, box.alias("box")).filter("box is not null")
    return cut.select("tile_id", *CHUNK, *[F.round(f"box.{k}", 6).alias(k) for k in ("min_x", "min_y", "max_x", "max_y")])


@query(
    f"SELECT tile_id, time_idx, row_idx, col_idx, x, y, greatest(x_end - x, 1) AS width, greatest(y_end - y, 1) AS height FROM (SELECT *, CAST(floor(round((w - tw) / (te - tw) * 1024, 6)) AS BIGINT) AS x, CAST(floor(round((s - ts) / (tn - ts) * 1024, 6)) AS BIGINT) AS y, CAST(ceil(round((e - tw) / (te - tw) * 1024, 6)) AS BIGINT) AS x_end, CAST(ceil(round((n - ts) / (tn - ts) * 1024, 6)) AS BIGINT) AS y_end FROM ({_OVER}) o WHERE w < e AND s < n) p"
)
def pixel_window(spark, sf_dir):
    from lattica.operators import windows

    tw, ts, te, tn = B.prefixed()
    gt = F.struct(((te - tw) / 1024).alias("a"), F.lit(0.0).alias("b"), tw.alias("c"), F.lit(0.0).alias("d"), ((tn - ts) / 1024).alias("e"), ts.alias("f"))
    asked = _pairs(spark, sf_dir).withColumn("gt", gt)
    return windows.planned(asked, GRID, [C.WGS84], 1024, 1024).select("tile_id", *CHUNK, "window.x", "window.y", "window.width", "window.height")


@query(f"SELECT tile_id, k AS x, k AS y, 64 + k AS width, 32 + k AS height FROM (SELECT tile_id, CAST(substr(tile_id, 2) AS BIGINT) % 448 AS k FROM {_T}) q")
def bounds_window_roundtrip(spark, sf_dir):
    k = F.col("k").cast("double")
    rows = tiles(spark, sf_dir).withColumn("k", F.expr("cast(substr(tile_id, 2) as bigint) % 448"))
    box = rows.withColumn("b", B.window_bounds(k, k, k + 64, k + 32, B.prefixed(), 1024, 1024))
    # Half a thousandth of a pixel inside, as bounds on pixel edges may fall to either side.
    px, py = (F.col("max_x") - F.col("min_x")) / 1024 * 0.0005, (F.col("max_y") - F.col("min_y")) / 1024 * 0.0005
    inside = (F.col("b.min_x") + px, F.col("b.min_y") + py, F.col("b.max_x") - px, F.col("b.max_y") - py)
    return box.withColumn("w", B.pixel_window(inside, B.prefixed(), 1024, 1024)).select("tile_id", "w.x", "w.y", "w.width", "w.height")


@query(
    f"SELECT tile_id, round((lon - min_lon) / ((max_lon - min_lon) / 1024), 6) AS px, round((lat - max_lat) / (-(max_lat - min_lat) / 1024), 6) AS py, round(lon, 6) AS wx, round(lat, 6) AS wy, FALSE AS is_bottom_up FROM (SELECT *, min_lon + (max_lon - min_lon) / 4 AS lon, min_lat + (max_lat - min_lat) / 8 AS lat FROM {_T}) q"
)
def affine_world_pixel(spark, sf_dir):
    w, s, e, n = B.prefixed()
    zero = F.lit(0.0)
    matrix = F.array((e - w) / 1024, zero, zero, w, zero, -(n - s) / 1024, zero, n, *[zero] * 7, F.lit(1.0))
    rows = tiles(spark, sf_dir).withColumn("gt", B.affine(matrix))
    gt = F.col("gt")
    px, py = B.world_to_pixel(gt, w + (e - w) / 4, s + (n - s) / 8)
    wx, wy = B.pixel_to_world(gt, px, py)
    return rows.select("tile_id", F.round(px, 6).alias("px"), F.round(py, 6).alias("py"), F.round(wx, 6).alias("wx"), F.round(wy, 6).alias("wy"), B.bottom_up(gt).alias("is_bottom_up"))


# Pixels.
_EMB = "(SELECT vec_id, b - 1 AS band, CAST(embedding[b] AS DOUBLE) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS b FROM embeddings) u)"
_Q = "CAST(least(greatest(round(sqrt(abs(x)) * sign(x) * CAST(127.5 AS DOUBLE)), -127), 127) AS INTEGER)"


def _bands(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.posexplode("embedding").alias("band", "x"))


@query(f"SELECT vec_id, CAST(band AS INTEGER) AS band, {_Q} AS q FROM {_EMB} e")
def quantize(spark, sf_dir):
    return _bands(spark, sf_dir).select("vec_id", "band", scalars.quantise(F.col("x").cast("double")).alias("q"))


@query(f"SELECT vec_id, band, round((q / CAST(127.5 AS DOUBLE)) * (q / CAST(127.5 AS DOUBLE)) * sign(q), 6) AS x FROM (SELECT vec_id, CAST(band AS INTEGER) AS band, {_Q} AS q FROM {_EMB} e) d")
def dequantize(spark, sf_dir):
    return quantize(spark, sf_dir).select("vec_id", "band", F.round(scalars.dequantise(F.col("q")), 6).alias("x"))


MOSAIC_SQL = f"""
SELECT pixel_id, row, col, band, CAST(CASE WHEN n = 0 THEN -128 ELSE round(s / CAST(n AS DOUBLE)) END AS INTEGER) AS value, n FROM (
  SELECT pixel_id, row, col, band, sum(CASE WHEN value <> -128 THEN value ELSE 0 END) AS s, CAST(sum(ok) AS BIGINT) AS n FROM (
    SELECT *, max(CASE WHEN value <> -128 THEN 1 ELSE 0 END) OVER (PARTITION BY pixel_id, src) AS ok FROM ({PIXELS_SQL}) p) f
  GROUP BY 1, 2, 3, 4) g
"""


@query(MOSAIC_SQL)
def mosaic_mean(spark, sf_dir):
    return mosaic.mean_long(pixels(spark, sf_dir))


@query(f"SELECT count(*) FILTER (WHERE value <> -128) AS valid_pixels, count(*) AS pixels FROM ({MOSAIC_SQL}) m")
def valid_pixel_count(spark, sf_dir):
    return mosaic_mean(spark, sf_dir).agg(F.count_if(F.col("value") != scalars.NODATA).alias("valid_pixels"), F.count(F.lit(1)).alias("pixels"))


@query(
    f"""WITH s AS ({PIXELS_SQL}), o AS (SELECT src, row, col, row * 2 AS out_row, col * 2 AS out_col FROM (SELECT DISTINCT src, row, col FROM s) d)
SELECT o.src, o.out_row + a.i AS out_row, o.out_col + b.i AS out_col, s.band, s.value FROM o JOIN (SELECT unnest([0, 1]) AS i, 1 AS k) a ON a.k = 1 JOIN (SELECT unnest([0, 1]) AS i, 1 AS k) b ON b.k = 1 JOIN s ON s.src = o.src AND s.row = o.row AND s.col = o.col"""
)
def nearest_resample(spark, sf_dir):
    """Twice as fine: each output pixel takes the source pixel that its centre is nearest to."""
    source = pixels(spark, sf_dir)
    spots = source.select("src", "row", "col").distinct()
    two = F.array(F.lit(0), F.lit(1))
    out = spots.select("src", (F.col("row") * 2).alias("r"), (F.col("col") * 2).alias("c")).withColumn("i", F.explode(two)).withColumn("j", F.explode(two)).select("src", (F.col("r") + F.col("i")).alias("out_row"), (F.col("c") + F.col("j")).alias("out_col"))
    near = lambda v: F.round((v + 0.5) / 2 - 0.5).cast("int")
    return out.withColumn("row", near(F.col("out_row"))).withColumn("col", near(F.col("out_col"))).join(source, ["src", "row", "col"]).select("src", "out_row", "out_col", "band", "value")


# Metrics.
@query(
    """SELECT event_type, n AS http_requests, round(CASE WHEN elapsed > 0 THEN n / CAST(elapsed AS DOUBLE) ELSE 0 END, 6) AS chunks_per_second, round(CASE WHEN elapsed > 0 THEN v * 1048576 / CAST(1073741824 AS DOUBLE) / elapsed ELSE 0 END, 6) AS read_gib_s,
       round(CASE WHEN n > 0 THEN h / CAST(n AS DOUBLE) * 100 ELSE 0 END, 6) AS hit_rate FROM (
  SELECT event_type, count(*) AS n, date_diff('second', min(ts), max(ts)) AS elapsed, sum(CAST(floor(value) AS BIGINT)) AS v, count(*) FILTER (WHERE user_id % 2 = 0) AS h FROM events GROUP BY 1) g"""
)
def metrics_summary(spark, sf_dir):
    from lattica.plans import metrics

    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    g = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), (F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))).alias("elapsed"), F.sum(F.floor("value")).alias("v"), F.count_if(F.col("user_id") % 2 == 0).alias("h"))
    n, s = F.col("n"), F.col("elapsed")
    return g.select("event_type", n.alias("http_requests"), F.round(metrics.rate(n, s), 6).alias("chunks_per_second"), F.round(metrics.gib_rate(F.col("v") * 1048576, s), 6).alias("read_gib_s"), F.round(metrics.hit_rate(F.col("h"), n - F.col("h")), 6).alias("hit_rate"))


# Projections: a catalogue over all UTM zones, and an equal-area grid.
UTM_CODES = [f"EPSG:{32600 + 100 * south + zone}" for south in (0, 1) for zone in range(1, 61)]
EQUAL_AREA = OutputGrid.over(BOX, C.EASE2, 2500.0, [2020], 64, ChunkShape(1, 64, 256, 256))
_UTM_SQL = """
SELECT *, 'EPSG:' || (32600 + 100 * south + zone) AS crs, CAST(6 * zone - 183 AS DOUBLE) AS meridian, CASE WHEN south = 1 THEN CAST(10000000 AS DOUBLE) ELSE 0 END AS north_at FROM (
  SELECT 'T' || c_custkey AS tile_id, CAST(c_custkey % 60 + 1 AS INTEGER) AS zone, CAST(c_custkey // 60 % 2 AS INTEGER) AS south, CAST(300000 + (c_custkey * 7919 % 4000) * 100 AS DOUBLE) AS x, CAST(1000000 + (c_custkey * 104729 % 700) * 10000 AS DOUBLE) AS y, CAST(c_custkey % 30 AS DOUBLE) / 10 - 2 AS dlon, (c_custkey * 104729 % 1500) / CAST(10 AS DOUBLE) - 75 AS lat FROM customer) k
"""
_FIXED = {k: f"CAST({v!r} AS DOUBLE)" for k, v in {"e": C._E, "e2": C._E2, "m": C.K0 * C._RADIUS, "area": C.EqualArea().scale, "a": C.A}.items()}


def _sum_sql(terms, text: str) -> str:
    """``text`` for each coefficient ``k`` with its number ``j``, added up."""
    return " + ".join(text.format(k=f"CAST({k!r} AS DOUBLE)", j=2 * j) for j, k in enumerate(terms, 1))


def utm_inverse_sql(rows: str) -> str:
    """``rows`` with columns x, y, meridian, north_at: with lon and lat."""
    out = f"SELECT *, (y - north_at) / {_FIXED['m']} AS xi, (x - 500000) / {_FIXED['m']} AS eta FROM ({rows}) i0"
    out = f"SELECT *, xi - ({_sum_sql(C._BETA, '{k} * sin({j} * xi) * cosh({j} * eta)')}) AS u, eta - ({_sum_sql(C._BETA, '{k} * cos({j} * xi) * sinh({j} * eta)')}) AS v FROM ({out}) i1"
    out = f"SELECT *, asin(sin(u) / cosh(v)) AS chi FROM ({out}) i2"
    return f"SELECT *, meridian + degrees(atan2(sinh(v), cos(u))) AS lon_, degrees(chi + {_sum_sql(C._DELTA, '{k} * sin({j} * chi)')}) AS lat_ FROM ({out}) i3"


def utm_forward_sql(rows: str) -> str:
    """``rows`` with columns lon, lat, meridian, north_at: with x and y."""
    out = f"SELECT *, sinh(atanh(sin(radians(lat))) - {_FIXED['e']} * atanh({_FIXED['e']} * sin(radians(lat)))) AS t, radians(lon - meridian) AS turn FROM ({rows}) f0"
    out = f"SELECT *, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(t * t + 1)) AS eta FROM ({out}) f1"
    return f"SELECT *, 500000 + {_FIXED['m']} * (eta + {_sum_sql(C._ALPHA, '{k} * cos({j} * xi) * sinh({j} * eta)')}) AS x_, north_at + {_FIXED['m']} * (xi + {_sum_sql(C._ALPHA, '{k} * sin({j} * xi) * cosh({j} * eta)')}) AS y_ FROM ({out}) f2"


def _utm(spark, sf_dir):
    k = F.col("c_custkey")
    zone, south = (k % 60 + 1).cast("int"), F.floor(k / 60) % 2
    x, y = (300000 + (k * 7919 % 4000) * 100).cast("double"), (1000000 + (k * 104729 % 700) * 10000).cast("double")
    lon, lat = zone * 6.0 - 183 + k % 30 / 10.0 - 2, (k * 104729 % 1500) / 10.0 - 75
    box = (x.alias("min_x"), y.alias("min_y"), (x + 10240).alias("max_x"), (y + 10240).alias("max_y"), lon.alias("min_lon"), lat.alias("min_lat"), (lon + 0.5).alias("max_lon"), (lat + 0.5).alias("max_lat"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("T"), k.cast("string")).alias("tile_id"), F.concat(F.lit("EPSG:"), (32600 + 100 * south + zone).cast("int").cast("string")).alias("crs"), *box)


_CORNERS = [(0, 0), (10240, 0), (10240, 10240), (0, 10240)]
_RING_SQL = " UNION ALL ".join(f"SELECT tile_id, crs, {i} AS corner, x + {dx} AS x, y + {dy} AS y, meridian, north_at FROM utm" for i, (dx, dy) in enumerate([*_CORNERS, _CORNERS[0]]))


@query(f"WITH utm AS ({_UTM_SQL}) SELECT tile_id, crs, corner, round(lon_, 7) AS lon, round(lat_, 7) AS lat FROM ({utm_inverse_sql(_RING_SQL)}) r")
def utm_footprint(spark, sf_dir):
    """Footprints of a catalogue in all 120 zones."""
    rows = catalog.with_footprint(_utm(spark, sf_dir), UTM_CODES).select("tile_id", "crs", F.posexplode("footprint").alias("corner", "p"))
    return rows.select("tile_id", "crs", "corner", F.round("p.lon", 7).alias("lon"), F.round("p.lat", 7).alias("lat"))


_BOX_SQL = " UNION ALL ".join(f"SELECT tile_id, crs, meridian + dlon + {dx} AS lon, lat + {dy} AS lat, meridian, north_at FROM utm" for dx, dy in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5)))


@query(f"WITH utm AS ({_UTM_SQL}) SELECT tile_id, crs, round(min(x_), 3) AS min_x, round(min(y_), 3) AS min_y, round(max(x_), 3) AS max_x, round(max(y_), 3) AS max_y FROM ({utm_forward_sql(_BOX_SQL)}) r GROUP BY 1, 2")
def utm_native_bounds(spark, sf_dir):
    """Geographic bounds in the system of each tile."""
    box = C.bounds_by_code(B.geographic(), F.col("crs"), UTM_CODES)
    return _utm(spark, sf_dir).withColumn("box", box).select("tile_id", "crs", *[F.round(f"box.{k}", 3).alias(k) for k in ("min_x", "min_y", "max_x", "max_y")])


_ER, _EC = EQUAL_AREA.chunk_counts[2:]
_ESTEP = 256 * 2500
_D = lambda v: f"CAST({v!r} AS DOUBLE)"


def _authalic_sql(y: str) -> str:
    e2 = _FIXED["e2"]
    pole = f"((1 - {e2}) * (1 / (1 - {e2}) - ln((1 - {_FIXED['e']}) / (1 + {_FIXED['e']})) / (2 * {_FIXED['e']})))"
    b = f"asin({y} * 2 * {_FIXED['area']} / ({_FIXED['a']} * {pole}))"
    series = (C._E2 / 3 + 31 * C._E2**2 / 180 + 517 * C._E2**3 / 5040, 23 * C._E2**2 / 360 + 251 * C._E2**3 / 3780, 761 * C._E2**3 / 45360)
    return f"degrees({b} + " + _sum_sql(series, "{k} * sin({j} * " + b.replace("{", "").replace("}", "") + ")") + ")"


@query(
    f"""SELECT row_idx, col_idx, round(degrees(x0 / ({_FIXED['a']} * {_FIXED['area']})), 7) AS west, round({_authalic_sql('y0')}, 7) AS south, round(degrees(x1 / ({_FIXED['a']} * {_FIXED['area']})), 7) AS east, round({_authalic_sql('y1')}, 7) AS north FROM (
  SELECT *, greatest(y1 - {_ESTEP}, {_D(EQUAL_AREA.bounds[1])}) AS y0, least(x0 + {_ESTEP}, {_D(EQUAL_AREA.bounds[2])}) AS x1 FROM (
    SELECT CAST(i // {_EC} AS INTEGER) AS row_idx, CAST(i % {_EC} AS INTEGER) AS col_idx, {_D(EQUAL_AREA.bounds[0])} + (i % {_EC}) * {_ESTEP} AS x0, {_D(EQUAL_AREA.bounds[3])} - (i // {_EC}) * {_ESTEP} AS y1 FROM range({_ER * _EC}) r(i)) c) d"""
)
def equal_area_chunks(spark, sf_dir):
    """Geographic bounds of the chunks of an equal-area grid."""
    box = EQUAL_AREA.chunk_bounds_wgs84(F.col("row_idx"), F.col("col_idx"))
    return EQUAL_AREA.chunks(spark).select("row_idx", "col_idx", *[F.round(v, 7).alias(k) for k, v in zip(("west", "south", "east", "north"), box)])


@query()
def projection_roundtrip(spark, sf_dir):
    """Tile corners to the UTM zone that they are in and to equal-area coordinates and back; the largest errors, in degrees."""
    lon, lat = F.col("min_lon"), F.col("min_lat")
    zone = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))
    own = F.concat(F.lit("EPSG:"), (F.when(lat < 0, 32700).otherwise(32600) + zone).cast("int").cast("string"))
    rows = tiles(spark, sf_dir).select(lon, lat, own.alias("utm"), F.lit(C.EASE2).alias("ease2"))
    for name, codes in (("utm", UTM_CODES), ("ease2", [C.EASE2])):
        rows = rows.withColumn("p", C.by_code(lon, lat, F.col(name), codes, False)).withColumn("q", C.by_code(F.col("p.x"), F.col("p.y"), F.col(name), codes, True))
        rows = rows.withColumn(f"error_{name}", F.greatest(F.abs(F.col("q.x") - lon), F.abs(F.col("q.y") - lat)))
    return rows.agg(F.count(F.lit(1)).alias("points"), *[F.max(c).alias(c) for c in ("error_utm", "error_ease2")])
