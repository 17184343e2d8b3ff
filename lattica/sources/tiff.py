"""A tiled-TIFF reader in NumPy: headers, windows, and a writer for tests.

Only what cloud-optimised pixel tiles use: little- or big-endian classic and
BigTIFF, first directory, 8-bit samples, planar or chunky, no, deflate or zstd
compression, with or without a horizontal predictor. Byte ranges are read
through a function, so a source can be a file, an object store, or bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

# Tag numbers, element types and compression codes of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, SAMPLES, PLANAR, PREDICTOR = 256, 257, 258, 259, 277, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
STRIP_OFFSETS, ROWS_PER_STRIP, STRIP_COUNTS = 273, 278, 279
PIXEL_SCALE, TIEPOINT, TRANSFORMATION = 33550, 33922, 34264
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
NONE, DEFLATE, OLD_DEFLATE, ZSTD, ZSTD_ALT = 1, 8, 32946, 50000, 34926
NODATA = -128

Reader = Callable[[int, int], bytes]


class TiffError(ValueError):
    """The file isn't one that this reader supports."""


@dataclass(frozen=True)
class Header:
    width: int
    height: int
    bands: int
    planar: bool
    tile_width: int
    tile_height: int
    compression: int
    predictor: int
    signed: bool
    offsets: tuple[int, ...]
    counts: tuple[int, ...]
    #: a, b, c, d, e, f of the affine, or None.
    affine: tuple[float, ...] | None

    @property
    def tiles_across(self) -> int:
        return -(-self.width // self.tile_width)

    @property
    def tiles_down(self) -> int:
        return -(-self.height // self.tile_height)


def header(read: Reader) -> Header:
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None:
        raise TiffError("no TIFF byte order mark")
    magic = struct.unpack(order + "H", head[2:4])[0]
    if magic not in (42, 43):
        raise TiffError(f"no TIFF: magic number {magic}")
    big = magic == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    count = struct.unpack(order + ("Q" if big else "H"), read(at, 8 if big else 2))[0]
    size, base = (20, at + 8) if big else (12, at + 2)
    raw = read(base, size * count)
    tags: dict[int, tuple] = {}
    for i in range(count):
        entry = raw[i * size : (i + 1) * size]
        tag, kind = struct.unpack(order + "HH", entry[:4])
        if kind not in TYPES:
            continue
        n = struct.unpack(order + ("Q" if big else "I"), entry[4:12] if big else entry[4:8])[0]
        value, width = entry[12:] if big else entry[8:], struct.calcsize(TYPES[kind]) * n
        if width > len(value):
            value = read(struct.unpack(order + ("Q" if big else "I"), value)[0], width)
        tags[tag] = struct.unpack(f"{order}{n}{TYPES[kind]}", value[:width])
    one = lambda t, default=None: tags[t][0] if t in tags else default
    width, height, bands = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    if not width or not height:
        raise TiffError("no image size")
    if any(b != 8 for b in tags.get(BITS, (8,))) or one(SAMPLE_FORMAT, 1) not in (1, 2):
        raise TiffError("samples must be 8-bit integers")
    tiled = TILE_OFFSETS in tags
    return Header(
        width, height, bands, one(PLANAR, 1) == 2, one(TILE_WIDTH, width), one(TILE_HEIGHT) if tiled else min(one(ROWS_PER_STRIP, height), height), one(COMPRESSION, NONE), one(PREDICTOR, 1), one(SAMPLE_FORMAT, 1) == 2,
        tags.get(TILE_OFFSETS if tiled else STRIP_OFFSETS, ()), tags.get(TILE_COUNTS if tiled else STRIP_COUNTS, ()), _affine(tags),
    )


def _affine(tags: dict[int, tuple]) -> tuple[float, ...] | None:
    """From the transformation matrix, else from a tie point and the pixel scale."""
    m = tags.get(TRANSFORMATION, ())
    if len(m) >= 8:
        return m[0], m[1], m[3], m[4], m[5], m[7]
    scale, tie = tags.get(PIXEL_SCALE, ()), tags.get(TIEPOINT, ())
    if len(scale) >= 2 and len(tie) >= 6:
        return scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1]
    return None


def _decoded(h: Header, raw: bytes, rows: int) -> np.ndarray:
    """One stored tile as (samples, rows, columns) int8; the last strip of an image may be shorter."""
    if h.compression in (ZSTD, ZSTD_ALT):
        import zstandard

        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    elif h.compression in (DEFLATE, OLD_DEFLATE):
        raw = zlib.decompress(raw)
    elif h.compression != NONE:
        raise TiffError(f"compression {h.compression} is not supported")
    samples = 1 if h.planar else h.bands
    if len(raw) < rows * h.tile_width * samples:
        raise TiffError(f"a tile has {len(raw)} bytes; {rows * h.tile_width * samples} are needed")
    data = np.frombuffer(raw, np.uint8)[: rows * h.tile_width * samples].reshape(rows, h.tile_width, samples)
    if h.predictor == 2:
        data = np.cumsum(data, 1, dtype=np.uint8)
    return data.transpose(2, 0, 1).view(np.int8) if data.flags["C_CONTIGUOUS"] else np.ascontiguousarray(data.transpose(2, 0, 1)).view(np.int8)


def window(read: Reader, h: Header, x: int, y: int, width: int, height: int) -> np.ndarray:
    """Pixels (bands, height, width) as int8; tiles of one row that lie side by side are read at once."""
    if x < 0 or y < 0 or width <= 0 or height <= 0 or x + width > h.width or y + height > h.height:
        raise TiffError(f"window {x},{y} {width}x{height} is outside the image of {h.width}x{h.height}")
    out = np.full((h.bands, height, width), NODATA, np.int8)
    tx0, tx1 = x // h.tile_width, (x + width - 1) // h.tile_width
    for ty in range(y // h.tile_height, (y + height - 1) // h.tile_height + 1):
        rows = h.tile_height if h.tile_width != h.width or h.tile_height * (ty + 1) <= h.height else h.height - h.tile_height * ty
        for plane in range(h.bands if h.planar else 1):
            first = (plane * h.tiles_down + ty) * h.tiles_across
            index = range(first + tx0, first + tx1 + 1)
            for i, raw in zip(index, _ranges(read, [(h.offsets[i], h.counts[i]) for i in index])):
                tile = _decoded(h, raw, rows)
                px, py = (i - first) * h.tile_width, ty * h.tile_height
                x0, x1, y0, y1 = max(x, px), min(x + width, px + h.tile_width, h.width), max(y, py), min(y + height, py + rows, h.height)
                bands = slice(plane, plane + 1) if h.planar else slice(None)
                out[bands, y0 - y : y1 - y, x0 - x : x1 - x] = tile[:, y0 - py : y1 - py, x0 - px : x1 - px]
    return out


def _ranges(read: Reader, spans: list[tuple[int, int]]) -> list[bytes]:
    """Bytes of spans; neighbours are read in one request."""
    out: list[bytes] = []
    k = 0
    while k < len(spans):
        j, end = k, spans[k][0] + spans[k][1]
        while j + 1 < len(spans) and spans[j + 1][0] == end:
            j += 1
            end += spans[j][1]
        raw = read(spans[k][0], end - spans[k][0])
        out += [raw[o - spans[k][0] : o - spans[k][0] + n] for o, n in spans[k : j + 1]]
        k = j + 1
    return out


def file_reader(path: str) -> Reader:
    """Ranges of a local file."""

    def read(offset: int, size: int) -> bytes:
        with open(path, "rb") as f:
            f.seek(offset)
            return f.read(size)

    return read


def arrow_reader(path: str) -> Reader:
    """Ranges of a file at any address that Arrow's file systems know."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    f = system.open_input_file(inner)

    def read(offset: int, size: int) -> bytes:
        return f.read_at(size, offset)

    return read


def reader(path: str) -> Reader:
    return arrow_reader(path.replace("s3a://", "s3://")) if "://" in path else file_reader(path)


def write(path: str, data: np.ndarray, affine: tuple[float, ...] | None, tile: int = 16, planar: bool = True, compression: int = ZSTD) -> None:
    """A tiled file of int8 or uint8 ``data`` (bands, height, width), for fixtures."""
    import zstandard

    bands, height, width = data.shape
    down, across = -(-height // tile), -(-width // tile)
    padded = np.zeros((bands, down * tile, across * tile), data.dtype)
    padded[:, :height, :width] = data
    cut = lambda planes, r, c: planes[:, r * tile : (r + 1) * tile, c * tile : (c + 1) * tile].transpose(1, 2, 0).tobytes()
    groups = [padded[b : b + 1] for b in range(bands)] if planar else [padded]
    pack = {NONE: bytes, DEFLATE: zlib.compress, ZSTD: zstandard.ZstdCompressor().compress}[compression]
    blobs = [pack(cut(g, r, c)) for g in groups for r in range(down) for c in range(across)]
    entries = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8] * bands), (COMPRESSION, 3, [compression]), (SAMPLES, 3, [bands]), (PLANAR, 3, [2 if planar else 1]), (TILE_WIDTH, 3, [tile]), (TILE_HEIGHT, 3, [tile])]
    entries += [(TILE_OFFSETS, 4, [0] * len(blobs)), (TILE_COUNTS, 4, [len(b) for b in blobs]), (SAMPLE_FORMAT, 3, [2 if data.dtype == np.int8 else 1] * bands)]
    if affine:
        a, b, c, d, e, f = affine
        entries.append((TRANSFORMATION, 12, [a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]))
    extra_at = 8 + 2 + 12 * len(entries) + 4
    sizes = [struct.calcsize(TYPES[k]) * len(v) for _, k, v in entries]
    start = extra_at + sum(n for n in sizes if n > 4)
    offsets = [start + sum(map(len, blobs[:i])) for i in range(len(blobs))]
    directory, extra = b"", b""
    for (tag, kind, values), size in zip(entries, sizes):
        raw = struct.pack(f"<{len(values)}{TYPES[kind]}", *(offsets if tag == TILE_OFFSETS else values))
        directory += struct.pack("<HHI", tag, kind, len(values)) + (raw.ljust(4, b"\0") if size <= 4 else struct.pack("<I", extra_at + len(extra)))
        extra += raw if size > 4 else b""
    with open(path, "wb") as out:
        out.write(struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(entries)) + directory + b"\0\0\0\0" + extra + b"".join(blobs))
