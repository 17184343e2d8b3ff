"""Shared helpers of the training-data operators.

Everything here is DataFrame code. Lineage is cut with tables written to the
folder that the session names in ``spark.checkpoint.dir``; that folder is
shared, so a lost executor costs a re-read and no recomputation.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import count

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that a group may hold when one task sorts or compares it whole.
GROUP_ROWS = 4096
#: Bytes of a batch that goes to a Python worker, about; it ends with the row that fills it.
BATCH_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder of its own only where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="lattica-")
        named = _own_dirs[app]
    return named.rstrip("/")


_open = threading.local()


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Collects the tables that ``cut`` writes meanwhile, for a caller that knows when they are no longer read."""
    stack = _open.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield stack[-1]
    finally:
        stack.pop()


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def cut(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one copy of the work, no lineage.

    The table goes with ``drop_cut``, or at the latest when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lattica-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, at = _hadoop(spark, path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._lattica_path = path
    if stack := _open.__dict__.get("stack"):
        stack[-1].append(out)
    return out


def drop_cut(*tables: DataFrame | None) -> None:
    """Delete tables that ``cut`` wrote, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_lattica_path", None):
            files, at = _hadoop(df.sparkSession, path)
            files.delete(at, True)


def room(values: np.ndarray, n: int) -> np.ndarray:
    """``values`` with room for ``n`` rows, doubled when it is full."""
    return values if n <= len(values) else np.concatenate([values, np.zeros((max(n, 2 * len(values)) - len(values), *values.shape[1:]), values.dtype)])


class Words:
    """Numbers of the words that a worker remembers, in order of arrival; those that come again stay when it is full."""

    def __init__(self, most: int):
        self.most, self.known, self.uses = most, {"": 0}, np.zeros(1 << 12, np.int32)

    def __len__(self) -> int:
        return len(self.known)

    def new(self, words: Iterable[str]) -> list[str]:
        return sorted(set(words).difference(self.known))

    def add(self, words: Iterable[str]) -> int:
        """The number of the first of these new words."""
        at = len(self.known)
        self.known.update(zip(words, count(at)))
        self.uses = room(self.uses, len(self.known))
        return at

    def find(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.uses[out] += 1
        return out

    def forget(self) -> np.ndarray | None:
        """If it is full: the old numbers of the words that stay, in order of their new ones."""
        if len(self.known) <= self.most:
            return None
        least, uses = 2, self.uses[: len(self.known)]
        uses[0] = np.iinfo(np.int32).max
        while (uses >= least).sum() > self.most // 2:
            least *= 2
        kept, words = np.flatnonzero(uses >= least), list(self.known)
        self.known = {words[i]: n for n, i in enumerate(kept)}
        self.uses = uses[kept] >> 1
        return kept


_held: dict = {}


def held_by_worker(key, make):
    """What ``make`` gives for ``key``, kept for the next tasks of this Python worker; one object at a time, so that stages don't add up."""
    if key not in _held:
        release_worker()
        _held[key] = make()
    return _held[key]


def release_worker() -> None:
    """Give back what this Python worker holds from earlier tasks, and its free pages: idle workers share an executor's memory with the stages to come."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let batches of this session hold about ``most`` bytes from here on, if they may hold more.

    A batch stands in the executor's memory beside the heap, with room to grow, and in the worker again. By Spark's
    defaults it holds all texts of a task, and what the JVM frees of buffers that large it keeps.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)))
    if now > most:
        spark.conf.set(name, f"{most}b")


def free(columns: list[str], name: str) -> str:
    """``name``, or what stands for it where a column has it, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row id, written, so that it stays the same wherever it is read."""
    return cut(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def bounded_count(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than it needs to know."""
    return df.limit(limit + 1).count() <= limit


def joinable(df: DataFrame, limit: int = 500_000) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few, else as it is (a shuffled join)."""
    return F.broadcast(df) if bounded_count(df, limit) else df


def blocks_for(rows: int, per_block: int = 20_000) -> int:
    return max(1, -(-rows // per_block))


def numbered(df: DataFrame, by: list[str], order: list[Column], spread: Column, blocks: int, name: str) -> DataFrame:
    """Gapless numbers from 0 within each ``by`` group, without a task that sees a whole group.

    Rows are dealt into ``blocks`` sub-groups by ``spread``; each sub-group is
    numbered in its own task and shifted by the sizes of those before it.
    """
    dealt = df.withColumn("_blk", F.pmod(F.xxhash64(spread), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy(*by, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*by, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy(*by, "_blk").orderBy(*order)
    return (
        dealt.withColumn("_at", F.row_number().over(within) - 1)
        .join(joinable(shift), [*by, "_blk"])
        .withColumn(name, (F.col("_at") + F.col("_shift")).cast("long"))
        .drop("_blk", "_at", "_shift")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``(node, root)``, root the smallest node.

    Alternating large-star and small-star steps, each a pre-aggregated minimum
    and one join; a star's centre, however large, is split by adaptive joins.
    Rounds go on until the edges are what they were, so the result is whole.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            out = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            down = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            low = down.groupBy("u").agg(F.min("v").alias("m"))
            out = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        return out.filter("a <> b").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.select("a", "b").filter("a <> b").distinct(), "cc")
    seen = mark(now)
    was = None
    while was != seen:
        nxt = cut(star(star(now, True), False), "cc")
        drop_cut(now)
        now, was, seen = nxt, seen, mark(nxt)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())
