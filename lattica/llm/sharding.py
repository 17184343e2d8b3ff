"""Sharding by a hierarchical weighted hash tree, in DataFrame operations only.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key, the level and the
child; the smallest draw wins. A child's draw depends on nothing but its own
weight, so a change of weights moves rows only into (or out of) the subtrees
whose weights change. ``default_tree`` opens a new region for shards beyond
full ones: the weights of all others stay, and one more shard that opens a
region takes rows only into itself.

Slots number each shard's rows without a gap; no task sees a whole shard.

Defined results: a null text has no bytes (size 8, crc 0); rows with a null id
share one shard; repeated rows each have a slot of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import blocks_for, numbered, read

SHARDS = 24
RACKS, RACK_SHARDS = 3, 4
SIZE_EXTRA = 8
BLOCK_ROWS = 2000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def default_tree(shards: int) -> list[Leaf]:
    """Regions of ``RACKS`` racks of ``RACK_SHARDS`` shards, filled in order."""
    each = RACKS * RACK_SHARDS
    return [Leaf(s // each, s // RACK_SHARDS, s) for s in range(shards)]


def _children(pairs: list[tuple[int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in pairs])


def _draw(key: Column, level: str, children: Column) -> Column:
    """The child of ``children`` (id, weight) with the smallest draw; ties go to the smaller id."""

    def one(c: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(level), c["id"], key), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / c["w"]).alias("draw"), c["id"].alias("id"))

    return F.array_min(F.transform(children, one))["id"]


def descend(df: DataFrame, key: Column, tree: list[Leaf], name: str) -> DataFrame:
    """``df`` with the shard of each row's ``key``."""
    regions = sorted({x.region for x in tree})
    racks = {r: sorted({x.rack for x in tree if x.region == r}) for r in regions}
    weight = lambda **at: sum(x.weight for x in tree if all(getattr(x, k) == v for k, v in at.items()))
    by_region = F.array(*[_children([(k, weight(region=r, rack=k)) for k in racks[r]]) for r in regions])
    places = [(r, k) for r in regions for k in racks[r]]
    by_rack = F.array(*[_children([(x.shard, x.weight) for x in tree if (x.region, x.rack) == p]) for p in places])
    slot_of = lambda column, values: F.array_position(F.array(*map(F.lit, values)), column).cast("int")
    out = df.withColumn("_region", _draw(key, "region", _children([(r, weight(region=r)) for r in regions])))
    out = out.withColumn("_rack", _draw(key, "rack", F.element_at(by_region, slot_of(F.col("_region"), regions))))
    ids = [r * 1_000_003 + k for r, k in places]
    out = out.withColumn(name, _draw(key, "shard", F.element_at(by_rack, slot_of(F.col("_region") * 1_000_003 + F.col("_rack"), ids))))
    return out.drop("_region", "_rack")


def shard_documents(docs: DataFrame, tree: list[Leaf], grown: list[Leaf]) -> DataFrame:
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(data) + SIZE_EXTRA).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"))
    rows = descend(descend(rows, F.col("doc_id"), tree, "shard"), F.col("doc_id"), grown, "grown_shard")
    blocks = blocks_for(docs.count(), BLOCK_ROWS * len(tree))
    out = numbered(rows, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.col("doc_id"), blocks, "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), default_tree(SHARDS), default_tree(SHARDS + 1))
