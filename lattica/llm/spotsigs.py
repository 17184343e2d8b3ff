"""SpotSigs fingerprints, in DataFrame operations only.

A spot signature is a common word (the anchor) with the chain of the next
``CHAIN`` content words after it, common words skipped. A text's fingerprint is
its set of signatures; so that lists and tables, which lack common words, have
spots as well, one content word in ``PICKED``, chosen by its hash, is an anchor
too. Two fingerprints are compared by Jaccard likeness. A text without a spot
has one signature, its own hash.

``near_classes`` finds which fingerprints are alike from a likeness on. Of a set of
n signatures the first n - ceil(likeness * n) + 1 in an order common to all,
in which the most frequent ones of a bounded sample come last, meet those of
each partner. They are an index, partitioned by set length into bands such that
a set's partners are in its own or a neighbouring band. In each posting list
the members are compared with one of them, pruned by length and by what their
prefixes share, and verified with the exact likeness of whole sets; then members of different classes are
compared with each other. So a list of copies costs as many comparisons as it
has members, and no link between classes is lost; a list of texts that share a
passage and are not alike costs as many as it has pairs.

The edited text of a document takes code points of the next document in order
of ids. Documents are dealt into blocks of neighbouring ids; the first of each
block also visits the block before, so texts are shuffled once. Rows of one id,
or of none, that are too many for a block are dealt into several.

Defined results: null texts are empty; a repeated row is a document of its
own, next to its twin; rows that share an id stand in any order; one document
alone is its own next one; an empty table gives no rows; null ids come first;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattica.llm.common import components, cut, joinable, read

CHAIN = 2
PICKED = 8
BLOCK_DOCS = 512
#: Blocks of neighbouring ids are made narrower while one has more documents than this.
BLOCK_MOST = 8 * BLOCK_DOCS
#: Documents of a task of blocks, about.
TASK_DOCS = 4096
SIMILARITY = 0.8
#: Documents, about, whose signatures are counted for the order; those in more than one of ``RARE`` of them, ``OFTEN`` at most, come last.
SAMPLE_DOCS, RARE, OFTEN = 20_000, 1000, 1024
# Fixed list: very common words of four languages, the anchors.
COMMON = (
    "the of and to a in is that for it on with as are was by be this from at or an have not "
    "le la les de des du un une et que qui dans pour par sur est en au aux avec ce il elle ne pas plus "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus "
    "el los las y del se por con una su para como más al lo o pero sus"
).split()
COMMON = sorted(set(COMMON))


def signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the distinct signature hashes of ``text`` (not null)."""
    words, content = F.col("_w"), F.col("_c")
    out = df.withColumn("_w", F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), 0))
    out = out.withColumn("_c", F.filter(words, lambda w: ~w.isin(COMMON)))
    anchors = F.filter(F.transform(words, lambda w, i: F.when(w.isin(COMMON), i)), lambda i: i.isNotNull())
    # Before the n-th anchor, at place i, there are i - n content words.
    chain = lambda i, n: F.xxhash64(F.get(words, i), *[F.get(content, i - n + k) for k in range(CHAIN)])
    spots = F.transform(anchors, lambda i, n: F.when(i - n + CHAIN <= F.size(content), chain(i, n)))
    picked = F.transform(content, lambda w, j: F.when((F.pmod(F.xxhash64(w), F.lit(PICKED)) == 0) & (j + CHAIN < F.size(content)), F.xxhash64(F.lit(""), w, *[F.get(content, j + 1 + k) for k in range(CHAIN)])))
    found = F.array_distinct(F.filter(F.concat(spots, picked), lambda h: h.isNotNull()))
    out = out.withColumn("_s", found).withColumn(name, F.when(F.size("_s") > 0, F.col("_s")).otherwise(F.array(F.xxhash64(F.lit("whole"), F.col(text)))))
    return out.drop("_w", "_c", "_s")


def digest(signatures: Column) -> Column:
    """A set of signatures as 32 hex digits."""
    ordered = F.sort_array(signatures)
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(ordered)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), ordered)), 16, "0")))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness, or 0 without an intersection where lengths bound it below ``least``."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(low < least * high, F.lit(0.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, uid)`` of ``docs``, whose rows come in the same order each time they are read, as those of files do."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("uid"))


def with_next(docs: DataFrame) -> DataFrame:
    """``(uid, doc_id, text, sigs, next_text, next_sigs)``: each document beside the next one, the first after the last."""
    rows = numbered_rows(docs)
    ids = rows.select("doc_id", "uid")
    low, high, n, none = ids.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    low, high = low or 0, high or 0
    hot = {r["doc_id"]: r["n"] for r in ids.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK_MOST // 2).collect()}
    known = F.array(*[F.lit(h) for h in sorted(hot)]).cast("array<bigint>")
    is_hot = F.array_contains(known, F.col("doc_id")) if hot else F.lit(False)
    deals = F.when(F.col("doc_id").isNull(), max(1, -(-none // BLOCK_DOCS)))
    for h, m in hot.items():
        deals = deals.when(F.col("doc_id") == h, -(-m // BLOCK_DOCS))
    segment = F.size(F.filter(known, lambda h: h < F.col("doc_id"))) * 2 + is_hot.cast("int") if hot else F.lit(0)
    bucket = F.pmod(F.xxhash64("uid"), deals.otherwise(1))
    place = lambda width: F.coalesce(F.floor((F.col("doc_id") - low) / F.lit(width)).cast("long"), F.lit(-1).cast("long"))
    width = max(1, math.ceil((high - low + 1) / max(1, n) * BLOCK_DOCS))
    plain = ids.filter(F.col("doc_id").isNotNull() & ~is_hot)
    while width > 1 and (plain.groupBy(place(width).alias("b")).count().agg(F.max("count")).first()[0] or 0) > BLOCK_MOST:
        width = max(1, width // 16)
    block = F.struct(place(width).alias("p"), F.coalesce(segment, F.lit(0)).alias("s"), bucket.cast("long").alias("k")).alias("blk")
    firsts = ids.groupBy(block).agg(F.min(F.struct("doc_id", "uid")).alias("first")).select("blk", "first.uid")
    # The block before each block, in two levels; the outer one has a row for some 4096 blocks.
    group = F.floor(F.col("blk.p") / 4096)
    inner = firsts.withColumn("_g", group).withColumn("prev", F.lag("blk").over(Window.partitionBy("_g").orderBy("blk")))
    outer = firsts.groupBy(group.alias("_g")).agg(F.max("blk").alias("_last"))
    last = outer.agg(F.max("_last")).first()[0]
    end = F.struct(*[F.lit(v).cast(t).alias(c) for c, t, v in zip("psk", ("long", "int", "long"), last)]) if last else F.lit(None).cast("struct<p:bigint,s:int,k:bigint>")
    outer = outer.withColumn("_before", F.lag("_last").over(Window.orderBy("_g")))
    before = inner.join(outer, "_g").select("uid", F.coalesce("prev", "_before", end).alias("prev"))
    marked = rows.join(joinable(before, 2_000_000), "uid", "left")
    homes = F.array(F.struct(block, F.lit(0).alias("guest")))
    dealt = marked.select("doc_id", "text", "uid", F.inline(F.when(F.col("prev").isNotNull(), F.concat(homes, F.array(F.struct(F.col("prev").alias("blk"), F.lit(1).alias("guest"))))).otherwise(homes)))
    dealt = dealt.repartition(max(1, -(-n // TASK_DOCS)), "blk")
    order = Window.partitionBy("blk").orderBy("guest", F.col("doc_id").asc_nulls_first(), "uid")
    both = signatures(dealt, "text", "sigs").withColumn("next_text", F.lead("text").over(order)).withColumn("next_sigs", F.lead("sigs").over(order))
    return both.filter("guest = 0").drop("guest", "blk")


def frequent(docs: DataFrame, n: int) -> list[int]:
    """The signatures that more than one in ``RARE`` of a sample of about ``SAMPLE_DOCS`` documents has, ``OFTEN`` at most; they decide the order of the index, not what it finds."""
    some = numbered_rows(docs).filter(F.pmod(F.xxhash64("uid", F.lit("sample")), F.lit(max(1, n // SAMPLE_DOCS))) == 0)
    # An inner explode would have its filter made of the whole expression, evaluated again for each word.
    counted = signatures(some.select("text"), "text", "sigs").select(F.explode_outer("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    least = max(4, min(n, SAMPLE_DOCS) // RARE)
    return [r["sig"] for r in counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "sig").limit(OFTEN).select("sig").collect()]


def prefix(sigs: Column, last: list[int], similarity: float) -> Column:
    """The first signatures of a set, enough to meet those of each partner; those in ``last`` come last."""
    some = F.size(sigs) - F.ceil(F.lit(similarity) * F.size(sigs) - 1e-9).cast("int") + 1
    order = F.sort_array(sigs)
    if last:
        held = F.array_intersect(sigs, F.array(*map(F.lit, last)).cast("array<bigint>"))
        order = F.concat(F.sort_array(F.array_except(sigs, held)), F.sort_array(held))
    return F.slice(order, F.lit(1), some)


def classes(docs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(f1, f2, class_id)``: the smallest id of the documents that are alike; ``sets(uid, doc_id, f1, f2, n, prefix)`` are the written fingerprints of ``docs``."""
    first = cut(sets.groupBy("f1", "f2").agg(F.min("uid").alias("u"), F.min("doc_id").alias("doc_id")), "sets")
    # 48 bits tell lists apart well enough: whole sets decide.
    heads = sets.join(joinable(first.select(F.col("u").alias("uid")), 1_000_000), "uid", "left_semi").select(F.col("uid").alias("u"), "n", "prefix")
    rows = heads.select("u", "n", F.explode("prefix").alias("sig")).select("u", "n", F.col("sig").bitwiseAND(F.lit((1 << 48) - 1)).alias("sig"))
    often = cut(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("sig"), "often")
    band = F.floor(F.log("n") / math.log(1 / similarity) + 1e-9)
    lists = cut(rows.join(often, "sig").select("sig", F.explode(F.array(band, band + 1)).alias("band"), "u", "n").distinct(), "lists")
    key = ["sig", "band"]
    # Prefixes as integers; what falls together in that is counted as lost.
    short = F.transform("prefix", lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    heads = heads.join(joinable(lists.select("u").distinct(), 1_000_000), "u", "left_semi").select("u", "n", short.alias("h"), (F.size("prefix") - F.size(F.array_distinct(short))).alias("lost"))
    heads = cut(heads, "heads")

    def alike(pairs: DataFrame) -> DataFrame:
        """Links among ``pairs(a, b)``. Signatures that two sets share lie in both prefixes or behind the one that ends first, which bounds the likeness before whole sets are read."""
        held = joinable(heads, 250_000)
        side = lambda x: held.select(F.col("u").alias(x), F.col("n").alias(f"n{x}"), F.col("h").alias(f"h{x}"), F.col("lost").alias(f"l{x}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        behind = F.greatest(F.ceil(F.lit(similarity) * F.col("na") - 1e-9), F.ceil(F.lit(similarity) * F.col("nb") - 1e-9)) - 1
        most = F.size(F.array_intersect("ha", "hb")) + F.col("la") + F.col("lb") + behind
        left = cut(both.filter(most >= similarity / (1 + similarity) * (F.col("na") + F.col("nb")) - 1e-6).select("a", "b"), "candidates")
        ids = left.select(F.col("a").alias("uid")).union(left.select("b")).distinct()
        whole = cut(signatures(numbered_rows(docs).join(joinable(ids, 1_000_000), "uid", "left_semi").select("uid", "text"), "text", "sigs").select("uid", "sigs"), "whole")
        one, two = (whole.select(F.col("uid").alias(x), F.col("sigs").alias(f"s{x}")) for x in "ab")
        return cut(left.join(one, "a").join(two, "b").filter(likeness(F.col("sa"), F.col("sb"), similarity) >= similarity).select("a", "b"), "links")

    near = lambda x, y: (F.col(x) >= similarity * F.col(y) - 1e-9) & (F.col(y) >= similarity * F.col(x) - 1e-9)
    centre = cut(lists.groupBy(*key).agg(F.min(F.struct("u", "n")).alias("c"), F.count(F.lit(1)).alias("m")).filter("m > 1").select(*key, F.col("c.u").alias("a"), F.col("c.n").alias("na")), "centres")
    links = alike(lists.join(centre, key).filter((F.col("u") != F.col("a")) & near("n", "na")).select("a", F.col("u").alias("b")).distinct())
    roots = cut(components(links), "roots")
    # Lists that hold several classes: members outside the largest are compared with all of other classes.
    own = cut(lists.join(centre.select(key), key, "left_semi").join(roots.withColumnRenamed("node", "u"), "u", "left").withColumn("root", F.coalesce("root", "u")), "own")
    parts = own.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("m")).groupBy(*key).agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", "m").alias("main")).filter("parts > 1")
    parts = cut(parts.select(*key, "main"), "parts")
    left = own.join(parts, key).filter("root <> main").select(*key, F.col("u").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    right = own.join(parts.select(key), key, "left_semi").select(*key, F.col("u").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    more = cut(left, "left").join(right, key).filter((F.col("ra") != F.col("rb")) & near("na", "nb"))
    more = alike(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not more.isEmpty():
        roots = cut(components(links.union(more)), "roots")
    named = first.select("f1", "f2", "u", "doc_id").join(roots.withColumnRenamed("node", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))
    named = cut(named, "named")
    return named.join(named.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("f1", "f2", "class_id")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id)`` of every row of ``docs(doc_id, text)``: the smallest id that is alike, from ``similarity`` on."""
    order = frequent(docs, docs.count())
    made = signatures(numbered_rows(docs), "text", "sigs")
    f1, f2 = (F.xxhash64(*seed, F.sort_array("sigs")) for seed in ((), (F.lit(1),)))
    made = cut(made.select("uid", "doc_id", f1.alias("f1"), f2.alias("f2"), F.size("sigs").alias("n"), prefix(F.col("sigs"), order, similarity).alias("prefix")), "spots")
    return made.select("doc_id", "f1", "f2").join(classes(docs, made, similarity), ["f1", "f2"]).select("doc_id", "class_id")


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each of ``docs(doc_id, text)``: its fingerprint and its edited text's, their likeness, and that to the next document's."""
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    return signatures(rows, "edited", "edited_sigs").select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digest(F.col("sigs")).alias("fingerprint"), digest(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
