"""Line deduplication with a suffix array over line ids, in DataFrame operations only.

Every line that isn't blank is a symbol; documents stand in the order of their
ids. The suffix array comes from prefix doubling: in round k each place whose
next 2**k lines occur at least twice has a rank, equal for equal runs and in
their order; the pair of ranks at a place and 2**k lines on is sorted for the
next round. Places whose run is unique are settled and leave, so each round
works on what still repeats, and rounds end with the longest repeated run.

Each rank class is an interval of the suffix array whose longest common prefix
is at least 2**k. A place that isn't the earliest of its class begins a later
copy; the deepest such class names the copied source, and the longest common
prefix with it, found exactly by going down the levels again, is the maximal
run at that place. A line is deleted if it has ``MIN_WORDS`` words and occurs
earlier, or if it lies in a run of two or more lines that occurs earlier;
neighbouring deleted lines form one span. A text of which blank lines alone remain goes whole.

Ranks are made with a range partition and a sort of distinct keys, counted
with partial aggregates: one line that fills a third of all rows is one key.

Defined results: null and empty texts have no lines; lines are compared
without white space at their ends; each row is a document of its own, in the
order of ids (null ids last), texts and rows, so of repeated rows one stays
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattica.llm.common import cut, drop_cut, free, read, with_rows

MIN_WORDS = 5
STRIDE = 32


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with numbers that rise with ``order``: a range partition, a sort, and the row's number in its partition."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())


def gapless(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """As ``ranked``, numbers from 0 without a gap; one row a partition is summed up."""
    rough = cut(ranked(df, order, "_r"), "order")
    part = F.shiftright("_r", 33)
    sizes = rough.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    return rough.withColumn("_p", part).join(F.broadcast(shift), "_p").withColumn(name, F.col("_s") + F.col("_r").bitwiseAND(F.lit((1 << 33) - 1))).drop("_p", "_s", "_r")


def lines(docs: DataFrame, row: str | None = None) -> DataFrame:
    """``(doc_id, th, uid, i, start, chars, words, h1, h2)``: lines that aren't blank, ``i`` their number among those; ``uid`` is the column ``row``, if that is named."""
    zero, add = F.lit(0).cast("long"), lambda a, x: a + x
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (F.col(row) if row else F.monotonically_increasing_id()).alias("uid")).filter("text is not null and text <> ''")
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), "uid", F.split("text", "\n", -1).alias("u"))
    rows = rows.withColumn("n", F.transform("u", lambda x: F.length(x).cast("long") + 1))
    rows = rows.withColumn("b", F.transform(F.sequence(F.lit(0), F.ceil(F.size("n") / STRIDE).cast("int") - 1), lambda b: F.aggregate(F.slice("n", b * STRIDE + 1, F.lit(STRIDE)), zero, add)))
    rows = rows.withColumn("p", F.transform("b", lambda x, i: F.aggregate(F.slice("b", F.lit(1), i), zero, add)))

    def line(x: Column, i: Column) -> Column:
        block = F.floor(i / STRIDE).cast("int")
        start = F.get("p", block) + F.aggregate(F.slice("n", block * STRIDE + 1, i % STRIDE), zero, add)
        return F.struct(start.alias("start"), F.length(x).cast("long").alias("chars"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("line"))

    kept = F.filter(F.transform("u", line), lambda x: x["line"] != "")
    rows = rows.select("doc_id", "th", "uid", F.posexplode(kept).alias("i", "x")).select("doc_id", "th", "uid", F.col("i").cast("long").alias("i"), "x.*")
    words = F.regexp_count(F.col("line"), F.lit(r"\s+")) + 1
    return rows.select("doc_id", "th", "uid", "i", "start", "chars", words.alias("words"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _classes(pairs: DataFrame, key: list[str]) -> DataFrame:
    """``(pos, r, first)`` of the places whose key occurs at least twice; r rises with the key."""
    twice = pairs.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).filter("n > 1").drop("n")
    return pairs.join(ranked(twice, key, "r"), key).select("pos", "r", "first")


def suffix_classes(places: DataFrame) -> list[DataFrame]:
    """By level ``(pos, r, first)``: the places whose run of 2**level lines occurs at least twice, its rank and its first place.

    ``places(pos, h1, h2)`` are the lines.
    """
    found, now = [], cut(_classes(places, ["h1", "h2"]), "suffix")
    while not now.isEmpty():
        found.append(now)
        on = now.select((F.col("pos") - (1 << (len(found) - 1))).alias("pos"), F.col("r").alias("r2"))
        now = cut(_classes(now.select("pos", F.col("r").alias("r1")).join(on, "pos"), ["r1", "r2"]), "suffix")
    drop_cut(now)
    return found


def common_runs(pairs: DataFrame, classes: list[DataFrame]) -> DataFrame:
    """``pairs(a, b, level, ...)`` with ``run_lines``, the longest common prefix of the places ``a`` and ``b``, which share 2**level lines and not twice as many."""
    out = pairs.withColumn("run_lines", F.expr("shiftleft(cast(1 as bigint), level)"))
    for k in range(len(classes) - 2, -1, -1):
        ranks = classes[k].select("pos", "r")
        # Pairs that parted above this level have a place that is none.
        on = lambda at: F.when(F.col("level") > k, F.col(at) + F.col("run_lines")).otherwise(-F.col("a") - 1)  # noqa: B023, E731
        both = out.withColumn("pa", on("a")).withColumn("pb", on("b"))
        both = both.join(ranks.select(F.col("pos").alias("pa"), F.col("r").alias("ra")), "pa", "left").join(ranks.select(F.col("pos").alias("pb"), F.col("r").alias("rb")), "pb", "left")
        was, out = out, cut(both.withColumn("run_lines", F.col("run_lines") + F.when(F.col("ra") == F.col("rb"), 1 << k).otherwise(0)).select(out.columns), "runs")
        drop_cut(was)
    return out


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, row: str | None = None) -> DataFrame:
    """Deleted spans: ``(doc_id, start, end, lines, words, run_lines, first_doc_id)``, and the column ``row`` if that is named.

    ``run_lines`` has the length of the maximal run at the span's beginning, ``first_doc_id`` the document that has it first.
    """
    every = cut(lines(docs, row), "lines")
    known = gapless(every.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("th").alias("th")).withColumn("_none", F.col("doc_id").isNull()), ["_none", "doc_id", "th", "uid"], "d")
    known = cut(known.select("uid", "d", "doc_id"), "docs")
    # A place is document * 2**bits + line; the longest document leaves one place free after its last line.
    bits = ((every.agg(F.max("i")).first()[0] or 0) + 2).bit_length()
    if bits + known.count().bit_length() > 62:
        raise ValueError("the lines of these documents can't be numbered in 62 bits")
    at = cut(every.join(known.select("uid", "d"), "uid").select((F.shiftleft("d", bits) + F.col("i")).alias("pos"), "start", "chars", "words", "h1", "h2"), "places")
    drop_cut(every)
    classes = suffix_classes(at.select("pos", "h1", "h2"))
    later = at.select("pos").filter(F.lit(False)).select("pos", F.lit(0).alias("level"), F.col("pos").alias("first"))
    for level, found in enumerate(classes):
        later = later.union(found.filter("first < pos").select("pos", F.lit(level).alias("level"), "first"))
    # Every later place is one line at least; those of two lines cover the next line as well.
    alone = later.filter("level = 0").select("pos", F.lit(False).alias("run"))
    pair = later.filter("level = 1").select(F.explode(F.array(F.col("pos"), F.col("pos") + 1)).alias("pos"), F.lit(True).alias("run"))
    marked = alone.union(pair).groupBy("pos").agg(F.max("run").alias("run"))
    gone = at.select("pos", "start", "chars", "words").join(marked, "pos").filter(F.col("run") | (F.col("words") >= min_words))
    island = gone.withColumn("d", F.shiftright("pos", bits)).withColumn("_run", F.col("pos") - F.row_number().over(Window.partitionBy("d").orderBy("pos")))
    spans = island.groupBy("d", "_run").agg(F.min("pos").alias("a"), F.min("start").alias("start"), F.max(F.col("start") + F.col("chars")).alias("end"), F.count(F.lit(1)).alias("lines"), F.sum("words").cast("long").alias("words")).drop("_run")
    spans = cut(spans, "spans")
    deep = later.join(spans.select(F.col("a").alias("pos")), "pos", "left_semi").groupBy("pos").agg(F.max("level").alias("level"), F.max_by("first", "level").alias("b"))
    runs = common_runs(deep.withColumnRenamed("pos", "a"), classes).withColumn("f", F.shiftright("b", bits)).select("a", "f", "run_lines")
    source = known.select(F.col("d").alias("f"), F.col("doc_id").alias("first_doc_id"))
    named = known.select("d", "doc_id", *([F.col("uid").alias(row)] if row else []))
    return spans.join(runs, "a").join(named, "d").join(source, "f").select("doc_id", *([row] if row else []), "start", "end", "lines", "words", "run_lines", "first_doc_id")


def remove(docs: DataFrame, spans: DataFrame, row: str, flag: str) -> DataFrame:
    """``docs`` without the spans and the line ends that follow them, matched by the column ``row``; the column ``flag`` tells whether lines remain."""
    own = free(docs.columns + [flag], "_cut")
    lists = spans.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(own))
    joined, zero, cuts = docs.join(lists, row, "left"), F.lit(0).cast("long"), F.col(f"`{own}`")
    edges = F.concat(F.array(F.struct(zero.alias("start"), zero.alias("end"))), F.transform(cuts, lambda e: F.struct(e["start"].alias("start"), (e["end"] + 1).alias("end"))))
    upto = lambda i: F.coalesce(F.get(cuts, i)["start"], F.length("text").cast("long"))
    kept = F.array_join(F.transform(edges, lambda e, i: F.substring(F.col("text"), (e["end"] + 1).cast("int"), F.greatest(upto(i) - e["end"], zero).cast("int"))), "")
    return joined.withColumn("text", F.when(cuts.isNull(), F.col("text")).otherwise(kept)).withColumn(flag, cuts.isNull() | F.col("text").rlike(r"\S")).drop(own)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without later copies; rows that lose all their lines go."""
    row, flag = free(docs.columns, "_row"), free(docs.columns, "_left")
    rows = with_rows(docs, row)
    return remove(rows, repeats(rows.select(row, "doc_id", "text"), row=row), row, flag).filter(F.col(flag)).select(docs.columns)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(read(spark, sf_dir, "documents"))
