"""Substring deduplication by line or paragraph hashing, original offsets retained.

A text is cut into blocks (``line``: lines; ``paragraph``: what stands between
empty lines) and into parts, the sentences within its lines, so that a passage
set inside a longer line is found. Blocks and parts are normalised (lower case,
single blanks) and hashed to 128 bits. Digests are grouped globally; the
earliest occurrence, by document id and place, stays, and each other one is
marked. A marked block of ``WHOLE_WORDS`` words is removed. Marked parts are
removed where neighbouring ones make a run of ``MIN_WORDS`` words: a short
sentence that many texts share by chance, inside lines that differ, is no
copied passage. With 1 for either floor every repeated block or part goes.

Blocks and parts are written once. Digests are counted with partial aggregates
before the shuffle, and those that repeat are written, so that adaptive
execution can split the join that marks a digest that holds a third of all rows.

Defined results: null and empty texts have no blocks; each row is a document
of its own, in the order of ids (null ids last) and rows, so of repeated rows
one stays whole; a block repeated within a text keeps its first place; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattica.llm.common import cut, free, read, with_rows

#: A run of repeated sentences inside lines goes from so many words on, a repeated whole line or paragraph from so many.
MIN_WORDS = 25
WHOLE_WORDS = 5
#: Patterns whose matches, end to end, are the whole text.
BLOCKS = {"line": r"[^\n]+\s*|\s+", "paragraph": r"(?:[^\n]+\n?)+\s*|\s+"}
PARTS = r"[^.!?\n]+[.!?]*\s*|[.!?]+\s*|\s+"
#: Elements that a running sum adds up directly.
STRIDE = 32
#: A rank is (id - lowest long) * RANK + number of the unit, one number of 38 digits.
RANK, LOWEST = Decimal(10**18), Decimal(1 << 63)


def _plain(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))


def units(docs: DataFrame, kind: str = "line", row: str | None = None) -> DataFrame:
    """``(doc_id, row, uid, whole, start, chars, words, h1, h2)``: each block (``whole``) and part that isn't blank, its place in code points and a number that rises with the row."""
    zero, add = F.lit(0).cast("long"), lambda a, x: a + x
    found = docs.select("doc_id", (F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col("text").cast("string").alias("text")).filter("text is not null and text <> ''")
    patterns = {"v": BLOCKS[kind], "u": PARTS}
    found = found.select("doc_id", "row", *[F.regexp_extract_all("text", F.lit(p), 0).alias(c) for c, p in patterns.items()])
    for c in patterns:
        found = found.withColumn(f"n{c}", F.transform(c, lambda x: F.length(x).cast("long")))
    for c in patterns:
        sums = F.transform(F.sequence(F.lit(0), F.ceil(F.size(c) / STRIDE).cast("int") - 1), lambda b: F.aggregate(F.slice(f"n{c}", b * STRIDE + 1, F.lit(STRIDE)), zero, add))  # noqa: B023
        found = found.withColumn(f"b{c}", sums)
    for c in patterns:
        found = found.withColumn(f"p{c}", F.transform(f"b{c}", lambda x, i: F.aggregate(F.slice(f"b{c}", F.lit(1), i), zero, add)))  # noqa: B023

    def placed(c: str) -> Column:
        def unit(x: Column, i: Column) -> Column:
            block = F.floor(i / STRIDE).cast("int")
            start = F.get(f"p{c}", block) + F.aggregate(F.slice(f"n{c}", block * STRIDE + 1, i % STRIDE), zero, add)
            return F.struct(F.lit(c == "v").alias("whole"), start.alias("start"), F.length(x).alias("chars"), _plain(x).alias("plain"))

        return F.transform(c, unit)

    rows = found.select("doc_id", "row", F.inline(F.concat(placed("v"), placed("u")))).filter("plain <> ''")
    words = F.length("plain") - F.length(F.replace(F.col("plain"), F.lit(" "))) + 1
    return rows.select("doc_id", "row", F.monotonically_increasing_id().alias("uid"), "whole", "start", "chars", words.alias("words"), F.xxhash64("plain", "whole").alias("h1"), F.xxhash64(F.lit(1), "plain", "whole").alias("h2"))


def repeats(docs: DataFrame, kind: str = "line", min_words: int = MIN_WORDS, whole_words: int = WHOLE_WORDS, row: str | None = None) -> DataFrame:
    """Removed runs: ``(doc_id, start, end, units, words, first_doc_id)``, and the column ``row`` if that is named.

    ``units`` counts parts; ``first_doc_id`` has the earliest of the documents where they stay.
    """
    every = cut(units(docs, kind, row), "units")
    ident = F.coalesce(F.col("doc_id").cast("decimal(20,0)") + F.lit(LOWEST), F.lit(2 * LOWEST))
    rank = (ident * F.lit(RANK) + F.col("uid")).cast("decimal(38,0)")
    twice = cut(every.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "twice")
    later = every.join(twice, ["h1", "h2"]).filter(rank > F.col("first")).select("doc_id", "row", "whole", "start", (F.col("start") + F.col("chars")).alias("end"), "words", "first_doc_id")
    # A block stands before its first part.
    place = Window.partitionBy("row").orderBy("start", F.col("whole").desc())
    reach = F.max(F.when(F.col("whole") & (F.col("words") >= whole_words), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, 0))
    parts = _runs(later.withColumn("_reach", F.coalesce(reach, F.lit(0))).filter(~F.col("whole")))
    parts = parts.withColumn("_total", F.sum("words").over(Window.partitionBy("row", "_run")))
    gone = _runs(parts.filter((F.col("_total") >= min_words) | (F.col("start") < F.col("_reach"))))
    spans = gone.groupBy("row", "_run").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("units"), F.sum("words").cast("long").alias("words"), F.min("first_doc_id").alias("first_doc_id"))
    return spans.select("doc_id", *([F.col("row").alias(row)] if row else []), "start", "end", "units", "words", "first_doc_id")


def _runs(parts: DataFrame) -> DataFrame:
    """``parts`` with ``_run``: one number for those that stand end to end."""
    place = Window.partitionBy("row").orderBy("start")
    first = F.coalesce((F.lag("end").over(place) != F.col("start")).cast("int"), F.lit(1))
    return parts.withColumn("_first", first).withColumn("_run", F.sum("_first").over(place)).drop("_first")


def remove(docs: DataFrame, spans: DataFrame, row: str, removed: str = "removed") -> DataFrame:
    """``docs`` with the spans, matched by the column ``row``, cut out of their texts and listed, with original offsets, in a column ``removed``."""
    lists = spans.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(removed))
    joined, cuts, zero = docs.join(lists, row, "left"), F.col(f"`{removed}`"), F.lit(0).cast("long")
    edges = F.concat(F.array(F.struct(zero.alias("start"), zero.alias("end"))), cuts)
    upto = lambda i: F.coalesce(F.get(cuts, i)["start"], F.length("text").cast("long"))
    kept = F.array_join(F.transform(edges, lambda e, i: F.substring(F.col("text"), (e["end"] + 1).cast("int"), (upto(i) - e["end"]).cast("int"))), "")
    return joined.withColumn("text", F.when(cuts.isNull(), F.col("text")).otherwise(kept))


def dedup(docs: DataFrame, kind: str = "line", min_words: int = MIN_WORDS, whole_words: int = WHOLE_WORDS) -> DataFrame:
    """``docs``, all columns, without later copies; what was cut out of a text is listed in ``removed`` (with a mark after it where ``docs`` has such a column)."""
    row, removed = free(docs.columns, "_row"), free(docs.columns, "removed")
    rows = with_rows(docs, row)
    return remove(rows, repeats(rows.select(row, "doc_id", "text"), kind, min_words, whole_words, row), row, removed).select(*docs.columns, removed)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(read(spark, sf_dir, "documents"))


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row, regexp_extract_all(text, '{BLOCKS["line"]}') AS u FROM documents WHERE text IS NOT NULL AND text <> ''),
p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row, regexp_extract_all(text, '{PARTS}') AS v FROM documents WHERE text IS NOT NULL AND text <> ''),
e AS (
  SELECT doc_id, row, true AS whole, unnest(u) AS x, unnest(range(1, len(u) + 1)) AS k FROM d
  UNION ALL
  SELECT doc_id, row, false, unnest(v), unnest(range(1, len(v) + 1)) FROM p
),
c AS (SELECT *, CAST(sum(length(x)) OVER (PARTITION BY row, whole ORDER BY k) AS BIGINT) - length(x) AS start FROM e),
f AS (SELECT *, start + length(x) AS until, trim(regexp_replace(lower(x), '\s+', ' ', 'g')) AS plain FROM c),
h AS (
  SELECT *, min(doc_id) OVER (PARTITION BY plain, whole) AS first_doc_id, row_number() OVER (PARTITION BY plain, whole ORDER BY doc_id, row, k) AS nth,
         length(plain) - length(replace(plain, ' ', '')) + 1 AS words
  FROM f WHERE plain <> ''
),
m AS (SELECT *, coalesce(max(CASE WHEN whole AND words >= {WHOLE_WORDS} THEN until END) OVER (PARTITION BY row ORDER BY start, whole DESC), 0) AS reach FROM h WHERE nth > 1),
r AS (SELECT *, CASE WHEN lag(until) OVER (PARTITION BY row ORDER BY start) = start THEN 0 ELSE 1 END AS f FROM m WHERE NOT whole),
s AS (SELECT *, sum(f) OVER (PARTITION BY row ORDER BY start) AS run FROM r),
t AS (SELECT *, sum(words) OVER (PARTITION BY row, run) AS total FROM s),
g AS (SELECT *, CASE WHEN lag(until) OVER (PARTITION BY row ORDER BY start) = start THEN 0 ELSE 1 END AS f2 FROM t WHERE total >= {MIN_WORDS} OR start < reach),
o AS (SELECT *, sum(f2) OVER (PARTITION BY row ORDER BY start) AS run2 FROM g)
SELECT doc_id, CAST(min(start) AS BIGINT) AS start, CAST(max(until) AS BIGINT) AS "end", count(*) AS units, CAST(sum(words) AS BIGINT) AS words, min(first_doc_id) AS first_doc_id
FROM o GROUP BY doc_id, row, run2
"""
