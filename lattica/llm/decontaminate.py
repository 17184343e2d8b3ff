"""Benchmark decontamination by template windows, in DataFrame operations only.

Texts become sequences of canonical tokens: words in lower case, and typed
slots for numbers, for units that follow a number and for names (capitalised
words inside a sentence). A window of ``WINDOW`` tokens is a template in which
a slot stands for any value of its type, so a question asked anew with other
numbers and names has the templates of the first. Whether their slots
correspond is then checked: the values of an item's slots are paired with the
document's, once over all windows and once for each occurrence (windows at one
distance between document and item). The share of values to pairs is the
match's consistency: 1 if each value of the item stands for one value
throughout, less if a name or number that comes again is another one there.
Values that an occurrence doesn't hold count as pairs that disagree, and the
best of these shares holds.

Templates are hashed and joined with the benchmark's. A document is taken to
hold an item if it has at least ``COVERAGE`` of the item's distinct windows,
with a consistency of ``CONSISTENCY`` where the item has slots; if windows
enough match with the same values, the document holds it verbatim, consistency 1.
Items of 5 to 7 tokens are one window of their own length. A window with fewer
than four plain words is too weak a template and stands for its tokens as they
are, whatever their types. Coverage is of all windows, or of those that are
templates, so that an item asked anew is found although its weak windows differ.
Shorter items prove nothing; ``unsearchable`` lists them.

The benchmark's windows are broadcast only if they are counted to be few; else
the join is shuffled. Matches are aggregated before they are shuffled.

Defined results: null and empty texts hold nothing; repeated rows with one id
count as one document; an empty table on either side gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import cut, joinable, read

WINDOW = 8
SHORTEST = 5
PLAIN_WORDS = 4
COVERAGE = 0.5
#: One value of ten may stand for two.
CONSISTENCY = 0.9
SLOT = "\x01"
#: Tags of canonical tokens.
NUMBER, UNIT, NAME, PLAIN = 0, 1, 2, 7
# Measuring units that are slots after a number.
MEASURES = "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hours days weeks months years kb mb gb tb hz khz mhz ghz w kw mw v kv a ma c f k pa kpa bar mph kmh percent usd eur gbp dollars euros pounds cents meters metres miles feet inches liters litres grams kilograms seconds minutes".split()


def words(text: Column) -> Column:
    """Words and numbers of a text, in order and in lower case; names keep a mark in front."""
    named = F.regexp_replace(text, r"(?<=[\p{L}\d,;:] )(\p{Lu}\p{Ll}+)", SLOT + "$1")
    return F.regexp_extract_all(F.lower(named), F.lit(rf"{SLOT}?[\p{{L}}\p{{M}}]+|\d+(?:[.,]\d+)*"), 0)


def _tagged(value: Column, tag: int) -> Column:
    """A hash whose last three bits are a tag: 7 for plain words, else the type of a slot."""
    return F.xxhash64(value).bitwiseAND(F.lit(~7).cast("long")).bitwiseOR(F.lit(tag).cast("long"))


def canonical(column: str) -> Column:
    """The array of words in ``column`` as tagged hashes."""
    number = lambda t: F.substring(t, 1, 1).between("0", "9")

    def token(t: Column, i: Column) -> Column:
        unit = t.isin(MEASURES) & (i > 0) & number(F.get(column, i - 1))
        return F.when(number(t), _tagged(t, NUMBER)).when(t.startswith(SLOT), _tagged(F.ltrim(t, F.lit(SLOT)), NAME)).when(unit, _tagged(t, UNIT)).otherwise(_tagged(t, PLAIN))

    return F.transform(column, token)


def _untyped(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: t.bitwiseAND(F.lit(~7).cast("long")))


def _slot(token: Column) -> Column:
    return token.bitwiseAND(F.lit(7).cast("long")) != PLAIN


def _templates(starts: Column, n: int, weak: bool = True) -> Column:
    """Hashes of the windows of ``n`` tokens of ``t`` at ``starts``; where too few words are plain, of the tokens as they are, null if not ``weak``."""
    window = lambda i: F.slice("t", i, F.lit(n))

    def slotted(i: Column) -> Column:
        w = window(i)
        filled = F.transform(w, lambda t: F.when(_slot(t), t.bitwiseAND(F.lit(7).cast("long"))).otherwise(t))
        out = F.when(~F.exists(w, _slot), F.xxhash64(w)).when(F.size(F.filter(w, lambda t: ~_slot(t))) >= PLAIN_WORDS, F.xxhash64(filled))
        return out.otherwise(F.xxhash64(_untyped(w))) if weak else out

    return F.when(F.col("slots"), F.transform(starts, slotted)).otherwise(F.transform(starts, lambda i: F.xxhash64(window(i))))


def templates(rows: DataFrame, key: str, lengths: list[int], weak: bool = True) -> DataFrame:
    """``(key, n, h)``: distinct template hashes of the windows of the given lengths of ``rows(key, text)``, n tokens in all."""
    found = rows.filter("text is not null").select(key, words(F.col("text").cast("string")).alias("w")).select(key, canonical("w").alias("t"))
    found = found.withColumn("slots", F.exists("t", _slot))
    size, none = F.size("t"), F.array().cast("array<int>")
    each = [_templates(F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(none), n, weak) for n in lengths]
    return found.select(key, size.alias("n"), F.explode(F.array_distinct(F.concat(*each))).alias("h")).filter("h is not null")


def slots(rows: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """``(key, th, at, h, v)``: the windows with slots, their text's hash, place and template, and the slots' values in order."""
    found = rows.filter("text is not null").select(key, F.xxhash64(F.col("text").cast("string")).alias("th"), words(F.col("text").cast("string")).alias("w")).select(key, "th", canonical("w").alias("t"))
    found = found.withColumn("slots", F.exists("t", _slot)).filter("slots")
    size, none = F.size("t"), F.array().cast("array<int>")
    out = None
    for n in lengths:
        starts = F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(none)
        one = found.select(key, "th", F.explode(F.arrays_zip(starts.alias("at"), _templates(starts, n, weak=False).alias("h"), F.transform(starts, lambda i: F.filter(F.slice("t", i, F.lit(n)), _slot)).alias("v"))).alias("x"))
        one = one.select(key, "th", "x.at", "x.h", "x.v").filter("h is not null and size(v) > 0")
        out = one if out is None else out.union(one)
    return out


def unsearchable(benchmark: DataFrame) -> DataFrame:
    """``(item_id, n)``: items of fewer than ``SHORTEST`` tokens, which are not searched for, and how many they have."""
    return benchmark.select("item_id", F.coalesce(F.size(words(F.col("text").cast("string"))), F.lit(0)).alias("n")).filter(F.col("n") < SHORTEST)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """``(doc_id, item_id, matched, windows, consistency)`` for every document that holds an item."""
    items = benchmark.filter("text is not null").groupBy("item_id").agg(F.max("text").alias("text"))
    sizes = items.select(F.size(words(F.col("text"))).alias("n"))
    short = sorted(r["n"] for r in sizes.filter(F.col("n").between(SHORTEST, WINDOW - 1)).distinct().collect())
    searched = [(n, items if n == WINDOW else items.filter(F.size(words(F.col("text"))) == n)) for n in [WINDOW, *short]]
    wanted = None
    for n, rows in searched:
        strong = templates(rows, "item_id", [n], weak=False).select("item_id", "h", F.lit(True).alias("strong"))
        part = templates(rows, "item_id", [n]).select("item_id", "h").join(strong, ["item_id", "h"], "left").withColumn("strong", F.coalesce("strong", F.lit(False)))
        wanted = part if wanted is None else wanted.union(part)
    wanted = cut(wanted, "templates")
    of = lambda name: (F.count(F.lit(1)).alias(name), F.count(F.when(F.col("strong"), 1)).alias(f"{name}_strong"))
    totals = wanted.groupBy("item_id").agg(*of("windows"))
    # Matching starts with the distinct hashes; a hash that many items share fans out after that.
    hashes, lengths = wanted.select("h").distinct(), [WINDOW, *short]
    hit = templates(docs.select("doc_id", "text"), "doc_id", lengths).join(joinable(hashes, 1_000_000), "h", "left_semi").select("doc_id", "h").distinct()
    pairs = hit.join(wanted, "h").groupBy("doc_id", "item_id").agg(*of("matched"))
    enough = lambda kind: F.col(f"matched{kind}") >= coverage * F.col(f"windows{kind}")
    held = pairs.join(totals, "item_id").filter(enough("") | (F.col("matched_strong") > 0) & enough("_strong")).select("doc_id", "item_id", "matched", "windows")
    asked = slots(items, "item_id", lengths)
    if asked.isEmpty():
        return held.withColumn("consistency", F.lit(1.0))
    held, asked = cut(held, "leaks"), cut(asked.distinct(), "slots")
    # Values are compared in the documents that hold an item with slots; only their texts are read apart again.
    open_pairs = held.join(asked.select("item_id").distinct(), "item_id", "left_semi").select("doc_id", "item_id")
    own = slots(docs.join(joinable(open_pairs.select("doc_id").distinct(), 1_000_000), "doc_id", "left_semi").select("doc_id", "text"), "doc_id", lengths)
    met = own.distinct().join(open_pairs, "doc_id").join(asked.select("item_id", F.col("at").alias("i"), "h", F.col("v").alias("a")), ["item_id", "h"])
    met = cut(met.select("doc_id", "item_id", "th", (F.col("at") - F.col("i")).alias("off"), "h", "a", "v"), "met")
    pair = ["doc_id", "item_id"]
    values = met.select(*pair, "th", "off", F.explode(F.arrays_zip("a", "v")).alias("x")).select(*pair, "th", "off", "x.a", "x.v").distinct()
    share = F.countDistinct("a").alias("na"), F.count(F.lit(1)).alias("np")
    overall = values.select(*pair, "a", "v").distinct().groupBy(*pair).agg(*share)
    each = values.groupBy(*pair, "th", "off").agg(*share).join(overall.select(*pair, F.col("na").alias("all")), pair)
    best = each.groupBy(*pair).agg(F.max(F.col("na") / (F.col("np") + F.col("all") - F.col("na"))).alias("best"))
    # Windows without slots match verbatim, and so do those with the same values.
    same = met.groupBy(*pair).agg((F.countDistinct("h") - F.countDistinct(F.when(F.col("a") == F.col("v"), F.col("h")))).alias("other"))
    agreed = overall.select(*pair, (F.col("na") / F.col("np")).alias("overall")).join(best, pair).join(same, pair)
    judged = held.join(agreed, pair, "left")
    verbatim = F.col("matched") - F.col("other") >= coverage * F.col("windows")
    value = F.when(F.col("other").isNull() | ((F.col("matched") > F.col("other")) & verbatim), 1.0).otherwise(F.greatest("overall", "best"))
    return judged.select(*pair, "matched", "windows", value.alias("consistency")).filter(F.col("consistency") >= consistency)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
