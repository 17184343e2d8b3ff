"""A training corpus from ``documents``: language, lines, near copies, benchmark, sequences.

Each stage takes what the one before it kept, written as Parquet and read
again, and all but the last return the columns of ``documents``. Near copies
and benchmark items are removed by row, so null and repeated ids are no copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import decontaminate, langid, linededup, packing, simhash
from lattica.llm.common import cut, drop_cut, free, joinable, read, scratch, small_batches, with_rows


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter, or between languages, go."""
    small_batches(spark)
    return langid.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines and runs of lines are deleted; a document that loses all its lines goes."""
    left = linededup.dedup(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the row with the smallest id stays; null ids are the largest."""
    small_batches(spark)
    row = free(docs.columns, "_row")
    rows = with_rows(docs, row)
    groups = simhash.near_groups(rows.select(F.col(row).alias("rid"), "doc_id", "text"))
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = cut(groups.join(first, "root").filter(F.col("rid") != F.col("first.rid")).select(F.col("rid").alias(row)), "gone")
    return rows.join(joinable(gone, 1_000_000), row, "left_anti").select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    row = free(docs.columns, "_row")
    rows = with_rows(docs, row)
    gone = decontaminate.leaks(rows.select(F.col(row).alias("doc_id"), "text"), read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(joinable(cut(gone, "gone"), 1_000_000), row, "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens, a row for each piece."""
    small_batches(spark)
    return packing.pack_documents(docs, memory=packing.LITTLE_MEMORY)


STAGES = [("language_id", language), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", benchmark), ("packing", pack)]

#: Language models, prints and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; tables of the stages before are deleted as soon as their results are written."""
    out, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch() as made:
            found = stage(spark, out, sf_dir)
            out = cut(found, name)
        drop_cut(before, *(t for t in made if t is not out))
        before = out
    return STAGES[-1][1](spark, out, sf_dir)
