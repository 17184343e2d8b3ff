"""Chat formatting by multi-party perspective rotation.

A conversation is rendered once for each of its participants (every role but
``system``): that speaker's turns become the assistant's, all others become
users named after their role, system turns stay, and only the assistant's
words and end mark bear loss. A row of the result is one turn in one rendering
with its text and place; joined in order they are the rendered dialogue.

Places are running sums. Turns are put in order with a range partition, summed
within each partition, and shifted by the sums of the partitions before: a
conversation with a third of all turns is spread over tasks like any other.

Text can't forge a turn: a backslash is put into what begins or ends like a
marker (``<|``, ``|>``), after those that stand there already, so that taking
one out restores it; blanks in names become underscores.

Defined results: null texts are empty turns; a null role is the participant
``unknown``; turns that share a number go by role, then text; repeated rows
are turns of their own; a conversation of system turns alone has no rendering;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattica.llm.common import cut, read

SYSTEM = "system"
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    """``text`` without markers: one backslash more in each ``<|`` and ``|>``."""
    return F.regexp_replace(F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|"), r"\|(\\*)>", r"|\\$1>")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(F.regexp_replace(text, r"\|\\(\\*)>", r"|$1>"), r"<\\(\\*)\|", r"<$1|")


def rotate(conversations: DataFrame) -> DataFrame:
    """``(conv_id, perspective, turn, seq, role, name, segment, start, end, loss_start, loss_end)``.

    Places are code points in the rendering; ``seq`` rises with the order of turns; loss places are null where no token bears loss.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "speaker", "text"]
    # Shared with both uses below: numbers that rise with the order, a partition's above bit 33.
    ordered = cut(turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id()), "turns")
    people = ordered.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    rows = ordered.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("speaker") == F.col("perspective")
    rows = rows.withColumn("role", F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")).withColumn("name", F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker")))
    head = F.concat(F.lit("<|"), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.regexp_replace(escaped(F.col("name")), r"\s", "_")), F.lit("")), F.lit("|>\n"))
    rows = rows.withColumn("_head", F.length(head).cast("long")).withColumn("segment", F.concat(head, escaped(F.col("text")), F.lit(END))).withColumn("_n", F.length("segment").cast("long"))
    rows = rows.withColumn("_part", F.shiftright("seq", 33))
    within = Window.partitionBy("conv_id", "perspective", "_part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "perspective", "_part").agg(F.sum("_n").alias("_t"))
    parts = Window.partitionBy("conv_id", "perspective").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("_part").alias("_q"), F.sum("_t").over(parts).alias("_shift")).filter("_shift is not null")
    placed = rows.withColumn("_at", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    placed = placed.join(shift, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("_part") == F.col("_q")), "left")
    start = F.col("_at") + F.coalesce("_shift", F.lit(0))
    return placed.select(
        "conv_id", "perspective", "turn", "seq", "role", "name", "segment", start.alias("start"), (start + F.col("_n")).alias("end"),
        F.when(own, start + F.col("_head")).alias("loss_start"), F.when(own, start + F.col("_n") - 1).alias("loss_end"),
    )


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations")).drop("seq")


def _escaped_sql(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '<(\\\\*)\\|', '<\\\\\\1|', 'g'), '\\|(\\\\*)>', '|\\\\\\1>', 'g')"


OP3_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
         row_number() OVER (ORDER BY conv_id, turn, coalesce(role, 'unknown'), coalesce(text, '')) AS seq
  FROM conversations
), p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.conv_id, perspective, turn, seq, speaker = perspective AS own, text,
         CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
         CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), h AS (
  SELECT *, '<|' || role || coalesce(' name=' || regexp_replace({_escaped_sql('name')}, '\\s', '_', 'g'), '') || '|>' || chr(10) AS head FROM r
), s AS (SELECT *, head || {_escaped_sql('text')} || '<|end|>' || chr(10) AS segment FROM h),
q AS (
  SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s
)
SELECT conv_id, perspective, turn, role, name, segment, start, CAST(start + length(segment) AS BIGINT) AS "end",
       CASE WHEN own THEN CAST(start + length(head) AS BIGINT) END AS loss_start,
       CASE WHEN own THEN CAST(start + length(segment) - 1 AS BIGINT) END AS loss_end
FROM q
"""
