"""10. Multi-party chat formatting by perspective rotation.

Every participant of a dialogue gets one rendering in which it is the assistant, every other participant is a user
under its own name, and system turns stay system turns. Only the perspective's own turns are trained on: ``mask`` is 1
for their text and end mark, which is the character range ``mask_start`` to ``mask_end`` of the whole rendering.

The result has one row per dialogue, perspective and turn, so a dialogue may hold any share of the table: a running
offset is summed within chunks of ``CHUNK`` turn numbers and shifted by the sums of the chunks before it, and no
dialogue is gathered in one task. Concatenating ``rendered`` by ``start`` gives the training text.

Cases: a null role is the speaker ``unknown``; a null text is empty; null turns come first. Rows without a dialogue id
form one dialogue. Speakers of a dialogue whose names differ only in characters that a name cannot keep are told apart
by a number after a dot. Very long texts are rendered whole. Ties within a turn are ordered by role and text, and
repeated rows are rendered one after the other. A dialogue with system turns only has no perspective; an empty table
gives an empty one. Marks inside texts are defused, so a text cannot open or close a turn. Extra columns are not part
of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.registry import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM_ROLES = ("system",)
CHUNK = 512


def _name(role: Column) -> Column:
    """Names keep letters, marks and digits of all scripts, ``_`` and ``-``."""
    return F.regexp_replace(role, r"[^\p{L}\p{M}\p{N}_-]", "_")


def rotate(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``(conv_id, perspective, turn, speaker, chat_role, rendered, mask, start, mask_start, mask_end)``."""
    said = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("unknown")).alias("speaker"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"),
    )
    people = said.filter(~F.col("speaker").isin(*SYSTEM_ROLES)).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    # speakers of a dialogue whose names come out equal are numbered; no name has a dot of its own
    alike = F.row_number().over(Window.partitionBy("p", "name").orderBy("named"))
    names = people.select(F.col("c").alias("p"), F.col("perspective").alias("named"), _name(F.col("perspective")).alias("name"))
    names = names.withColumn("alike", alike).select(
        "p", "named", F.concat("name", F.when(F.col("alike") > 1, F.concat(F.lit("."), F.col("alike").cast("string"))).otherwise("")).alias("name"))
    said = said.join(names, F.col("conv_id").eqNullSafe(F.col("p")) & (F.col("speaker") == F.col("named")), "left")
    own = F.col("speaker") == F.col("perspective")
    chat_role = F.when(F.col("speaker").isin(*SYSTEM_ROLES), "system").when(own, "assistant").otherwise("user")
    head = F.concat(F.lit(OPEN), chat_role, F.when(chat_role == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(""), F.lit("\n"))
    seen = said.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "perspective", "turn", "speaker", chat_role.alias("chat_role"), F.length(head).alias("head"),
        F.concat(head, F.col("said"), F.lit(CLOSE)).alias("rendered"),
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))).alias("chunk"),
    )
    key = ["conv_id", "perspective"]
    sums = seen.groupBy(*key, "chunk").agg(F.sum(F.length("rendered")).alias("size"))
    before = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*[F.col(c).alias(f"b_{c}") for c in [*key, "chunk"]], F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    same = F.col("conv_id").eqNullSafe(F.col("b_conv_id")) & (F.col("perspective") == F.col("b_perspective")) & (F.col("chunk") == F.col("b_chunk"))
    earlier = Window.partitionBy(*key, "chunk").orderBy("turn", "speaker", "rendered").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.join(bases, same).withColumn("start", F.col("base") + F.coalesce(F.sum(F.length("rendered")).over(earlier), F.lit(0)))
    trained = F.col("chat_role") == "assistant"
    return placed.select(
        *key, "turn", "speaker", "chat_role", "rendered", trained.cast("int").alias("mask"), "start",
        F.when(trained, F.col("start") + F.col("head")).alias("mask_start"),
        F.when(trained, F.col("start") + F.length("rendered")).alias("mask_end"),
    )


QUERY = "op10_chat_format"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE_SQL = r"""
WITH s AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM s WHERE speaker <> 'system'),
n AS (
  SELECT c AS p, perspective AS named, regexp_replace(perspective, '[^\p{L}\p{M}\p{N}_-]', '_', 'g') AS name FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY p, name ORDER BY named) AS alike FROM n),
r AS (
  SELECT conv_id, perspective, turn, speaker, said, name || CASE WHEN alike > 1 THEN '.' || alike ELSE '' END AS name,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
  FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.c LEFT JOIN k ON s.conv_id IS NOT DISTINCT FROM k.p AND speaker = named),
h AS (
  SELECT *, '<|im_start|>' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || name ELSE '' END
    || chr(10) AS head FROM r),
t AS (SELECT *, head || said || '<|im_end|>' || chr(10) AS rendered FROM h),
o AS (
  SELECT *, coalesce(CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, rendered
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start FROM t)
SELECT conv_id, perspective, turn, speaker, chat_role, rendered, CAST(chat_role = 'assistant' AS INTEGER) AS mask, start,
  CASE WHEN chat_role = 'assistant' THEN start + length(head) END AS mask_start,
  CASE WHEN chat_role = 'assistant' THEN start + length(rendered) END AS mask_end FROM o
"""
