"""Digest tables: verdicts, sections, tags, topics, evidence of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.settings import SECTIONS


def attach_verdicts(items: DataFrame, verdicts: DataFrame, on: str = "item_id") -> DataFrame:
    return items.join(verdicts, on)


def gate_by_verdict(items: DataFrame, verdicts: DataFrame, on: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(items that go on, items a person must look at)."""
    judged = attach_verdicts(items, verdicts, on)
    return judged.filter(F.col("verdict") == "pass"), judged.filter(F.col("verdict") == "escalate")


def verdict_counts(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    return verdicts.groupBy(*keys).agg(
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in fixed.VERDICTS]
    )


def section_table(periods: DataFrame, counts: DataFrame, keys: list[str], sections: tuple[tuple[str, str, str, str], ...] = SECTIONS) -> DataFrame:
    """The fixed sections of every period, empty ones with their message.

    ``counts`` holds ``section`` and ``n``.
    """
    fixed_rows = F.array(*[
        F.struct(
            F.lit(i).cast("bigint").alias("position"), F.lit(sid).alias("section"),
            F.lit(label).alias("label"), F.lit(title).alias("title"), F.lit(empty).alias("empty_message"),
        )
        for i, (sid, label, title, empty) in enumerate(sections, 1)
    ])
    rows = periods.select(*keys, F.inline(fixed_rows))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return (
        rows.join(counts, [*keys, "section"], "left")
        .select(
            *keys, "position", "section", "label", "title", n.alias("n_items"),
            F.when(n == 0, F.col("empty_message")).otherwise(F.lit("")).alias("message"),
        )
    )


def first_tag(tags: Column) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit(fixed.OTHER_TAG))


def tips_by_tag(tips: DataFrame, keys: list[str], tags: str = "feature_tags") -> DataFrame:
    """Groups of tips per key: most tips first, then by tag."""
    counted = tips.groupBy(*keys, first_tag(F.col(tags)).alias("tag")).agg(
        F.count(F.lit(1)).alias("n_tips")
    )
    order = Window.partitionBy(*keys).orderBy(F.desc("n_tips"), "tag")
    return counted.withColumn("position", F.row_number().over(order).cast("bigint"))


def tag_domain_violations(tips: DataFrame, id_col: str, tags: str = "feature_tags") -> DataFrame:
    """Tags outside the fixed list; reported, not blocking."""
    outside = F.array_except(
        F.coalesce(F.col(tags), F.array().cast("array<string>")), F.array(*map(F.lit, fixed.FEATURE_TAGS))
    )
    return tips.select(id_col, F.explode(outside).alias("tag"))


def rank_topics(threads: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Top threads per key by messages, people and open questions."""
    order = Window.partitionBy(*keys).orderBy(
        F.desc("n_messages"), F.desc("participants"), F.desc("n_unresolved"), "thread_id"
    )
    return threads.withColumn("position", F.row_number().over(order).cast("bigint")).filter(
        F.col("position") <= k
    )


def missing_evidence(items: DataFrame, messages: DataFrame, keys: list[str], id_col: str = "item_id") -> DataFrame:
    """Item evidence ids that are no message of the item's period."""
    cited = items.select(*keys, id_col, F.explode("source_message_ids").alias("message_id"))
    return cited.join(messages.select(*keys, "message_id"), [*keys, "message_id"], "left_anti")
