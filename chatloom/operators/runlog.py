"""Run log and escalations: append-only tables and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom import fixed


def append_run_log(records: DataFrame, path: str) -> None:
    """One JSON record per attempt below its date; null fields are left out."""
    (
        records.withColumn("date", F.to_date("ts"))
        .write.mode("append").partitionBy("date").json(path)
    )


def append_escalations(records: DataFrame, path: str) -> None:
    (
        records.withColumn("date", F.to_date("ts"))
        .write.mode("append").partitionBy("date").parquet(path)
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Attempts per date and stage, one column per status."""
    return (
        log.groupBy("date", "stage").pivot("status", list(fixed.LOG_STATUSES))
        .agg(F.count(F.lit(1))).na.fill(0, list(fixed.LOG_STATUSES))
    )


def recent_rejections(
    rejections: DataFrame, keys: list[str], order: list[str], n: int = fixed.RECENT_REJECTIONS
) -> DataFrame:
    """The last n rejections per key, oldest first."""
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    kept = rejections.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= n)
    forward = Window.partitionBy(*keys).orderBy(*order)
    return kept.withColumn("position", F.row_number().over(forward).cast("bigint")).drop("_back")
