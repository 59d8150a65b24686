"""Streaming jobs run to completion and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.plans import derive
from chatloom.plans.derive import MERGED_SQL, MSG_SQL, STAMP_SQL, stamp, threads_sql
from chatloom.plans.privacy import RE2_PATHS, RE2_PII, kinds_sql
from chatloom.plans.registry import query
from chatloom.session import scratch_dir
from chatloom.streaming import jobs


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream; the table may be one file or a folder of files."""
    return derive.as_messages(jobs.stream_messages(spark, f"{sf_dir}/events.parquet*", "parquet", derive.EVENT_SCHEMA))


def _inbox(spark: SparkSession, name: str, first: DataFrame) -> tuple[str, str, DataFrame]:
    """A folder of message files, a place for checkpoint and output, and the stream of the folder; ``first`` is in it."""
    root = scratch_dir(spark, name)
    first.write.parquet(f"{root}/inbox")
    return f"{root}/inbox", root, jobs.stream_messages(spark, f"{root}/inbox", "parquet", first.schema)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """All messages, and whether one is from before noon of the middle day."""
    rows = derive.messages(spark, sf_dir)
    middle = F.expr("timestamp_micros((min(unix_micros(ts)) + max(unix_micros(ts))) div 2)")
    noon = rows.select(F.date_format(middle, "yyyy-MM-dd 12:00:00")).first()[0]
    return rows.withColumn("early", F.col("ts") < F.lit(noon).cast("timestamp")), F.col("early")


_HALVES_SQL = """
halves AS (
  SELECT *, ts < strftime(make_timestamp((SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 FROM msg)), '%Y-%m-%d 12:00:00')::TIMESTAMP AS early FROM msg)"""


@query("stream_messages", f"WITH {MSG_SQL} SELECT message_id, room_id, text, {STAMP_SQL.format('ts')} AS ts FROM msg")
def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_to_table(_live(spark, sf_dir), "messages").select(
        "message_id", "room_id", "text", stamp("ts").alias("ts")
    )


@query("stream_dedup", f"WITH {MERGED_SQL} SELECT room_id, dedup_key FROM merged")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = _live(spark, sf_dir)
    both = live.unionByName(derive.overlap(_live(spark, sf_dir)))
    return jobs.run_to_table(jobs.stream_dedup(both), "dedup").select("room_id", "dedup_key")


@query("stream_threads", f"""
WITH {MSG_SQL}, {threads_sql('msg')},
t AS (SELECT room_id, thread_id, min(ts) AS s, max(ts) AS e, count(*) AS n_messages FROM threaded GROUP BY ALL)
SELECT room_id, {STAMP_SQL.format('s')} AS start_ts, {STAMP_SQL.format('e')} AS end_ts, n_messages FROM t
WHERE e + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM msg) - INTERVAL 1 HOUR""")
def stream_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over files that are cut in the middle of the day: threads that span both come out whole."""
    rows, early = _halves(spark, sf_dir)
    inbox, root, stream = _inbox(spark, "threads", rows.filter(early).drop("early"))
    jobs.resume_to_table(jobs.stream_threads(stream), root)
    rows.filter(~early).drop("early").write.mode("append").parquet(inbox)
    found, _ = jobs.resume_to_table(jobs.stream_threads(stream), root)
    return found.select("room_id", stamp("start_ts").alias("start_ts"), stamp("end_ts").alias("end_ts"), "n_messages")


@query("stream_merge", f"WITH {MERGED_SQL} SELECT room_id, dedup_key, src, message_id, {STAMP_SQL.format('ts')} AS ts FROM merged")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; the coarser export comes first, the better source in a file that arrives later."""
    rows = derive.messages(spark, sf_dir)
    inbox, root, stream = _inbox(spark, "merge", derive.overlap(rows))
    jobs.merge_stream(stream, f"{root}/winners", f"{root}/checkpoint")
    rows.write.mode("append").parquet(inbox)
    won = jobs.merge_stream(stream, f"{root}/winners", f"{root}/checkpoint")
    return won.select("room_id", "dedup_key", "src", "message_id", stamp("ts").alias("ts"))


@query("stream_late", f"""
WITH {MSG_SQL}, {_HALVES_SQL},
sent AS (SELECT *, CASE WHEN early AND message_id % 10 <> 3 THEN 1 ELSE 2 END AS run FROM halves),
mark AS (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 AS wm FROM sent WHERE run = 1)
SELECT run, count(*) AS n_input, count(*) FILTER (WHERE run = 1 OR epoch_us(ts) > wm) AS n_kept,
       count(*) FILTER (WHERE run = 2 AND epoch_us(ts) <= wm) AS n_late
FROM sent, mark GROUP BY run""")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one checkpoint; the second file has rows from before the first run's watermark, which are counted."""
    rows, early = _halves(spark, sf_dir)
    first = early & (F.col("message_id") % 10 != 3)
    inbox, root, stream = _inbox(spark, "late", rows.filter(first).drop("early"))
    told, before = [], 0
    for run in (1, 2):
        if run == 2:
            rows.filter(~first).drop("early").write.mode("append").parquet(inbox)
        kept, progress = jobs.resume_to_table(jobs.stream_dedup(stream), root)
        now = kept.count()
        told.append((run, sum(p.n_input for p in progress), now - before, sum(p.n_late for p in progress)))
        before = now
    return spark.createDataFrame(told, "run int, n_input long, n_kept long, n_late long")


@query("stream_digest_stats", f"""
WITH {MSG_SQL} SELECT room_id, week, count(*) AS n_messages, count(DISTINCT nickname) FILTER (WHERE NOT is_system) AS n_people FROM msg
WHERE week::DATE + 7 <= (SELECT max(ts) FROM msg) - INTERVAL 1 HOUR GROUP BY ALL""")
def stream_digest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_to_table(jobs.stream_digest_stats(_live(spark, sf_dir)), "stats")


@query("stream_weekly_counts", f"""
WITH {MSG_SQL} SELECT room_id, week, count(*) AS n_messages FROM msg
WHERE week::DATE + 7 <= (SELECT max(ts) FROM msg) - INTERVAL 1 HOUR GROUP BY ALL""")
def stream_weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_to_table(jobs.stream_digest_stats(_live(spark, sf_dir)), "stats").select(
        "room_id", "week", "n_messages"
    )


_ALERT_SQL = f"""
WITH {MSG_SQL}, t AS (
  SELECT room_id, message_id, text || ' ' || {derive.sql_list(derive.UNSAFE)}[(message_id % {len(derive.UNSAFE)}) + 1] AS text FROM msg)
SELECT room_id, message_id, unnest({kinds_sql('text', RE2_PII | RE2_PATHS)}) AS kind FROM t"""


@query("stream_pii_alerts", _ALERT_SQL)
def stream_pii_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.element_at(F.array(*map(F.lit, derive.UNSAFE)), (F.col("message_id") % len(derive.UNSAFE) + 1).cast("int"))
    unsafe = _live(spark, sf_dir).withColumn("text", F.concat("text", F.lit(" "), line))
    return jobs.run_to_table(jobs.pii_alerts(unsafe), "alerts", batches=True).select("room_id", "message_id", "kind")
