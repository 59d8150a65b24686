"""Structured Streaming counterparts of the batch jobs.

The file source with a checkpoint replaces a list of processed inputs, the
watermark replaces the stored high-water mark: rows behind it are dropped and
counted in ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from chatloom.functions import patterns
from chatloom.operators.messages import dedup_key, merge_messages
from chatloom.schemas import MESSAGE
from chatloom.session import scratch, scratch_dir
from chatloom.sources import generations

LATENESS = "1 hour"


def stream_messages(
    spark: SparkSession, path: str, fmt: str = "json", schema: StructType = MESSAGE, **options: str
) -> DataFrame:
    """Messages as files arrive; each file is read once."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def stream_dedup(messages: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """First row per key within the lateness, over overlapping exports."""
    return (
        messages.withColumn("dedup_key", dedup_key()).withWatermark("ts", lateness)
        .dropDuplicatesWithinWatermark(["room_id", "dedup_key"])
    )


def stream_threads(messages: DataFrame, gap: str = "30 minutes", lateness: str = LATENESS) -> DataFrame:
    """Closed threads per room."""
    return (
        messages.withWatermark("ts", lateness)
        .groupBy("room_id", F.session_window("ts", gap))
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n_messages"))
        .select("room_id", "start_ts", "end_ts", "n_messages")
    )


def stream_digest_stats(messages: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Weekly messages and people per room, exact; weeks start on Monday (the epoch was a Thursday).

    Two aggregations in a chain: messages per room, week and person, then of those per room and week. State holds a
    row per person and open week, not sets of names. System messages count, but have no person.
    """
    person = F.when(~F.col("is_system"), F.col("nickname"))
    each = (
        messages.withWatermark("ts", lateness)
        .groupBy("room_id", F.window("ts", "7 days", "7 days", "4 days").alias("w"), person.alias("person"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        each.groupBy("room_id", F.window("w", "7 days", "7 days", "4 days").alias("week"))
        .agg(F.sum("n").alias("n_messages"), F.count("person").alias("n_people"))
        .select("room_id", F.date_format("week.start", "yyyy-MM-dd").alias("week"), "n_messages", "n_people")
    )


def pii_alerts(messages: DataFrame) -> DataFrame:
    """Stateless: one row per message and kind of unsafe content."""
    return messages.select(
        "room_id", "message_id", F.explode(patterns.unsafe_kinds(F.col("text"))).alias("kind")
    )


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that a repeated batch overwrites instead of doubling."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_to_table(stream: DataFrame, name: str, batches: bool = False) -> DataFrame:
    """Process what is there, stop, and read the result back from the shared folder."""
    root = scratch_dir(stream.sparkSession, name)
    return resume_to_table(stream, root, batches)[0]


def resume_to_table(stream: DataFrame, root: str, batches: bool = False) -> tuple[DataFrame, list[Progress]]:
    """Go on from the checkpoint below ``root``, if there is one, until all files that are there now are read.

    Returns all rows written so far, by this run and those before it, and what became of the rows of this run.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint")
    if batches:
        query = writer.foreachBatch(append_batches(f"{root}/out")).start()
    else:
        query = writer.format("parquet").outputMode("append").start(f"{root}/out")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out"), progress_of(query)


@dataclass(frozen=True)
class Progress:
    """Rows of one micro-batch: read from the source, and dropped because they came behind the watermark."""

    batch: int
    n_input: int
    n_late: int


def progress_of(query: StreamingQuery) -> list[Progress]:
    """What ``numRowsDroppedByWatermark`` and the sources told of each batch that the query still remembers."""
    return [
        Progress(p["batchId"], p["numInputRows"], sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]))
        for p in query.recentProgress
    ]


# --- winners by source rank, merged batch by batch ---------------------------------------------------

UNDATED = "undated"


def _winners_schema(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", day string"


def merge_batch(batch: DataFrame, target: str, horizon: int) -> None:
    """Bring one batch into the winners of all batches before it; a batch that is repeated changes nothing.

    Winners are stored by day. Only days within ``horizon`` days of the batch are read, and only those that gain or
    lose a row are written, as files of one new generation; a job that breaks leaves the winners as they were.
    """
    spark = batch.sparkSession
    fresh = merge_messages(batch)
    schema = _winners_schema(fresh.schema)
    day = F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit(UNDATED))
    with scratch(spark, "merge") as work:
        fresh.withColumn("day", day).write.parquet(f"{work}/fresh")
        fresh = spark.read.parquet(f"{work}/fresh")
        days = sorted(r["day"] for r in fresh.select("day").distinct().collect())  # days of the calendar
        if not days:
            return
        base = generations.current(spark, target)
        near = [d for d in base.parts if _near(d, days, horizon)]
        if not near:  # nothing to compare with: the batch has won as it is, and its days are new
            generations.replace(fresh, target, base, "day", days)
            return
        old = generations.read(spark, target, schema, "day", base, near)
        keys = fresh.select("room_id", "dedup_key")  # each once
        same = F.col("room_id").eqNullSafe(F.col("k.room_id")) & (F.col("dedup_key") == F.col("k.dedup_key"))
        met = old.join(keys.select(F.struct("room_id", "dedup_key").alias("k")), same, "left_semi")
        # of equal rows the stored one wins, so that a repeated batch finds nothing to write
        both = fresh.withColumn("is_new", F.lit(True)).unionByName(met.withColumn("is_new", F.lit(False)))
        merged = merge_messages(both.drop("dedup_key"))
        merged.write.parquet(f"{work}/merged")
        merged = spark.read.parquet(f"{work}/merged")
        gained = merged.filter("is_new").drop("is_new")
        won = gained.select("room_id", "dedup_key")
        lost = met.join(won.select(F.struct("room_id", "dedup_key").alias("k")), same, "left_semi")
        touched = sorted({r["day"] for r in gained.select("day").unionByName(lost.select("day")).distinct().collect()})
        if not touched:
            return
        kept = generations.read(spark, target, schema, "day", base, touched).join(
            won.select(F.struct("room_id", "dedup_key").alias("k")), same, "left_anti")
        generations.replace(gained.unionByName(kept), target, base, "day", touched)


def _near(day: str, days: list[str], horizon: int) -> bool:
    if day == UNDATED:
        return UNDATED in days
    dated = [date.fromisoformat(d) for d in days if d != UNDATED]
    reach = timedelta(days=horizon)
    return bool(dated) and dated[0] - reach <= date.fromisoformat(day) <= dated[-1] + reach


def merge_stream(messages: DataFrame, target: str, checkpoint: str, horizon: int = 31) -> DataFrame:
    """Winners by the rule of ``merge_messages`` (db before csv before txt, then time) over all runs so far.

    A better source that arrives later, in another batch or run, takes the place of what was kept. Copies whose times
    lie more than ``horizon`` days apart are not compared: that bounds what a batch reads, as a watermark would.
    """
    spark = messages.sparkSession
    query = messages.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: merge_batch(batch, target, horizon)).start()
    query.awaitTermination()
    schema = _winners_schema(StructType([*messages.schema.fields, StructField("dedup_key", StringType())]))
    return generations.read(spark, target, schema, "day", generations.current(spark, target)).drop("day")


def closed_before(end: Column, newest: Column, gap: str = "30 minutes", lateness: str = LATENESS) -> Column:
    """Whether a thread is final once the watermark has followed the newest row."""
    return end + F.expr(f"INTERVAL {gap}") <= newest - F.expr(f"INTERVAL {lateness}")
