"""Streams over several runs and files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import messages
from chatloom.plans import streams
from chatloom.plans.registry import QUERIES
from chatloom.session import scratch_dir
from chatloom.sources import generations
from chatloom.streaming import jobs

MSG = ("room_id string, message_id bigint, ts timestamp, nickname string, text string, is_system boolean, "
       "src string, links array<string>, reply_to string, native_id string")
T0 = dt.datetime(2024, 1, 1)


def message(i, seconds, src="csv", text="t", native=None, room="r"):
    return (room, i, None if seconds is None else T0 + dt.timedelta(seconds=seconds), "n", text, False, src, [], None, native)


def rows_of(df):
    return sorted((r.room_id or "", r.dedup_key, r.src, r.message_id, str(r.ts)) for r in df.collect())


def run(spark, parts, **options):
    root = scratch_dir(spark, "stream")
    for part in parts:
        spark.createDataFrame(part, MSG).coalesce(1).write.mode("append").parquet(f"{root}/inbox")
        stream = jobs.stream_messages(spark, f"{root}/inbox", "parquet")
        got = jobs.merge_stream(stream, f"{root}/winners", f"{root}/checkpoint", **options)
    return root, got


def test_winners_of_any_order_of_files_equal_the_batch_job(spark):
    rng = random.Random(1)
    everything = []
    for i in range(300):
        second = rng.choice([None, rng.randrange(10 * 86_400)])
        for src in rng.sample(["db", "csv", "txt"], rng.randint(1, 3)):
            everything.append(message(1000 * len(src) + i, second, src, f"t{i % 50}", rng.choice([None, "", f"n{i}"]), rng.choice(["a", "b", None])))
    rng.shuffle(everything)
    _, got = run(spark, [everything[k::3] for k in range(3)])
    assert rows_of(got) == rows_of(messages.merge_messages(spark.createDataFrame(everything, MSG)))


def test_a_repeated_batch_writes_nothing(spark):
    part = [message(i, 60 * i, text=str(i)) for i in range(20)] + [message(99, None, text="undated")]
    root, got = run(spark, [part])
    before, version = rows_of(got), generations.current(spark, f"{root}/winners").version
    jobs.merge_batch(spark.createDataFrame(part, MSG), f"{root}/winners", 31)
    assert generations.current(spark, f"{root}/winners").version == version
    jobs.merge_batch(spark.createDataFrame(part, MSG).filter("false"), f"{root}/winners", 31)
    better = spark.createDataFrame([message(500, 60 * 3, "db", "3")], MSG)
    jobs.merge_batch(better, f"{root}/winners", 31)
    now = jobs.merge_stream(jobs.stream_messages(spark, f"{root}/inbox", "parquet"), f"{root}/winners", f"{root}/checkpoint")
    assert len(rows_of(now)) == len(before) and {r.message_id for r in now.filter("text = '3'").collect()} == {500}


def test_a_winner_moves_between_days_and_the_horizon_bounds_it(spark):
    first, later = [message(1, 86_300, "txt", native="7")], [message(2, 86_500, "db", native="7")]
    assert [x[3] for x in rows_of(run(spark, [first, later])[1])] == [2]
    far = [message(3, 50 * 86_400, "db", native="7")]
    assert sorted(x[3] for x in rows_of(run(spark, [first, far], horizon=31)[1])) == [1, 3]


def test_late_rows_are_counted_not_lost_silently(spark):
    root = scratch_dir(spark, "late")
    for k, part in enumerate(([message(i, 600 * i, text=str(i)) for i in range(50)], [message(200, 0, text="late"), message(201, 31_000, text="new")])):
        spark.createDataFrame(part, MSG).write.mode("append").parquet(f"{root}/inbox")
        kept, progress = jobs.resume_to_table(jobs.stream_dedup(jobs.stream_messages(spark, f"{root}/inbox", "parquet")), root)
        assert (sum(p.n_input for p in progress), sum(p.n_late for p in progress)) == [(50, 0), (2, 1)][k]
    assert kept.count() == 51


def test_people_are_counted_exactly_per_closed_week(spark):
    week = 7 * 86_400
    rows = [(*message(i, i * 3_000)[:3], f"p{i % 7}", "t", i % 11 == 0, "csv", [], None, None) for i in range(600)] + [message(9_999, 9 * week)]
    root = scratch_dir(spark, "people")
    df = spark.createDataFrame(rows, MSG)
    df.repartition(4).write.parquet(f"{root}/inbox")
    got = jobs.run_to_table(jobs.stream_digest_stats(jobs.stream_messages(spark, f"{root}/inbox", "parquet")), "stats")
    want = df.filter("message_id < 9999").groupBy("room_id", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")).agg(
        F.count("*").alias("n_messages"), F.count_distinct(F.when(~F.col("is_system"), F.col("nickname"))).alias("n_people"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("name", ["stream_messages", "stream_weekly_counts"])
def test_tables_of_several_files(spark, tmp_path, name):
    """A table that Spark wrote is a folder; its rows are streamed like those of one file."""
    one = "/root/testdata/sf0.001"
    spark.read.parquet(f"{one}/events.parquet").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    assert streams is not None
    want, got = (sorted(map(tuple, QUERIES[name](spark, d).collect())) for d in (one, str(tmp_path)))
    assert got == want and want
