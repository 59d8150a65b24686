"""Messages: normalise, deduplicate, slice, split into threads, count.

None of the jobs here puts a whole room, source or duplicate group into one
task: duplicates are reduced by a map-side combined aggregate, and threads are
found on time buckets instead of on rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import dates, text
from chatloom.schemas import MESSAGE


def normalize_messages(raw: DataFrame, src: str | None = None) -> DataFrame:
    """Any source → the common message schema; missing columns become NULL.

    An export row carries ``Date``, ``User`` and ``Message`` instead of ``ts``,
    ``nickname`` and ``text``.
    """
    renamed = raw.withColumnsRenamed({"Date": "ts", "User": "nickname", "Message": "text"})
    have = set(renamed.columns)

    def column(name: str, dtype) -> Column:
        if name == "src" and src is not None:
            value = F.lit(src)
        elif name == "links" and "links" not in have:
            value = F.transform(text.extract_links(F.col("text")), lambda x: x["url"])
        elif name == "ts":
            value = F.col("ts").try_cast("timestamp")
        elif name == "is_system" and "is_system" not in have:
            value = F.col("nickname").isNull()
        elif name in have:
            value = F.col(name)
        else:
            value = F.lit(None)
        return value.cast(dtype).alias(name)

    return renamed.select(*[column(f.name, f.dataType) for f in MESSAGE.fields])


def dedup_key() -> Column:
    """The native id if there is one, else a hash of second, nickname and text.

    Missing parts count as empty, so rows that did not parse stay apart by the
    parts that they have.
    """
    parts = [dates.iso_second(F.col("ts")), F.col("nickname"), F.col("text")]
    hashed = F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)
    native = F.col("native_id")
    return F.when(
        native.isNotNull() & (native != ""), F.concat(F.lit("native:"), native)
    ).otherwise(F.concat(F.lit("hash:"), hashed))


def merge_messages(*batches: DataFrame) -> DataFrame:
    """One row per key over all batches: db before csv before txt, then the earliest; one without a time comes last.

    The winner is an aggregate, not a window, so each task first reduces its own
    rows; a key that a third of all rows share costs one row per task to shuffle.
    """
    union = reduce(DataFrame.unionByName, batches)
    rank = (
        F.when(F.col("src") == "db", 0).when(F.col("src") == "csv", 1)
        .when(F.col("src") == "txt", 2).otherwise(3)
    )
    order = ["ts", "message_id"]
    rest = [c for c in union.columns if c not in order]
    best = F.min(F.struct(rank.alias("rank"), F.col("ts").isNull().alias("undated"), *order, *rest)).alias("m")
    return (
        union.groupBy(F.col("room_id").alias("room"), dedup_key().alias("dedup_key")).agg(best)
        .select("dedup_key", *[F.col(f"m.{c}").alias(c) for c in union.columns])
    )


def slice_period(
    messages: DataFrame,
    since: datetime | None = None,
    until: datetime | None = None,
    mark: datetime | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Half-open slice; without ``since`` the stored mark counts, else a week back."""
    since = since or mark or (now - timedelta(days=7) if now else None)
    if since is not None:
        messages = messages.filter(F.col("ts") >= F.lit(since))
    if until is not None:
        messages = messages.filter(F.col("ts") < F.lit(until))
    return messages


def week_start(ts: str = "ts") -> Column:
    return F.to_date(F.date_trunc("week", F.col(ts)))


# --- threads -------------------------------------------------------------------------

def _bucket(gap_seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col("ts")) / F.lit(gap_seconds * 1_000_000)).cast("bigint")


def _bucket_threads(per_bucket: DataFrame, gap_seconds: int) -> DataFrame:
    """Number the threads on (room, bucket) rows with ``lo`` and ``hi``.

    Two messages in one bucket of gap length are never more than a gap apart, so
    a bucket lies in one thread and only bucket borders can start a new one.
    The window sees one row per room and gap, however many messages there are.
    """
    by_room = Window.partitionBy("room_id").orderBy("bucket")
    previous = F.lag("hi").over(by_room)
    starts = previous.isNull() | (
        F.unix_micros("lo") - F.unix_micros(previous) > gap_seconds * 1_000_000
    )
    return (
        per_bucket.withColumn("starts", starts.cast("bigint"))
        .withColumn("ordinal", F.sum("starts").over(by_room))
        .drop("starts")
    )


def thread_name(room: str = "room_id", ordinal: str = "ordinal") -> Column:
    return F.concat(F.col(room), F.lit("-"), F.format_string("%06d", F.col(ordinal)))


def split_threads(messages: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Messages with ``thread_id``: a new thread starts after a silence > gap.

    Messages without a time are kept and have no thread.
    """
    gap = gap_minutes * 60
    keyed = messages.withColumn("bucket", _bucket(gap))
    dated = keyed.filter(F.col("bucket").isNotNull())
    per_bucket = dated.groupBy("room_id", "bucket").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    numbered = _bucket_threads(per_bucket, gap).select(
        "room_id", "bucket", thread_name().alias("thread_id")
    )
    return keyed.join(numbered, ["room_id", "bucket"], "left").drop("bucket")


def threads(messages: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per thread of dated messages.

    Rows are combined to (room, bucket, nickname) before anything is shuffled;
    spans and distinct people both come from that small table.
    """
    gap = gap_minutes * 60
    person = F.when(~F.coalesce(F.col("is_system"), F.lit(False)), F.col("nickname"))
    small = messages.filter(F.col("ts").isNotNull()).groupBy(
        "room_id", _bucket(gap).alias("bucket"), person.alias("person")
    ).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    per_bucket = small.groupBy("room_id", "bucket").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"),
    )
    numbered = _bucket_threads(per_bucket, gap)
    spans = numbered.groupBy("room_id", "ordinal").agg(
        F.min("lo").alias("start_ts"), F.max("hi").alias("end_ts"), F.sum("n").alias("n_messages"),
    )
    people = (
        small.filter(F.col("person").isNotNull())
        .join(numbered.select("room_id", "bucket", "ordinal"), ["room_id", "bucket"])
        .groupBy("room_id", "ordinal").agg(F.countDistinct("person").alias("participants"))
    )
    return (
        spans.join(people, ["room_id", "ordinal"], "left")
        .select(
            "room_id", thread_name().alias("thread_id"), "ordinal", "start_ts", "end_ts",
            "n_messages", F.coalesce("participants", F.lit(0)).cast("bigint").alias("participants"),
        )
    )


# --- periods and counts -----------------------------------------------------------------

def period_range(
    messages: DataFrame, keys: list[str], since: Column | None = None, until: Column | None = None
) -> DataFrame:
    """First and last date actually covered, falling back to the requested bounds."""
    none = F.lit(None).cast("timestamp")
    since, until = since if since is not None else none, until if until is not None else none
    return messages.groupBy(*keys).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        *keys,
        F.to_date(F.coalesce("lo", since)).alias("start"),
        F.to_date(F.coalesce("hi", until, "lo", since)).alias("end"),
    )


def next_watermark(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Where the next cycle starts: one second after the last message covered."""
    return messages.groupBy(*keys).agg(
        (F.max("ts") + F.expr("INTERVAL 1 SECOND")).alias("next_since")
    )


def digest_stats(threaded: DataFrame, keys: list[str], questions: DataFrame | None = None) -> DataFrame:
    """Messages, people, threads, questions and resolved questions per key.

    Rows are combined before the distinct counts; ``questions`` holds the keys
    and a boolean ``resolved``.
    """
    person = F.when(~F.coalesce(F.col("is_system"), F.lit(False)), F.col("nickname"))
    small = threaded.groupBy(*keys, "thread_id", person.alias("person")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = small.groupBy(*keys).agg(
        F.sum("n").alias("n_messages"),
        F.countDistinct("person").alias("n_people"),
        F.countDistinct("thread_id").alias("n_threads"),
    )
    if questions is None:
        return counts
    asked = questions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_questions"), F.count_if("resolved").alias("n_resolved")
    )
    return counts.join(asked, keys, "left").na.fill(0, ["n_questions", "n_resolved"])


def parse_rate(raw: DataFrame, ok: Column, keys: list[str]) -> DataFrame:
    return raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ok).alias("n_parsed"),
        F.round(F.count_if(ok) / F.count(F.lit(1)), 6).alias("rate"),
    )


def issue_number(periods: DataFrame, room: str = "room_id", period: str = "period_id") -> DataFrame:
    """1-based position of each period in its room's sorted periods."""
    distinct = periods.select(room, period).distinct()
    return distinct.withColumn(
        "issue", F.row_number().over(Window.partitionBy(room).orderBy(period)).cast("bigint")
    )


def issue_for(periods: DataFrame, wanted: DataFrame, room: str = "room_id", period: str = "period_id") -> DataFrame:
    """Issue of a wanted period; an unseen one comes after all known."""
    known = issue_number(periods, room, period)
    totals = known.groupBy(room).agg(F.count(F.lit(1)).alias("known"))
    return (
        wanted.join(known, [room, period], "left").join(totals, room, "left")
        .select(
            room, period,
            F.coalesce("issue", F.coalesce("known", F.lit(0)) + 1).cast("bigint").alias("issue"),
        )
    )


def link_replies(messages: DataFrame) -> DataFrame:
    """Replies with their parent message; a missing parent leaves NULL."""
    parents = messages.filter(F.col("native_id").isNotNull()).select(
        "room_id", F.col("native_id").alias("reply_to"), F.col("message_id").alias("parent_id"),
        F.col("nickname").alias("parent_nickname"),
    )
    return messages.filter(F.col("reply_to").isNotNull()).join(parents, ["room_id", "reply_to"], "left")
