"""Chat exports, normalised messages and the inbox of export files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chatloom.functions.vectors import nfc
from chatloom.schemas import CHAT_CSV, MESSAGE


def read_chat_csv(spark: SparkSession, path: str) -> DataFrame:
    """Three-column export; a row that does not parse keeps its text in ``_corrupt``."""
    return (
        spark.read.schema(CHAT_CSV)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
        .csv(path)
    )


def read_chat_csv_in_splits(spark: SparkSession, path: str) -> DataFrame:
    """``read_chat_csv`` for exports of any size: one large file is read by many tasks.

    Lines are read in splits. A line lies inside a quoted field if an odd number of quotes stands before it, so each
    split only needs the quotes of the splits before it: their counts are a row per split, summed in order per file.
    A record goes from a line outside quotes to the next such line and belongs to the split that it begins in; lines
    of a later split that go on with it are sent there. Records are put together by groups of their own few lines.

    The first record of each file is its header. A record that does not parse keeps its text in ``_corrupt``.
    Exports use doubled quotes inside quoted fields; a quote within an unquoted field would open one.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    lines = lines.withColumn("quotes", quotes.cast("long"))
    # splits in order: quotes before each, from a row per split
    in_file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("quotes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")).select("file", "block", (before % 2).alias("odd"))
    # a split has bounded size, so its lines can be numbered in one task
    in_split = Window.partitionBy("file", "block").orderBy("at")
    within = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opened = lines.join(splits, ["file", "block"]).withColumn("starts", (F.col("odd") + within) % 2 == 0)
    numbered = opened.withColumn("record", F.sum(F.col("starts").cast("long")).over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
    # lines before the first start of a split belong to the last record of the nearest split before that has a start
    counted = numbered.groupBy("file", "block").agg(F.max("record").alias("n"))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    having = F.when(F.col("n") > 0, F.struct("block", "n"))
    owners = counted.select("file", "block", F.last(having, ignorenulls=True).over(earlier).alias("owner"))
    placed = numbered.join(owners, ["file", "block"]).select(
        "file", F.when(F.col("record") > 0, F.col("block")).otherwise(F.coalesce("owner.block", "block")).alias("home"),
        F.when(F.col("record") > 0, F.col("record")).otherwise(F.coalesce("owner.n", F.lit(0))).alias("record"), "block", "at", "line")
    records = placed.groupBy("file", "home", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts")).select(
        "file", "home", "record", F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["line"]), "\n"), "\r\\z", "").alias("text"))
    header = records.groupBy("file").agg(F.min(F.struct("home", "record")).alias("first"))
    body = records.join(header, "file").filter(F.struct("home", "record") != F.col("first")).filter(F.trim("text") != "")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CHAT_CSV)
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "true"}
    return body.select(F.from_csv("text", schema, options).alias("row")).select("row.*")


def write_chat_csv(messages: DataFrame, path: str) -> None:
    messages.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date"),
        F.col("nickname").alias("User"), F.col("text").alias("Message"),
    ).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_messages_jsonl(messages: DataFrame, path: str) -> None:
    stamped = messages.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    stamped.write.json(path)


def read_messages_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One message per line; the schema is given, not inferred.

    Blank lines are skipped; lines that are no JSON object are listed by
    ``rejected_jsonl``.
    """
    return _jsonl(spark, path).filter(F.col("_line").isNull()).drop("_line")


def rejected_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``(line)``: what ``read_messages_jsonl`` cannot read, as it stands in the file."""
    return _jsonl(spark, path).filter(F.col("_line").isNotNull()).select(F.col("_line").alias("line"))


def _jsonl(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*MESSAGE.fields, StructField("_line", StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"})
    return lines.select(parsed.alias("m"), "value").select(
        *[F.col(f"m.{f.name}").alias(f.name) for f in MESSAGE.fields], F.coalesce("m._line", F.when(F.col("m").isNull(), F.col("value"))).alias("_line"))


def write_messages(messages: DataFrame, path: str) -> None:
    """The message store: Parquet by room and period, so that a scan prunes both."""
    (
        messages.hint("rebalance", "room_id", "period_id")  # few files each; a full one is split
        .write.mode("append").partitionBy("room_id", "period_id").parquet(path)
    )


def scan_messages(spark: SparkSession, path: str, room: str | None = None, period: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if room is not None:
        df = df.filter(F.col("room_id") == room)
    if period is not None:
        df = df.filter(F.col("period_id") == period)
    return df


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Names and times below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size")
    )


def pending_files(files: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Export files not yet processed; names are compared in NFC."""
    exports = files.filter(F.lower("name").rlike(r"\.(csv|txt)\z")).withColumn("nfc_name", nfc("name"))
    done = processed.select(*keys, nfc("name").alias("nfc_name")).distinct()
    return exports.join(done, [*keys, "nfc_name"], "left_anti")


def newest_file(pending: DataFrame, keys: list[str]) -> DataFrame:
    """Exports are cumulative, so the newest holds the older ones."""
    return pending.groupBy(*keys).agg(
        F.max(F.struct("mtime", "nfc_name")).alias("f"), F.count(F.lit(1)).alias("n_pending")
    ).select(*keys, F.col("f.nfc_name").alias("name"), F.col("f.mtime").alias("mtime"), "n_pending")


def ingest_verdict(raw: DataFrame, ts: Column, since: Column, keys: list[str]) -> DataFrame:
    """Per file: ``suspect`` if no row parses, ``stale`` if all is older, else ``ok``.

    ``raw`` keeps one all-NULL row for a file without rows, which is ``empty``.
    """
    filled = F.coalesce("Date", "User", "Message").isNotNull()
    agg = raw.groupBy(*keys).agg(
        F.count_if(filled).alias("n_rows"), F.count_if(filled & ts.isNotNull()).alias("n_ok"),
        F.max(ts).alias("last"), F.max(since).alias("since"),
    )
    verdict = (
        F.when(F.col("n_rows") == 0, F.lit("empty"))
        .when(F.col("n_ok") == 0, F.lit("suspect"))
        .when(F.col("last") < F.col("since"), F.lit("stale"))
        .otherwise(F.lit("ok"))
    )
    return agg.select(*keys, "n_rows", "n_ok", verdict.alias("verdict"))
