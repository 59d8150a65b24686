"""Queries on messages, threads and periods."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import dates, text
from chatloom.operators import messages as M
from chatloom.operators import report, runlog
from chatloom.plans import derive
from chatloom.plans.derive import GAPPY_MERGED_SQL, GAPPY_SQL, MERGED_SQL, MSG_SQL, STAMP_SQL, stamp, threads_sql, week
from chatloom.plans.registry import query
from chatloom.session import scratch_dir
from chatloom.sources import chat

ROOM_WEEK = ["room_id", "week"]


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = derive.messages(spark, sf_dir)
    return M.merge_messages(own, derive.overlap(own))


@query("weekly_digest_stats", f"""
WITH {MERGED_SQL}, {threads_sql('merged')},
stats AS (
  SELECT room_id, week, count(*) AS n_messages,
         count(DISTINCT CASE WHEN NOT is_system THEN nickname END) AS n_people,
         count(DISTINCT thread_id) AS n_threads
  FROM threaded GROUP BY ALL),
asked AS (
  SELECT q.room_id, q.week, count(*) AS n_questions, count(r.reply_to) AS n_resolved
  FROM merged q LEFT JOIN (SELECT DISTINCT room_id, reply_to FROM merged) r
    ON r.room_id = q.room_id AND r.reply_to = q.native_id
  WHERE q.text LIKE 'error%' GROUP BY ALL)
SELECT room_id, week, strftime(week::DATE, '%Y.%m.%d') || ' - ' ||
         CASE WHEN year(week::DATE) = year(week::DATE + 6) THEN strftime(week::DATE + 6, '%m.%d')
              ELSE strftime(week::DATE + 6, '%Y.%m.%d') END AS label,
       'insight-' || strftime(week::DATE, '%Y%m%d') || '-' || strftime(week::DATE + 6, '%Y%m%d') AS content_id,
       n_messages, n_people, n_threads,
       coalesce(n_questions, 0) AS n_questions, coalesce(n_resolved, 0) AS n_resolved
FROM stats LEFT JOIN asked USING (room_id, week)""")
def weekly_digest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged(spark, sf_dir).withColumn("week", week())
    answered = rows.filter(F.col("reply_to").isNotNull()).select(
        "room_id", F.col("reply_to").alias("native_id"), F.lit(True).alias("answered")
    ).distinct()
    questions = (
        rows.filter(F.col("text").startswith("error"))
        .join(answered, ["room_id", "native_id"], "left")
        .select(*ROOM_WEEK, F.col("answered").isNotNull().alias("resolved"))
    )
    start = F.to_date("week")
    end = F.date_add(start, 6)
    return M.digest_stats(M.split_threads(rows), ROOM_WEEK, questions).select(
        *ROOM_WEEK, dates.period_label(start, end).alias("label"), dates.content_id(start, end).alias("content_id"),
        "n_messages", "n_people", "n_threads", "n_questions", "n_resolved",
    )


@query("dedup_overlap", f"""
WITH {GAPPY_MERGED_SQL}
SELECT room_id, dedup_key, message_id, src, {STAMP_SQL.format('ts')} AS ts FROM merged""")
def dedup_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some messages have no time or no text; they stay apart by the parts that they have."""
    own = derive.gappy(derive.messages(spark, sf_dir))
    return M.merge_messages(own, derive.overlap(own)).select("room_id", "dedup_key", "message_id", "src", stamp("ts").alias("ts"))


@query("threads_gap", f"""
WITH {MSG_SQL}, {threads_sql('msg')}
SELECT room_id, thread_id, {STAMP_SQL.format('min(ts)')} AS start_ts, {STAMP_SQL.format('max(ts)')} AS end_ts,
       count(*) AS n_messages, count(DISTINCT CASE WHEN NOT is_system THEN nickname END) AS participants
FROM threaded GROUP BY room_id, thread_id""")
def threads_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.threads(derive.messages(spark, sf_dir)).select(
        "room_id", "thread_id", stamp("start_ts").alias("start_ts"), stamp("end_ts").alias("end_ts"),
        "n_messages", "participants",
    )


@query("message_threads", f"""
WITH {GAPPY_SQL}, dated AS (SELECT * FROM msg WHERE ts IS NOT NULL), {threads_sql('dated')}
SELECT message_id, thread_id FROM threaded UNION ALL SELECT message_id, NULL FROM msg WHERE ts IS NULL""")
def message_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.split_threads(derive.gappy(derive.messages(spark, sf_dir))).select("message_id", "thread_id")


@query("slice_counts", f"""
WITH {MSG_SQL}
SELECT room_id, count(*) AS n FROM msg
WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY room_id""")
def slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.slice_period(derive.messages(spark, sf_dir), datetime(2024, 1, 8), datetime(2024, 1, 22))
    return rows.groupBy("room_id").agg(F.count(F.lit(1)).alias("n"))


@query("period_range", f"""
WITH {MSG_SQL}
SELECT room_id, week, strftime(min(ts), '%Y-%m-%d') AS start_date, strftime(max(ts), '%Y-%m-%d') AS end_date
FROM msg GROUP BY room_id, week""")
def period_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.messages(spark, sf_dir).withColumn("week", week())
    return M.period_range(rows, ROOM_WEEK).select(
        *ROOM_WEEK, F.date_format("start", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end", "yyyy-MM-dd").alias("end_date"),
    )


@query("next_watermark", f"""
WITH {MSG_SQL}
SELECT room_id, {STAMP_SQL.format("max(ts) + INTERVAL 1 SECOND")} AS next_since FROM msg GROUP BY room_id""")
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.next_watermark(derive.messages(spark, sf_dir), ["room_id"]).select(
        "room_id", stamp("next_since").alias("next_since")
    )


@query("reply_links", f"""
WITH {MSG_SQL}
SELECT c.message_id, c.reply_to, p.message_id AS parent_id, p.nickname AS parent_nickname
FROM msg c LEFT JOIN msg p ON p.room_id = c.room_id AND p.native_id = c.reply_to
WHERE c.reply_to IS NOT NULL""")
def reply_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.link_replies(derive.messages(spark, sf_dir)).select(
        "message_id", "reply_to", "parent_id", "parent_nickname"
    )


@query("rank_topics", f"""
WITH {MSG_SQL}, {threads_sql('msg')},
t AS (
  SELECT room_id, min(week) AS week, thread_id, count(*) AS n_messages,
         count(DISTINCT CASE WHEN NOT is_system THEN nickname END) AS participants,
         count(*) FILTER (WHERE text LIKE 'error%') AS n_unresolved
  FROM threaded GROUP BY room_id, thread_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY room_id, week
    ORDER BY n_messages DESC, participants DESC, n_unresolved DESC, thread_id) AS position FROM t)
SELECT room_id, week, thread_id, n_messages, participants, n_unresolved, position FROM r WHERE position <= 5""")
def rank_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.split_threads(derive.messages(spark, sf_dir))
    small = rows.groupBy("room_id", "thread_id", F.when(~F.col("is_system"), F.col("nickname")).alias("person")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("ts"), F.count_if(F.col("text").startswith("error")).alias("open")
    )
    per_thread = small.groupBy("room_id", "thread_id").agg(
        F.min("ts").alias("ts"), F.sum("n").alias("n_messages"),
        F.countDistinct("person").alias("participants"), F.sum("open").alias("n_unresolved"),
    ).withColumn("week", week()).drop("ts")
    return report.rank_topics(per_thread, ROOM_WEEK, 5)


@query("sections_fixed", f"""
WITH {MSG_SQL},
fixed_rows(position, section, label, title, empty_message) AS (VALUES
  (1, 'topics', 'Topics', '많이 나눈 이야기', '주제로 묶인 대화가 없습니다.'),
  (2, 'solved', 'Answers', '답을 찾은 질문', '답을 찾은 질문이 없습니다.'),
  (3, 'open', 'Questions', '답을 찾는 질문', '남은 질문이 없습니다.'),
  (4, 'tips', 'Know-how', '나눈 요령', '새로 나눈 요령이 없습니다.'),
  (5, 'actions', 'To do', '할 일', '정한 일이 없습니다.'),
  (6, 'involved', 'Join', '참여 방법', '')),
days AS (SELECT DISTINCT room_id, strftime(ts, '%Y-%m-%d') AS day FROM msg),
counts AS (
  SELECT room_id, strftime(ts, '%Y-%m-%d') AS day,
         CASE split_part(text, ' ', 1) WHEN 'view' THEN 'topics' WHEN 'click' THEN 'solved' WHEN 'error' THEN 'open'
           WHEN 'purchase' THEN 'tips' ELSE 'actions' END AS section, count(*) AS n
  FROM msg GROUP BY ALL)
SELECT room_id, day, position::BIGINT AS position, section, label, title, coalesce(n, 0) AS n_items,
       CASE WHEN coalesce(n, 0) = 0 THEN empty_message ELSE '' END AS message
FROM days CROSS JOIN fixed_rows LEFT JOIN counts USING (room_id, day, section)""")
def sections_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.split("text", " "), 1)
    section = (
        F.when(kind == "view", "topics").when(kind == "click", "solved").when(kind == "error", "open")
        .when(kind == "purchase", "tips").otherwise("actions")
    )
    rows = derive.messages(spark, sf_dir).select(
        "room_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), section.alias("section")
    )
    counts = rows.groupBy("room_id", "day", "section").agg(F.count(F.lit(1)).alias("n"))
    return report.section_table(counts.select("room_id", "day").distinct(), counts, ["room_id", "day"])


@query("issue_labels", f"""
WITH {MSG_SQL}, w AS (SELECT DISTINCT room_id, week FROM msg),
i AS (SELECT *, row_number() OVER (PARTITION BY room_id ORDER BY week) AS issue, week::DATE AS s, week::DATE + 6 AS e FROM w)
SELECT room_id, week, issue, 'community-insight-' || format('{{:03d}}', issue) AS slug,
       issue || '호_' || strftime(s, '%y%m%d') || '~' || strftime(e, '%y%m%d') AS archive,
       replace(week, '-', '.') AS shown,
       issue || '호 · ' || room_id || ' 이번 주' AS title,
       room_id || '__' || strftime(s, '%Y%m%d') || '-' ||
         CASE WHEN issue % 2 = 0 THEN '끝' ELSE strftime(e, '%Y%m%d') END AS slice,
       strftime(s + INTERVAL 12 HOUR - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS generated_at
FROM i""")
def issue_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.messages(spark, sf_dir).select("room_id", week().alias("period_id")).distinct()
    start = F.to_date("period_id")
    end = F.date_add(start, 6)
    issue = F.col("issue")
    return M.issue_number(rows).select(
        "room_id", F.col("period_id").alias("week"), "issue", dates.slug(issue).alias("slug"),
        dates.archive_name(issue, F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")).alias("archive"),
        dates.display_date(F.col("period_id")).alias("shown"),
        text.digest_title(
            F.concat("room_id", F.lit(" 이번 주")), F.lit("보고"), issue, F.col("period_id"), "hook", True
        ).alias("title"),
        dates.slice_id(F.col("room_id"), start, F.when(issue % 2 != 0, end)).alias("slice"),
        dates.normalize_generated_at(
            F.concat("period_id", F.lit("T12:00:00.25+09:00"))
        ).alias("generated_at"),
    )


@query("issue_of_next_week", f"""
WITH {MSG_SQL}, w AS (SELECT DISTINCT room_id, week FROM msg),
wanted AS (SELECT room_id, max(week) AS period_id FROM w GROUP BY room_id
           UNION ALL SELECT room_id, '9999-01-01' FROM w GROUP BY room_id)
SELECT room_id, period_id, (SELECT count(*) FROM w WHERE w.room_id = x.room_id AND w.week <= x.period_id)
  + CASE WHEN period_id = '9999-01-01' THEN 1 ELSE 0 END AS issue
FROM wanted x""")
def issue_of_next_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = derive.messages(spark, sf_dir).select("room_id", week().alias("period_id")).distinct()
    last = periods.groupBy("room_id").agg(F.max("period_id").alias("period_id"))
    unseen = last.select("room_id", F.lit("9999-01-01").alias("period_id"))
    return M.issue_for(periods, last.unionByName(unseen))


# --- sources ---------------------------------------------------------------------------------------

@query("csv_roundtrip", f"""
WITH {MSG_SQL}
SELECT nickname, text, {STAMP_SQL.format('ts')} AS ts, nickname IS NULL AS is_system, 'csv' AS src FROM msg""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    chat.write_chat_csv(derive.messages(spark, sf_dir), path)
    rows = M.normalize_messages(chat.read_chat_csv(spark, path).drop("_corrupt"), "csv")
    return rows.select("nickname", "text", stamp("ts").alias("ts"), "is_system", "src")


@query("csv_splits", f"""
WITH {MSG_SQL}
SELECT nickname, replace(text, ' ', chr(10) || '"') AS text, {STAMP_SQL.format('ts')} AS ts FROM msg""")
def csv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of all messages, their texts with line breaks and quotes, read in splits of a hundredth of it or 16 MB at most.

    It has a file for each part of the table, so no task writes it alone; files are cut into splits like one large one.
    """
    path = scratch_dir(spark, "csv")
    texts = derive.messages(spark, sf_dir).withColumn("text", F.replace("text", F.lit(" "), F.lit('\n"')))
    chat.write_chat_csv(texts, path)
    size = chat.list_files(spark, path).agg(F.count(F.lit(1)), F.sum("size")).first()[1]
    sized = spark.newSession()
    sized.conf.set("spark.sql.files.maxPartitionBytes", max(1 << 12, min(size // 100, 16 << 20)))
    sized.conf.set("spark.sql.session.timeZone", "UTC")
    rows = M.normalize_messages(chat.read_chat_csv_in_splits(sized, path).drop("_corrupt"), "csv")
    return rows.select("nickname", "text", stamp("ts").alias("ts"))


_ALL = "room_id, message_id, nickname, text, is_system, src, reply_to, native_id"


@query("jsonl_roundtrip", f"WITH {MSG_SQL} SELECT {_ALL}, {STAMP_SQL.format('ts')} AS ts FROM msg")
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "jsonl")
    chat.write_messages_jsonl(derive.messages(spark, sf_dir), path)
    return chat.read_messages_jsonl(spark, path).select(*_ALL.split(", "), stamp("ts").alias("ts"))


@query("jsonl_rejects", f"""
WITH {MSG_SQL}
SELECT message_id, CASE message_id % 6 WHEN 1 THEN 'rejected' ELSE 'kept' END AS fate FROM msg""")
def jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth line is cut off in the middle; each line is either read or listed as it was."""
    path = scratch_dir(spark, "jsonl")
    line = F.to_json(F.struct("message_id", "room_id", "text", "nickname", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts")))
    cut = F.when(F.col("message_id") % 6 == 1, F.expr("substring(line, 1, length(line) - 4)")).otherwise(F.col("line"))
    derive.messages(spark, sf_dir).withColumn("line", line).select(cut.alias("value")).write.text(path)
    rejected = chat.rejected_jsonl(spark, path).select(F.regexp_extract("line", '"message_id":([0-9]+)', 1).cast("bigint").alias("message_id"), F.lit("rejected").alias("fate"))
    return chat.read_messages_jsonl(spark, path).select("message_id", F.lit("kept").alias("fate")).unionByName(rejected)


@query("message_store", f"""
WITH {MSG_SQL} SELECT room_id, message_id, week AS period_id, text FROM msg WHERE week = '2024-01-08'""")
def message_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "messages")
    chat.write_messages(derive.messages(spark, sf_dir).withColumn("period_id", week()), path)
    stored = chat.scan_messages(spark, path, period="2024-01-08")
    return stored.select("room_id", "message_id", F.col("period_id").cast("string").alias("period_id"), "text")


_RAW_SQL = """
raw AS (
  SELECT 'export_' || user_id AS file,
         CASE WHEN user_id % 11 = 0 OR event_id % 17 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d, ts,
         CASE WHEN user_id % 11 = 0 OR event_id % 17 = 0 THEN NULL ELSE ts END AS ok_ts, user_id FROM events)"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows per file; every eleventh file and some rows have no valid date."""
    broken = (F.col("user_id") % 11 == 0) | (F.col("event_id") % 17 == 0)
    return derive.table(spark, sf_dir, "events").select(
        F.concat(F.lit("export_"), F.col("user_id").cast("string")).alias("file"),
        F.when(broken, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("Date"),
        F.col("event_type").alias("User"), F.col("props").alias("Message"), "user_id",
    )


@query("parse_rate", f"""
WITH {_RAW_SQL}
SELECT file, count(*) AS n_rows, count(ok_ts) AS n_parsed, round(count(ok_ts) / count(*), 6) AS rate FROM raw GROUP BY file""")
def parse_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.parse_rate(_raw(spark, sf_dir), F.col("Date").try_cast("timestamp").isNotNull(), ["file"])


@query("ingest_verdict", f"""
WITH {_RAW_SQL}
SELECT file, count(*) AS n_rows, count(ok_ts) AS n_ok,
       CASE WHEN count(ok_ts) = 0 THEN 'suspect'
            WHEN max(ok_ts) < TIMESTAMP '2024-01-28' + INTERVAL (min(user_id % 3)) DAY THEN 'stale' ELSE 'ok' END AS verdict
FROM raw GROUP BY file
UNION ALL SELECT 'inbox_' || page_id, 0, 0, 'empty' FROM pages""")
def ingest_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.timestamp_seconds(F.lit(1706400000) + (F.col("user_id") % 3) * 86400)  # 2024-01-28 UTC
    none = F.lit(None).cast("string")
    empty = derive.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("inbox_"), F.col("page_id").cast("string")).alias("file"),
        none.alias("Date"), none.alias("User"), none.alias("Message"), F.lit(None).cast("bigint").alias("user_id"),
    )
    raw = _raw(spark, sf_dir).unionByName(empty)
    return chat.ingest_verdict(raw, F.col("Date").try_cast("timestamp"), since, ["file"])


_FILES_SQL = """
files AS (
  SELECT 'r' || (page_id % 7) AS room_id,
         CASE page_id % 2 WHEN 0 THEN 'cafe' || chr(769) ELSE 'caf' || chr(233) END || '_' || page_id ||
           CASE page_id % 5 WHEN 0 THEN '.html' WHEN 1 THEN '.CSV' ELSE '.txt' END AS name,
         TIMESTAMP '2024-01-01' + INTERVAL (page_id) MINUTE AS mtime, page_id FROM pages),
done AS (
  SELECT 'r' || (page_id % 7) AS room_id,
         'caf' || chr(233) || '_' || page_id || CASE page_id % 5 WHEN 0 THEN '.html' WHEN 1 THEN '.CSV' ELSE '.txt' END AS name
  FROM pages WHERE length(html) % 3 = 0),
pending AS (
  SELECT f.room_id, nfc_normalize(f.name) AS name, mtime FROM files f
  WHERE regexp_matches(lower(f.name), '\\.(csv|txt)$')
    AND NOT EXISTS (SELECT 1 FROM done d WHERE d.room_id = f.room_id AND d.name = nfc_normalize(f.name)))"""


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive.table(spark, sf_dir, "pages")
    page = F.col("page_id")
    ending = F.when(page % 5 == 0, ".html").when(page % 5 == 1, ".CSV").otherwise(".txt")
    room = F.concat(F.lit("r"), (page % 7).cast("string")).alias("room_id")
    composed = F.concat(F.lit("caf\u00e9_"), page.cast("string"), ending)
    split = F.concat(F.lit("cafe\u0301_"), page.cast("string"), ending)
    files = pages.select(
        room, F.when(page % 2 == 0, split).otherwise(composed).alias("name"),
        F.timestamp_seconds(F.lit(1704067200) + page * 60).alias("mtime"),
    )
    done = pages.filter(F.length("html") % 3 == 0).select(room, composed.alias("name"))
    return chat.pending_files(files, done, ["room_id"])


@query("pending_files", f"WITH {_FILES_SQL} SELECT room_id, name, {STAMP_SQL.format('mtime')} AS mtime FROM pending")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir).select("room_id", F.col("nfc_name").alias("name"), stamp("mtime").alias("mtime"))


@query("pending_on_disk", f"""
WITH {MSG_SQL}, rooms AS (SELECT room_id, count(*) AS n_messages FROM msg GROUP BY ALL)
SELECT room_id, n_messages FROM rooms WHERE substr(room_id, 2)::BIGINT % 3 <> 0""")
def pending_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of real exports, one per room: listed, those done before left out, the rest read."""
    path = scratch_dir(spark, "exports")
    rows = derive.messages(spark, sf_dir).select("room_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date"), F.col("nickname").alias("User"), F.col("text").alias("Message"))
    rows.repartition("room_id").write.option("header", True).option("escape", '"').option("quoteAll", True).partitionBy("room_id").csv(path)
    files = chat.list_files(spark, path).withColumn("room_id", F.regexp_extract("path", "room_id=([^/]+)/", 1))
    done = files.filter(F.substring("room_id", 2, 20).cast("bigint") % 3 == 0).select("room_id", "name")
    pending = chat.pending_files(files, done, ["room_id"]).select("room_id", "name")
    read = chat.read_chat_csv(spark, f"{path}/*").withColumn("name", F.element_at(F.split("_metadata.file_path", "/"), -1)) \
        .withColumn("room_id", F.regexp_extract("_metadata.file_path", "room_id=([^/]+)/", 1))
    return read.join(pending, ["room_id", "name"], "left_semi").groupBy("room_id").agg(F.count(F.lit(1)).alias("n_messages"))


@query("newest_files", f"""
WITH {_FILES_SQL}
SELECT room_id, arg_max(name, mtime) AS name, {STAMP_SQL.format('max(mtime)')} AS mtime, count(*) AS n_pending
FROM pending GROUP BY room_id""")
def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.newest_file(_pending(spark, sf_dir), ["room_id"]).select(
        "room_id", "name", stamp("mtime").alias("mtime"), "n_pending"
    )


# --- run log ------------------------------------------------------------------------------------------

_LOG_SQL = """
log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, 'A' || (event_id % 8) AS stage,
         CASE event_type WHEN 'error' THEN 'failure' WHEN 'signup' THEN 'skip' ELSE 'success' END AS status
  FROM events)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return derive.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("A"), (F.col("event_id") % 8).cast("string")).alias("stage"),
        F.when(kind == "error", "failure").when(kind == "signup", "skip").otherwise("success").alias("status"),
        F.when(kind == "error", F.col("props")).alias("detail"),
    )


@query("run_log", f"WITH {_LOG_SQL} SELECT date, stage, status, count(*) AS n FROM log GROUP BY ALL")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "runlog")
    runlog.append_run_log(_log(spark, sf_dir), path)
    stored = spark.read.schema("ts timestamp, stage string, status string, detail string, date date").json(path)
    return stored.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date"), "stage", "status").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("run_summary", f"""
WITH {_LOG_SQL}
SELECT date, stage, count(*) FILTER (WHERE status = 'success') AS success,
       count(*) FILTER (WHERE status = 'failure') AS failure, count(*) FILTER (WHERE status = 'skip') AS skip
FROM log GROUP BY date, stage""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_summary(_log(spark, sf_dir).withColumn("date", F.date_format("ts", "yyyy-MM-dd")))


@query("escalations", f"""
WITH {MSG_SQL}
SELECT strftime(ts, '%Y-%m-%d') AS date, 'A5' AS stage, text AS reason, 'm' || message_id AS file
FROM msg WHERE text LIKE 'error%'""")
def escalations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "escalations")
    rows = derive.messages(spark, sf_dir).filter(F.col("text").startswith("error")).select(
        "ts", F.lit("A5").alias("stage"), F.col("text").alias("reason"),
        F.array(F.concat(F.lit("m"), F.col("message_id").cast("string"))).alias("files"),
    )
    runlog.append_escalations(rows, path)
    return spark.read.parquet(path).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "stage", "reason", F.explode("files").alias("file")
    )


@query("recent_rejections", f"""
WITH {MSG_SQL}, last AS (
  SELECT room_id, message_id, text, ts, row_number() OVER (PARTITION BY room_id ORDER BY ts DESC, message_id DESC) AS back
  FROM msg WHERE text LIKE 'error%')
SELECT room_id, message_id, text AS reason, row_number() OVER (PARTITION BY room_id ORDER BY ts, message_id) AS position
FROM last WHERE back <= 3""")
def recent_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.messages(spark, sf_dir).filter(F.col("text").startswith("error"))
    return runlog.recent_rejections(rows, ["room_id"], ["ts", "message_id"]).select(
        "room_id", "message_id", F.col("text").alias("reason"), "position"
    )
