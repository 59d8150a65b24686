"""Queries on links, tags, dates, ids and long texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.functions import dates, text
from chatloom.operators import publish, report
from chatloom.plans import derive
from chatloom.plans.registry import query


def _sentence():
    url = F.col("url")
    return F.concat(
        F.lit("see ("), url, F.lit(")를, "), url, F.lit("에서 <"), url, F.lit('> "'), url,
        F.lit("/한글로\" then ["), url, F.lit("(x)]... and "), url, F.lit("으로부터!?"),
    )


@query("link_extract", """
WITH found AS (
  SELECT page_id, unnest([url, url, url, url || '/한글로', url || '(x)', url]) AS url,
         unnest(range(0, 6)) AS position FROM pages)
SELECT page_id, position, url, CASE WHEN length(url) <= 52 THEN url ELSE left(url, 49) || '…' END AS shown FROM found""")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = text.extract_links(_sentence())
    return derive.table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(links).alias("position", "link")
    ).select("page_id", F.col("position").cast("bigint").alias("position"), "link.url", "link.shown")


@query("code_spans", """
SELECT page_id, unnest([url, page_id::VARCHAR]) AS span, unnest([0, 1])::BIGINT AS position FROM pages""")
def code_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("run `"), F.col("url"), F.lit("` then `"), F.col("page_id").cast("string"), F.lit("` ``"))
    return derive.table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(text.extract_code_spans(line)).alias("position", "span")
    ).withColumn("position", F.col("position").cast("bigint"))


@query("page_text", r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\s\p{Z}\x0b\x1c-\x1f\x85]+', ' ', 'g'))) AS digest
FROM pages""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text.squeeze_ws(text.strip_tags(F.col("html")))).alias("digest")
    )


@query("tags_clean", "SELECT doc_id, lang || ',' || source || ',자동생성' AS tags FROM documents")
def tags_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array(F.col("lang"), F.lit(""), F.col("source"), F.lit(None).cast("string"), F.col("lang"))
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(text.add_auto_tags(text.ordered_unique(raw)), ",").alias("tags")
    )


_TIPS_SQL = "tips AS (SELECT doc_id, source, CASE WHEN doc_id % 9 <> 0 THEN [lang] ELSE [] END AS tags FROM documents)"


def _tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.when(F.col("doc_id") % 9 != 0, F.array("lang")).otherwise(none).alias("feature_tags")
    )


@query("tips_by_tag", f"""
WITH {_TIPS_SQL}, g AS (SELECT source, coalesce(tags[1], '기타') AS tag, count(*) AS n_tips FROM tips GROUP BY ALL)
SELECT source, tag, n_tips, row_number() OVER (PARTITION BY source ORDER BY n_tips DESC, tag) AS position FROM g""")
def tips_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.tips_by_tag(_tips(spark, sf_dir), ["source"])


@query("tag_domain", f"WITH {_TIPS_SQL} SELECT doc_id, unnest(tags) AS tag FROM tips")
def tag_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.array(*map(F.lit, fixed.FEATURE_TAGS))
    tagged = F.concat("feature_tags", F.slice(known, F.pmod("doc_id", F.lit(10)).cast("int") + 1, 2))
    return report.tag_domain_violations(_tips(spark, sf_dir).withColumn("feature_tags", tagged), "doc_id")


@query("uuid_ids", """
WITH h AS (SELECT page_id, md5(url) AS m, md5(html) AS other FROM pages)
SELECT page_id, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21) AS from_url,
       substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21) AS from_bare,
       NULL::VARCHAR AS from_query
FROM h""")
def uuid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, other = F.md5("url"), F.md5("html")
    return derive.table(spark, sf_dir, "pages").select(
        "page_id",
        text.uuid_from_url(F.concat(F.lit("https://x.example/p/a/"), F.upper(m), F.lit("?v="), other)).alias("from_url"),
        text.uuid_from_url(m).alias("from_bare"),
        text.uuid_from_url(F.concat(F.lit("https://x.example/p?v="), other)).alias("from_query"),
    )


_DATES_SQL = """
given AS (
  SELECT event_id, ts, CASE event_id % 6
      WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y%m%d') WHEN 2 THEN '2024-1-' || day(ts)
      WHEN 3 THEN '2024-02-' || (20 + day(ts) % 15) WHEN 4 THEN strftime(ts, '%Y-%m-%d') || ' ' ELSE NULL END AS d,
    strftime(ts, '%Y-%m-%d') || CASE WHEN event_id % 5 = 0 THEN ' ' ELSE 'T' END || strftime(ts, '%H:%M') ||
      CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, ':%S') END ||
      CASE event_id % 4 WHEN 0 THEN 'Z' WHEN 1 THEN '.5+09:00' WHEN 2 THEN '' ELSE '-03:30' END AS t
  FROM events)"""


@query("strict_dates", f"""
WITH {_DATES_SQL}
SELECT event_id,
  CASE WHEN regexp_full_match(d, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN strftime(try_cast(d AS DATE), '%Y-%m-%d') END AS day,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 4 <> 2 THEN
    strftime(date_trunc('second', ts) - CASE event_id % 4 WHEN 1 THEN INTERVAL 9 HOUR WHEN 3 THEN INTERVAL (-210) MINUTE ELSE INTERVAL 0 HOUR END,
      '%Y-%m-%dT%H:%M:%SZ') END AS instant
FROM given""")
def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, ts = F.col("event_id"), F.col("ts")
    day = (
        F.when(e % 6 == 0, F.date_format(ts, "yyyy-MM-dd")).when(e % 6 == 1, F.date_format(ts, "yyyyMMdd"))
        .when(e % 6 == 2, F.concat(F.lit("2024-1-"), F.dayofmonth(ts).cast("string")))
        .when(e % 6 == 3, F.concat(F.lit("2024-02-"), (F.dayofmonth(ts) % 15 + 20).cast("string")))
        .when(e % 6 == 4, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit(" ")))
    )
    instant = F.concat(
        F.date_format(ts, "yyyy-MM-dd"), F.when(e % 5 == 0, " ").otherwise("T"), F.date_format(ts, "HH:mm"),
        F.when(e % 7 == 0, "").otherwise(F.date_format(ts, ":ss")),
        F.when(e % 4 == 0, "Z").when(e % 4 == 1, ".5+09:00").when(e % 4 == 2, "").otherwise("-03:30"),
    )
    return derive.table(spark, sf_dir, "events").select(
        "event_id", F.date_format(dates.parse_full_date(day), "yyyy-MM-dd").alias("day"),
        dates.normalize_generated_at(instant).alias("instant"),
    )


@query("split_text", """
SELECT doc_id, i AS piece, md5(substr(text, i * 1000 + 1, 1000)) AS digest, length(substr(text, i * 1000 + 1, 1000)) AS n
FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 1, 0) // 1000 + 1)) AS i FROM documents)""")
def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.pieces(F.col("text"), 1000)).alias("piece", "text")
    ).select(
        "doc_id", F.col("piece").cast("bigint").alias("piece"), F.md5("text").alias("digest"),
        F.length("text").cast("bigint").alias("n"),
    )


@query("batch_rows", """
WITH p AS (SELECT doc_id, unnest(range(0, greatest(length(text) - 1, 0) // 20 + 1)) AS i FROM documents)
SELECT doc_id, i // 100 AS batch, count(*) AS n FROM p GROUP BY ALL""")
def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = derive.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.pieces(F.col("text"), 20)).alias("piece", "text")
    )
    return publish.batch_rows(blocks, ["doc_id"], ["piece"], 100).groupBy("doc_id", "batch").agg(
        F.count(F.lit(1)).alias("n")
    )
