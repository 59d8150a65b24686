"""Queries on chunks, vectors and crawl scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.vectors import decode_embedding, encode_embedding
from chatloom.operators import kb
from chatloom.operators import messages as M
from chatloom.operators.vector_search import knn
from chatloom.plans import derive
from chatloom.plans.derive import GAPPY_SQL, threads_sql
from chatloom.plans.registry import query
from chatloom.session import scratch_dir
from chatloom.settings import CrawlSource
from chatloom.sources import documents as store


@query("page_chunks")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kb.chunk_pages(derive.table(spark, sf_dir, "pages"), 500)


# --- versions of chunks -------------------------------------------------------------------------------
# Every page is crawled twice; the second crawl found a changed text on two pages in three.

_VERSIONS_SQL = """
old AS (
  SELECT page_id AS id, CASE page_id % 2 WHEN 0 THEN 'help' ELSE 'site' END AS source, split_part(url, '?', 1) AS url,
         NULL::VARCHAR AS heading_path, 'v1 ' || html AS text, TIMESTAMP '2024-01-01' + INTERVAL (page_id % 50) HOUR AS updated_at FROM pages),
new AS (
  SELECT id + 100000000 AS id, source, url, heading_path, CASE WHEN id % 3 = 0 THEN text ELSE 'v2 ' || text END AS text,
         TIMESTAMP '2024-02-01' + INTERVAL (id % 50) HOUR AS updated_at FROM old)"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    page = F.col("page_id")
    old = derive.table(spark, sf_dir, "pages").select(
        page.alias("id"), F.when(page % 2 == 0, "help").otherwise("site").alias("source"),
        F.substring_index("url", "?", 1).alias("url"), F.lit(None).cast("string").alias("heading_path"),
        F.concat(F.lit("v1 "), "html").alias("text"),
        F.timestamp_seconds(F.lit(1704067200) + page % 50 * 3600).alias("updated_at"),
    )
    new = old.select(
        (F.col("id") + 100000000).alias("id"), "source", "url", "heading_path",
        F.when(F.col("id") % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("v2 "), "text")).alias("text"),
        F.timestamp_seconds(F.lit(1706745600) + F.col("id") % 50 * 3600).alias("updated_at"),
    )
    return old, new


@query("superseded_chunks", f"""
WITH {_VERSIONS_SQL}, every AS (SELECT * FROM old UNION ALL SELECT * FROM new)
SELECT id, row_number() OVER (PARTITION BY source, url ORDER BY updated_at DESC, id DESC) > 1 AS superseded FROM every""")
def superseded_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    return kb.mark_superseded(old.unionByName(new)).select("id", "superseded")


@query("chunk_refresh", f"""
WITH {_VERSIONS_SQL},
kept AS (SELECT * FROM old UNION ALL SELECT * FROM new n WHERE NOT EXISTS (
  SELECT 1 FROM old o WHERE o.source = n.source AND o.url = n.url AND sha256(o.text) = sha256(n.text)))
SELECT id, row_number() OVER (PARTITION BY source, url ORDER BY updated_at DESC, id DESC) > 1 AS superseded FROM kept""")
def chunk_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kb.refresh_chunks(*_versions(spark, sf_dir)).select("id", "superseded")


@query("chunks_stored", f"""
WITH {_VERSIONS_SQL} SELECT id, 'chunk_source' AS rule, 'blog' AS detail FROM old WHERE id % 5 = 0""")
def chunks_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the chunk store, read it back and report chunks of unknown sources."""
    path = scratch_dir(spark, "chunks")
    old, _ = _versions(spark, sf_dir)
    source = F.when(F.col("id") % 5 == 0, "blog").otherwise(F.col("source"))
    store.append_chunks(old.withColumn("source", source), path)
    return kb.source_violations(store.read_chunks(spark, path))


_SPACES_SQL = "trim(regexp_replace({0}, '[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g'))"


@query("rendered_chunks", f"""
WITH blocks AS (
  SELECT doc_id AS page_id, 'intro' AS heading_path, {_SPACES_SQL.format("'about ' || source")} AS text FROM documents UNION ALL
  SELECT doc_id, 'intro > ' || lang, {_SPACES_SQL.format('text')} FROM documents UNION ALL
  SELECT doc_id, 'intro > end', unnest(['item ' || doc_id, 'last']) FROM documents),
pieces AS (
  SELECT *, unnest(range(0, greatest((length(text) - 1) // 700, 0) + 1)) AS piece FROM blocks WHERE text <> '')
SELECT page_id, heading_path, piece::INTEGER AS piece, md5(substr(text, (piece * 700 + 1)::INTEGER, 700)) AS digest FROM pieces""")
def rendered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made from whole documents, with known headings and blocks, cut into chunks."""
    def esc(c: Column) -> Column:
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(raw), F.lit(safe))
        return c

    c = F.concat
    html = c(
        F.lit("<!doctype html><html><head><style>p {}</style></head><body><h1>intro</h1><p>about <b>"), esc(F.col("source")),
        F.lit("</b></p><script>no('p')</script><h2>"), esc(F.col("lang")), F.lit("</h2><div><p>"), esc(F.col("text")),
        F.lit("</p></div><h2>end</h2><ul><li>item "), F.col("doc_id").cast("string"), F.lit("<li>last</ul></body></html>"))
    pages = derive.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    return kb.chunk_pages(pages, 700).select("page_id", "heading_path", F.col("piece").cast("int").alias("piece"), F.md5("text").alias("digest"))


@query("chat_chunks", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations)
SELECT conv_id, (i - 1) // 4 AS chunk_no, md5(string_agg(text, chr(10) ORDER BY i)) AS digest,
       string_agg(turn::VARCHAR, ',' ORDER BY i) AS message_ids
FROM n GROUP BY ALL""")
def chat_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.table(spark, sf_dir, "conversations")
    return kb.chat_chunks(rows, ["conv_id"], F.floor(F.col("turn") / 64), ["turn"], "turn", 4).select(
        "conv_id", "chunk_no", F.md5("text").alias("digest"), "message_ids"
    )


@query("thread_chunks", f"""
WITH {GAPPY_SQL},
dated AS (SELECT * FROM msg WHERE ts IS NOT NULL), {threads_sql('dated')},
every AS (SELECT room_id, thread_id, ts, message_id, text FROM threaded UNION ALL SELECT room_id, NULL, ts, message_id, text FROM msg WHERE ts IS NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY room_id, thread_id ORDER BY ts, message_id) AS i FROM every)
SELECT room_id, thread_id, (i - 1) // 10 AS chunk_no, string_agg(coalesce(text, ''), chr(10) ORDER BY i) AS text,
       string_agg(message_id::VARCHAR, ',' ORDER BY i) AS message_ids
FROM n GROUP BY ALL""")
def thread_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a time belong to no thread: they make chunks of their own room, numbered in sampled ranges."""
    rows = M.split_threads(derive.gappy(derive.messages(spark, sf_dir)))
    keys, order = ["room_id", "thread_id"], ["ts", "message_id"]
    dated = kb.chat_chunks(rows.filter("thread_id IS NOT NULL"), keys, F.date_trunc("minute", "ts"), order, "message_id", 10)
    return dated.unionByName(kb.chat_chunks(rows.filter("thread_id IS NULL"), keys, None, order, "message_id", 10))


# --- vectors ----------------------------------------------------------------------------------------------

_CENTROIDS_SQL = """
parts AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m FROM parts GROUP BY ALL),
q AS (SELECT label AS query_id, list(m ORDER BY pos) AS vec FROM means GROUP BY label)"""


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per label: the mean of its vectors."""
    parts = derive.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("v")
    ).select("query_id", F.transform("v", lambda p: p["m"]).alias("embedding"))


@query("vector_topk", f"""
WITH {_CENTROIDS_SQL},
r AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id
        ORDER BY list_cosine_similarity(vec, embedding::DOUBLE[]) DESC, vec_id) AS position FROM q, embeddings)
SELECT query_id, vec_id, position FROM r WHERE position <= 10""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = derive.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return knn(_centroids(spark, sf_dir), chunks, 10, chunk_id="vec_id").select("query_id", "vec_id", "position")


@query("chunk_search", f"""
WITH {_CENTROIDS_SQL},
dated AS (
  SELECT vec_id, embedding, strftime(DATE '2024-01-01' + (vec_id % 30)::INT, '%Y-%m-%d') AS updated FROM embeddings WHERE vec_id % 4 <> 0),
live AS (SELECT * FROM dated UNION ALL SELECT vec_id + 1000000, embedding, strftime(DATE '2024-03-01' + (vec_id % 30)::INT, '%Y-%m-%d') FROM dated),
r AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id
        ORDER BY round(list_cosine_similarity(vec, embedding::DOUBLE[]), 12) DESC, updated DESC, vec_id) AS position, updated FROM q, live)
SELECT query_id, vec_id, updated, position FROM r WHERE position <= 5""")
def chunk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = derive.table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 30).cast("int")).alias("updated_at"),
        (F.col("vec_id") % 4 == 0).alias("superseded"),
    )
    # every live chunk has a later twin with an equal vector, and some rows have no usable vector
    twins = chunks.filter("NOT superseded").withColumns({"vec_id": F.col("vec_id") + 1000000, "updated_at": F.date_add("updated_at", 60)})
    broken = chunks.filter("superseded").withColumns({
        "superseded": F.lit(False), "embedding": F.when(F.col("vec_id") % 8 == 0, F.slice("embedding", 1, 3))})
    chunks = chunks.unionByName(twins).unionByName(broken)
    return kb.search_chunks(_centroids(spark, sf_dir), chunks, 5, chunk_id="vec_id").select(
        "query_id", "vec_id", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"), "position"
    )


@query("embedding_roundtrip", """
SELECT vec_id, len(embedding)::BIGINT AS n, true AS equal FROM embeddings""")
def embedding_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.table(spark, sf_dir, "embeddings").withColumn("again", decode_embedding(encode_embedding("embedding")))
    return rows.select(
        "vec_id", F.size("again").cast("bigint").alias("n"), (F.col("again") == F.col("embedding")).alias("equal")
    )


# --- scope -----------------------------------------------------------------------------------------------------

_SOURCES = (
    CrawlSource("site", ("example.com",), (r"cheap-pills",), 3, ("en", "fr")),
    CrawlSource("help", ("example.net",), (), 2, ("fr", "de", "en")),
)


@query("crawl_scope", r"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS lang,
         regexp_extract(url, '^[a-z]+://[^/]+/[a-z]+/([0-9]+)', 1) AS page, url,
         len(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '')) AS depth FROM pages),
s AS (
  SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND url NOT LIKE '%cheap-pills%' AND depth <= 3 AND lang IN ('en', 'fr') THEN 'site'
              WHEN (host = 'example.net' OR host LIKE '%.example.net') AND depth <= 2 AND lang IN ('fr', 'de', 'en') THEN 'help' END AS source FROM p),
r AS (SELECT *, list_position(CASE source WHEN 'site' THEN ['en', 'fr'] ELSE ['fr', 'de', 'en'] END, lang)::BIGINT AS language_rank FROM s WHERE source IS NOT NULL)
SELECT page_id, source, lang, language_rank FROM r x
WHERE language_rank = (SELECT min(language_rank) FROM r y WHERE y.source = x.source AND y.host = x.host AND y.page = x.page)""")
def crawl_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.parse_url(F.col("url"), F.lit("HOST")).alias("host"),
        F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1).alias("lang"),
        F.regexp_extract("url", "^[a-z]+://[^/]+/[a-z]+/([0-9]+)", 1).alias("page"),
    )
    return kb.crawl_scope(pages, _SOURCES, F.col("lang"), ["host", "page"]).select(
        "page_id", "source", "lang", "language_rank"
    )
