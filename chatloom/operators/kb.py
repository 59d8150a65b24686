"""Knowledge-base chunks: make, refresh, supersede, search, scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text
from chatloom.operators.ranking import range_number, running_number
from chatloom.operators.vector_search import knn
from chatloom.settings import DEFAULTS, CrawlSource
from chatloom.sources.html import page_blocks


def chunk_pages(pages: DataFrame, max_chars: int = 1000) -> DataFrame:
    """Pages → chunks with heading path and position; nothing of the text is lost."""
    return (
        page_blocks(pages)
        .select("page_id", "url", "block", "heading_path",
                F.posexplode(text.pieces(F.col("text"), max_chars)).alias("piece", "text"))
    )


def chat_chunks(
    messages: DataFrame, keys: list[str], slice_: Column | None, order: list[str], id_col: str, size: int = 50
) -> DataFrame:
    """Threads → chunks of at most ``size`` messages with the ids they hold.

    ``keys`` must tell threads apart, the room among them: messages without a
    thread make chunks of their own per room.  Messages are numbered slice by
    slice, or in sampled ranges where ``slice_`` is None, so a thread of any
    length is spread over tasks and each gathered group has at most ``size`` rows.
    """
    numbered = range_number(messages, keys, order, "n") if slice_ is None else running_number(messages, keys, slice_, order, "n")
    line = F.struct("n", F.col(id_col).alias("id"), F.col("text").alias("text"))
    grouped = numbered.groupBy(*keys, F.floor((F.col("n") - 1) / size).cast("bigint").alias("chunk_no")).agg(
        F.sort_array(F.collect_list(line)).alias("lines")
    )
    return grouped.select(
        *keys, "chunk_no",
        F.array_join(F.transform("lines", lambda m: F.coalesce(m["text"], F.lit(""))), "\n").alias("text"),
        F.array_join(F.transform("lines", lambda m: m["id"].cast("string")), ",").alias("message_ids"),
    )


CHUNK_KEY = ["source", "url", "heading_path"]


def mark_superseded(chunks: DataFrame) -> DataFrame:
    """Flag every chunk version but the newest of its place.

    The newest is an aggregate joined back: a place with very many versions is
    combined map-side and never sorted in one task.
    """
    place = [F.coalesce(F.col(c), F.lit("")).alias(f"_{c}") for c in CHUNK_KEY]
    keyed = chunks.select("*", *place)
    names = [f"_{c}" for c in CHUNK_KEY]
    newest = keyed.groupBy(*names).agg(F.max(F.struct("updated_at", "id")).alias("_newest"))
    return (
        keyed.join(newest, names)
        .withColumn("superseded", F.struct("updated_at", "id") != F.col("_newest"))
        .drop("_newest", *names)
    )


def refresh_chunks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add chunks whose text is new at their place, then flag what they replace."""
    def place(df: DataFrame) -> list[Column]:
        return [F.coalesce(F.col(c), F.lit("")).alias(f"_{c}") for c in CHUNK_KEY] + [
            F.sha2(F.col("text"), 256).alias("_hash")
        ]

    names = [*(f"_{c}" for c in CHUNK_KEY), "_hash"]
    fresh = new.select("*", *place(new)).join(old.select(*place(old)), names, "left_anti").drop(*names)
    return mark_superseded(old.unionByName(fresh))


def source_violations(chunks: DataFrame, allowed: tuple[str, ...] = DEFAULTS.chunk_sources) -> DataFrame:
    return chunks.filter(~F.coalesce(F.col("source").isin(*allowed), F.lit(False))).select(
        "id", F.lit("chunk_source").alias("rule"), F.col("source").alias("detail")
    )


def search_chunks(queries: DataFrame, chunks: DataFrame, k: int, **ids: str) -> DataFrame:
    """Nearest live chunks, by similarity, then newest, then id."""
    live = chunks.filter(~F.col("superseded"))
    return knn(queries, live, k, newest="updated_at", **ids)


def crawl_scope(pages: DataFrame, sources: tuple[CrawlSource, ...], lang: Column, same_page: list[str]) -> DataFrame:
    """Pages in scope of a source; of one page's languages the most wanted stays.

    The scope list is a job parameter of a few entries, so it becomes plain
    conditions on the row.
    """
    host = F.parse_url(F.col("url"), F.lit("HOST"))
    path = F.coalesce(F.parse_url(F.col("url"), F.lit("PATH")), F.lit(""))
    depth = F.size(F.filter(F.split(path, "/"), lambda s: s != ""))
    matches = []
    for s in sources:
        inside = F.lit(False)
        for d in s.allowed_domains:
            inside = inside | (host == d) | host.endswith("." + d)
        for p in s.exclude_patterns:
            inside = inside & ~F.col("url").rlike(p)
        wanted = F.array_position(F.array(*map(F.lit, s.languages)), lang)
        matches.append(F.when(inside & (depth <= s.max_depth) & (wanted > 0), F.struct(
            F.lit(s.source).alias("source"), wanted.alias("language_rank")
        )))
    scoped = (
        pages.withColumn("_scope", F.coalesce(*matches)).filter(F.col("_scope").isNotNull())
        .select("*", "_scope.*").drop("_scope")
    )
    best = scoped.groupBy("source", *same_page).agg(F.min("language_rank").alias("language_rank"))
    return scoped.join(best, ["source", *same_page, "language_rank"])
