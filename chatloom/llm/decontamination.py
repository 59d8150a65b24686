"""3. Benchmark decontamination by a broadcast hash set of test n-grams.

The n-grams of the test items (``n`` consecutive normalised words; a shorter item is one n-gram) are hashed and
broadcast; every word window of every document is hashed in generated code and probed, and a hit counts only if the
words themselves agree. Documents are read once, and only hits are shuffled.

Broadcast bound: benchmarks are fixed test sets, and their n-grams are counted first. Above ``max_broadcast`` n-grams
the join is left to Spark, which then shuffles window hashes instead; the results are the same.

Cases: null, empty or wordless documents have no words and are never contaminated; null, empty or wordless items have
no n-gram. A document is known by its id, which may be null, and the hash of its text: rows that share an id are
judged by their own texts, equal rows are judged once and counted. Repeated items all count. An empty item table leaves every
document clean. Columns of the documents stay; columns of the same name as a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.registry import table

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
MAX_BROADCAST = 2_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Letters, digits and everything beyond ASCII, with A-Z in lower case; null has none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))
    # lower() would change letters beyond ASCII too
    plain = lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER))
    return F.transform(found, plain)


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _same_row(doc_id: str, text: str) -> Column:
    return F.col(doc_id).eqNullSafe(F.col("__id")) & (text_hash(text) == F.col("__hash"))


def _window_hash(hashes: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[hashes[start + k] for k in range(size)])


def item_grams(items: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, gram_size, gram, gram_hash)``: every n-gram of every item once."""
    listed = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - F.least(F.size("w"), F.lit(n)))).alias("at")
    cut = listed.filter(F.size("w") > 0).select("item_id", "w", at, F.least(F.size("w"), F.lit(n)).alias("gram_size"))
    cut = cut.select("item_id", "gram_size", F.expr("slice(w, at + 1, gram_size)").alias("g")).distinct()
    by_size = F.xxhash64(F.lit(0))
    for size in range(1, n + 1):
        hashes = F.transform("g", lambda w: F.xxhash64(w))
        by_size = F.when(F.col("gram_size") == size, _window_hash(hashes, F.lit(0), size)).otherwise(by_size)
    return cut.select("item_id", "gram_size", F.array_join("g", " ").alias("gram"), by_size.alias("gram_hash"))


def find_hits(
    docs: DataFrame, items: DataFrame, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``(doc_id, text_hash, n_words, copies, hits)``, a row for all equal rows: how many there are (one at a time without
    items), and hits as an array of (at, gram_size, item_ids), word positions from 0."""
    grams = item_grams(items, n, item_id, item_text).groupBy("gram_size", "gram", "gram_hash").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    sizes = {r["gram_size"]: r["n"] for r in grams.groupBy("gram_size").agg(F.count("*").alias("n")).collect()}  # n rows at most
    small = sum(sizes.values()) <= max_broadcast
    row = ("doc_id", "text_hash")
    hashed = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), words(F.col(text)).alias("w")).withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    # Position -1 stands for the document itself, so that documents without hits are kept by the same scan.
    at = hashed.select(*row, "w", "h", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    here = F.array(*[
        F.struct(
            F.lit(size).alias("gram_size"),
            F.when((F.col("at") >= 0) & (F.col("at") + size <= F.col("n_words")), _window_hash(F.col("h"), F.col("at"), size)).alias("gram_hash"),
        )
        for size in sorted(sizes)
    ])
    if len(sizes) == 1:
        probe = at.select(*row, "w", "n_words", "at", here[0]["gram_size"].alias("size"), here[0]["gram_hash"].alias("hash"))
    elif sizes:
        probe = at.select(*row, "w", "n_words", "at", F.explode(here).alias("x")).select(
            *row, "w", "n_words", "at", F.col("x.gram_size").alias("size"), F.col("x.gram_hash").alias("hash"))
    else:
        return hashed.select(*row, F.size("w").alias("n_words"), F.lit(1).cast("long").alias("copies"), F.expr("cast(array() as array<struct<at: int, gram_size: int, item_ids: array<bigint>>>)").alias("hits"))
    window = F.array_join(F.expr("slice(w, greatest(at, 0) + 1, size)"), " ")
    if small:
        grams = F.broadcast(grams)
    else:  # rows are shuffled: they carry their own window, not all words of the document
        probe = probe.select(*row, "n_words", "at", "size", "hash", window.alias("window"))
        window = F.col("window")
    same = (F.col("hash") == F.col("gram_hash")) & (F.col("size") == F.col("gram_size")) & (window == F.col("gram"))
    found = probe.join(grams, same, "left").filter((F.col("at") < 0) | F.col("gram").isNotNull())
    hit = F.when(F.col("gram").isNotNull(), F.struct("at", "gram_size", "item_ids"))
    itself = (F.col("at") < 0) & (F.col("size") == min(sizes))
    return found.select(*row, "n_words", itself.cast("long").alias("one"), hit.alias("hit")).groupBy(*row).agg(
        F.max("n_words").alias("n_words"), F.sum("one").alias("copies"), F.collect_set("hit").alias("hits"))


def hit_words(hits: Column) -> Column:
    """Sorted positions of all words inside a hit."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["gram_size"] - 1)))))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (ONE_IN * n_hit >= n_words)


def _judged(docs: DataFrame, items: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    found = find_hits(docs, items, n, doc_id, text)
    return found.withColumn("n_hit", F.size(hit_words(F.col("hits"))))


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    judged = _judged(docs.select(doc_id, text), items, n, doc_id, text)
    bad = judged.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    return docs.join(bad, _same_row(doc_id, text), "left_anti").select(*docs.columns)


def remove_spans(docs: DataFrame, items: DataFrame, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every hit word cut out of its text; what stands between the words stays."""
    judged = _judged(docs.select(doc_id, text), items, n, doc_id, text).filter("n_hit > 0")
    marks = F.map_from_arrays("at", F.transform("at", lambda _: F.lit(True)))
    dirty = judged.select("doc_id", "text_hash", hit_words(F.col("hits")).alias("at"))
    dirty = dirty.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), marks.alias("__hit"))
    source = F.coalesce(F.col(text), F.lit(""))
    gaps, found = F.split(source, _WORD, -1), F.regexp_extract_all(source, F.lit(_WORD), F.lit(0))
    # A word is kept or cut by its position; the gap before it stays.
    kept = F.transform(found, lambda w, i: F.when(F.coalesce(F.try_element_at("__hit", i), F.lit(False)), "").otherwise(w))
    cut = F.array_join(F.zip_with(gaps, kept, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    joined = docs.join(dirty, _same_row(doc_id, text), "left")
    return joined.select(*[F.when(F.col("__hit").isNull(), F.col(text)).otherwise(cut).alias(c) if c == text else F.col(c) for c in docs.columns])


QUERY = "op3_decontamination"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def verdicts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for every row of ``docs``: words, words in hits, items met and their digest, the verdict."""
    found = _judged(docs.select("doc_id", "text"), items, WINDOW, "doc_id", "text")
    ids = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.transform(h["item_ids"], lambda i: i.cast("string")))))
    out = found.select("doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"), F.array_sort(ids).alias("ids"), "copies")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


#: The contract in SQL: every occurrence of every item window, word by word.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM i WHERE len(w) > 0)),
p AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, (SELECT DISTINCT size FROM g))),
h AS (SELECT doc_id, s, p.size AS size, item_id FROM p JOIN g ON p.gram = g.gram AND p.size = g.size),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
