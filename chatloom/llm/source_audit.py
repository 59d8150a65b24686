"""13. Source divergence audit by sorting pointers to the starts of terms.

Every slice of an Arrow buffer of texts gets a pointer to the start of each of its terms. The pointers are sorted by
what they point at with a multikey quicksort whose characters are eight bytes wide: pointers are split by the group
(language and source) of their document, then by the first eight bytes, and each run of equal pointers whose terms go
on is split by the next eight. Runs that are equal to the end are the terms of the slice: their length is the count of
a group, the changes of document within them its document frequency. Spark adds up the runs of all slices, keeps the
terms of a language that enough documents have, and compares smoothed rates of sources in whole numbers.

Terms are runs of ASCII letters and of characters beyond ASCII, in lower case where they are A-Z. Rates are
p = 1 + floor(10^9 * (count + 2) / (N + 2 V)), and two rates differ by floor((p - q)^2 / (p + q)).

Cases: null text, language or source count as ''. A row is a document, whatever its id; repeated rows count each time.
Groups without terms take part, and have a rate for each kept term. A language that keeps no term has differences of 0
and no term rows. An empty table gives no rows; other columns are not read. Very long texts are cut from their buffer
whole. Memory: a slice holds about SLICE_BYTES of text and its pointers, or one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.graph import staged
from chatloom.llm.registry import table
from chatloom.session import ship_package

MIN_DOCUMENTS, TERM_RANKS, SCALE = 10, 10, 1_000_000_000
SLICE_BYTES = 6_000_000
#: Cells of the matrix of rates that a task holds at once.
CELLS = 2_000_000
COUNTS = "lang string, source string, term string, n long, n_docs long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each term of the texts data[offsets[i]:offsets[i + 1]]; a text's terms end with it."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    return np.flatnonzero(inside[1:] & (edge | ~inside[:-1])), np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))


def _keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The next eight bytes of each term as a number in their order; bytes beyond a term's end are 0."""
    key = np.zeros(len(start), np.uint64)
    for i in range(8):
        key <<= np.uint64(8)
        there = size > i
        key[there] |= data[start[there] + i]
    return key


def equal_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pointers ordered by group and term, with the bounds of their runs of equal ones; within a run they keep their order."""
    left, run, depth = np.arange(len(start)), group, 0
    while len(left):
        key = _keys(data, start[left] + depth, end[left] - start[left] - depth)
        order = np.lexsort((key, run))
        left, key, run = left[order], key[order], run[order]
        new = np.ones(len(left), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        depth += 8
        goes_on = end[left] - start[left] >= depth  # a term of exactly these bytes is told from longer ones by the next key
        run = np.cumsum(new)
        over = ~goes_on
        if over.any():
            done = run[over]
            bounds = np.flatnonzero(np.concatenate([[True], done[1:] != done[:-1], [True]]))
            yield left[over], bounds
        left, run = left[goes_on], run[goes_on]


def _take(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at])))


def _slice_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    data = _LOWER[data]
    start, end = pointers(data, offsets)
    doc = np.searchsorted(offsets, start, "right") - 1
    for order, bounds in equal_runs(data, start, end, group[doc]):
        first, docs = order[bounds[:-1]], doc[order]
        changes = np.concatenate([[0], np.cumsum(docs[1:] != docs[:-1])])
        of = group[doc[first]]
        yield pa.RecordBatch.from_arrays([
            pa.array([names[i][0] for i in of.tolist()], pa.string()), pa.array([names[i][1] for i in of.tolist()], pa.string()),
            _take(data, start[first], end[first]), pa.array(np.diff(bounds)), pa.array(changes[bounds[1:] - 1] - changes[bounds[:-1]] + 1),
        ], names=["lang", "source", "term", "n", "n_docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        wide = pa.types.is_large_string(texts.type)
        offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32, len(texts) + 1, texts.offset * (8 if wide else 4)).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        named: dict[tuple[str, str], int] = {}
        group = np.array([named.setdefault(key, len(named)) for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], np.int64)
        names, at = list(named), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
            yield from _slice_counts(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], group[at:to], names)
            at = to


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, n_docs)``: occurrences of each term in a group, and documents that have it."""
    ship_package(docs.sparkSession)
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return texts.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def rate(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / total) by long division to the base 1000, which stays within 64 bits."""
    whole, rest = np.divmod(count + 2, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return 1 + whole


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the given terms of the difference of every two sources of a language."""
    sums: dict[str, tuple[list[str], np.ndarray]] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in dict.fromkeys(langs.tolist()):
            rows = np.flatnonzero(langs == lang)
            own = batch.take(pa.array(rows))
            sources = own.column(1)[0].as_py()
            totals = np.array(own.column(2)[0].as_py(), np.int64)
            place = {s: i for i, s in enumerate(sources)}
            into = sums.setdefault(lang, (sources, np.zeros((len(sources), len(sources)), np.int64)))[1]
            step = max(1, CELLS // max(1, len(sources)))
            for at in range(0, len(rows), step):
                names, counts = own.column(3).slice(at, step), own.column(4).slice(at, step)
                row = np.repeat(np.arange(len(names)), np.array(pc.list_value_length(names)))
                cells = np.zeros((len(names), len(sources)), np.int64)
                cells[row, [place[s] for s in names.flatten().to_pylist()]] = counts.flatten().to_numpy()
                p = rate(cells, totals)
                for i in range(len(sources)):
                    q = p[:, i:i + 1]
                    into[i] += ((p - q) ** 2 // (p + q)).sum(axis=0)
    for lang, (sources, own) in sums.items():
        for i, source in enumerate(sources):
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(sources)), pa.array([source] * len(sources)), pa.array(sources), pa.array(own[i]),
            ], names=["lang", "source", "item", "value"])


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from the others and from its language."""
    counts = term_counts(docs)
    kept = staged(
        counts.groupBy("lang", "term")
        .agg(F.collect_list("source").alias("sources"), F.collect_list("n").alias("counts"), F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
        .filter(F.col("n_docs") >= min_documents), "audit-terms",
    )
    used = kept.select("lang", "term", F.col("n").alias("n_lang"), F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "n_lang", F.col("e.sources").alias("source"), F.col("e.counts").alias("n"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    size = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # a row per source of a language; kept small by the number of sources
    known = staged(
        groups.join(size, "lang", "left").join(sums, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"), F.coalesce("total", F.lit(0)).alias("total")),
        "audit-groups",
    )
    whole = F.col("total") + 2 * F.col("v")
    langs = known.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", whole.alias("whole")))).alias("g"))
    rows = kept.join(langs, "lang").select("lang", F.col("g.source").alias("all"), F.col("g.whole").alias("wholes"), "sources", "counts")
    value = rows.mapInArrow(_pair_sums, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    names = langs.select("lang", F.col("g.source").alias("all"))
    pairs = (
        known.select("lang", "source").join(names, "lang").select("lang", "source", F.explode("all").alias("item")).filter("source <> item")
        .join(value, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    )

    def smooth(count: str, total: str) -> str:
        return f"(1 + (({count} + 2) * {SCALE}BD) div ({total} + 2 * v))"

    terms = (
        used.join(known, ["lang", "source"]).withColumns({"p": F.expr(smooth("n", "total")), "q": F.expr(smooth("n_lang", "lang_total"))})
        .filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks))


QUERY = "op13_source_audit"
ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), found AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM docs
), terms AS (
  SELECT d, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM found
), kept AS (
  SELECT lang, term, count(*) AS n_lang FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 10
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, count(*) AS v, sum(n_lang) AS lang_total FROM kept GROUP BY lang
), totals AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total, coalesce(total, 0) AS total
  FROM groups LEFT JOIN sizes USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)
), rates AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (t.total + 2 * t.v) AS p,
    1 + (1000000000::HUGEINT * (k.n_lang + 2)) // (t.lang_total + 2 * t.v) AS q
  FROM totals t JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), of_terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM rates WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM of_terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))
