"""4. Secret scan with multipart credential linking.

Strong spans (key assignments, access ids, long hex) are reported wherever they stand. Weak parts - bare secrets,
account names, endpoints - mean nothing alone: an interval join within scopes reports each only if complementary parts
of a credential lie within ``SCOPE`` code points of it: an identifier for a bare secret, a secret for an account name,
and both for an endpoint. The join meets its parts in buckets of one scope, so a bucket holds a bounded number of
parts whatever the length of the text. Everything runs in DataFrame functions.

Positions come from the lengths of the pieces between matches, in code points. Spans are one small row each; a text
never leaves its scan task.

Cases: null and empty texts have no spans. Equal spans of one kind cannot repeat; weak parts inside a strong span are
not weak parts. A document is known by its id, which may be null, and the hash of its text: rows that share an id are
judged by their own texts, equal rows have equal spans. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.graph import staged
from chatloom.llm.registry import table

SCOPE = 200

# Fixed patterns of the strong kinds, in their order: (kind, pattern, group that must have a length, that length).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Weak parts of a credential, in their order.
WEAK = (
    ("bare_secret", r"[A-Za-z0-9+/_=-]{20,}", 0, 20),
    ("account", r"""((?i:user|user_?name|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3),
    ("endpoint", r"""(?:https?|jdbc:[a-z]+|ftp|redis|amqp)://[^\x00-\x20"'<>]+""", 0, 12),
)
KINDS = [k for k, *_ in BASE + WEAK]
#: Which parts must be near a weak part: one kind of every group.
NEEDS = {
    "bare_secret": (("access", "account"),),
    "account": (("assign", "hex", "bare_secret"),),
    "endpoint": (("access", "account"), ("assign", "hex", "bare_secret")),
}
_DIGIT, _LETTER = "[0-9]", "[A-Za-z]"


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, i, gap, size, kept): every match with the length of what stands before it."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    kept = lambda w: (F.length(w) >= least) & ((w.rlike(_DIGIT) & w.rlike(_LETTER)) if kind == "bare_secret" else F.lit(True))
    # zip_with reads each array once; inside a lambda an expression would be computed for every match
    matches = F.zip_with(whole, judged, lambda w, j: F.struct(F.length(w).alias("size"), kept(j).alias("kept")))
    rows = F.transform(F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("m"))), lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["m"]["size"].alias("size"), x["m"]["kept"].alias("kept")))
    return F.when(text.rlike(pattern), rows).otherwise(F.expr("cast(array() as array<struct<kind: int, i: int, gap: int, size: int, kept: boolean>>)"))


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, kind, start, end)`` of all strong spans and weak parts; kind is a position in KINDS."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = source.select("doc_id", "text_hash", F.explode(F.concat(*[_found(F.col("t"), *x) for x in BASE + WEAK])).alias("m"))
    # equal rows have equal matches: each counts once in the sum
    row = ("doc_id", "text_hash", "kind")
    found = found.select("doc_id", "text_hash", "m.*").repartition(*row).dropDuplicates([*row, "i"])
    so_far = Window.partitionBy(*row).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return found.withColumn("end", end).filter("kept").select(*row, (F.col("end") - F.col("size")).alias("start"), "end")


def _buckets(spans: DataFrame, reach: int) -> DataFrame:
    """Each span once for every bucket that it or its surroundings touch."""
    first, last = F.floor((F.col("start") - reach) / SCOPE), F.floor((F.col("end") + reach - 1) / SCOPE)
    return spans.withColumn("bucket", F.explode(F.sequence(first, last)))


def link(found: DataFrame) -> DataFrame:
    """The strong spans, and the weak parts whose complementary parts are in scope.

    The parts, small rows, are written once: every step below reads them, and texts must not be scanned for each.
    """
    found = staged(found, "parts")
    strong = found.filter(F.col("kind") < len(BASE))
    weak = found.filter(F.col("kind") >= len(BASE))
    other = (F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), F.col("kind").alias("part"), F.col("start").alias("s"), F.col("end").alias("e"))
    same_row = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h"))
    meets = same_row & (F.col("bucket") == F.col("b"))
    inside = _buckets(strong, 0).select(*other, F.col("bucket").alias("b"))
    overlaps = _buckets(weak, 0).join(inside, meets & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_semi")
    covered = overlaps.select(*other).distinct()
    weak = weak.join(covered, same_row & (F.col("kind") == F.col("part")) & (F.col("start") == F.col("s")), "left_anti")
    near = _buckets(strong.unionByName(weak), 0).select(*other, F.col("bucket").alias("b"))
    out = strong
    for kind, groups in NEEDS.items():
        kept = weak.filter(F.col("kind") == KINDS.index(kind))
        for group in groups:
            c = near.filter(F.col("part").isin(*[KINDS.index(k) for k in group]))
            in_scope = meets & (F.col("s") < F.col("end") + SCOPE) & (F.col("start") < F.col("e") + SCOPE)
            kept = _buckets(kept, SCOPE).join(c, in_scope, "left_semi").drop("bucket").distinct()
        out = out.unionByName(kept)
    return out


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, kind, start, end)`` of everything to report; kind is one of KINDS."""
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return link(parts(docs, doc_id, text)).withColumn("kind", name)


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span, overlapping ones together, replaced by ``mask``."""
    found = find_secrets(docs, doc_id, text).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "start", "end")
    spans = found.groupBy("__id", "__hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    # spans grow with the corpus: joined by the same merge at every size, instead of a broadcast while they are few
    joined = docs.join(spans.hint("merge"), F.col(doc_id).eqNullSafe(F.col("__id")) & (text_hash(text) == F.col("__hash")), "left")
    # Ends so far in the order of starts: a span that starts beyond them begins a new cut.
    state = F.aggregate(
        "__spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
                F.substr(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)))).alias("out")))
    rest = F.substr(F.col(text), (state["at"] + 1).cast("int"))
    cut = F.concat(F.array_join(state["out"], ""), rest)
    return joined.select(*[F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut).alias(c) if c == text else F.col(c) for c in docs.columns])


QUERY = "op4_secrets"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(table(spark, sf_dir, "documents"))


def listing(docs: DataFrame) -> DataFrame:
    """A row for every row of ``docs``: counts of the strong kinds, their digest, and all spans."""
    spans = link(parts(docs)).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    rows = docs.select("doc_id", text_hash("text").alias("text_hash"))
    listed = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h")), "left").withColumn("s", F.coalesce("s", F.expr("cast(array() as array<struct<start: bigint, kind: int, end: bigint>>)")))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    return listed.select(
        "doc_id", *map(count, range(len(BASE))),
        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("s")).alias("spans"),
    )


def _sql() -> str:
    """The same in SQL: positions from piece lengths, scopes by distance."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    scans = []
    for kind, pattern, group, least in BASE + WEAK:
        judged = f"regexp_extract_all(t, {quoted(pattern)}, {group})"
        also = "AND regexp_matches(j[i], '[0-9]') AND regexp_matches(j[i], '[A-Za-z]')" if kind == "bare_secret" else ""
        scans.append(
            f"SELECT doc_id, {KINDS.index(kind)} AS kind, i, len(g[i]) + len(m[i]) AS step, len(m[i]) AS size, len(j[i]) >= {least} {also} AS kept FROM ("
            f"SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, {quoted(pattern)}) AS g, "
            f"regexp_extract_all(t, {quoted(pattern)}) AS m, {judged} AS j FROM d))")
    near = "c.doc_id = w.doc_id AND c.s < w.e + {r} AND w.s < c.e + {r}"
    needs = " UNION ALL ".join(
        f"SELECT * FROM weak w WHERE kind = {KINDS.index(kind)} AND " + " AND ".join(
            f"EXISTS (SELECT 1 FROM good c WHERE {near.format(r=SCOPE)} AND c.kind IN ({', '.join(str(KINDS.index(k)) for k in group)}))" for group in groups)
        for kind, groups in NEEDS.items())
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS ({" UNION ALL ".join(scans)}),
p AS (SELECT doc_id, kind, pos - size AS s, pos AS e FROM (
  SELECT *, CAST(sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS pos FROM x) WHERE kept),
strong AS (SELECT * FROM p WHERE kind < {len(BASE)}),
weak AS (SELECT * FROM p w WHERE kind >= {len(BASE)} AND NOT EXISTS (SELECT 1 FROM strong c WHERE {near.format(r=0)})),
good AS (SELECT * FROM strong UNION ALL SELECT * FROM weak),
o AS (SELECT *, ({names})[kind + 1] || ':' || s || ':' || e AS shown FROM (SELECT * FROM strong UNION ALL {needs})),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = {k}) AS n_{KINDS[k]}" for k in range(len(BASE)))},
  string_agg(shown, ',' ORDER BY s, kind) FILTER (kind < {len(BASE)}) AS base, string_agg(shown, ',' ORDER BY s, kind) AS spans FROM o GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{KINDS[k]}, 0) AS n_{KINDS[k]}" for k in range(len(BASE)))},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


ORACLE_SQL = _sql()
