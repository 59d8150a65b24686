"""Queries on planning, gating and writing publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.functions import canonical, dates
from chatloom.operators import contract, cycle, publish, recovery, report
from chatloom.operators.projection import build_evidence, project_publication
from chatloom.plans import derive
from chatloom.plans.derive import CANONICAL_SQL, FINAL_SQL, MSG_SQL
from chatloom.plans.documents import text_violations_sql
from chatloom.plans.privacy import PERSON_SQL, RE2_PATHS, RE2_PII, kinds_sql
from chatloom.plans.registry import query
from chatloom.session import scratch_dir
from chatloom.settings import DEFAULTS
from chatloom.sources import documents as store
from chatloom.sources import html


# --- verdicts ---------------------------------------------------------------------------------------

_VERDICT_SQL = """
verdicts AS (
  SELECT doc_id AS item_id, CASE WHEN toxic = 1 AND quality = 1 THEN 'escalate' WHEN quality = 0 THEN 'discard' ELSE 'pass' END AS verdict
  FROM labels)"""


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("item_id"),
        F.when((F.col("toxic") == 1) & (F.col("quality") == 1), "escalate")
        .when(F.col("quality") == 0, "discard").otherwise("pass").alias("verdict"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "lang", "source")


@query("verdict_gate", f"""
WITH {_VERDICT_SQL}
SELECT item_id, lang, source, verdict FROM documents JOIN verdicts ON item_id = doc_id WHERE verdict IN ('pass', 'escalate')""")
def verdict_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, escalated = report.gate_by_verdict(_items(spark, sf_dir), _verdicts(spark, sf_dir))
    return passed.unionByName(escalated)


@query("verdict_counts", f"""
WITH {_VERDICT_SQL}
SELECT source, count(*) FILTER (WHERE verdict = 'pass') AS n_pass, count(*) FILTER (WHERE verdict = 'discard') AS n_discard,
       count(*) FILTER (WHERE verdict = 'escalate') AS n_escalate
FROM documents JOIN verdicts ON item_id = doc_id GROUP BY source""")
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.verdict_counts(report.attach_verdicts(_items(spark, sf_dir), _verdicts(spark, sf_dir)), ["source"])


@query("missing_evidence", f"""
WITH {MSG_SQL}, items AS (SELECT message_id AS item_id, room_id, week, unnest([message_id, message_id + 7]) AS cited FROM msg)
SELECT i.room_id, i.week, item_id, cited AS message_id FROM items i
WHERE NOT EXISTS (SELECT 1 FROM msg m WHERE m.room_id = i.room_id AND m.week = i.week AND m.message_id = i.cited)""")
def missing_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.messages(spark, sf_dir).withColumn("week", derive.week())
    items = rows.select(
        "room_id", "week", F.col("message_id").alias("item_id"),
        F.array(F.col("message_id"), F.col("message_id") + 7).alias("source_message_ids"),
    )
    return report.missing_evidence(items, rows, ["room_id", "week"])


# --- upserts -------------------------------------------------------------------------------------------

_STATE_SQL = """CASE WHEN doc_id % 7 = 0 THEN 'base' ELSE 'draft' END"""


@query("upsert_plan", f"""
WITH {FINAL_SQL}
SELECT content_id, CASE
    WHEN doc_id % 9 = 8 THEN 'create' WHEN doc_id % 25 = 4 THEN 'blocked'
    WHEN doc_id % 25 = 5 THEN CASE WHEN doc_id % 3 = 1 THEN 'conflict' ELSE 'noop' END WHEN doc_id % 3 = 1 THEN CASE WHEN doc_id % 7 = 0 THEN 'conflict' ELSE 'update' END ELSE 'noop' END AS action
FROM fin
UNION ALL SELECT content_id || '-x', 'keep' FROM fin WHERE doc_id % 9 = 8""")
def upsert_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "digests")
    derive.publications(spark, sf_dir).select("doc_id", "content_id", "content_sha256").write.parquet(path)
    docs = spark.read.parquet(path)  # read four times
    """Also ids with a second document: an unreadable one, or a base one of the same or another content beside a draft."""
    absent = F.col("doc_id") % 9 == 8
    existing = docs.select(
        F.when(absent, F.concat("content_id", F.lit("-x"))).otherwise(F.col("content_id")).alias("content_id"),
        F.when(F.col("doc_id") % 3 == 1, F.sha2("content_sha256", 256)).otherwise(F.col("content_sha256")).alias("content_sha256"),
        F.when(F.col("doc_id") % 7 == 0, "base").otherwise("draft").alias("state"), F.lit(True).alias("valid"), "doc_id",
    )
    present = existing.filter(~absent)
    unreadable = present.filter("doc_id % 25 = 4").withColumns({"content_sha256": F.lit(None).cast("string"), "valid": F.lit(False)})
    base = present.filter("doc_id % 25 = 5").withColumn("state", F.lit("base"))
    existing = existing.unionByName(unreadable).unionByName(base)
    return publish.plan_upserts(docs.select("content_id", "content_sha256"), existing)


@query("upsert_blocked", f"""
WITH {CANONICAL_SQL}, {text_violations_sql()}
SELECT content_id, CASE WHEN doc_id % 2 = 0 OR doc_id % 11 = 3 OR doc_id IN (SELECT doc_id FROM found) THEN 'blocked' ELSE 'noop' END AS action
FROM fin""")
def upsert_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents are read back, re-validated and re-hashed: one that was
    tampered with or cannot be read blocks even a same-hash no-op."""
    even = F.col("doc_id") % 2 == 0
    docs = derive.publications(spark, sf_dir, filled=True)
    kept = scratch_dir(spark, "existing")
    stored = F.col("document")
    docs.select(
        "doc_id", "content_id", "content_sha256",
        F.when(F.col("doc_id") % 11 == 3, F.lit("not json"))
        .when(even, F.regexp_replace(stored, '"schema_version":1', '"schema_version":2')).otherwise(stored).alias("json"),
    ).write.parquet(kept)
    table = spark.read.parquet(kept)
    existing = publish.existing_state(
        table.select("doc_id", "content_id", canonical.strict_json(F.col("json")).alias("doc"), F.lit("draft").alias("state"))
    )
    return publish.plan_upserts(table.select("content_id", "content_sha256"), existing)


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.publications(spark, sf_dir).select("doc_id", "content_id", "content_sha256", "document")


@query("published_changed", f"""
WITH {CANONICAL_SQL}
SELECT content_id, CASE WHEN doc_id % 13 = 6 THEN 'refused' WHEN doc_id % 5 = 0 THEN 'updated' WHEN doc_id % 5 = 1 THEN 'created' ELSE 'unchanged' END AS status,
       CASE WHEN doc_id % 5 = 1 AND doc_id % 13 = 6 THEN NULL ELSE sha256(canonical) END AS stored FROM canon
UNION ALL SELECT 'x-' || content_id, 'refused', NULL FROM fin WHERE doc_id % 10 = 2""")
def published_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write an older state, then the current one; report what the second write did.

    Among the new documents are invalid ids and ids with two documents.
    """
    target, staged = scratch_dir(spark, "publications"), scratch_dir(spark, "documents")
    _stored(spark, sf_dir).write.option("compression", "zstd").parquet(staged)
    docs = spark.read.parquet(staged)
    case = F.col("doc_id") % 5
    current = (F.col("doc_id") % 13 != 6) & (case == 0)
    older = docs.filter(case != 1).withColumn(
        "content_sha256", F.when(current, F.sha2("content_sha256", 256)).otherwise(F.col("content_sha256"))
    )
    doubled = docs.filter("doc_id % 13 = 6").withColumn("content_sha256", F.sha2("content_sha256", 256))
    misnamed = docs.filter("doc_id % 10 = 2").withColumn("content_id", F.concat(F.lit("x-"), "content_id"))
    store.write_publications_if_changed(older.drop("doc_id"), target)
    outcome = store.write_publications_if_changed(docs.unionByName(doubled).unionByName(misnamed).drop("doc_id"), target)
    plain = F.regexp_replace("document", ',"content_sha256":"[0-9a-f]*"', "")
    kept = store.read_publications(spark, target).select("content_id", F.sha2(plain, 256).alias("stored"))
    return outcome.join(kept, "content_id", "left")


_CYCLE_SQL = f"""
{CANONICAL_SQL.replace("n + 1 AS issue", "n + CASE WHEN doc_id % 10 = 7 AND n > 0 THEN 0 ELSE 1 END AS issue")}, {text_violations_sql()},
flags AS (SELECT doc_id, len({kinds_sql('text', RE2_PII | RE2_PATHS)}) > 0 AS pii, {PERSON_SQL.format('text')} AS named FROM fin),
at_set AS (
  SELECT doc_id, 'nickname_policy' AS rule FROM flags WHERE named UNION ALL SELECT doc_id, 'pii_scan' FROM flags WHERE pii
  UNION ALL SELECT doc_id, 'payload_mismatch' FROM fin WHERE doc_id % 17 IN (6, 8)
  UNION ALL SELECT doc_id, 'source_count' FROM fin WHERE doc_id % 17 = 8
  UNION ALL SELECT doc_id, unnest(['period_order', 'requested_period']) FROM fin WHERE doc_id % 17 = 9
  UNION ALL SELECT doc_id, 'issue_minimum' FROM fin WHERE doc_id % 17 = 10),
parsed AS (SELECT * FROM fin WHERE doc_id % 17 NOT IN (5, 7)),
at_gate AS (SELECT * FROM parsed WHERE doc_id NOT IN (SELECT doc_id FROM at_set)),
seeds AS (SELECT * FROM fin WHERE doc_id % 13 IN (4, 5)),
owners AS (
  SELECT slug, content_id FROM at_gate UNION SELECT slug, content_id FROM seeds),
at_contract AS (
  SELECT DISTINCT doc_id, rule FROM found
  UNION ALL SELECT doc_id, 'slug_shared' FROM at_gate WHERE slug IN (SELECT slug FROM owners GROUP BY slug HAVING count(DISTINCT content_id) > 1)),
reasons AS (
  SELECT doc_id, CASE doc_id % 17 WHEN 5 THEN 'not_strict_json' ELSE 'too_large' END AS rules FROM fin WHERE doc_id % 17 IN (5, 7)
  UNION ALL SELECT doc_id, string_agg(DISTINCT rule, ',' ORDER BY rule) FROM at_set WHERE doc_id IN (SELECT doc_id FROM parsed) GROUP BY doc_id
  UNION ALL SELECT doc_id, string_agg(DISTINCT rule, ',' ORDER BY rule) FROM at_contract WHERE doc_id IN (SELECT doc_id FROM at_gate) GROUP BY doc_id),
judged AS (
  SELECT f.*, coalesce(rules, CASE WHEN doc_id % 13 = 4 THEN 'plan_conflict' END) AS rules FROM fin f LEFT JOIN reasons USING (doc_id))"""


@query("publish_cycle", f"""
WITH {_CYCLE_SQL}
SELECT CASE WHEN doc_id % 31 <> 3 THEN doc_id END AS doc_id, content_id,
  CASE WHEN rules IS NOT NULL THEN 'refused' WHEN doc_id % 13 = 5 THEN 'updated' ELSE 'created' END AS status,
  CASE WHEN rules IS NULL THEN 'unchanged' ELSE 'refused' END AS again, rules
FROM judged, range(CASE WHEN doc_id % 29 = 2 THEN 2 ELSE 1 END)""")
def publish_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gates in a row over a store with older drafts and public documents, twice: the second run changes nothing.

    Scans of the source become evidence. Some sets are no JSON, too large, or changed after their evidence was made;
    some ask for a reversed period, an issue 0 or print wrong counts; neighbours share a slug; rows come twice or
    without an id.
    """
    sets = derive.finals(spark, sf_dir, filled=True)
    n, neighbour = F.col("doc_id") % derive.PERIODS, (F.col("doc_id") % 10 == 7) & (F.col("doc_id") % derive.PERIODS > 0)
    issue = F.when(neighbour, n).otherwise(n + 1)
    suffix = F.regexp_extract("slug", r"(-r[0-9]+)?$", 0)
    sets = sets.withColumns({"issue": issue, "slug": F.concat(dates.slug(issue), suffix)})
    safe, unnamed = cycle.scan_flags(F.col("text"))
    sealed = build_evidence(sets, F.col("start"), F.col("end"), F.col("text"), "anon", safe, unnamed)
    json, case = F.to_json("final"), F.col("doc_id") % 17
    tampered = F.when(case == 5, F.concat(json, F.lit("}"))).when(case == 6, F.regexp_replace(json, '"period_id":"p', '"period_id":"q')) \
        .when(case == 7, F.concat(json, F.repeat(F.lit(" "), fixed.MAX_DOCUMENT_BYTES))) \
        .when(case == 8, F.regexp_replace(json, f'"{fixed.STAT_QUESTIONS}":', f'"{fixed.STAT_QUESTIONS}":7')).otherwise(json)
    path = scratch_dir(spark, "approved")
    sealed.select(
        "doc_id", F.encode(tampered, "UTF-8").alias("content"), F.when(case == 9, F.date_add("end", 1)).otherwise(F.col("start")).alias("start"), "end",
        F.when(case == 10, 0).otherwise(F.col("issue")).alias("issue"), "generated_at", "content_id", "slug").write.parquet(path)
    raw, target = spark.read.parquet(path), scratch_dir(spark, "published")
    raw = raw.unionByName(raw.filter("doc_id % 29 = 2"))
    older = sealed.filter("doc_id % 13 IN (4, 5)").withColumn("generated_at", F.lit("2029-12-31T00:00:00Z"))
    seeded = scratch_dir(spark, "seeds")
    project_publication(older, "anon").select("content_id", "content_sha256", "document").write.parquet(seeded)
    store.write_publications_if_changed(spark.read.parquet(seeded), target)
    public = raw.filter("doc_id % 13 = 4").select("content_id")
    raw = raw.withColumn("doc_id", F.when(F.col("doc_id") % 31 != 3, F.col("doc_id")))
    first, second = (cycle.publish_cycle(raw, target, "anon", published=public) for _ in range(2))
    again = second.groupBy("content_id").agg(F.min("status").alias("again"))
    return first.join(again, "content_id").select("doc_id", "content_id", "status", "again", "rules")


@query("publication_paths", f"""
WITH {FINAL_SQL}
SELECT doc_id, strftime(s, '%Y%m') AS month, 'publications/' || content_id || '/publication.json' AS path FROM fin
UNION ALL SELECT doc_id, NULL, NULL FROM fin""")
def publication_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = derive.finals(spark, sf_dir).select("doc_id", F.explode(F.array("content_id", F.concat(F.lit("x"), "content_id"))).alias("c"))
    return ids.select(
        "doc_id", store.publication_partition(F.col("c")).alias("month"), store.publication_path(F.col("c")).alias("path")
    )


@query("already_published", f"""
WITH {FINAL_SQL}
SELECT content_id FROM fin WHERE doc_id % 4 <> 0 AND issue NOT IN (SELECT issue FROM fin WHERE doc_id % 6 = 0)""")
def already_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derive.finals(spark, sf_dir).select(
        "doc_id", "content_id", F.concat(F.col("issue").cast("string"), F.lit("호")).alias("title")
    )
    by_id = docs.filter(F.col("doc_id") % 4 == 0).select("content_id", F.lit("-").alias("title"))
    by_title = docs.filter(F.col("doc_id") % 6 == 0).select(F.lit("-").alias("content_id"), "title")
    return publish.skip_published(docs, by_id.unionByName(by_title), "both").select("content_id")


@query("draft_only", """
SELECT doc_id, 'published_status' AS rule, CASE doc_id % 5 WHEN 1 THEN '발행' WHEN 2 THEN 'published' ELSE '공개' END AS detail
FROM documents WHERE doc_id % 5 IN (1, 2, 3)""")
def draft_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("doc_id") % 5
    status = F.when(case == 1, "발행").when(case == 2, "published").when(case == 3, "공개").otherwise(fixed.DRAFT_STATUS)
    return publish.draft_only(derive.table(spark, sf_dir, "documents").select("doc_id", status.alias("status")), "doc_id")


@query("slug_duplicates", f"""
WITH {FINAL_SQL}, p AS (SELECT 'community-insight-' || format('{{:03d}}', doc_id % 150) AS slug, 'publications/' || content_id || '/publication.json' AS path FROM fin),
d AS (SELECT slug, count(*) AS n, min(path) AS first_path FROM p GROUP BY slug HAVING count(*) > 1)
SELECT slug, n, first_path, path FROM p JOIN d USING (slug)""")
def slug_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derive.finals(spark, sf_dir).select(
        F.format_string("community-insight-%03d", F.col("doc_id") % 150).alias("slug"),
        store.publication_path(F.col("content_id")).alias("path"),
    )
    return contract.duplicate_slugs(docs)


# --- change sets and paths ---------------------------------------------------------------------------------

@query("changeset_gate", f"""
WITH {FINAL_SQL}
SELECT doc_id AS changeset_id, CASE doc_id % 8 WHEN 0 THEN 'ok' WHEN 1 THEN 'more_than_one_file' WHEN 2 THEN 'forbidden_status'
  WHEN 3 THEN 'forbidden_path' WHEN 4 THEN 'id_not_directory' WHEN 5 THEN 'code_only' WHEN 6 THEN 'forbidden_status' ELSE 'more_than_one_file' END AS verdict
FROM fin""")
def changeset_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derive.finals(spark, sf_dir).select("doc_id", "content_id", (F.col("doc_id") % 8).alias("c"))
    c, none = F.col("c"), F.lit(None).cast("string")
    path = store.publication_path(F.col("content_id"))

    def change(status: Column, name: Column, old: Column = none) -> Column:
        return F.struct(status.alias("status"), name.alias("path"), old.alias("old_path"))

    changed = F.when(c == 1, F.array(change(F.lit("A"), path), change(F.lit("M"), F.lit("README.md")))) \
        .when(c == 2, F.array(change(F.lit("D"), path))) \
        .when(c == 3, F.array(change(F.lit("A"), F.concat(F.lit("publications/"), "content_id", F.lit("/extra.json"))))) \
        .when(c == 5, F.array(change(F.lit("M"), F.lit("src/a.py")), change(F.lit("A"), F.lit("src/b.py")))) \
        .when(c == 6, F.array(change(F.lit("R100"), path, F.concat(path, F.lit(".old"))))) \
        .when(c == 7, F.array(change(F.lit("A"), path), change(F.lit("M"), path))) \
        .otherwise(F.array(change(F.lit("M"), path)))
    rows = docs.select(
        F.col("doc_id").alias("changeset_id"), F.inline(changed),
        F.when(c == 4, F.concat("content_id", F.lit("-r2"))).otherwise(F.col("content_id")).alias("doc_content_id"),
    )
    committed, working = rows.drop("doc_content_id"), rows.drop("doc_content_id")
    ids = docs.select(
        F.col("doc_id").alias("changeset_id"),
        F.when(c == 4, F.concat("content_id", F.lit("-r2"))).otherwise(F.col("content_id")).alias("doc_content_id"),
    )
    merged = publish.merge_changes(committed, working).join(ids, "changeset_id")
    return publish.changeset_boundary(merged)


_PATHS = (
    "output/insights/x.json", "notes.draft.json", "run.log", "publications/README.md", "publications/{id}/extra.json",
    "publications//{id}/publication.json", "publications/{id}/publication.json", "a/./b.py", "/abs/x.py", "../up.py",
    "inbox/.gitkeep", "src/logs", "data/x.SQLITE3", "docs/final.md", "docs/finale.md", "./a.py", "a/b/", ".db", "src/x.py",
)
_PATH_RULES = {0: "artifact", 1: "artifact", 2: "artifact", 3: "unexpected_path", 4: "unexpected_path", 5: "malformed_path",
               7: "malformed_path", 8: "malformed_path", 9: "malformed_path", 11: "artifact", 12: "artifact", 13: "artifact",
               15: "malformed_path", 16: "malformed_path"}
_PATHS_SQL = "['" + "', '".join(_PATHS) + "']"


@query("artifact_paths", f"""
WITH {FINAL_SQL},
rules(c, rule) AS (VALUES {', '.join(f"({c}, '{r}')" for c, r in _PATH_RULES.items())})
SELECT replace({_PATHS_SQL}[c + 1], '{{id}}', content_id) AS path, rule FROM fin JOIN rules ON doc_id % {len(_PATHS)} = c""")
def artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, _PATHS)), (F.col("doc_id") % len(_PATHS) + 1).cast("int"))
    paths = derive.finals(spark, sf_dir).select(F.replace(name, F.lit("{id}"), F.col("content_id")).alias("path"))
    return publish.forbid_artifacts(paths)


@query("safe_paths", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url END AS path FROM pages""")
def safe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("page_id") % 3
    raw = F.when(case == 1, F.concat(F.encode("url", "UTF-8"), F.lit(b"\n"))) \
        .when(case == 2, F.concat(F.encode("url", "UTF-8"), F.lit(bytes([0xFF])))).otherwise(F.encode("url", "UTF-8"))
    return derive.table(spark, sf_dir, "pages").select("page_id", publish.safe_path(raw).alias("path"))


# --- pages with embedded documents and report pages -----------------------------------------------------------

@query("html_embedded", f"""
WITH {CANONICAL_SQL}
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN sha256(canonical) END AS content_sha256, doc_id % 3 = 0 AS embedded FROM canon""")
def html_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embed each document in a page and read it back; two kinds of pages are refused."""
    case = F.col("doc_id") % 3
    page = F.when(case == 1, F.lit(f'<html><body><i id="{DEFAULTS.embed_id}"></i></body></html>')) \
        .when(case == 2, F.lit("<html><body></body></body></html>")).otherwise(F.lit("<html><body><p>x</p></body></html>"))
    docs = derive.publications(spark, sf_dir).select(
        "doc_id", store.embed_in_page(page, F.col("doc"), DEFAULTS.embed_id).alias("html")
    )
    found = store.extract_embedded_json(F.col("html"), DEFAULTS.embed_id)
    return docs.select(
        "doc_id", canonical.content_sha256(found).alias("content_sha256"), F.col("html").isNotNull().alias("embedded")
    )


# One kind of broken page per rule of the layout: what is replaced, by what, and the problem that it is.
_BROKEN_PAGES = {
    1: ('<dd class="num">', '<dd class="num">about ', "stats that is no number"),
    2: ('<ol class="topics">', "<ol>", "missing topics list"),
    3: ('<div class="a">', '<div class="b">', "faq without answer"),
    4: ('</header>', '</header><section id="tips"></section>', "repeated tips"),
    5: ('<p class="act">', '<p class="fact">', "actions without text"),
    6: ('<p class="period">', '<p class="periods">', "masthead without period"),
}
_PROBLEM_SQL = "CASE WHEN doc_id % 10 = 9 THEN 'missing tips' " + " ".join(f"WHEN doc_id % 20 = {k} THEN '{v[2]}'" for k, v in _BROKEN_PAGES.items()) + " END"


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed report pages one per insight set; every tenth lacks its tips, others break the layout in one way."""
    def esc(c: Column) -> Column:
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(raw), F.lit(safe))
        return c

    def html_list(values: Column, build) -> Column:
        return F.array_join(F.transform(values, build), "")

    d = derive.publications(spark, sf_dir).select("doc_id", "start", "end", "issue", *[
        F.try_variant_get("doc", f"$.{n}", t).alias(n) for n, t in (
            ("intro", "string"), ("faq", "array<struct<question:string,answer:string,tags:array<string>,practical_tip:string>>"),
            ("unresolved", "array<struct<question:string>>"),
            ("tips", "array<struct<title:string,body:string>>"), ("topics", "array<struct<topic:string,why:string>>"),
        )
    ])
    c = F.concat
    head = c(
        F.lit('<!doctype html><html><head><meta charset="utf-8"><title>x</title></head><body><header class="masthead"><p class="issue">'),
        F.col("issue").cast("string"), F.lit('호</p><p class="period">'), F.date_format("start", "yyyy.MM.dd"), F.lit(" ~ "),
        F.date_format("end", "yyyy.MM.dd"), F.lit('</p><h1>보고 민수쌤(3반)</h1><p class="intro">'), esc(F.col("intro")),
        F.lit('</p><dl><div class="stat"><dt class="lbl">메시지 수</dt><dd class="num">1,2'), (F.col("doc_id") % 90 + 10).cast("string"),
        F.lit("</dd></div></dl></header>"),
    )
    topics = html_list(F.col("topics"), lambda t: c(F.lit("<li><h3>"), esc(t["topic"]), F.lit("</h3><p>"), esc(t["why"]), F.lit("</p></li>")))
    faq = html_list(F.col("faq"), lambda f: c(
        F.lit('<article class="qa"><h3 class="q">'), esc(f["question"]), F.lit('</h3><div class="a">'), esc(f["answer"]), F.lit("</div>"),
        F.coalesce(c(F.lit("<p class='tip'><mark>"), esc(f["practical_tip"]), F.lit("</mark></p>")), F.lit("")),
        F.lit('<p class="chips">'), html_list(f["tags"], lambda t: c(F.lit('<span class="chip">'), esc(t), F.lit("</span>"))), F.lit("</p></article>"),
    ))
    opened = html_list(F.col("unresolved"), lambda u: c(F.lit("<li>"), esc(u["question"]), F.lit("</li>")))
    tips = c(
        F.lit('<div class="tip-group"><h3 class="group-head">기타<span class="group-count">1</span></h3><div class="tip-grid">'),
        html_list(F.col("tips"), lambda t: c(F.lit('<article class="tip-card"><h3>'), esc(t["title"]), F.lit("</h3><p>"), esc(t["body"]), F.lit("</p></article>"))),
        F.lit("</div></div>"),
    )
    owner = F.when(F.col("doc_id") % 2 == 0, "참여자AB").otherwise("가온쌤")
    actions = c(F.lit('<ul class="act-list"><li><p class="act">정리</p><p class="meta"><span>'), owner, F.lit('</span><span class="due">2030-02-03 까지</span></p></li></ul>'))

    def section(name: str, inner: Column) -> Column:
        return c(F.lit(f'<section id="{name}"><h2>{name}</h2>'), inner, F.lit("</section>"))

    page = c(
        head, section("topics", c(F.lit('<ol class="topics">'), topics, F.lit("</ol>"))), section("solved", faq),
        section("open", c(F.lit('<ul class="open-list">'), opened, F.lit("</ul>"))),
        F.when(F.col("doc_id") % 10 == 9, F.lit("")).otherwise(section("tips", tips)), section("actions", actions),
        F.lit("</body></html>"),
    )
    edits = F.when(F.lit(False), F.col("html"))
    for case, (old, new, _) in _BROKEN_PAGES.items():
        edits = edits.when(F.col("doc_id") % 20 == case, F.replace("html", F.lit(old), F.lit(new)))
    whole = d.select("doc_id", "start", "end", "issue", page.alias("html"))
    return whole.withColumn("html", edits.otherwise(F.col("html")))


@query("report_items", f"""
WITH {FINAL_SQL}, judged AS (SELECT *, {_PROBLEM_SQL} AS problem FROM fin)
SELECT doc_id, problem,
  CASE WHEN problem IS NULL THEN issue || '호' END AS issue, CASE WHEN problem IS NULL THEN 1::BIGINT END AS topics,
  CASE WHEN problem IS NULL THEN n_faq END AS faq, CASE WHEN problem IS NULL THEN n_open END AS unresolved,
  CASE WHEN problem IS NULL THEN len(lines)::BIGINT END AS tips, CASE WHEN problem IS NULL THEN 1::BIGINT END AS actions,
  CASE WHEN problem IS NULL THEN 1200 + doc_id % 90 + 10 END AS messages,
  CASE WHEN problem IS NULL THEN md5(trim(regexp_replace(text, '[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g'))) END AS intro
FROM judged""")
def report_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_report_html(report_pages(spark, sf_dir))

    def size(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.size(name)).cast("bigint").alias(name)

    return found.select(
        "doc_id", "problem", "issue", *[size(n) for n in fixed.ITEM_LIMITS],
        F.col("stats")[fixed.STAT_MESSAGES].alias("messages"),
        F.when(F.col("problem").isNull(), F.md5(F.coalesce("intro", F.lit("")))).alias("intro"),  # a page may say nothing there
    )


_SQUEEZED = "trim(regexp_replace({0}, '[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g'))"


@query("report_recovered", f"""
WITH {FINAL_SQL}, pages AS (SELECT *, {_PROBLEM_SQL} AS page_problem FROM fin),
readable AS (SELECT *, {_SQUEEZED.format('text')} AS intro, list_transform(lines, lambda x: {_SQUEEZED.format('x')}) AS bodies FROM pages WHERE page_problem IS NULL),
texts AS (
  SELECT doc_id, 3000 AS max_len, intro AS string FROM readable UNION ALL
  SELECT doc_id, 8000, unnest(bodies) FROM readable),
broken AS (
  SELECT doc_id, 'unsafe_text' AS rule FROM texts WHERE len({kinds_sql('string', RE2_PII | RE2_PATHS)}) > 0
  UNION ALL SELECT doc_id, 'max_length' FROM texts WHERE length(string) > max_len
  UNION ALL SELECT doc_id, 'string_limit' FROM texts WHERE length(string) > 8000
  UNION ALL SELECT doc_id, 'max_items' FROM readable WHERE len(lines) > 100
  UNION ALL SELECT doc_id, 'total_limit' FROM readable WHERE len(lines) + n_faq + n_open + 2 > 250),
judged AS (
  SELECT p.*, coalesce(page_problem, 'contract: ' || (SELECT string_agg(DISTINCT rule, ',' ORDER BY rule) FROM broken b WHERE b.doc_id = p.doc_id)) AS problem FROM pages p)
SELECT doc_id, problem,
  CASE WHEN problem IS NULL THEN 'insight-' || strftime(s, '%Y%m%d') || '-' || strftime(e, '%Y%m%d') END AS content_id,
  CASE WHEN problem IS NULL THEN '보고 함께한 선생님' END AS hook_title,
  CASE WHEN problem IS NULL THEN CASE WHEN doc_id % 2 = 0 THEN '함께한 선생님AB' ELSE '가온쌤' END END AS owner,
  CASE WHEN problem IS NULL THEN '2030-02-03' END AS due, CASE WHEN problem IS NULL THEN n_faq + n_open END AS questions,
  CASE WHEN problem IS NULL THEN len(lines)::BIGINT END AS tips, CASE WHEN problem IS NULL THEN true END AS sealed
FROM judged""")
def report_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_report_html(report_pages(spark, sf_dir))
    docs = recovery.recover_publications(found, "2030-02-01T00:00:00Z")

    def at(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("doc", path, kind)

    return docs.select(
        "doc_id", "problem", at("$.content_id").alias("content_id"), at("$.hook_title").alias("hook_title"),
        at("$.actions[0].owner").alias("owner"), at("$.actions[0].due").alias("due"),
        at(f"$.stats['{fixed.STAT_QUESTIONS}']", "bigint").alias("questions"),
        F.when(F.col("doc").isNotNull(), F.size(at("$.tips", "array<variant>"))).cast("bigint").alias("tips"),
        (at("$.content_sha256") == canonical.content_sha256(F.col("doc"))).alias("sealed"),
    )
