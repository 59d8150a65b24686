"""From an approved insight set to a public document.

``final`` is a VARIANT column holding the approved set.  Provenance evidence is
checked first; the public document is then built from named fields only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom import fixed
from chatloom.functions import canonical, dates, text
from chatloom.operators.contract import Rule, check_shape, deepest, violation, walk_documents
from chatloom.settings import DEFAULTS, DigestSettings

_object = canonical.sorted_struct


def _get(column: str, path: str) -> Column:
    return F.try_variant_get(column, path, "variant")


def _text(column: str, path: str) -> Column:
    value = _get(column, path)
    return F.when(canonical.json_type(value) == "string", value.try_cast("string"))


def payload(final: str = "final") -> Column:
    return canonical.without_keys(F.col(final), "privacy_evidence")


def _payload_members() -> Column:
    return F.map_filter(F.col("final").try_cast("map<string,variant>"), lambda k, _: k != "privacy_evidence")


def build_evidence(
    passed: DataFrame, start: Column, end: Column, source: Column, mode: str,
    pii_passed: Column | None = None, names_passed: Column | None = None,
) -> DataFrame:
    """Bind period and payload by digest: ``final`` gains its evidence block, ``document`` is its canonical JSON.

    ``final`` is a VARIANT or, which is written out in a fraction of the time, a struct of sorted structs without maps;
    it comes out as VARIANT.
    ``source`` is the canonical input the set was made from; the flags say what
    its scans found, where they are not part of an earlier gate.
    """
    dates_ = {"period_start": F.date_format(start, "yyyy-MM-dd"), "period_end": F.date_format(end, "yyyy-MM-dd")}
    kind = passed.schema["final"].dataType
    typed = isinstance(kind, T.StructType)
    if typed:
        if not canonical.is_sorted(kind):
            raise ValueError("the fields of a typed set must stand in the order of their names, at every level")
        fields = sorted({*kind.names, *dates_} - {"privacy_evidence"})
        body = _object(**{f: dates_[f] if f in dates_ else F.col("final")[f] for f in fields})
        payload_text = canonical.struct_json(F.col("_body"))
    else:
        body = F.map_concat(
            F.map_filter(F.col("final").try_cast("map<string,variant>"), lambda k, _: ~k.isin(*dates_, "privacy_evidence")),
            F.to_variant_object(F.create_map(*[x for name, day in dates_.items() for x in (F.lit(name), day)])).try_cast("map<string,variant>"),
        )
        payload_text = canonical.canonical_json(F.to_variant_object("_body"))
    evidence = _object(
        evidence_version=F.lit(fixed.EVIDENCE_VERSION).cast("bigint"),
        stage=F.lit(fixed.EVIDENCE_STAGE),
        consent_mode=F.lit(mode),
        pii_scan_passed=F.lit(True) if pii_passed is None else pii_passed,
        nickname_policy_passed=F.lit(True) if names_passed is None else names_passed,
        source_sha256=F.sha2(source, 256),
        payload_sha256=F.sha2(payload_text, 256),
        **dates_,
    )
    sealed = passed.withColumn("_body", body).withColumn("_evidence", evidence)
    if typed:
        whole = _object(privacy_evidence=F.col("_evidence"), **{f: F.col("_body")[f] for f in fields})
        text_ = canonical.struct_json(F.col("_whole"))
    else:
        whole = F.map_concat("_body", F.create_map(F.lit("privacy_evidence"), F.to_variant_object("_evidence")))
        text_ = canonical.canonical_json(F.to_variant_object("_whole"))
    sealed = sealed.withColumn("_whole", whole)
    return sealed.withColumns({"final": F.to_variant_object("_whole"), "document": text_}).drop("_body", "_evidence", "_whole")


_EVIDENCE = "$.privacy_evidence"


def _with_evidence(finals: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Adds what the rules of provenance look at: the members of the evidence block, each taken apart once into its type
    and text, the set's bounds and its digest made anew."""
    members = _get("final", _EVIDENCE).try_cast("map<string,variant>")
    told = F.transform_values(members, lambda _, v: F.struct(F.schema_of_variant(v).alias("type"), v.try_cast("string").alias("text")))
    return finals.withColumn("_told", told).withColumns({
        "_actual": F.when(F.col("_told").isNotNull(), F.sha2(canonical.members_json(_payload_members()), 256)),
        **{f"_{name}": _text("final", f"$.{name}") for name in ("period_start", "period_end")},
        **{f"_asked_{name}": F.lit(None).cast("date") if bound is None else bound.cast("date") for name, bound in (("period_start", start), ("period_end", end))},
    })


def _evidence_violations(mode: str, start_asked: bool, end_asked: bool) -> Column:
    """Broken rules of provenance as an array, over the columns of ``_with_evidence``."""
    keys = F.map_keys("_told")
    wanted = F.array(*map(F.lit, fixed.EVIDENCE_KEYS))

    def said(name: str, kind: str = "STRING") -> Column:
        member = F.try_element_at("_told", F.lit(name))
        return F.when(member["type"] == kind, member["text"])

    applied = said("consent_mode")

    def flag(name: str) -> Column:
        return F.coalesce(said(name, "BOOLEAN") == "true", F.lit(False))

    def digest(name: str) -> Column:
        return F.coalesce(said(name).rlike(fixed.SHA256_PATTERN), F.lit(False))

    def period(name: str) -> Column:
        return F.coalesce(dates.parse_full_date(said(name)).isNotNull() & (said(name) == F.col(f"_{name}")), F.lit(False))

    def requested(name: str, asked: bool) -> Column:
        if not asked:
            return F.lit(False)
        return F.coalesce(said(name) != F.date_format(f"_asked_{name}", "yyyy-MM-dd"), F.lit(True))

    provenance = (said("evidence_version", "BIGINT") == str(fixed.EVIDENCE_VERSION)) & (said("stage") == fixed.EVIDENCE_STAGE)
    rules = {
        "evidence_keys": (F.size(F.array_except(keys, wanted)) > 0) | (F.size(F.array_except(wanted, keys)) > 0),
        "provenance": ~F.coalesce(provenance, F.lit(False)),
        "mode": ~F.coalesce(applied.isin(*fixed.CONSENT_MODES), F.lit(False)),
        "mode_drift": applied.isin(*fixed.CONSENT_MODES) & (applied != mode),
        "pii_scan": ~flag("pii_scan_passed"),
        "nickname_policy": ~flag("nickname_policy_passed"),
        "source_digest": ~digest("source_sha256"),
        "payload_digest": ~digest("payload_sha256"),
        "period_start": ~period("period_start"),
        "period_end": ~period("period_end"),
        "requested_period": requested("period_start", start_asked) | requested("period_end", end_asked),
        "payload_mismatch": digest("payload_sha256") & (said("payload_sha256") != F.col("_actual")),
    }
    missing = keys.isNull()
    found = F.when(missing, F.array(F.lit("evidence_missing"))).otherwise(
        F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    )
    return F.transform(found, lambda rule: violation(F.lit(_EVIDENCE), rule))


def verify_evidence(finals: DataFrame, mode: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``(doc_id, location, rule, detail)`` for every broken provenance rule."""
    found = _with_evidence(finals, start, end).select("doc_id", _evidence_violations(mode, *(bound is not None for bound in (start, end))).alias("found"))
    return found.select("doc_id", F.inline_outer("found")).filter(F.col("rule").isNotNull())


# --- allowlist projection ------------------------------------------------------------------

def _need(template: str) -> Rule:
    return Rule(template, ("string",), min_len=1, non_blank=True)


def _may(template: str) -> Rule:
    return Rule(template, ("string", "null"))


def _list(template: str, *required: str) -> list[Rule]:
    return [Rule(template, ("array",)), Rule(f"{template}[]", ("object",), required=required)]


def _tag_list(template: str) -> list[Rule]:
    return [Rule(template, ("array",)), _need(template + "[]")]


FINAL_RULES: tuple[Rule, ...] = (
    Rule("$", ("object",), required=("report",)),
    Rule("$.report", ("object",), required=("sections", "intro")),
    Rule("$.report.sections", ("object",)),
    Rule("$.report.hook_title", ("string", "null"), min_len=1, non_blank=True),
    _need("$.report.intro"),
    Rule("$.report.sections.stats", ("object",)),
    *_list("$.report.sections.topics", "topic", "why"),
    _need("$.report.sections.topics[].topic"), _need("$.report.sections.topics[].why"),
    *_list("$.report.sections.unresolved", "question"), _need("$.report.sections.unresolved[].question"),
    *_list("$.faq", "question", "answer"),
    _need("$.faq[].question"), _need("$.faq[].answer"), *_tag_list("$.faq[].tags"),
    _may("$.faq[].practical_tip"),
    *_list("$.tips", "title", "body"),
    _need("$.tips[].title"), _need("$.tips[].body"), *_tag_list("$.tips[].feature_tags"),
    _may("$.tips[].practical_tip"),
    *_list("$.actions", "type", "text"),
    _need("$.actions[].type"), _need("$.actions[].text"), _may("$.actions[].owner_nickname"),
    _may("$.actions[].due"),
)


# Lists of items at the top of a set: nearly all of its nodes.
_LISTS = ("faq", "tips", "actions")


def _plain(name: str) -> Column:
    """True only for a list that breaks no rule, told from its schema and its strings, without a look at each node.

    The schema of a list is merged from all items: it has the types that occur, but a null or an absent member does not
    show. So needed strings and tags are looked at, too. Names other than plain words are quoted in it and do not match.
    """
    head = f"$.{name}[]."
    own = {r.template.removeprefix(head): r for r in FINAL_RULES if r.template.startswith(head)}
    members = {m: r for m, r in own.items() if not m.endswith("[]")}
    types = {m: "ARRAY<STRING>" if "array" in r.types else "(?:STRING|VOID)" if "null" in r.types else "STRING" for m, r in members.items()}
    scalar = "(?:STRING|BIGINT|BOOLEAN|VOID)"
    known = "|".join(f"{m}: {t}" for m, t in types.items())
    member = rf"(?:{known}|(?!(?:{'|'.join(members)}): )\w+: (?:{scalar}|ARRAY<{scalar}>))"
    value = _get("final", f"$.{name}")
    shaped = F.schema_of_variant(value).rlike(rf"\AARRAY<OBJECT<{member}(?:, {member})*>>\z")
    looked_at = {m: r for m, r in members.items() if "array" in r.types or r.non_blank}
    fields = ",".join(f"{m}:{'array<string>' if 'array' in r.types else 'string'}" for m, r in looked_at.items())

    def filled(item: Column) -> Column:
        return reduce(and_, [F.forall(item[m], text.has_text) if "array" in r.types else text.has_text(item[m]) for m, r in looked_at.items()])

    return F.coalesce(shaped & F.forall(F.try_variant_get("final", f"$.{name}", f"array<struct<{fields}>>"), filled), F.lit(False))


def _plain_lists() -> Column:
    """Names of the lists of a set that break no rule."""
    return F.array_compact(F.array(*[F.when(_plain(name), F.lit(name)) for name in _LISTS]))


def _doubtful() -> Column:
    """What of a set its rules must look at: neither ``plain`` lists nor the evidence, for which there is no such rule.

    ``plain`` is named twice: the optimizer would copy into the lambda what is named once, and make it anew for each key.
    """
    kept = F.map_filter(F.col("final").try_cast("map<string,variant>"), lambda k, _: (k != "privacy_evidence") & ~F.array_contains("plain", k))
    return F.coalesce(F.when(F.size("plain") > 0, F.to_variant_object(kept)), F.col("final"))


def _request_violations() -> Column:
    def size(path: str) -> Column:
        return F.coalesce(F.size(_get("final", path).try_cast("array<variant>")), F.lit(0))

    def off(stat: str, expected: Column) -> Column:
        printed = _get("final", f"$.report.sections.stats['{stat}']")
        return printed.isNotNull() & (F.to_json(printed) != expected.cast("string"))

    n_faq, n_open = size("$.faq"), size("$.report.sections.unresolved")
    rules = (
        ("$.period_start", F.coalesce(F.col("start") > F.col("end"), F.lit(True)), "period_order"),
        ("$.issue", F.coalesce(F.col("issue") < 1, F.lit(True)), "issue_minimum"),
        (f"$.report.sections.stats.{fixed.STAT_QUESTIONS}", off(fixed.STAT_QUESTIONS, n_faq + n_open), "source_count"),
        (f"$.report.sections.stats.{fixed.STAT_RESOLVED}", off(fixed.STAT_RESOLVED, n_faq), "source_count"),
    )
    return F.array_compact(F.array(*[F.when(cond, violation(F.lit(location), F.lit(rule))) for location, cond, rule in rules]))


def check_request(finals: DataFrame) -> DataFrame:
    """Preconditions of a projection: the period's order, the issue, and printed counts against the approved items.

    ``finals`` has start, end and issue.
    """
    return finals.select("doc_id", F.inline_outer(_request_violations())).filter(F.col("rule").isNotNull())


def check_final(
    finals: DataFrame, mode: str, start: Column | None = None, end: Column | None = None, request: bool = False,
) -> DataFrame:
    """Why a set cannot be projected; no row means it can. With ``request`` also what ``check_request`` finds; one look at each set."""
    found = _evidence_violations(mode, *(bound is not None for bound in (start, end)))
    carried = F.concat(found, _request_violations()) if request else found
    sets = _with_evidence(finals, start, end).select("doc_id", "final", carried.alias("carried"), _plain_lists().alias("plain"))
    return check_shape(walk_documents(sets.select("doc_id", _doubtful().alias("doc"), "carried"), ["carried"], deepest(FINAL_RULES)), FINAL_RULES)


def project_publication(
    finals: DataFrame, mode: str, settings: DigestSettings = DEFAULTS,
) -> DataFrame:
    """``doc`` VARIANT, ``document`` (its canonical JSON) and ``content_sha256`` of each final; input columns
    ``start end issue generated_at``.

    Text and digest are made of typed, sorted structs, which is several times faster than writing out a variant. Optional columns ``content_id`` and ``slug`` carry a revision.  Every public
    field is named here; nothing else of the input can get through.
    """
    issue = F.col("issue").cast("bigint")
    given = set(finals.columns)
    parts = finals.withColumns({
        "_topics": F.try_variant_get("final", "$.report.sections.topics", "array<struct<topic:string,why:string>>"),
        "_faq": F.try_variant_get(
            "final", "$.faq", "array<struct<question:string,answer:string,tags:array<string>,practical_tip:string>>"),
        "_open": F.try_variant_get("final", "$.report.sections.unresolved", "array<struct<question:string>>"),
        "_tips": F.try_variant_get(
            "final", "$.tips", "array<struct<title:string,body:string,feature_tags:array<string>,practical_tip:string>>"),
        "_actions": F.try_variant_get(
            "final", "$.actions", "array<struct<type:string,text:string,owner_nickname:string,due:string>>"),
        "_stats": F.try_variant_get("final", "$.report.sections.stats", "map<string,variant>"),
    })
    no_tags = F.array().cast("array<string>")

    def listed(column: str) -> Column:
        """An absent array counts as empty."""
        return F.coalesce(F.col(column), F.array().cast(parts.schema[column].dataType))

    body = {
        "schema_version": F.lit(fixed.SCHEMA_VERSION).cast("bigint"),
        "kind": F.lit(fixed.DOCUMENT_KIND),
        "content_id": F.col("content_id") if "content_id" in given else dates.content_id(F.col("start"), F.col("end")),
        "slug": F.col("slug") if "slug" in given else dates.slug(issue),
        "issue": issue,
        "period": _object(
            start=F.date_format("start", "yyyy-MM-dd"),
            end=F.date_format("end", "yyyy-MM-dd"),
            label=dates.period_label(F.col("start"), F.col("end")),
        ),
        "title": F.replace(F.lit(settings.title_pattern), F.lit("{issue}"), issue.cast("string")),
        "hook_title": F.regexp_replace(_text("final", "$.report.hook_title"), F.lit(r"(?U)^\s+|\s+\z"), F.lit("")),
        "intro": _text("final", "$.report.intro"),
        "stats": F.coalesce("_stats", F.from_json(F.lit("{}"), "map<string,variant>")),
        "topics": F.transform(listed("_topics"), lambda t: _object(topic=t["topic"], why=t["why"])),
        "faq": F.transform(listed("_faq"), lambda f: _object(
            question=f["question"], answer=f["answer"], tags=F.coalesce(f["tags"], no_tags), practical_tip=f["practical_tip"],
        )),
        "unresolved": F.transform(listed("_open"), lambda u: _object(question=u["question"])),
        "tips": F.transform(listed("_tips"), lambda t: _object(
            title=t["title"], body=t["body"], feature_tags=F.coalesce(t["feature_tags"], no_tags), practical_tip=t["practical_tip"],
        )),
        "actions": F.transform(listed("_actions"), lambda a: _object(
            type=a["type"], text=a["text"], owner=a["owner_nickname"], due=a["due"],
        )),
        "privacy": _object(
            consent_mode=F.lit(mode), pii_scan_passed=F.lit(True), source_ids_stripped=F.lit(True),
        ),
        "generated_at": dates.normalize_generated_at(F.col("generated_at")),
    }
    built = parts.withColumn("_body", _object(**body))
    sealed = built.withColumn("content_sha256", F.sha2(canonical.struct_json(F.col("_body")), 256))
    whole = _object(content_sha256=F.col("content_sha256"), **{name: F.col("_body")[name] for name in body})
    sealed = sealed.withColumn("_whole", whole)
    hidden = [c for c in sealed.columns if c.startswith("_")]
    return sealed.withColumns({"doc": F.to_variant_object("_whole"), "document": canonical.struct_json(F.col("_whole"))}).drop(*hidden)


def seal(documents: DataFrame) -> DataFrame:
    """Add the document's own digest to ``doc``."""
    members = F.map_filter(F.col("doc").try_cast("map<string,variant>"), lambda k, _: k != "content_sha256")
    digest = canonical.content_sha256(F.col("doc"))
    added = F.to_variant_object(F.create_map(F.lit("content_sha256"), digest)).try_cast("map<string,variant>")
    return documents.withColumn("doc", F.to_variant_object(F.map_concat(members, added)))


def changed_counts() -> Column:
    """Item counts that differ between ``final`` and ``doc``, as an array of violations."""
    pairs = {
        "topics": "$.report.sections.topics", "faq": "$.faq",
        "unresolved": "$.report.sections.unresolved", "tips": "$.tips", "actions": "$.actions",
    }

    def size(column: str, path: str) -> Column:
        return F.greatest(F.size(_get(column, path).try_cast("array<variant>")), F.lit(0))

    return F.array_compact(F.array(*[
        F.when(~F.equal_null(size("final", path), size("doc", f"$.{name}")), violation(
            F.lit(f"$.{name}"), F.lit("count_changed"), F.concat_ws("->", size("final", path), size("doc", f"$.{name}"))))
        for name, path in pairs.items()
    ]))


def counts_preserved(projected: DataFrame) -> DataFrame:
    """Documents whose item counts differ from their approved set."""
    return projected.select("doc_id", F.inline_outer(changed_counts())).filter(F.col("rule").isNotNull())
