"""Text clean-up, names, links and masks as native column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.functions import patterns
from chatloom.settings import DEFAULTS, NamePolicy, TERMS


def _sub(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def strip_tags(html: Column) -> Column:
    return _sub(html, fixed.TAG_PATTERN, " ")


def squeeze_ws(text: Column) -> Column:
    return F.trim(_sub(text, r"(?U)\s+", " "))


def has_text(text: Column) -> Column:
    """True if at least one character is not white space."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def ordered_unique(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def add_auto_tags(tags: Column, auto: tuple[str, ...] = fixed.AUTO_TAGS) -> Column:
    return F.array_union(F.coalesce(tags, F.array().cast("array<string>")), F.array(*map(F.lit, auto)))


def rename_terms(text: Column, pairs: tuple[tuple[str, str], ...] = TERMS) -> Column:
    """Literal replacements in list order."""
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def extract_code_spans(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(fixed.CODE_SPAN_PATTERN), F.lit(1))


# --- names ------------------------------------------------------------------------

def normalize_public_names(text: Column, policy: NamePolicy = DEFAULTS.policy) -> Column:
    """Every spelling of a consenting person becomes the one display form."""
    return reduce(lambda c, p: _sub(c, f"(?U){p.spelling}", p.display), policy.public_names, text)


def anonymize_honorifics(text: Column, policy: NamePolicy = DEFAULTS.policy, limit: int | None = None) -> Column:
    """Hide people addressed by an honorific, but keep consenting names.

    Names to keep are parked on private-use characters, which no word class
    matches, so that a neighbouring name cannot swallow them. A text within
    ``limit`` that the longer label would push beyond it gets the neutral title,
    which is no longer than a name. A text without any of the words looked for,
    nearly every one, is told by plain searches and stays as it is.
    """
    marks = [(p.display, chr(0xE000 + i)) for i, p in enumerate(policy.public_names)]
    named = reduce(lambda a, b: a | b, [text.contains(x) for x in (fixed.OLD_PSEUDONYM_PREFIX, "쌤", "샘", *policy.displays)])

    def hidden(label: str) -> Column:
        out = text
        for display, mark in marks:
            out = _sub(out, re.escape(display) + r"(?:\([^)]*\))?", mark)
        out = _sub(out, fixed.OLD_PSEUDONYM_PREFIX + "([A-Z]+)", label + "$1")
        for honorific in ("쌤", "샘"):
            out = _sub(out, rf"(?U)([\w-]{{2,20}}){honorific}(?:\([^)]*\))?", label)
        for display, mark in marks:
            out = F.replace(out, F.lit(mark), F.lit(display))
        return out

    full = hidden(fixed.PSEUDONYM_PREFIX)
    if limit is not None:
        pushed = (F.length(text) <= limit) & (F.length(full) > limit)
        full = F.when(pushed, hidden(fixed.NEUTRAL_TITLES[0])).otherwise(full)
    return F.when(named, full).otherwise(text)


def normalize_owner(owner: Column, policy: NamePolicy = DEFAULTS.policy) -> Column:
    """Owner to a public name, a pseudonym, or NULL."""
    letters = F.regexp_extract(owner, fixed.OLD_PSEUDONYM_PREFIX + "([A-Z]+)", 1)
    picked = reduce(
        lambda c, d: c.when(owner.contains(d), F.lit(d)),
        policy.displays,
        F.when(owner.isNull() | (owner == ""), F.lit(None).cast("string")),
    )
    return picked.when(letters != "", F.concat(F.lit(fixed.PSEUDONYM_PREFIX), letters))


def pseudonyms_in(text: Column) -> Column:
    """Distinct pseudonyms (old or new prefix) in a text."""
    pattern = f"((?:{fixed.PSEUDONYM_PREFIX}|{fixed.OLD_PSEUDONYM_PREFIX})[A-Z]+)"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def pseudonym_label(ordinal: Column) -> Column:
    """0 → A, 25 → Z, 26 → AA, …"""
    start = F.struct(ordinal.cast("bigint").alias("n"), F.lit("").alias("s"))
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(14)),  # 26^14 exceeds the bigint range
        start,
        lambda acc, _: F.when(
            acc["n"] >= 0,
            F.struct(
                (F.floor(acc["n"] / 26) - 1).cast("bigint").alias("n"),
                F.concat(F.char((acc["n"] % 26 + 65).cast("bigint")), acc["s"]).alias("s"),
            ),
        ).otherwise(acc),
    )
    return done["s"]


# --- links ---------------------------------------------------------------------------

def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _trim_link(url: Column) -> Column:
    """Cut particles, punctuation and unbalanced closers off the end of a URL.

    One step cuts one piece; the first step that cuts nothing ends the work, so
    the bound (the length of the URL) is never felt.
    """
    particle = r"(?<=[^가-힣])(?:" + "|".join(fixed.PARTICLES) + r")\z"
    punctuation = "[" + re.escape(fixed.TRAILING_PUNCTUATION) + r"]\z"

    def step(acc: Column, _: Column) -> Column:
        u = acc["u"]
        unbalanced = reduce(
            lambda a, b: a | b,
            [u.endswith(c) & (_count(u, c) > _count(u, o)) for c, o in ((")", "("), ("]", "["), ("}", "{"))],
        )
        cut = (
            F.when(u.rlike(particle), _sub(u, particle, ""))
            .when(u.rlike(punctuation) | unbalanced, F.left(u, F.length(u) - 1))
            .otherwise(u)
        )
        moved = F.transform(
            F.array(cut), lambda c: F.struct(c.alias("u"), ((c == u) | (c == "")).alias("done"))
        )[0]
        return F.when(acc["done"], acc).otherwise(moved)

    start = F.struct(url.alias("u"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.length(url)), start, step)["u"]


def extract_links(text: Column) -> Column:
    """Links of a raw text as ``array<struct<url, shown>>``."""
    found = F.when(
        text.contains("http"), F.regexp_extract_all(text, F.lit(fixed.URL_PATTERN), F.lit(1))
    ).otherwise(F.array().cast("array<string>"))

    def shown(u: Column) -> Column:
        short = F.concat(F.left(u, F.lit(fixed.LINK_SHORTENED_CHARS)), F.lit("…"))
        return F.when(F.length(u) <= fixed.LINK_SHOWN_CHARS, u).otherwise(short)

    return F.transform(
        F.transform(found, _trim_link), lambda u: F.struct(u.alias("url"), shown(u).alias("shown"))
    )


def uuid_from_url(text: Column) -> Column:
    """URL or bare id → hyphenated UUID; the query string is not looked at."""
    run = F.lower(F.regexp_extract(_sub(text, r"\?.*", ""), "([0-9A-Fa-f]{32})", 1))
    return F.when(
        run != "",
        F.regexp_replace(run, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
    )


# --- long texts ------------------------------------------------------------------------

def pieces(text: Column, size: int) -> Column:
    """Consecutive pieces of at most ``size`` characters, in one pass over the text."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


# --- masks -------------------------------------------------------------------------------

def mask_pii(text: Column) -> Column:
    """Replace every personal-data or secret match by ``[kind]``, in pattern order.

    The scan decides first, so that clean text never meets the replacements.
    """
    masked = reduce(lambda c, p: _sub(c, p[1], f"[{p[0]}]"), fixed.PII_PATTERNS, text)
    return F.when(F.size(patterns.pii_kinds(text)) > 0, masked).otherwise(text)


# --- titles --------------------------------------------------------------------------------

def digest_title(
    hook: Column, formal: Column, issue: Column, label: Column, mode: str, prefix_issue: bool = False
) -> Column:
    if mode not in fixed.TITLE_MODES:
        raise ValueError(f"unknown title mode: {mode!r}")
    number = F.concat(issue.cast("string"), F.lit("호 · "))
    if mode == "issue":
        return F.concat(number, label)
    body = hook if mode == "hook" else formal
    return F.concat(number, body) if prefix_issue else body
