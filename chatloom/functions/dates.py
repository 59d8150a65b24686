"""Strict dates, labels and identifiers derived from dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom import fixed


def parse_full_date(text: Column) -> Column:
    """``YYYY-MM-DD`` that exists on the calendar, else NULL."""
    return F.when(text.rlike(fixed.FULL_DATE_PATTERN), text.try_cast("date"))


def parse_rfc3339(text: Column) -> Column:
    """Strict RFC 3339 instant, else NULL."""
    return F.when(text.rlike(fixed.RFC3339_PATTERN), text.try_cast("timestamp"))


def normalize_generated_at(text: Column) -> Column:
    """RFC 3339 in any offset to UTC whole seconds with ``Z``; NULL if not strict."""
    return F.date_format(parse_rfc3339(text), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def period_label(start: Column, end: Column) -> Column:
    head = F.concat(F.date_format(start, "yyyy.MM.dd"), F.lit(" - "))
    same_year = F.year(start) == F.year(end)
    return F.concat(
        head,
        F.when(same_year, F.date_format(end, "MM.dd")).otherwise(F.date_format(end, "yyyy.MM.dd")),
    )


def display_date(iso: Column) -> Column:
    return F.when(F.length(iso) == 10, F.replace(iso, F.lit("-"), F.lit("."))).otherwise(iso)


def yymmdd(iso: Column) -> Column:
    digits = F.replace(F.coalesce(iso, F.lit("")), F.lit("-"), F.lit(""))
    return F.when(F.length(digits) >= 8, F.substring(digits, 3, 6)).otherwise(F.lit("000000"))


def archive_name(issue: Column, start_iso: Column, end_iso: Column) -> Column:
    return F.concat(issue.cast("string"), F.lit("호_"), yymmdd(start_iso), F.lit("~"), yymmdd(end_iso))


def content_id(start: Column, end: Column) -> Column:
    return F.concat(
        F.lit("insight-"), F.date_format(start, "yyyyMMdd"),
        F.lit("-"), F.date_format(end, "yyyyMMdd"),
    )


def slug(issue: Column) -> Column:
    return F.format_string("community-insight-%03d", issue)


def slice_id(period_id: Column, since: Column, until: Column) -> Column:
    """Name of a slice; a missing bound is spelled out."""
    return F.concat(
        period_id, F.lit("__"),
        F.coalesce(F.date_format(since, "yyyyMMdd"), F.lit("처음")), F.lit("-"),
        F.coalesce(F.date_format(until, "yyyyMMdd"), F.lit("끝")),
    )


def iso_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
