import hashlib
import json

import pytest
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.functions import canonical, dates, patterns, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(
        f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in (values or {"x": 1}).items()
    ))
    return row.select(column.alias("c")).first().c


@pytest.mark.parametrize("doc", [
    {"b": "x\x1f\x0b \u2028 \\u000B \\", "a": [1, True, None, {"z": "é😀/\"\n\t"}]},
    {"é": 1, "z": {}, "a": [], "\x7f": "\x01"}, {"k": "\\\\u001F", "n": -5},
])
def test_canonical_json_equals_python(spark, doc):
    want = json.dumps(doc, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert one(spark, canonical.canonical_json(F.parse_json("j")), j=json.dumps(doc)) == want


def test_content_hash_leaves_itself_out(spark):
    doc = {"b": [1, {"c": "가"}], "content_sha256": "x"}
    bare = {"b": doc["b"]}
    want = hashlib.sha256(json.dumps(bare, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert one(spark, canonical.content_sha256(F.parse_json("j")), j=json.dumps(doc)) == want


@pytest.mark.parametrize("raw, verdict", [
    (b'{"a":1}', "ok"), (b' [1] ', "ok"), (b'{"a":1,"a":2}', "not_strict_json"),
    (b'{"x":{"a":1,"a":1}}', "not_strict_json"), (b'{"a":NaN}', "not_strict_json"), (b'{"a":1} x', "not_strict_json"),
    (b'1,2', "not_strict_json"), (b'{"a":"\xff"}', "not_utf8"), (b'"' + b"a" * 262_143 + b'"', "too_large"),
    (b'"' + b"a" * 262_142 + b'"', "ok"),
])
def test_strict_json(spark, raw, verdict):
    row = spark.createDataFrame([(bytearray(raw),)], "raw binary")
    assert row.select(canonical.strict_json_verdict(F.col("raw")).alias("v")).first().v == verdict


def test_types_are_exact(spark):
    want = {"true": "boolean", "1": "integer", "1.0": "number", "1e2": "number", '"1"': "string", "null": "null",
            "[]": "array", "{}": "object"}
    rows = spark.createDataFrame([(k,) for k in want], "j string").select("j", canonical.json_type(F.parse_json("j")).alias("t"))
    assert {r.j: r.t for r in rows.collect()} == want


@pytest.mark.parametrize("sign", ["&", "<", ">", "\u2028", "\u2029"])
def test_embedding_cannot_break_out(spark, sign):
    """Each escaped sign at both ends, doubled, in keys and nested values; closing tags in any case."""
    doc = {f"{sign}k{sign}": [sign * 2, {"deep": f"{sign}x</SCRIPT >{sign}"}], "plain": "</style><!-- -->"}
    html = one(spark, canonical.embed_json(F.parse_json("j"), "e"), j=json.dumps(doc))
    inner = html[html.index(">") + 1:html.rindex("</script>")]
    assert not set("&<>\u2028\u2029") & set(inner)
    assert json.loads(inner) == doc


@pytest.mark.parametrize("value, kind", [
    ("메일은 help-desk@mail.example.org 로", "email"), ("로그: /home/jiho/run.txt", "linux_local_path"), ("번호 +82-10-2222-0000 입니다", "phone"),
    ("참고 http://wiki.example.org/a", "url"), ("authorization: bearer qwertyuiop1234567890", "bearer_token"), ("dial +49 30 901820", "international_phone"),
    ("전화 (02) 555-0000", "phone"), ("위치 /var/lib/app/data", "sensitive_posix_path"), ("notion.site/our-notes-page", "bare_notion_share"),
    ("ntn_" + "q1" * 15, "notion_token"), ("share=" + "z7" * 9, "share_token"), ("www.example.org", "url"), ("api_key: " + "k" * 14, "assigned_secret"),
    ("1600-0000", "service_phone"), ("751231-1999999", "rrn"), ("Z:/share", "windows_slash_path"), ("~/note", "tilde_local_path"),
])
def test_unsafe_strings(spark, value, kind):
    assert kind in one(spark, patterns.unsafe_kinds(F.col("s")), s=value)


def test_clean_string_and_public_name(spark):
    assert one(spark, patterns.unsafe_kinds(F.col("s")), s="보기마다 속성을 고를 수 있습니다. 12:30") == []
    assert one(spark, patterns.names_person(F.col("s")), s="지호쌤이 알림") is True
    assert one(spark, patterns.names_person(F.col("s")), s="가온쌤이 함께한 선생님AB 선생님께") is False


def test_every_pattern_passes_its_own_guard(spark):
    """A guard may only skip a text that the pattern does not match."""
    from chatloom.plans.derive import UNSAFE

    rows = spark.createDataFrame([(u,) for u in UNSAFE], "s string")
    plain = [F.col("s").rlike(p).alias(k) for k, p in fixed.PII_PATTERNS + fixed.PATH_PATTERNS]
    for r in rows.select("s", patterns.unsafe_kinds(F.col("s")).alias("got"), F.struct(*plain).alias("want")).collect():
        assert sorted(r.got) == sorted(k for k, v in r.want.asDict().items() if v), r.s


@pytest.mark.parametrize("n, label", [(0, "A"), (25, "Z"), (26, "AA"), (51, "AZ"), (52, "BA"), (701, "ZZ"), (702, "AAA"), (18278, "AAAA")])
def test_pseudonym_label(spark, n, label):
    assert one(spark, text.pseudonym_label(F.col("n")), n=n) == label


def test_links(spark):
    s = "https://a.io/x를 (https://b.io/y), https://c.io/한글로 [https://d.io/a(b)].. https://e.io/" + "." * 40
    got = [r.url for r in one(spark, text.extract_links(F.col("s")), s=s)]
    assert got == ["https://a.io/x", "https://b.io/y", "https://c.io/한글로", "https://d.io/a(b)", "https://e.io/"]


def test_pieces_lose_nothing(spark):
    s = "가😀나\n다" * 1000
    got = one(spark, text.pieces(F.col("s"), 999), s=s)
    assert "".join(got) == s and max(map(len, got)) == 999
    assert one(spark, text.pieces(F.col("s"), 9), s="") == [""]


@pytest.mark.parametrize("value, want", [
    ("2026-09-03T12:00:00.5+09:00", "2026-09-03T03:00:00Z"), ("2026-09-03T12:00:00Z", "2026-09-03T12:00:00Z"),
    ("2026-09-03 12:00:00+09:00", None), ("2026-02-30T00:00:00Z", None), ("2026-09-03T12:00Z", None), ("2026-09-03T12:00:00", None),
])
def test_generated_at(spark, value, want):
    assert one(spark, dates.normalize_generated_at(F.col("s")), s=value) == want


@pytest.mark.parametrize("value, ok", [("2026-08-19", True), ("20260819", False), ("2026-8-1", False), ("2026-02-30", False), ("2026-08-19\n", False)])
def test_full_date(spark, value, ok):
    assert (one(spark, dates.parse_full_date(F.col("s")), s=value) is not None) is ok


def test_titles():
    with pytest.raises(ValueError):
        text.digest_title(F.lit("h"), F.lit("f"), F.lit(1), F.lit("l"), "other")


def test_title_modes(spark):
    def title(mode, prefix=False):
        return one(spark, text.digest_title(F.lit("후킹"), F.lit("사무적"), F.lit(3), F.lit("기간"), mode, prefix))

    assert (title("hook", True), title("formal"), title("issue")) == ("3호 · 후킹", "사무적", "3호 · 기간")
