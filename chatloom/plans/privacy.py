"""Queries on pseudonyms, scans and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import text
from chatloom.operators import privacy
from chatloom.plans import derive
from chatloom.plans.derive import DOC_SQL, MSG_SQL, NAMES_SQL, STAMP_SQL, stamp, week
from chatloom.plans.registry import query

ROOM_WEEK = ["room_id", "week"]


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.messages(spark, sf_dir).withColumn("week", week())


def _map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonym_map(_weekly(spark, sf_dir), derive.public_names(spark), ROOM_WEEK)


MAP_SQL = MSG_SQL + ", " + NAMES_SQL + """,
seen AS (
  SELECT room_id, week, nickname, min(ts) AS first_ts FROM msg
  WHERE nickname IS NOT NULL AND NOT is_system GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY room_id, week ORDER BY first_ts, nickname) - 1 AS i
  FROM seen s WHERE nickname NOT IN (SELECT nickname FROM names)),
map AS (
  SELECT room_id, week, nickname, '함께한 선생님' ||
         CASE WHEN i < 26 THEN chr((65 + i)::INT) ELSE chr((64 + i // 26)::INT) || chr((65 + i % 26)::INT) END AS pseudonym
  FROM ranked
  UNION ALL SELECT s.room_id, s.week, s.nickname, n.display FROM seen s JOIN names n USING (nickname))"""

REPLACED_SQL = MAP_SQL + """,
words AS (
  SELECT room_id, week, message_id, text, regexp_extract(text, '@(user_[0-9]+)', 1) AS nickname FROM msg),
replaced AS (
  SELECT w.message_id, w.room_id, w.week,
         CASE WHEN m.pseudonym IS NULL THEN w.text
              ELSE regexp_replace(w.text, w.nickname || '\\b', m.pseudonym) END AS text
  FROM words w LEFT JOIN map m USING (room_id, week, nickname))"""


@query("pseudonym_map", f"WITH {MAP_SQL} SELECT * FROM map")
def pseudonym_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(spark, sf_dir)


@query("public_exemptions", f"""
WITH {MAP_SQL}
SELECT s.room_id, s.week, s.nickname, {STAMP_SQL.format('first_ts')} AS first_ts, n.display
FROM seen s LEFT JOIN names n USING (nickname)""")
def public_exemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = privacy.first_seen(_weekly(spark, sf_dir), ROOM_WEEK)
    return privacy.public_name_exemption(seen, derive.public_names(spark)).select(
        *ROOM_WEEK, "nickname", stamp("first_ts").alias("first_ts"), "display"
    )


@query("pseudonym_lookup", f"""
WITH {MAP_SQL}
SELECT room_id, week, nickname, pseudonym FROM map WHERE pseudonym IN ('함께한 선생님C', '함께한 선생님AB')""")
def pseudonym_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _weekly(spark, sf_dir).select(
        *ROOM_WEEK, F.explode(F.array(F.lit("함께한 선생님C"), F.lit("함께한 선생님AB"))).alias("pseudonym")
    ).distinct()
    return privacy.resolve_pseudonym(_map(spark, sf_dir), wanted, ROOM_WEEK)


@query("nickname_lookup", f"""
WITH {MAP_SQL}, firsts AS (SELECT room_id, week, min(nickname) AS nickname FROM msg GROUP BY ALL)
SELECT room_id, week, nickname, pseudonym FROM map JOIN firsts USING (room_id, week, nickname)""")
def nickname_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _weekly(spark, sf_dir).groupBy(*ROOM_WEEK).agg(F.min("nickname").alias("nickname"))
    return privacy.resolve_nickname(_map(spark, sf_dir), wanted, ROOM_WEEK)


@query("pseudonymised_text", f"WITH {REPLACED_SQL} SELECT message_id, text FROM replaced")
def pseudonymised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.apply_pseudonyms(
        _weekly(spark, sf_dir), _map(spark, sf_dir), ROOM_WEEK, "message_id", "text"
    ).select("message_id", "text")


# A name as it stands in Korean text: bare, mentioned, with a particle, an honorific, or both.
_FORMS = (("@", ""), ("", "님이"), ("", "쌤이"), ("", "님께"), ("", "샘"), ("", "한테"), ("", "랑"), ("", "가"), ("(", ")"), ("", "선생님께서는"))
_NAMED_SQL = MAP_SQL + f""",
forms AS (SELECT message_id, room_id, week, nickname, {derive.sql_list(tuple(a for a, _ in _FORMS))}[message_id % {len(_FORMS)} + 1] AS head,
  {derive.sql_list(tuple(b for _, b in _FORMS))}[message_id % {len(_FORMS)} + 1] AS tail FROM msg)"""


@query("pseudonymised_names", f"""
WITH {_NAMED_SQL}
SELECT message_id, '오늘 ' || head || coalesce(pseudonym, CASE WHEN nickname LIKE '%7' THEN '꼬마 ' ELSE '' END || replace(nickname, 'user_', '민수'))
  || tail || ' 말했다' AS text
FROM forms LEFT JOIN map USING (room_id, week, nickname)""")
def pseudonymised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message speaks of its author in one of the usual forms; some names have two words."""
    def renamed(name: str) -> Column:
        own = F.regexp_replace(name, "user_", "민수")
        return F.when(F.col(name).endswith("7"), F.concat(F.lit("꼬마 "), own)).otherwise(own)

    form = F.element_at(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _FORMS]), (F.col("message_id") % len(_FORMS) + 1).cast("int"))
    rows = _weekly(spark, sf_dir).select(
        *ROOM_WEEK, "message_id", F.concat(F.lit("오늘 "), form["a"], renamed("nickname"), form["b"], F.lit(" 말했다")).alias("text"))
    mapping = _map(spark, sf_dir).withColumn("nickname", renamed("nickname"))
    return privacy.apply_pseudonyms(rows, mapping, ROOM_WEEK, "message_id", "text").select("message_id", "text")


@query("pseudonym_count", f"""
WITH {REPLACED_SQL}
SELECT message_id, len(list_distinct(regexp_extract_all(text, '(?:함께한 선생님|참여자)[A-Z]+')))::BIGINT AS n FROM replaced""")
def pseudonym_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = privacy.apply_pseudonyms(
        _weekly(spark, sf_dir), _map(spark, sf_dir), ROOM_WEEK, "message_id", "text"
    )
    return hidden.select("message_id", F.size(text.pseudonyms_in(F.col("text"))).cast("bigint").alias("n"))


@query("owner_pseudonyms", f"""
WITH {MAP_SQL} SELECT message_id, pseudonym AS owner FROM msg LEFT JOIN map USING (room_id, week, nickname)""")
def owner_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _weekly(spark, sf_dir).select(*ROOM_WEEK, "message_id", F.col("nickname").alias("owner"))
    return privacy.apply_owner_pseudonyms(items, _map(spark, sf_dir), ROOM_WEEK, "owner").select("message_id", "owner")


# --- scans of whole documents ----------------------------------------------------------------------
# RE2 has no look-around: a neighbour class stands in, which is equal for yes/no.

# The contract's patterns once more, in the dialect of the oracle, which has no look-around.
_D, _E = r"(?:^|[^0-9])", r"(?:[^0-9]|$)"
_START = r"(?:^|[\s(''\"])"
PHONE_CORE = r"(?:(?:\+?82[- .]?(?:0[- .]?)?)|0|\(0)(?:1[016789]|2|[3-6][1-5]|70|50[0-9])\)?[- .]?[0-9]{3,4}[- .]?[0-9]{4}"
RE2_PII = {
    "phone": _D + PHONE_CORE + _E,
    "international_phone": r"(?:^|[^\p{L}\p{N}_])\+[0-9]{1,3}[- .]?(?:\([0-9]{1,4}\)[- .]?|[0-9]{1,4}[- .]?)[0-9]{2,4}[- .]?[0-9]{3,4}(?:[^\p{L}\p{N}_]|$)",
    "service_phone": _D + r"1[0-9]{3}[- .]?[0-9]{4}" + _E,
    "email": r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+",
    "rrn": _D + r"[0-9]{6}-?[1-8][0-9]{6}" + _E,
    "url": r"(?i)(?:https?://|www\.)\S+",
    "github_token": r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,})\b",
    "slack_token": r"\bxox[baprs]-[A-Za-z0-9-]{10,}\b",
    "google_api_key": r"\bAIza[0-9A-Za-z_-]{30,}\b",
    "aws_access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "bearer_token": r"(?i)\bBearer\s+[A-Za-z0-9._~-]{16,}\b",
    "notion_token": r"\b(?:ntn_[A-Za-z0-9_-]{20,}|secret_[A-Za-z0-9_-]{20,})\b",
    "oauth_token": r"\bya29\.[A-Za-z0-9_-]{20,}\b",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b",
    "assigned_secret": r"(?i)\b(?:api[_-]?key|access[_-]?token|auth[_-]?token|client[_-]?secret|password)\s*[:=]\s*[''\"]?[A-Za-z0-9._~+/=-]{12,}",
    "bare_notion_share": r"(?i)(?:^|[^\p{L}\p{N}_.-])(?:www\.)?notion\.(?:so|site)/[^\s<>''\"]+",
    "share_token": r"(?i)\b(?:share|shared|invite)[/_?=&:-][A-Za-z0-9_-]{16,}\b",
    "uuid": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[1-8][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\b",
}
RE2_PATHS = {
    "mac_local_path": _START + r"/Users/[^\s)''\"]+",
    "linux_local_path": _START + r"/home/[^\s)''\"]+",
    "windows_local_path": r"\b[A-Za-z]:\\[^\s\"'']+",
    "windows_slash_path": r"\b[A-Za-z]:/[^\s\"'']+",
    "windows_unc_path": _START + r"(?:\\\\|//)[^\s)\"'']+",
    "tilde_local_path": _START + r"~[/\\][^\s)\"'']+",
    "relative_local_path": _START + r"(?:\.\.?/)[^\s)\"'']+",
    "sensitive_posix_path": _START + r"/(?:private|tmp|var|etc|mnt|Volumes)/[^\s)\"'']+",
    "private_output_path": _START + r"(?:output|inbox)/[^\s)''\"]+",
}
PERSON_SQL = (
    "regexp_matches(regexp_replace({0}, '가온쌤|다솜쌤|라온쌤|함께한 선생님[A-Z]+|선생님|관리자님|운영자님', '', 'g'), "
    "'[가-힣A-Za-z0-9_]{{2,20}}(?:님|쌤)')"
)


def kinds_sql(column: str, table: dict[str, str]) -> str:
    """A list of the kinds found in a column."""
    tests = ", ".join(f"CASE WHEN regexp_matches({column}, '{p}') THEN '{k}' END" for k, p in table.items())
    return f"list_filter([{tests}], lambda x: x IS NOT NULL)"


@query("pii_scan", f"""
WITH {DOC_SQL} SELECT doc_id, 'text' AS location, 'pii' AS rule, unnest({kinds_sql('text', RE2_PII)}) AS detail FROM doc""")
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.scan_pii(derive.documents(spark, sf_dir), "doc_id", ["text"])


@query("path_scan", f"""
WITH {DOC_SQL} SELECT doc_id, 'text' AS location, 'local_path' AS rule, unnest({kinds_sql('text', RE2_PATHS)}) AS detail FROM doc""")
def path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.scan_local_paths(derive.documents(spark, sf_dir), "doc_id", ["text"])


@query("person_names", f"""
WITH {DOC_SQL}
SELECT doc_id, 'text' AS location, 'person_name' AS rule, 'honorific' AS detail FROM doc WHERE {PERSON_SQL.format('text')}""")
def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.scan_person_names(derive.documents(spark, sf_dir), "doc_id", ["text"])


def _mask_sql(column: str) -> str:
    """Kinds with a neighbour class keep it, and run twice for neighbours they share."""
    for kind, pattern in RE2_PII.items():
        keep_head = pattern.startswith("(?:^|") or "(?:^|" in pattern[:10]
        p = pattern
        if keep_head:
            p = p.replace("(?:^|", "(^|", 1)
            tail = p.endswith("|$)")
            if tail:
                head, _, end = p.rpartition("(?:[^")
                p = head + "([^" + end
            swap = f"\\1[{kind}]" + ("\\2" if tail else "")
        else:
            swap = f"[{kind}]"
        for _ in range(2 if keep_head else 1):
            column = f"regexp_replace({column}, '{p}', '{swap}', 'g')"
    return column


@query("pii_masked", f"WITH {DOC_SQL} SELECT doc_id, md5({_mask_sql('text')}) AS digest FROM doc")
def pii_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = privacy.mask_texts(derive.documents(spark, sf_dir), ["text"])
    return masked.select("doc_id", F.md5("text").alias("digest"))


# --- names in running text ----------------------------------------------------------------------------

_TALK_SQL = """
talk AS (
  SELECT event_id, CASE event_id % 8 WHEN 0 THEN '가온 샘(운영)' WHEN 1 THEN '다솜쌤 (총무)' WHEN 2 THEN '라온지기쌤'
    WHEN 3 THEN '참여자' || chr((65 + user_id % 26)::INT) WHEN 4 THEN '민수' || user_id || '쌤(3반)' WHEN 5 THEN '영희샘'
    WHEN 6 THEN NULL ELSE '' END AS who, event_type FROM events)"""


def _talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id") % 8, F.col("user_id")
    who = (
        F.when(e == 0, "가온 샘(운영)").when(e == 1, "다솜쌤 (총무)").when(e == 2, "라온지기쌤")
        .when(e == 3, F.concat(F.lit("참여자"), F.char((u % 26 + 65).cast("bigint"))))
        .when(e == 4, F.concat(F.lit("민수"), u.cast("string"), F.lit("쌤(3반)"))).when(e == 5, "영희샘")
        .when(e == 6, F.lit(None)).otherwise("")
    )
    return derive.table(spark, sf_dir, "events").select("event_id", who.alias("who"), "event_type")


_PUBLIC_SQL = (
    "regexp_replace(regexp_replace(regexp_replace({0}, '가온\\s?[샘쌤](?:\\s*\\(운영\\))?', '가온쌤', 'g'), "
    "'다솜\\s?[샘쌤](?:\\s*\\(총무\\))?', '다솜쌤', 'g'), '라온\\s?(?:지기)?\\s?[샘쌤]', '라온쌤', 'g')"
)


@query("name_normalise", f"WITH {_TALK_SQL} SELECT event_id, {_PUBLIC_SQL.format('who')} AS name FROM talk")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _talk(spark, sf_dir).select("event_id", text.normalize_public_names(F.col("who")).alias("name"))


@query("honorifics_hidden", f"""
WITH {_TALK_SQL}, shown AS (SELECT event_id, event_type, {_PUBLIC_SQL.format('who')} AS who FROM talk)
SELECT event_id, CASE WHEN who IN ('가온쌤', '다솜쌤', '라온쌤') THEN who
    WHEN who LIKE '참여자%' THEN replace(who, '참여자', '함께한 선생님')
    WHEN who LIKE '민수%' OR who LIKE '영희%' THEN '함께한 선생님' ELSE coalesce(who, '') END || ' ' || event_type AS line
FROM shown""")
def honorifics_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = text.normalize_public_names(F.coalesce("who", F.lit("")))
    line = F.concat(who, F.lit(" "), F.col("event_type"))
    return _talk(spark, sf_dir).select("event_id", text.anonymize_honorifics(line).alias("line"))


@query("owner_normalise", f"""
WITH {_TALK_SQL}, shown AS (SELECT event_id, {_PUBLIC_SQL.format('who')} AS who FROM talk)
SELECT event_id, CASE WHEN who IN ('가온쌤', '다솜쌤', '라온쌤') THEN who
    WHEN who LIKE '참여자%' THEN replace(who, '참여자', '함께한 선생님') END AS owner FROM shown""")
def owner_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = text.normalize_public_names(F.col("who"))
    return _talk(spark, sf_dir).select("event_id", text.normalize_owner(who).alias("owner"))


@query("term_rename", """
SELECT event_id, replace(replace(replace(replace('현재 기간 ' || event_type || ', 직전 기간, 기간별 인원',
  '현재 기간', '금주'), '직전 기간', '전주'), '기간', '주'), '인원', '참여한 사람') AS line FROM events""")
def term_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("현재 기간 "), F.col("event_type"), F.lit(", 직전 기간, 기간별 인원"))
    return derive.table(spark, sf_dir, "events").select("event_id", text.rename_terms(line).alias("line"))
