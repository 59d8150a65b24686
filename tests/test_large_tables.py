"""Queries against their SQL on rows as only larger tables have them: long documents, ids of later revisions."""

import hashlib
import json

import duckdb
import pyarrow as pa
import pytest
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from chatloom.operators import privacy, recovery
from chatloom.operators.ranking import running_number
from chatloom.schemas import REPORT_PAGE
from chatloom.sources import documents as store
from chatloom.sources import html

LONG = "\n".join(f"{i} " + "가나다라 " * 20 for i in range(900))  # beyond the bytes and the nodes of a document
ROWS = [
    (3007, "short text\nsecond line"), (27009, "short text"), (14, "no violation at all"), (35, LONG), (57, "x@y.example\n" + LONG),
    (58, "mail x@y.example"), (3011, "x" * 9000), (80, "\n".join(["a"] * 101)), (6014, "plain\n님 words 12345"),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, text, "ko", "web", len(text)) for i, text in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", ["contract_violations", "report_recovered"])
def test_long_documents_and_late_revisions(spark, tables, name):
    folder, con = tables
    assert compare(spark, con, name, folder, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_sets_are_not_refused_for_what_they_hold(spark, tables):
    folder, con = tables
    name = "publish_cycle"
    assert compare(spark, con, name, folder, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_white_space_around_a_set_is_too_large(spark):
    large, small = '{"a":"' + "x" * 40 + '"}', '{"a":1}'
    texts = [large, large + "\n", large + " " * 20, small, small + " " * 13, small + " " * 14, small + "x" * 40]
    raw = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "doc_id long, content binary")
    found = {r.doc_id: r.verdict for r in store.parse_strict(raw, "content", 20, padding_only=True).collect()}
    assert [found[i] for i in range(7)] == ["ok", "ok", "too_large", "ok", "ok", "too_large", "not_strict_json"]


@pytest.mark.parametrize("name", ["contract_violations", "final_check", "publish_cycle", "report_items", "report_recovered"])
def test_texts_without_a_character(spark, tmp_path, name):
    texts = ["", " ", "\n", " \n\u00a0\n"]
    rows = [(i, texts[i % 4], "ko", "web", len(texts[i % 4])) for i in (30, 31, 32, 33, 37, 72, 73, 75, 77, 20, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, name, str(tmp_path), entry.queries()[name], entry.oracle_sql()[name]) is None


def test_hidden_names_push_no_text_beyond_its_limit(spark, tmp_path):
    # with the line that names a person, texts from one below the limit to one beyond it
    rows = [(i, "x" * n, "ko", "web", n) for i, n in zip((27, 70, 113, 156, 328, 371), range(2982, 2988), strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "report_recovered"
    assert compare(spark, con, name, str(tmp_path), entry.queries()[name], entry.oracle_sql()[name]) is None


def test_recovered_documents_are_written_from_typed_structs(spark):
    page = {"problem": None, "issue": "7호", "period": "2030.01.07 ~ 2030.01.13", "title": "x", "intro": None,
            "stats": {"메시지 수": 3, "스레드 수": 1, "기타": 5}, "topics": [("t", None)], "faq": [("q", "a", ["b", "a", "b"], None)],
            "unresolved": [], "tips": [("민수쌤 \u001f", "b", ["기타"], None)], "actions": [("action", "a", "가온쌤", None)]}
    docs = recovery.rebuild_publications(spark.createDataFrame([page], REPORT_PAGE).withColumn("doc_id", F.lit(1)), "2030-02-01T00:00:00Z")
    text = docs.first().document
    whole = json.loads(text)
    rest = {k: v for k, v in whole.items() if k != "content_sha256"}

    def canonical(value):
        return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))

    assert text == canonical(whole) and whole["content_sha256"] == hashlib.sha256(canonical(rest).encode()).hexdigest()
    assert whole["hook_title"] == "x" and whole["stats"] == {"메시지 수": 3, "스레드 수": 1, "질문 수": 1, "그중 해결된 수": 1}
    assert whole["tips"][0]["title"] == "함께한 선생님 \u001f" and whole["faq"][0]["tags"] == ["b", "a"]


def test_names_in_texts_are_joined_without_the_driver(spark):
    rows = spark.createDataFrame([("r", 1, "민수1이 말했다"), ("r", 2, "nobody")], "room_id string, message_id long, text string")
    mapping = spark.createDataFrame([("r", "민수1", "A")], "room_id string, nickname string, pseudonym string")
    hidden = privacy.apply_pseudonyms(rows, mapping, ["room_id"], "message_id", "text")
    assert sorted(tuple(r) for r in hidden.select("message_id", "text").collect()) == [(1, "A이 말했다"), (2, "nobody")]
    assert "Broadcast" not in hidden._jdf.queryExecution().optimizedPlan().toString() + hidden._jdf.queryExecution().sparkPlan().toString()


def test_running_numbers_are_joined_without_the_driver(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    numbered = running_number(rows, ["k"], F.floor(F.col("id") / 10), ["id"], "n")
    assert "Broadcast" not in numbered._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.k, r.n) for r in numbered.collect()) == sorted((i % 3, i // 3 + 1) for i in range(100))


def test_large_pages_are_parsed_in_slices():
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(40)), "html": ["x" * 100_000] * 39 + [None]})
    cut = list(html._slices(iter([batch, batch.slice(0, 0), batch.slice(3, 2)]), "html"))
    assert pa.Table.from_batches(cut).column("page_id").to_pylist() == [*range(40), 3, 4]
    assert max(b.num_rows for b in cut) <= 6
