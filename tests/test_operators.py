import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.operators import contract, kb, messages, privacy, projection, publish, recovery
from chatloom.operators.ranking import range_number, running_number
from chatloom.operators.vector_search import build_index, knn, search_index
from chatloom.plans import derive
from chatloom.session import scratch_dir
from chatloom.sources import chat, documents as store, html
from chatloom.streaming import jobs

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)
MSG = ("room_id string, message_id bigint, ts timestamp, nickname string, text string, is_system boolean, "
       "src string, links array<string>, reply_to string, native_id string")


def message(i, seconds, room="r", nick="n", text="t", src="csv", native=None):
    return (room, i, T0 + dt.timedelta(seconds=seconds), nick, text, False, src, [], None, native)


def test_merge_is_idempotent_and_whole_under_a_hot_key(spark):
    copies = [message(i, 0.5, text="same") for i in range(3000)]
    rows = spark.createDataFrame(copies + [message(9000 + i, i * 60, text=f"x{i}") for i in range(50)], MSG)
    once = messages.merge_messages(rows)
    again = messages.merge_messages(once.drop("dedup_key"))
    key = lambda df: sorted((r.dedup_key, r.message_id) for r in df.collect())
    assert key(once) == key(again) and once.count() == 51


def test_source_rank_and_native_ids(spark):
    rows = spark.createDataFrame([
        message(1, 5.9, src="txt"), message(2, 5.1, src="csv"), message(3, 5.0, src="db"),
        message(4, 0, native="7", src="txt"), message(5, 99, native="7", text="edited", src="db"),
    ], MSG)
    assert sorted(r.message_id for r in messages.merge_messages(rows).collect()) == [3, 5]


def test_threads_against_plain_python(spark):
    rnd = random.Random(3)
    rows = [message(i, rnd.choice([rnd.uniform(0, 40000), 1800 * rnd.randrange(20)]), room=rnd.choice("ab")) for i in range(400)]
    got = {r.message_id: r.thread_id for r in messages.split_threads(spark.createDataFrame(rows, MSG)).collect()}
    want = {}
    for room in "ab":
        n, last = 0, None
        for r in sorted((r for r in rows if r[0] == room), key=lambda r: r[2]):
            n += last is None or r[2] - last > dt.timedelta(minutes=30)
            last = r[2]
            want[r[1]] = f"{room}-{n:06d}"
    assert got == want


def test_running_number_equals_row_number(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 5000).alias("v"))
    got = running_number(rows, ["k"], F.floor(F.col("v") / 100), ["v"], "n").collect()
    for k in range(3):
        values = sorted((r.v, r.n) for r in got if r.k == k)
        assert [n for _, n in values] == list(range(1, len(values) + 1))


def test_pseudonyms_replace_whole_names_longest_first(spark):
    rows = spark.createDataFrame([("r", 1, "하늘 바다님, user_1과 user_12가 user_123"), ("r", 2, "아무도 없음")], "room_id string, id bigint, text string")
    mapping = spark.createDataFrame(
        [("r", "user_1", "A"), ("r", "user_12", "B"), ("r", "하늘 바다", "C"), ("q", "user_123", "Z")],
        "room_id string, nickname string, pseudonym string")
    got = {r.id: r.text for r in privacy.apply_pseudonyms(rows, mapping, ["room_id"], "id", "text").collect()}
    assert got == {1: "C님, A과 B가 user_123", 2: "아무도 없음"}


@pytest.mark.parametrize("text, want", [
    ("민수가 왔다", "A가 왔다"), ("민수정이 왔다", "민수정이 왔다"), ("김민수와 민수", "김민수와 A"), ("민수네 집", "A네 집"), ("@민수님께서는", "@A님께서는"),
    ("민수에게도, 민수.", "A에게도, A."), ("수민수정과 민수야", "수민수정과 A야"), ("민수쌤하고", "A쌤하고"), ("민수x", "민수x"),
])
def test_names_within_other_names_stay(spark, text, want):
    rows = spark.createDataFrame([("r", 1, text + " 그리고 민수")], "room_id string, id bigint, text string")
    mapping = spark.createDataFrame([("r", "민수", "A")], "room_id string, nickname string, pseudonym string")
    assert privacy.apply_pseudonyms(rows, mapping, ["room_id"], "id", "text").first().text == want + " 그리고 A"


def test_chunks_never_mix_rooms(spark):
    rows = spark.createDataFrame([(f"r{i % 2}", i, None, None, f"t{i}") for i in range(30)], "room_id string, message_id bigint, ts timestamp, thread_id string, text string")
    for slice_ in (None, F.lit(1)):
        got = kb.chat_chunks(rows, ["room_id", "thread_id"], slice_, ["ts", "message_id"], "message_id", 4).collect()
        assert len(got) == 8 and all({int(t[1:]) % 2 for t in r.text.split("\n")} == {int(r.room_id[1])} for r in got)


def test_range_numbers_of_one_big_group_come_from_several_tasks(spark):
    rows = spark.range(200_000).select(F.lit("r").alias("room"), F.lit(None).cast("timestamp").alias("ts"), ((F.col("id") * 7919) % 200_000).alias("v"))
    got = range_number(rows, ["room"], ["ts", "v"], "n", 6)
    assert got.columns == ["room", "ts", "v", "n"] and got.filter("n <> v + 1").count() == 0 and got.count() == 200_000
    ties = range_number(rows.withColumn("v", F.lit(0)), ["room"], ["ts", "v"], "n", 6)
    assert ties.agg(F.count_distinct("n"), F.max("n")).first()[:] == (200_000, 200_000)


@pytest.mark.parametrize("block_rows", [1000, 3])
def test_knn_both_ways_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    chunks, queries = rng.normal(size=(200, 8)), rng.normal(size=(7, 8))
    frame = lambda m, n: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{n} bigint, embedding array<double>")
    got = knn(frame(queries, "query_id"), frame(chunks, "chunk_id").repartition(5), 4, block_rows=block_rows, shard_rows=30)
    sim = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ (chunks / np.linalg.norm(chunks, axis=1, keepdims=True)).T
    want = {(q, int(c), p + 1) for q in range(7) for p, c in enumerate(np.argsort(-sim[q])[:4])}
    assert {(r.query_id, r.chunk_id, r.position) for r in got.collect()} == want


def _vectors(spark, m, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{name} bigint, embedding array<double>")


def test_index_prunes_clustered_vectors_and_stays_exact(spark, tmp_path):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    chunks = centres[rng.integers(0, 40, 3_000)] + 0.05 * rng.normal(size=(3_000, 16))
    chunks[::500] = chunks[1]  # ties
    chunks[7] = 0  # no direction
    queries = np.vstack([centres[:12] + 0.05 * rng.normal(size=(12, 16)), chunks[1:2], -chunks[2:3]])
    index = build_index(_vectors(spark, chunks, "chunk_id"), str(tmp_path / "index"), 16, clusters=40)
    got = search_index(index, _vectors(spark, queries, "query_id"), 5, shard_rows=50).collect()
    norm = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    sim = norm(queries) @ norm(chunks).T
    want = {(q, int(c), p + 1) for q in range(len(queries)) for p, c in enumerate(np.argsort(-sim[q].round(12), kind="stable")[:5])}
    assert {(r.query_id, r.chunk_id, r.position) for r in got} == want
    compared = {r.query_id: r.compared for r in got}
    assert sum(compared[q] for q in range(12)) < 0.2 * 12 * 3_000
    again = search_index(index, _vectors(spark, queries[3:4], "query_id"), 2).collect()  # the index is there to be used again
    assert [r.chunk_id for r in sorted(again, key=lambda r: r.position)] == [c for q, c, p in sorted(want, key=lambda w: w[2]) if q == 3][:2]


def test_index_of_nothing_little_and_one_place(spark):
    queries = _vectors(spark, [[1.0, 0.0], [0.0, 0.0]], "query_id")
    none = _vectors(spark, [[1.0, 1.0]], "chunk_id").filter("false")
    assert knn(queries, none, 3).collect() == []
    few = _vectors(spark, [[0.0, 1.0], [0.0, 0.0], [2.0, 0.0]], "chunk_id")
    got = sorted((r.query_id, r.position, r.chunk_id) for r in knn(queries, few, 5).collect())
    assert got == [(0, 1, 2), (0, 2, 0), (0, 3, 1), (1, 1, 0), (1, 2, 1), (1, 3, 2)]
    same = _vectors(spark, [[3.0, 4.0]] * 500, "chunk_id")
    assert [r.chunk_id for r in sorted(knn(queries.filter("query_id = 0"), same, 3, shard_rows=20).collect(), key=lambda r: r.position)] == [0, 1, 2]


def test_valid_document_and_its_violations(spark):
    final = """{"period_id":"p","report":{"hook_title":" 어떻게? ","intro":"소개","sections":{"stats":{"메시지 수":3},
      "topics":[{"topic":"a","why":"b","source_thread_ids":["x"]}],"unresolved":[{"question":"q","source_message_ids":[1]}]},
      "local_path":"/private/x"},"faq":[{"id":"f","question":"q","answer":"a","tags":["t"],"practical_tip":null}],
      "tips":[],"actions":[{"type":"action","text":"t","owner_nickname":"함께한 선생님A, 가온쌤","due":"2024-01-05"}]}"""
    rows = spark.createDataFrame([("d", final)], "doc_id string, j string").select(
        "doc_id", F.parse_json("j").alias("final"), F.lit("2024-01-01").cast("date").alias("start"),
        F.lit("2025-01-02").cast("date").alias("end"), F.lit(7).alias("issue"), F.lit("2024-01-08T00:00:00Z").alias("generated_at"))
    built = projection.build_evidence(rows, F.col("start"), F.col("end"), F.lit("source"), "anon")
    assert projection.check_final(built, "anon", F.col("start"), F.col("end")).collect() == []
    assert [r.rule for r in projection.check_final(built, "named").collect()] == ["mode_drift"]
    docs = projection.project_publication(built, "anon")
    assert contract.validate_publications(docs).collect() == []
    assert projection.counts_preserved(docs).collect() == []
    doc = docs.select(F.to_json("doc").alias("j")).first().j
    assert '"label":"2024.01.01 - 2025.01.02"' in doc and "source_" not in doc.replace("source_ids_stripped", "") and "local_path" not in doc
    edited = F.regexp_replace(F.to_json("doc"), '"tags":\\["t"\\]', '"tags":["t","t",1]')
    bad = projection.seal(docs.withColumn("doc", F.parse_json(edited)))
    assert {(r.location, r.rule) for r in contract.validate_publications(bad.select("doc_id", "doc")).collect()} == {
        ("$.faq[0].tags", "unique_items"), ("$.faq[0].tags[2]", "type")}


def test_non_object_and_too_deep_documents_are_refused(spark):
    rows = spark.createDataFrame([(1, "[1]"), (2, "[" * 40 + "]" * 40)], "doc_id bigint, j string")
    found = contract.validate_publications(rows.select("doc_id", F.parse_json("j").alias("doc"))).collect()
    assert {(r.doc_id, r.rule) for r in found} >= {(1, "type"), (2, "type"), (2, "depth_limit")}


def test_store_rerun_is_a_noop(spark):
    target = scratch_dir(spark, "t")
    docs = spark.createDataFrame(
        [(f"insight-2024010{i}-2024011{i}", f"h{i}", "{}") for i in range(1, 6)], "content_id string, content_sha256 string, document string")
    status = lambda df: {r.status for r in df.collect()}
    assert status(store.write_publications_if_changed(docs, target)) == {"created"}
    assert status(store.write_publications_if_changed(docs, target)) == {"unchanged"}
    part = docs.limit(2).withColumn("content_sha256", F.lit("new"))
    assert status(store.write_publications_if_changed(part, target)) == {"updated"}
    assert store.read_publications(spark, target).count() == 5


def test_strict_files(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"a":1}')
    (tmp_path / "b.json").write_bytes(b'{"a":1,"a":1}')
    got = {r.doc_id.rsplit("/", 1)[1]: r.verdict for r in store.read_json_strict(spark, str(tmp_path)).collect()}
    assert got == {"a.json": "ok", "b.json": "not_strict_json"}
    assert {r.name for r in chat.list_files(spark, str(tmp_path)).collect()} == {"a.json", "b.json"}


def test_csv_quotes_lines_and_corrupt_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('Date,User,Message\n2024-01-01 10:00:00,a,"two\nlines, ""quoted"""\nbroken\n', encoding="utf-8")
    rows = chat.read_chat_csv(spark, str(tmp_path)).collect()
    assert rows[0].Message == 'two\nlines, "quoted"' and rows[1]._corrupt is not None


def test_page_chunks_keep_all_text_and_headings(spark):
    page = "<title>t</title><h1>A</h1><p>one <b>two</b><br>three<script>no()</script><h2>B</h2><ul><li>x &amp; y</ul><h1>C</h1>tail"
    pages = spark.createDataFrame([(1, "u", page), (2, "v", "<p>" + "z" * 25)], "page_id bigint, url string, html string")
    got = sorted((r.page_id, r.block, r.piece, r.heading_path, r.text) for r in kb.chunk_pages(pages, 10).collect())
    joined = {}
    for p, b, _, h, t in got:
        joined.setdefault((p, b, h), []).append(t)
    assert {k: "".join(v) for k, v in joined.items()} == {
        (1, 0, ""): "t", (1, 1, "A"): "one two three", (1, 2, "A > B"): "x & y", (1, 3, "C"): "tail", (2, 0, ""): "z" * 25}


def test_recovered_report_is_valid(spark):
    page = """<header class="masthead"><p class="issue">3호</p><p class="period">2024.12.30 ~ 2025.01.05</p><h1>민수쌤의 질문</h1>
      <p class="intro">안내</p></header><section id="topics"><ol class="topics"><li><h3>a</h3></li></ol></section>
      <section id="solved"><article class="qa"><h3 class="q">q</h3><div class="a">a</div></article></section><section id="open"></section>
      <section id="tips"></section><section id="actions"><ul class="act-list"><li><p class="act">x</p><p class="meta"><span>참여자B</span></p></li></ul></section>"""
    found = html.extract_report_html(spark.createDataFrame([(1, page), (2, "<p>")], "doc_id bigint, html string"))
    docs = recovery.recover_publications(found, "2025-01-06T00:00:00Z").cache()
    good = docs.filter("problem is null")
    assert contract.validate_publications(good.select("doc_id", "doc")).collect() == []
    body = good.select(F.to_json("doc").alias("j")).first().j
    assert '"owner":"함께한 선생님B"' in body and '"hook_title":"함께한 선생님의 질문"' in body and "2024.12.30 - 2025.01.05" in body
    assert docs.filter("doc_id = 2").first().problem.startswith("missing")


def test_unknown_duplicate_check(spark):
    with pytest.raises(ValueError):
        publish.skip_published(spark.range(1), spark.range(1), "none")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    first, second = tmp_path / "in", scratch_dir(spark, "late")
    for i, seconds in enumerate([7200 * 5, 0]):
        chat.write_messages_jsonl(spark.createDataFrame([message(i, seconds)], MSG), str(first / str(i)))
        stream = jobs.stream_dedup(jobs.stream_messages(spark, str(first / "*")))
        query = (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{second}/c")
                 .format("parquet").start(f"{second}/o"))
        query.awaitTermination()
        dropped = sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1
    assert [r.message_id for r in spark.read.parquet(f"{second}/o").collect()] == [0]


def test_batch_and_stream_threads_agree(spark):
    rows = derive.messages(spark, SF)
    newest = rows.agg(F.max("ts")).first()[0]
    closed = messages.threads(rows).filter(jobs.closed_before(F.col("end_ts"), F.lit(newest)))
    live = derive.as_messages(jobs.stream_messages(spark, SF, "parquet", derive.EVENT_SCHEMA, pathGlobFilter="events.parquet"))
    streamed = jobs.run_to_table(jobs.stream_threads(live), "t")
    key = lambda df: sorted((r.room_id, r.start_ts, r.end_ts, r.n_messages) for r in df.collect())
    assert key(closed) == key(streamed) != []
