"""Lists that break no rule are told without walking their nodes; all others are walked as ever."""

import json

from pyspark.sql import functions as F

from chatloom.operators import contract, projection

_TIP = {"id": "x", "title": "t", "body": "b", "feature_tags": ["a"], "practical_tip": None, "source_message_ids": [1]}
_FAQ = {"question": "q", "answer": "a", "tags": ["t"], "practical_tip": "p"}
_ACTION = {"type": "action", "text": "t", "owner_nickname": None, "due": None}


def _sets():
    def tip(**changes):
        return {**_TIP, **changes}

    short = {k: v for k, v in _TIP.items() if k != "body"}
    tips = [
        [_TIP], [_TIP] * 3, [tip(practical_tip="p"), _TIP], [tip(extra=True, more=["x", None])],          # plain
        [], None, "x", {}, [None], [3], [_TIP, None], [_TIP, short], [_TIP, tip(title=None)], [tip(title="")], [tip(title=" 　")],
        [tip(title=7)], [tip(title=7), _TIP], [tip(practical_tip=7)], [tip(feature_tags=None), _TIP], [tip(feature_tags=["a", ""])],
        [tip(feature_tags=["a", None])], [tip(feature_tags=[1])], [tip(feature_tags="a")], [tip(feature_tags=[])], [tip(body={"title": "x"})],
        [{"title: STRING, body": "x", "body": "b"}], [[_TIP]], [tip(extra={"title": 1})], [tip(extra=1.5)], [tip(**{"제목": "x"})],
    ]
    report = {"intro": "i", "hook_title": None, "sections": {"topics": [], "stats": {}}}
    sets = [{"report": report, "tips": t, "faq": [_FAQ], "actions": [_ACTION], "privacy_evidence": {"stage": "A6"}} for t in tips]
    return [*sets, {"report": report}, {"tips": [_TIP]}, {"report": report, "faq": [{**_FAQ, "answer": " "}], "actions": [{**_ACTION, "due": 3}]},
            {"report": report, "tips[]": 3, "tips[].title": 3}, [], [_TIP], "x", 7, None]


def _finals(spark):
    rows = [(i, json.dumps(s, ensure_ascii=False)) for i, s in enumerate(_sets())] + [(1000, None)]
    return spark.createDataFrame(rows, "doc_id long, j string").select("doc_id", F.parse_json("j").alias("final"))


def test_plain_lists_are_told_apart(spark):
    plain = {r.doc_id: sorted(r.plain) for r in _finals(spark).select("doc_id", projection._plain_lists().alias("plain")).collect()}
    assert all(plain[i] == ["actions", "faq", "tips"] for i in range(4))
    assert [i for i in range(4, 30) if "tips" in plain[i]] == []
    assert plain[32] == [] and plain[1000] == []


def test_pruned_sets_break_the_same_rules(spark):
    finals = _finals(spark)
    whole = contract.check_shape(contract.walk_documents(finals.select("doc_id", F.col("final").alias("doc"))), projection.FINAL_RULES)
    want = sorted(tuple(r) for r in whole.collect())
    got = sorted(tuple(r) for r in projection.check_final(finals, "anon").filter("location <> '$.privacy_evidence'").collect())
    assert len(want) > 30 and got == want


def test_nodes_of_plain_lists_are_not_walked(spark):
    told = _finals(spark).select("doc_id", "final", projection._plain_lists().alias("plain"))
    nodes = contract.walk_documents(told.select("doc_id", projection._doubtful().alias("doc")))
    assert {r.path for r in nodes.filter("doc_id = 1").collect()} == {
        "$", "$.report", "$.report.intro", "$.report.hook_title", "$.report.sections", "$.report.sections.topics", "$.report.sections.stats"}
