"""Evidence of typed sets is that of their variants, and its rules take the block apart once."""

import pytest
from pyspark.sql import functions as F

from chatloom.functions import canonical
from chatloom.operators import projection
from chatloom.plans import derive

SF_DIR = "/root/testdata/sf0.001"


def test_typed_sets_get_the_evidence_of_their_variants(spark):
    typed = derive.evidenced(spark, SF_DIR).select("doc_id", "document", F.to_json("final").alias("final"))
    finals = derive.finals(spark, SF_DIR)
    plain = projection.build_evidence(finals, F.col("start"), F.col("end"), F.col("text"), "anon").select("doc_id", "document", F.to_json("final").alias("final"))
    assert typed.count() > 0 and typed.exceptAll(plain).count() == plain.exceptAll(typed).count() == 0
    assert typed.filter("document <> final").count() == 0


def test_unsorted_sets_are_refused(spark):
    rows = spark.range(1).select(F.struct(F.lit(1).alias("b"), F.lit(2).alias("a")).alias("final"))
    day = F.lit("2024-01-01").cast("date")
    with pytest.raises(ValueError):
        projection.build_evidence(rows, day, day, F.lit("x"), "anon")


def test_text_of_members_is_that_of_the_object(spark):
    texts = ['{}', '{"b":1,"a":null}', '{"\\u000b\\"\\\\":"\\u001f/","é":[{"z":1.50,"y":"😀"}]}', '[1]', '"x"', None]
    rows = spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("final"))
    told = rows.select(
        canonical.members_json(projection._payload_members()).alias("a"), canonical.canonical_json(projection.payload()).alias("b")).collect()
    assert [r.a for r in told] == [r.b for r in told] and told[2].a == '{"\\u000b\\"\\\\":"\\u001f/","é":[{"y":"😀","z":1.5}]}'


def test_types_of_evidence_members_count(spark):
    """A text is no flag, a number no version, an object no digest."""
    good = {"evidence_version": "1", "stage": '"A6"', "consent_mode": '"anon"', "pii_scan_passed": "true", "nickname_policy_passed": "true",
            "source_sha256": '"' + "a" * 64 + '"', "payload_sha256": '"' + "b" * 64 + '"', "period_start": '"2024-01-01"', "period_end": '"2024-01-07"'}
    cases = {
        "pii_scan_passed": ('"true"', "pii_scan"), "nickname_policy_passed": ("1", "nickname_policy"), "evidence_version": ('"1"', "provenance"),
        "stage": ("null", "provenance"), "source_sha256": ('{"a":1}', "source_digest"), "consent_mode": ("[]", "mode"), "period_end": ("20240107", "period_end")}
    rows = [(name, "{" + ",".join(f'"{k}":{cases[name][0] if k == name else v}' for k, v in good.items()) + "}") for name in cases]
    rows += [("none", "null"), ("list", "[]")]
    finals = spark.createDataFrame(rows, "doc_id string, e string").select(
        "doc_id", F.parse_json(F.concat(F.lit('{"period_start":"2024-01-01","period_end":"2024-01-07","privacy_evidence":'), "e", F.lit("}"))).alias("final"))
    found = {}
    for r in projection.verify_evidence(finals, "anon").collect():
        found.setdefault(r.doc_id, set()).add(r.rule)
    assert found == {**{n: {rule, "payload_mismatch"} for n, (_, rule) in cases.items()}, "none": {"evidence_missing"}, "list": {"evidence_missing"}}
