"""Each stage of the pipeline against a plain computation on its own input."""

import hashlib

import pytest
import sentencepiece as spm
from pyspark.sql import functions as F
from test_corpora import brute_components

import corpus_pipeline
from chatloom.llm import decontamination, sentencepiece, toxicity
from chatloom.llm.graph import staged
from chatloom.llm.registry import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[1:-1])


def test_toxic_documents_go(spark, steps):
    model = toxicity.fit(steps[0].filter(~toxicity.held_out()), table(spark, SF, "labels"))
    rows = steps[0].select("doc_id", "text").toPandas()
    import pyarrow as pa

    score = model.score(pa.array(rows["text"], pa.string())) if model else rows["doc_id"] * 0.0
    assert ids(steps[1]) == set(rows.doc_id[score < toxicity.THRESHOLD])


def test_one_of_each_group_stays(steps):
    roots = brute_components([(r.doc_id, r.text) for r in steps[1].collect()])
    assert ids(steps[2]) == {i for i, (_, root) in roots.items() if i == root}


def test_contaminated_documents_go(spark, steps):
    judged = decontamination._judged(steps[2], table(spark, SF, "benchmark"), 13, "doc_id", "text")
    assert ids(steps[3]) == ids(steps[2]) - {r.doc_id for r in judged.collect() if r.n_hit and 20 * r.n_hit >= r.n_words}


def test_secrets_are_masked(steps):
    assert ids(steps[4]) == ids(steps[3])
    assert steps[4].filter(F.col("text").rlike("AKIA[A-Z0-9]{12}|[0-9a-f]{32}")).count() == 0
    assert steps[4].filter("n_chars <> length(text)").count() == 0


def test_encoding(steps):
    library = spm.SentencePieceProcessor(model_proto=sentencepiece.model_bytes())
    want = {r.doc_id: hashlib.sha256(",".join(map(str, library.encode(r.text))).encode()).hexdigest() for r in steps[4].collect()}
    assert {r.doc_id: r.ids_sha256 for r in steps[5].collect()} == want


def test_run(spark, steps):
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, steps[5].select(steps[5].columns).collect()))
