"""From raw documents to training text: five stages, each over all that its predecessor kept.

Cases: a row with a null or empty text is scored as a text without words; unless that score rejects it, it passes all
stages, as it links with nothing, holds no words and no secrets, and has no tokens. Rows are told apart by id and text: a null id is judged by its text like any other,
and of equal rows one stays. Very long texts are judged whole in every stage. An empty table gives an empty result.
Without labels of both classes nothing is rejected as toxic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import decontamination, jaccard_join, secrets, sentencepiece, toxicity
from chatloom.llm.graph import staged
from chatloom.llm.registry import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones of the corpus, does not reject."""
    model = toxicity.fit(table(spark, sf_dir, "documents").filter(~toxicity.held_out()), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, or one without if none has an id."""
    return jaccard_join.drop_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in the place of every reported secret."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, per document."""
    return sentencepiece.digests(docs.select("doc_id", "lang", "source", "text"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

#: SQL can express neither the network nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
