import pytest

from chatloom.llm.registry import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    rows = [
        (1, None, "x", 1.5), (2, "", "x", None), (3, " \t\n", None, 1.0), (4, "one", "x", 0.0), (5, "a b c d", "x", 2.0),
        (6, "The quick brown Fox jumps over the lazy dog " * 6, "x", 2.0), (7, "the quick brown fox jumps over the lazy dog " * 6, "y", 2.0),
        (8, "ÄÖ é 日本 \U0001f600 word", "x", 3.0), (9, "lorem ipsum " * 40_000, "z", 3.0), (10, "x" * 5_000, "z", 3.0),
        (11, "a b c d", "x", 2.0), (11, "a b c d", "x", 2.0), (None, "no id at all", "x", 2.0), (None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, score double")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def small(spark):
    return {name: table(spark, SMALL, name) for name in ("documents", "benchmark", "labels", "embeddings", "conversations")}
