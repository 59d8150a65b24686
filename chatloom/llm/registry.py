"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Module of each operator's query, in the order of their numbers.
MODULES = (
    "sentencepiece", "lm_scoring", "decontamination", "secrets", "ann",
    "language_id", "jaccard_join", "substring_dedup", "toxicity", "chat_format",
    "word_bpe", "structure_repair", "source_audit",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for name in MODULES:
        module = import_module(f"chatloom.llm.{name}")
        queries[module.QUERY] = module.query
        if module.ORACLE_SQL:
            oracles[module.QUERY] = module.ORACLE_SQL
    return queries, oracles
