"""5. Approximate nearest neighbours by a permutation index.

Every vector is represented by the order of its ``PREFIX`` nearest pivots and posted in the inverted file of each of
them. A query adds up footrule distances over the files of its own pivots, takes the best ``FRACTION`` of the rows by
footrule (with all ties), and ranks those by the exact distance. A share of the rows, not a number, keeps recall alike
at every size; on vectors without structure about a quarter of all rows is needed for 0.95.

The index is fitted on ``PIVOTS`` rows (the smallest hashes of their ids, a bounded sample) and holds every row, in
shards by hash of bounded size. Queries come in bounded blocks; a (shard, block) pair is one task's work, and every
query gets its best ``k`` of each shard.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do vectors of
another dimension than the pivots. Equal vectors are all candidates; ties go to the smaller id. Rows with one id count
once each as candidates; equal query rows ask once. A row without an id can be found, first among ties, but asks nothing. Without valid rows the result is empty, and with fewer rows than ``k`` all of them are found.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.registry import table
from chatloom.session import ship_package

PIVOTS = 64
#: Stands for a null id in tasks, whose columns would turn to floats by a null.
NO_ID = -(2**63)
PREFIX = 32
FRACTION = 0.35
SHARD_ROWS, BLOCK_ROWS = 8_192, 2_048
_CHUNK = 128


def valid(vector: Column) -> Column:
    """Non-null, non-empty, finite and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """The pivots' vectors: a bounded sample by hash of the id."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    if not chosen:
        return np.zeros((0, 0))
    size = pd.Series([len(r["vector"]) for r in chosen]).mode().iloc[0]
    return np.array([r["vector"] for r in chosen if len(r["vector"]) == size], np.float64)


def ranks(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Place of every pivot in each vector's order, ``prefix`` for those beyond it."""
    distance = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    order = np.argsort(distance, axis=1, kind="stable")
    place = np.empty(order.shape, np.int16)
    np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return np.minimum(place, prefix)


class InvertedFiles:
    """The permutation index of one shard."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        place = ranks(vectors, pivots, prefix)
        self.prefix, self.rows = prefix, len(vectors)
        self.files = [(at := np.flatnonzero(place[:, p] < prefix), place[at, p]) for p in range(len(pivots))]
        self.alone = (prefix - place).sum(axis=1, dtype=np.int32)

    def footrule(self, queries: np.ndarray) -> np.ndarray:
        """Footrule distance of each query's ranks to every row, from the files of the query's pivots."""
        total = (self.prefix - queries).sum(axis=1, dtype=np.int32)[:, None] + self.alone[None, :]
        for p, (rows, place) in enumerate(self.files):
            asking = np.flatnonzero(queries[:, p] < self.prefix)
            own = queries[asking, p].astype(np.int32)[:, None]
            total[np.ix_(asking, rows)] += np.abs(own - place) - (self.prefix - own) - (self.prefix - place)
        return total


def search(
    queries: DataFrame, rows: DataFrame, k: int = 10, pivots: int = PIVOTS, prefix: int = PREFIX, fraction: float = FRACTION,
    vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for every query but the query's own id."""
    ship_package(rows.sparkSession)
    narrow = lambda df: df.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).filter(valid(F.col("vector")))
    # a query counts once for each of its vectors, however often its row occurs; a null id can be found, but asks nothing
    rows, queries = narrow(rows), narrow(queries).filter(F.col("vec_id") != NO_ID).dropDuplicates(["vec_id", "vector"])
    chosen = fit_pivots(rows, pivots)
    prefix = min(prefix, max(1, len(chosen) // 2))
    shards, blocks = max(1, math.ceil(rows.count() / shard_rows)), max(1, math.ceil(queries.count() / block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    index = rows.filter(F.size("vector") == chosen.shape[1]).select(part(shards).alias("shard"), every(blocks).alias("block"), "vec_id", "vector")
    asked = queries.filter(F.size("vector") == chosen.shape[1]).select(every(shards).alias("shard"), part(blocks).alias("block"), "vec_id", "vector")

    def best(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(asked):
            order = np.argsort(index["vec_id"].to_numpy(), kind="stable")
            ids, vectors = index["vec_id"].to_numpy()[order], np.stack(index["vector"].to_numpy())[order]
            files = InvertedFiles(vectors, chosen, prefix)
            share = max(1, min(len(ids), math.ceil(fraction * len(ids)) + k))
            for at in range(0, len(asked), _CHUNK):
                own = asked.iloc[at:at + _CHUNK]
                wanted = np.stack(own["vector"].to_numpy())
                distance = files.footrule(ranks(wanted, chosen, prefix))
                limit = np.partition(distance, share - 1, axis=1)[:, share - 1]
                for i, query_id in enumerate(own["vec_id"].tolist()):
                    near = np.flatnonzero((distance[i] <= limit[i]) & (ids != query_id))
                    score = np.sqrt(((vectors[near] - wanted[i]) ** 2).sum(axis=1))
                    top = np.lexsort((ids[near], score))[:k]
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near[top]], "score": score[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    pair = ["shard", "block"]
    found = index.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInPandas(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


QUERY = "op5_ann"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows.filter("vec_id % 100 = 0"), rows)
