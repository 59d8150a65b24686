"""Exact nearest neighbours by cosine, over an index that prunes.

Chunks are put into coarse clusters of their unit vectors. A cluster has a centre and a radius, so by the triangle
inequality no row of it is nearer to a query than the distance to the centre less the radius. Every query first meets
the clusters nearest to it, which gives it k rows; after that only clusters whose bound can reach the k-th of them.
The rest of the index is neither compared nor read, and the result is exact all the same.

Clusters are fitted on a bounded sample; every row is indexed. A cluster with many rows is split into shards by a hash
of the ids, queries into blocks; each (shard, block) is one task's work of bounded size and keeps its best k. There is
one way for every number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.session import scratch_dir

SHARD_ROWS, BLOCK_ROWS = 20_000, 2_000
#: Clusters at most, rows and bytes of the sample they are fitted on, rounds of fitting.
MOST_CLUSTERS, SAMPLE_PER_CLUSTER, SAMPLE_BYTES, ROUNDS = 1_024, 32, 64 << 20, 8
#: Similarities that differ by less may be rounding: a bound must miss the k-th by more.
SLACK = 1e-7
#: The cluster of vectors without a direction, whose similarity to everything is 0.
NOWHERE = -1
_COLUMNS, _ROWS = 2_000, 250


def usable(vector: Column, size: int | None = None) -> Column:
    """A vector of finite numbers (of one size)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0) & (F.size(vector) == size if size else F.lit(True)), F.lit(False))


def vector_rejects(rows: DataFrame, id_col: str, vector: str, size: int) -> DataFrame:
    """Rows that no search finds: their vector is missing, of another size or not finite."""
    v = F.col(vector)
    reason = F.when(v.isNull(), "missing").when(F.size(v) != size, "size").when(~usable(v, size), "not_finite")
    return rows.select(id_col, reason.alias("reason")).filter(F.col("reason").isNotNull())


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype(np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _centres(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Centres of unit vectors by Lloyd's rounds from evenly spaced rows; the same for the same sample."""
    centres = sample[np.linspace(0, len(sample) - 1, min(clusters, len(sample))).astype(int)]
    centres = np.unique(centres, axis=0)
    for _ in range(ROUNDS):
        nearest = (sample @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        centres = np.where(counts[:, None] > 0, total / np.maximum(counts, 1)[:, None], centres)
    return centres


def _distances(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (unit**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * unit @ centres.T
    return np.sqrt(np.maximum(squares, 0))


@dataclass(frozen=True)
class VectorIndex:
    """Chunks by cluster at ``path``, and what queries need to know of the clusters: at most MOST_CLUSTERS rows."""

    path: str
    columns: str
    chunk_id: str
    extra: tuple[str, ...]
    size: int
    centres: np.ndarray
    rows: dict[int, int]
    radius: dict[int, float]

    def chunks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def build_index(
    chunks: DataFrame, path: str, size: int, chunk_id: str = "chunk_id", vector: str = "embedding",
    extra: tuple[str, ...] = (), clusters: int | None = None,
) -> VectorIndex:
    """Write all chunks with a usable vector of ``size`` to ``path``, one folder for each cluster."""
    spark = chunks.sparkSession
    fits = chunks.filter(usable(F.col(vector), size)).select(F.col(chunk_id), *extra, F.col(vector).alias("vector"))
    wanted = clusters or max(1, min(MOST_CLUSTERS, math.isqrt(fits.count())))
    taken = max(1, min(wanted * SAMPLE_PER_CLUSTER, SAMPLE_BYTES // (8 * size)))
    sample = fits.select("vector", chunk_id).orderBy(F.xxhash64(chunk_id), chunk_id).limit(taken).toPandas()["vector"]
    unit = _unit(sample) if len(sample) else np.zeros((0, size))
    unit = unit[(unit != 0).any(axis=1)]
    centres = _centres(unit, wanted) if len(unit) else np.zeros((1, size))

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), _COLUMNS):
                own = part.iloc[at:at + _COLUMNS]
                unit = _unit(own["vector"])
                distance = _distances(unit, centres)
                nearest = distance.argmin(axis=1)
                found = np.where((unit != 0).any(axis=1), nearest, NOWHERE)
                yield own.assign(cluster=found.astype(np.int32), distance=distance[np.arange(len(own)), nearest])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in fits.schema]
    fields = ", ".join(kinds)
    assigned = fits.mapInPandas(assign, f"{fields}, cluster int, distance double")
    assigned.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(path)
    if not fits.take(1):
        return VectorIndex(path, ", ".join(kinds[:-1]), chunk_id, extra, size, centres, {}, {})
    told = spark.read.parquet(path).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r")).collect()
    return VectorIndex(path, ", ".join(kinds[:-1]), chunk_id, extra, size, centres, {t["cluster"]: t["n"] for t in told}, {t["cluster"]: t["r"] for t in told})


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def search_index(
    index: VectorIndex, queries: DataFrame, k: int, query_id: str = "query_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(query_id, chunk_id, extra…, similarity, position, compared)`` of the k best chunks per query.

    Equal similarities go to the later of the first ``extra`` column, then to the smaller id. ``compared`` is the
    number of chunks that the query met.
    """
    spark = queries.sparkSession
    wanted = queries.filter(usable(F.col(vector), index.size)).select(F.col(query_id), F.col(vector).alias("vector"))
    kinds = dict(queries.dtypes)
    query_kind = kinds[query_id]
    if not index.rows:
        return spark.createDataFrame([], f"`{query_id}` {query_kind}, {index.columns}, similarity double, position bigint, compared bigint")
    blocks = max(1, math.ceil(wanted.count() / block_rows))
    clusters = sorted(index.rows)
    counts, radius = (np.array([of[c] for c in clusters], float) for of in (index.rows, index.radius))
    centres = np.stack([index.centres[c] if c != NOWHERE else np.zeros(index.size) for c in clusters])
    nowhere = np.array([c == NOWHERE for c in clusters])

    def bounds(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The best similarity that a row of each cluster can have, and clusters in the order to meet them."""
        unit = _unit(vectors)
        apart = _distances(unit, centres)
        least = np.maximum(apart - radius, 0)
        best = np.where(nowhere | ~(unit != 0).any(axis=1)[:, None], 0.0, 1 - least**2 / 2)
        return best, np.argsort(np.where(nowhere, np.inf, apart), axis=1, kind="stable")

    def first(vectors: pd.Series) -> np.ndarray:
        """Which clusters a query meets first: the nearest ones that have k rows together."""
        _, order = bounds(vectors)
        before = np.cumsum(counts[order], axis=1) - counts[order]
        meets = np.zeros(order.shape, bool)
        np.put_along_axis(meets, order, before < k, axis=1)
        return meets

    def routed(meets: np.ndarray, part: pd.DataFrame) -> pd.DataFrame:
        row, column = np.nonzero(meets)
        return part[[query_id, "vector"]].iloc[row].assign(cluster=np.array(clusters, np.int32)[column])

    def route_first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield routed(first(part["vector"]), part)

    def route_rest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            best, _ = bounds(part["vector"])
            reach = best >= part["kth"].to_numpy()[:, None] - SLACK
            yield routed(reach & ~first(part["vector"]), part)

    extra = list(index.extra)
    table = index.chunks(spark)
    shards = spark.createDataFrame([(c, max(1, math.ceil(index.rows[c] / shard_rows)), index.rows[c]) for c in clusters], "cluster int, shards int, n bigint")
    schema = f"`{query_id}` {query_kind}, {index.columns}, similarity double"

    def best(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _best(c, q, k, query_id, index.chunk_id, extra)

    def met(routes: DataFrame) -> DataFrame:
        """The best k of every shard for the queries routed to it; other clusters are not read."""
        used = F.broadcast(routes.select("cluster").distinct().join(shards, "cluster"))  # at most a row per cluster
        cell = ["cluster", "shard", "block"]
        left = table.join(used, "cluster").select(
            "cluster", F.pmod(F.xxhash64(index.chunk_id), F.col("shards")).cast("int").alias("shard"), _each(blocks).alias("block"),
            index.chunk_id, *extra, "vector")
        right = routes.join(F.broadcast(shards), "cluster").select(
            "cluster", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
            F.pmod(F.xxhash64(query_id), F.lit(blocks)).cast("bigint").alias("block"), query_id, "vector")
        return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(best, schema)

    routes = f"`{query_id}` {query_kind}, vector {dict(wanted.dtypes)['vector']}, cluster int"
    order = Window.partitionBy(query_id).orderBy(F.desc("similarity"), *map(F.desc_nulls_last, extra), index.chunk_id)
    work = scratch_dir(spark, "search")
    near_routes = wanted.mapInPandas(route_first, routes)
    near_routes.write.parquet(f"{work}/first")
    near_routes = spark.read.parquet(f"{work}/first")
    met(near_routes).write.parquet(f"{work}/near")
    near = spark.read.parquet(f"{work}/near")
    kth = near.withColumn("p", F.row_number().over(order)).filter(F.col("p") == k).select(query_id, F.col("similarity").alias("kth"))
    asked = wanted.join(kth, query_id, "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0)))
    asked.mapInPandas(route_rest, routes).write.parquet(f"{work}/rest")
    far_routes = spark.read.parquet(f"{work}/rest")
    compared = near_routes.select(query_id, "cluster").unionByName(far_routes.select(query_id, "cluster")) \
        .join(F.broadcast(shards), "cluster").groupBy(query_id).agg(F.sum("n").alias("compared"))
    found = near.unionByName(met(far_routes)).withColumn("position", F.row_number().over(order).cast("bigint")).filter(F.col("position") <= k)
    return found.join(compared, query_id)


def _best(c: pd.DataFrame, q: pd.DataFrame, k: int, query_id: str, chunk_id: str, extra: list[str]) -> pd.DataFrame:
    if c.empty or q.empty:
        return pd.DataFrame({x: [] for x in (query_id, chunk_id, *extra, "similarity")})
    # in the order that breaks ties, so that a stable sort by similarity is enough
    c = c.sort_values([*extra, chunk_id], ascending=[False] * len(extra) + [True], kind="stable").reset_index(drop=True)
    matrix, out = _unit(c["vector"]), []
    for at in range(0, len(q), _ROWS):
        own = q.iloc[at:at + _ROWS]
        wanted = _unit(own["vector"])
        kept, score = np.zeros((len(own), 0), np.int64), np.zeros((len(own), 0))
        for first in range(0, len(c), _COLUMNS):
            fresh = wanted @ matrix[first:first + _COLUMNS].T
            score = np.hstack([score, fresh])
            kept = np.hstack([kept, np.broadcast_to(np.arange(first, first + fresh.shape[1]), fresh.shape)])
            order = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, kept = np.take_along_axis(score, order, axis=1), np.take_along_axis(kept, order, axis=1)
        found = c.iloc[kept.ravel()][[chunk_id, *extra]].reset_index(drop=True)
        found.insert(0, query_id, np.repeat(own[query_id].to_numpy(), kept.shape[1]))
        out.append(found.assign(similarity=score.ravel()))
    return pd.concat(out)


def knn(
    queries: DataFrame, chunks: DataFrame, k: int,
    query_id: str = "query_id", chunk_id: str = "chunk_id", vector: str = "embedding", newest: str | None = None,
    block_rows: int = BLOCK_ROWS, shard_rows: int = SHARD_ROWS, clusters: int | None = None,
) -> DataFrame:
    """``(query_id, chunk_id, similarity, position, compared)`` of the k best chunks per query, over an index of its own.

    Equal similarities go to the later ``newest`` (kept in the result), then to
    the smaller id.  Rows without a usable vector of the queries' size take no
    part; ``vector_rejects`` lists them.
    """
    spark = queries.sparkSession
    size = queries.filter(usable(F.col(vector))).agg(F.max(F.size(vector))).first()[0] or 1
    index = build_index(chunks, scratch_dir(spark, "index"), size, chunk_id, vector, (newest,) if newest else (), clusters)
    return search_index(index, queries, k, query_id, vector, block_rows, shard_rows)
