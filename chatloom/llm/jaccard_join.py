"""7. N-gram Jaccard join with count-vector R-trees.

Documents are sets of distinct word shingles; two link if ``100 * |intersection| >= 75 * |union|``. The tokens of a
set are hashed into groups, and the group counts are the document's point. The overlap of two sets is at
most the sum of the smaller coordinates of their points, and the overlap with anything in an R-tree node at most the
sum of the smaller of query and box maximum; pairs that survive this bound and the size bound are verified on the sets.

One tree over all documents could not be distributed, and random points in many dimensions do not separate in boxes,
so trees are built per *family*. Two linked sets share a token among the quarter of their tokens that comes first in
any fixed order; sets that share such a token and have compatible sizes are chained, and a family is a connected
component of these chains. Every link therefore lies within one family, and none is lost. The order puts tokens that
many documents share last (a sketch of token counts of fixed size), which keeps passages that many documents quote
from joining families; the order changes the work, never the result.

Equal sets are one node. A family beyond ``TILE`` members is cut into parts, and each pair of parts is one task's
tree, so no family is gathered in one task. Trees report a spanning forest of their links, not all pairs; components
are found by Spark.

Cases: null, empty and wordless texts have no shingle and link with nothing; texts below ``size`` words have their
whole sequence as the one shingle. A component is named by its smallest id; a null id takes part and names nothing, so
a component without ids has the name null. Rows that share an id are nodes by their sets. An empty table gives an
empty one. Extra columns do not matter.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import words as W
from chatloom.llm.graph import components, staged
from chatloom.llm.registry import table
from chatloom.llm.substring_dedup import pack, unpack
from chatloom.session import ship_package

SIZE = 5
#: A pair links if SCALE * intersection >= LEAST * union.
LEAST, SCALE = 75, 100
#: Groups of tokens: a quarter of the median set size within these limits. Larger sets need more to differ.
GROUPS, MOST_GROUPS = 128, 2_048
#: The sketch of token counts that orders the tokens has a cell (a byte) for about eight tokens, 2^28 at most. It is a file
#: that the Python workers of an executor map into memory together.
SKETCH_BITS = 28
BLOCK_BITS = 18
#: Tokens whose cells a task sorts and packs together, or those of one slice of text.
TOGETHER = 1 << 20
TILE = 2_048
LEAF = 16
FANOUT = 16


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, words in W.split(texts, lower=True):
        hashes = words.hashes()
        found, _, _ = W.windows(hashes, words.first, size)
        counts = np.diff(words.first)
        ends = np.cumsum(np.maximum(counts - size + 1, 0))
        for i, n in enumerate(counts.tolist()):
            if n >= size:
                yield np.unique(found[ends[i] - (n - size + 1):ends[i]])
            elif n:
                yield np.array([W.sequence_hash(hashes[words.first[i]:words.first[i + 1]])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def sketch_bits(octets: int) -> int:
    """The sketch has 2^bits cells for texts of so many bytes, six or so to a token."""
    return min(SKETCH_BITS, max(16, (octets // 6 // 8).bit_length()))


def token_levels(docs: DataFrame, size: int) -> str:
    """How often the tokens of each sketch cell occur, in steps of an eighth of an octave: the name of a file on all executors."""
    octets = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = sketch_bits(octets)
    block_bits = min(BLOCK_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for at, words in W.split(batch.column(0), lower=True):
                found.append((W.windows(words.hashes(), words.first, size)[0] >> np.uint64(64 - bits)).astype(np.uint32))
                held += len(found[-1])
                if held >= TOGETHER or at + len(words.first) - 1 == batch.num_rows:
                    cells = np.sort(np.concatenate(found)).astype(np.int64)
                    found, held = [], 0
                    blocks, first = np.unique(cells >> block_bits, return_index=True)
                    packed = [pack(part & ((1 << block_bits) - 1)) for part in np.split(cells, first[1:])] if len(cells) else []
                    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=["block", "cells"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << block_bits, np.int64)
        for packed in part["cells"]:
            total += np.bincount(unpack(packed), minlength=1 << block_bits)
        levels = np.minimum(8 * np.log2(total + 1.0), 255).astype(np.uint8)
        return pd.DataFrame({"block": part["block"].iloc[:1], "levels": [levels.tobytes()]})

    merged = docs.select("text").mapInArrow(count, "block int, cells binary").groupBy("block").applyInPandas(add, "block int, levels binary")
    name = f"levels-{uuid.uuid4().hex}"
    path = f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/{name}"
    with open(path, "wb") as out:  # block by block, so the driver never holds the sketch
        out.truncate(1 << bits)
        for r in merged.toLocalIterator():
            out.seek(r["block"] << block_bits)
            out.write(r["levels"])
    docs.sparkSession.sparkContext.addFile(path)
    return name


def describe(docs: DataFrame, size: int, levels: str) -> DataFrame:
    """``(key, text_hash, n, node, firsts)`` of each document: set size, hash of the set, the first tokens in the common order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.memmap(SparkFiles.get(levels), np.uint8, "r")
        shift = np.uint64(65 - len(level).bit_length())
        for batch in batches:
            sizes, nodes, firsts = [], [], []
            for tokens in shingle_sets(batch.column(2), size):
                n = len(tokens)
                sizes.append(n)
                if not n:
                    nodes.append(None)
                    firsts.append(b"")
                    continue
                nodes.append(int(W.mix(np.array([W.mix(tokens).sum(dtype=np.uint64) + np.uint64(n)]))[0].astype(np.int64)))
                order = (level[(tokens >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (W.mix(tokens) >> np.uint64(8))
                first = n - -(-LEAST * n // SCALE) + 1
                firsts.append((np.partition(order, first - 1)[:first] if first < n else order).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(firsts, pa.binary())],
                names=["key", "text_hash", "n", "node", "firsts"])

    return docs.select("key", "text_hash", "text").mapInArrow(work, "key long, text_hash long, n long, node long, firsts binary")


_POST = np.dtype([("token", np.uint64), ("n", np.int32), ("node", np.int64)])


def chains(described: DataFrame, shards: int) -> DataFrame:
    """``(a, b)``: nodes of compatible size that share a first token, as a forest per shard of tokens."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            sizes = np.array([len(x) for x in tokens])
            posts = np.empty(int(sizes.sum()), _POST)
            posts["token"] = np.concatenate([np.zeros(0, np.uint64), *tokens])
            posts["n"] = np.repeat(batch.column(0).to_numpy(), sizes)
            posts["node"] = np.repeat(batch.column(1).to_numpy(), sizes)
            shard = (W.mix(posts["token"]) >> np.uint64(33)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            used, begin = np.unique(shard[order], return_index=True)
            packed = [p.tobytes() for p in np.split(posts[order], begin[1:])] if len(used) else []
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names=["shard", "posts"])

    def chain(part: pd.DataFrame) -> pd.DataFrame:
        posts = np.frombuffer(b"".join(part["posts"]), _POST)
        order = np.argsort(posts["token"], kind="stable")
        posts = posts[order]
        same = posts["token"][1:] == posts["token"][:-1]
        shared = np.zeros(len(posts), bool)
        shared[1:] |= same
        shared[:-1] |= same
        posts = posts[shared]
        posts = posts[np.lexsort((posts["node"], posts["n"], posts["token"]))]
        x, y = posts[:-1], posts[1:]
        fits = (x["token"] == y["token"]) & (x["node"] != y["node"]) & (SCALE * x["n"].astype(np.int64) >= LEAST * y["n"].astype(np.int64))
        edges = np.unique(np.stack([x["node"][fits], y["node"][fits]], axis=1), axis=0)
        forest = Forest()
        kept = [(a, b) for a, b in edges.tolist() if forest.join(a, b)]
        return pd.DataFrame(kept, columns=["a", "b"], dtype=np.int64)

    posted = described.filter("n > 0").select("n", "node", "firsts").mapInArrow(post, "shard int, posts binary")
    return posted.groupBy("shard").applyInPandas(chain, "a long, b long").distinct()


class Forest:
    """Union-find over any hashable nodes."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while up.get(top, top) != top:
            top = up[top]
        while up.get(x, x) != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class CountTree:
    """An R-tree over group counts, packed bottom-up from points sorted by set size and leading coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        slab = np.arange(len(sizes))
        by_size = np.lexsort((slab, sizes))
        slab[by_size] = np.arange(len(sizes)) // (LEAF * FANOUT)
        self.order = np.lexsort((points[:, 1], points[:, 0], slab))
        self.points, self.sizes = points, sizes
        # levels[0]: leaves; each level: box maxima, smallest and largest set size
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = []
        for width in (LEAF, *[FANOUT] * 64):
            cuts = np.arange(0, len(low), width)
            top, low, high = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))
            if len(cuts) == 1:
                break

    @staticmethod
    def _may(point: np.ndarray, n: int, top: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boxes in which a set of n tokens may have a link, and the bound of the overlap there."""
        least = np.maximum(low, -(-LEAST * n // SCALE))
        at = np.flatnonzero((least <= high) & (LEAST * low <= SCALE * n))
        bound = np.minimum(point, top[at]).sum(axis=1, dtype=np.int64)
        enough = bound >= -(-LEAST * (n + least[at]) // (SCALE + LEAST))
        return at[enough], bound[enough]

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Points that point i may link with, and the bounds of their overlaps."""
        point, n = self.points[i], int(self.sizes[i])
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            nodes = nodes[self._may(point, n, top[nodes], low[nodes], high[nodes])[0]]
            width, count = (FANOUT, len(self.levels[depth - 1][1])) if depth else (LEAF, len(self.order))
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
            nodes = nodes[nodes < count]
        rows = self.order[nodes]
        at, bound = self._may(point, n, self.points[rows], self.sizes[rows], self.sizes[rows])
        return rows[at], bound


def links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links among these sets; the closest pairs by bound are verified first."""
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = min(MOST_GROUPS, max(GROUPS, 1 << (int(np.median(sizes)) // 4).bit_length()))
    narrow = np.uint16 if sizes.max() < 1 << 16 else np.int64
    points = np.stack([np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(narrow) for s in sets])
    tree = CountTree(points, sizes)
    pairs = []
    for i in range(1, len(sets)):
        j, bound = tree.near(i)
        before = j < i
        pairs.append((np.full(int(before.sum()), i), j[before], bound[before] / (sizes[i] + sizes[j[before]])))
    a, b, close = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
    order = np.argsort(-close, kind="stable")
    a, b = a[order], b[order]
    part, out = np.arange(len(sets)), []
    while len(a):
        for i, j in zip(a[:64].tolist(), b[:64].tolist(), strict=True):
            if part[i] != part[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if SCALE * both >= LEAST * (sizes[i] + sizes[j] - both):
                    part[part == part[i]] = part[j]
                    out.append((i, j))
        a, b = a[64:], b[64:]
        if len(a) > 256:
            apart = part[a] != part[b]
            a, b = a[apart], b[apart]
    return out


def verified(members: DataFrame, size: int) -> DataFrame:
    """``(a, b)``: links within families; ``members`` has (task, family, node, text)."""

    def work(part: pd.DataFrame) -> pd.DataFrame:
        sets = list(shingle_sets(pa.array(part["text"], pa.string()), size))
        docs, out = part["node"].to_numpy(), []
        for rows in part.groupby("family", sort=False).indices.values():
            out += [(docs[rows[i]], docs[rows[j]]) for i, j in links([sets[r] for r in rows])]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return members.groupBy("task").applyInPandas(work, "a long, b long")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _row(key: str) -> tuple[Column, Column]:
    """A nullable id as columns without nulls."""
    return F.coalesce(F.col(key), F.lit(0)).alias("id"), F.col(key).isNull().alias("none")


def linked(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component, component_id)``: component is null for texts without a shingle."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("key"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    described = staged(describe(source, size, token_levels(source, size)), "sets")
    tokens = described.agg(F.sum("n")).first()[0] or 0
    shards = max(16, math.ceil(tokens / 4 / (1 << 19)))
    # the row that stands for a set
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash"))
    nodes = described.filter("n > 0").groupBy("node").agg(first.alias("row")).select("node", F.col("row.key").alias("doc"), F.col("row.text_hash").alias("hash"))
    family = components(chains(described, shards)).withColumnsRenamed({"root": "family"})
    member = staged(family.join(nodes, "node").select("family", "node", "doc", "hash"), "members")
    sizes = member.groupBy("family").agg(F.count("*").alias("m"))
    parts = F.ceil(F.col("m") / TILE).cast("int")
    tasks = max(1, math.ceil(member.count() / TILE))
    placed = member.join(sizes, "family").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("family"), F.lit(tasks))).otherwise(
        F.xxhash64("family", F.least("part", "other"), F.greatest("part", "other")))
    # members grow with the corpus: they are shuffled at every size; of equal rows one text is sent on
    row = ["id", "none", "text_hash"]
    placed = placed.select(*_row("doc"), F.col("hash").alias("text_hash"), "family", "node", "parts", "part")
    wanted = source.select(*_row("key"), "text_hash", "text").join(placed.hint("merge"), row).dropDuplicates(row)
    texts = wanted.withColumn("other", F.explode(other)).select(task.alias("task"), "family", "node", "text")
    root = components(verified(texts, size))
    named = staged(nodes.join(root, "node", "left").select("node", "doc", F.coalesce("root", "node").alias("component")), "named")
    names = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = named.join(names, "component").select("node", "component", "component_id")
    out = described.select("key", "text_hash", "n", "node").join(named, "node", "left")
    return out.select(
        F.col("key").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def join(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for every row of ``docs``."""
    return linked(docs, size, doc_id, text).select("doc_id", "n_shingles", "component_id")


def drop_copies(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, of the smallest id, null last, and then text hash; texts without a shingle stay."""
    rows = linked(docs, size, doc_id, text).filter("component IS NOT NULL").groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row"))
    stays = F.col("doc_id").eqNullSafe(F.col("row.doc_id")) & (F.col("text_hash") == F.col("row.text_hash"))
    marked = rows.join(best, "component").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), stays.alias("__once"), "copies")
    # copies grow with the corpus: joined by the same merge at every size, instead of a broadcast while they are few
    marked = staged(marked.filter("NOT __once OR copies > 1").drop("copies"), "copies").hint("merge")
    same_row = F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (text_hash(text) == F.col("__hash"))
    alone = docs.join(marked, same_row, "left_anti").select(*docs.columns)
    once = docs.join(marked.filter("__once").hint("merge"), same_row).dropDuplicates(["__id", "__hash"]).select(*docs.columns)
    return alone.unionByName(once)


QUERY = "op7_jaccard_join"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
