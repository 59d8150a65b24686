"""8. Substring deduplication with a count-min prefilter.

A *window* is ``size`` consecutive words of one document. Words inside a window whose word sequence also starts
earlier (smaller document id, or earlier in the same document) are removed.

First pass: every batch of a partition counts its windows in a count-min sketch of two rows and sends it on as sorted
cells in blocks; blocks are merged by Spark. A sketch only overestimates, so a window that occurs twice is always
found repeated. What is kept of the merged sketch is one bit per cell, "counted more than once".

Second pass: windows with both bits set are grouped exactly by a 64-bit hash of all their words. A batch reports one
row for each of its distinct windows (its earliest place; later places in the batch are repeats anyway), so one very
frequent window costs at most a row per batch. Windows are packed per shard of the hash, shards hold a bounded share.

Broadcast bound: a row has at most 2^``MAX_BITS`` cells, 64 MB of bits. Up to that the rows grow with the input;
beyond it more windows are estimated repeated and the second pass groups more of them, with the same result.

Cases: null and empty texts and texts below ``size`` words have no windows and are kept, as single-blank words. Equal
documents: all but the one with the smallest id lose their windows. Rows sort by id, a null id first, and then by the
hash of their texts; of rows equal in both, all but one lose their windows. An empty table gives an empty one. Columns of the input stay; ones
that clash with a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm import words as W
from chatloom.llm.graph import staged
from chatloom.llm.registry import table
from chatloom.session import ship_package

SIZE = 20
MAX_BITS = 29
BLOCK_BITS = 18
#: Windows that a shard of the second pass is planned for.
SHARD_WINDOWS = 1 << 21
_NO_ID = -(2**63)
_ROWS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((hashes * _ROWS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def pack(cells: np.ndarray) -> bytes:
    """Sorted cells of a block, each at most twice: gaps of a byte, or plain numbers where those are shorter."""
    gaps = np.diff(cells, prepend=0)
    long_ = gaps // 255
    size = len(cells) + int(long_.sum())
    if size >= 4 * len(cells):
        return b"\1" + cells.astype(np.uint32).tobytes()
    out = np.full(size, 255, np.uint8)
    out[np.cumsum(long_ + 1) - 1] = gaps % 255
    return b"\0" + out.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    if packed[:1] == b"\1":
        return np.frombuffer(packed, np.uint32, offset=1).astype(np.int64)
    steps = np.frombuffer(packed, np.uint8, offset=1)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def _batch_windows(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, first word within the document, row) of all windows, slice by slice."""
    for row, words in W.split(texts, lower=False):
        found, at, doc = W.windows(words.hashes(), words.first, size)
        yield found, at - words.first[doc], doc + row


def sketch(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """``(line, block, repeated)``: for each row of the merged sketch and block of cells, a bit per cell."""
    block_bits = min(BLOCK_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.concatenate([np.zeros(0, np.uint64), *(h for h, _, _ in _batch_windows(batch.column(0), size))])
            for line in range(len(_ROWS)):
                cells = np.sort(_cells(hashes, line, bits))
                third = np.zeros(len(cells), bool)
                third[2:] = cells[2:] == cells[:-2]
                cells = cells[~third]
                blocks, first = np.unique(cells >> block_bits, return_index=True)
                packed = [pack(part & ((1 << block_bits) - 1)) for part in np.split(cells, first[1:])] if len(cells) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([line] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=["line", "block", "cells"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        seen, repeated = np.zeros(1 << block_bits, bool), np.zeros(1 << block_bits, bool)
        for packed in part["cells"]:
            cells = unpack(packed)
            repeated[cells[1:][cells[1:] == cells[:-1]]] = True
            repeated[cells[seen[cells]]] = True
            seen[cells] = True
        return pd.DataFrame({"line": part["line"].iloc[:1], "block": part["block"].iloc[:1], "repeated": [np.packbits(repeated).tobytes()]})

    counted = docs.select("text").mapInArrow(count, "line int, block int, cells binary")
    return counted.groupBy("line", "block").applyInPandas(merge, "line int, block int, repeated binary")


def _collect_bits(merged: DataFrame, bits: int) -> list[np.ndarray]:
    """The rows of the sketch, 2^bits bits each."""
    block_bytes = max(1, (1 << min(BLOCK_BITS, bits)) >> 3)
    out = [np.zeros(max(1, (1 << bits) >> 3), np.uint8) for _ in _ROWS]
    for r in merged.toLocalIterator():
        out[r["line"]][r["block"] * block_bytes:(r["block"] + 1) * block_bytes] = np.frombuffer(r["repeated"], np.uint8)
    return out


_PLACE = np.dtype([("hash", np.uint64), ("doc", np.int64), ("text", np.int64), ("at", np.int32)])


def _later(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order, and which of them are not the earliest of their hash."""
    places = places[np.lexsort((places["at"], places["text"], places["doc"], places["hash"]))]
    later = np.zeros(len(places), bool)
    moved = np.logical_or.reduce([places[f][1:] != places[f][:-1] for f in ("doc", "text", "at")])
    later[1:] = (places["hash"][1:] == places["hash"][:-1]) & moved
    later[1:] |= later[:-1] & (places["hash"][1:] == places["hash"][:-1])
    return places, later


_PAIR = np.dtype([("doc", np.int64), ("text", np.int64), ("at", np.int32)])


def _pairs(docs: np.ndarray, texts: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(docs), _PAIR)
    out["doc"], out["text"], out["at"] = docs, texts, at
    return out


def _by_doc(places: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Id, text hash and packed starts of each document."""
    places = places[np.lexsort((places["at"], places["text"], places["doc"]))]
    new = np.ones(len(places), bool)
    new[1:] = (places["doc"][1:] != places["doc"][:-1]) | (places["text"][1:] != places["text"][:-1])
    first = np.flatnonzero(new)
    starts = [part.astype(np.int32).tobytes() for part in np.split(places["at"], first[1:])] if len(first) else []
    return places["doc"][first].tolist(), places["text"][first].tolist(), starts


def later_starts(docs: DataFrame, size: int, bits: int, shards: int) -> DataFrame:
    """``(key, hash, starts)``: places of windows that also start earlier, a row per document that has any."""
    sent = docs.sparkSession.sparkContext.broadcast(_collect_bits(sketch(docs, size, bits), bits))
    schema = "shard int, key long, hash long, packed binary"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = sent.value
        for batch in batches:
            keys, texts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            parts = [np.zeros(0, _PLACE)]
            for hashes, at, row in _batch_windows(batch.column(2), size):
                maybe = np.arange(len(hashes))
                for line, row_bits in enumerate(lines):
                    cells = _cells(hashes[maybe], line, bits)
                    maybe = maybe[(row_bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1]
                part = np.empty(len(maybe), _PLACE)
                part["hash"], part["doc"], part["text"], part["at"] = hashes[maybe], keys[row[maybe]], texts[row[maybe]], at[maybe]
                parts.append(part)
            places, later = _later(np.concatenate(parts))
            known, known_texts, starts = _by_doc(places[later])
            first = places[~later]
            first = first[np.r_[True, first["hash"][1:] != first["hash"][:-1]][:len(first)]]
            shard = ((first["hash"] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            used, begin = np.unique(shard[order], return_index=True)
            packed = [p.tobytes() for p in np.split(first[order], begin[1:])] if len(used) else []
            yield pa.RecordBatch.from_arrays([
                pa.array([*used.tolist(), *(k % shards for k in known)], pa.int32()),
                pa.array([*[None] * len(used), *known], pa.int64()),
                pa.array([*[0] * len(used), *known_texts], pa.int64()),
                pa.array([*packed, *starts], pa.binary()),
            ], names=["shard", "key", "hash", "packed"])

    def resolve(part: pd.DataFrame) -> pd.DataFrame:
        own = part["key"].isna().to_numpy()
        found = np.frombuffer(b"".join(part["packed"][own]), _PLACE)
        places, later = _later(found)
        done = part[~own]
        known = np.frombuffer(b"".join(done["packed"]), np.int32)
        sizes = np.array([len(x) // 4 for x in done["packed"]], np.int64)
        repeat = [np.repeat(done[c].to_numpy(np.int64), sizes) for c in ("known", "hash")]
        pairs = np.concatenate([_pairs(*(places[f][later] for f in ("doc", "text", "at"))), _pairs(*repeat, known)])
        bucket = (W.mix(pairs["doc"].astype(np.uint64) ^ pairs["text"].astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % shards
        order = np.argsort(bucket, kind="stable")
        used, begin = np.unique(bucket[order], return_index=True)
        return pd.DataFrame({"bucket": used.astype(np.int32), "pairs": [p.tobytes() for p in np.split(pairs[order], begin[1:])] if len(used) else []})

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        keys, texts, starts = _by_doc(np.frombuffer(b"".join(part["pairs"]), _PAIR))
        return pd.DataFrame({"key": keys, "hash": texts, "starts": starts})

    placed = docs.select("key", "hash", "text").mapInArrow(place, schema)
    # A second copy of the key keeps its exact value where pandas turns a nullable column into floats.
    placed = placed.withColumn("known", F.coalesce("key", F.lit(0)))
    resolved = placed.groupBy("shard").applyInPandas(resolve, "bucket int, pairs binary")
    return resolved.groupBy("bucket").applyInPandas(gather, "key long, hash long, starts binary")


def plan_bits(docs: DataFrame) -> tuple[int, int]:
    """Bits of a sketch row and number of shards for the size of the texts."""
    octets = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    windows = octets // 6 + 1
    bits = min(MAX_BITS, max(16, (3 * windows).bit_length()))
    return bits, max(8, -(-windows // SHARD_WINDOWS))


def remove_repeats(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``, the words left over joined by single blanks."""
    ship_package(docs.sparkSession)
    results = ("n_words", "n_removed", "kept", "__starts", "__key", "__hash", "__again")
    row = ["__key", "__hash"]
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(doc_id).isNull())
    source = docs.drop(*results).withColumn("__key", F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))).withColumn("__hash", hashed)
    narrow = source.select(F.col("__key").alias("key"), F.col("__hash").alias("hash"), F.col(text).alias("text"))
    bits, shards = plan_bits(narrow)
    starts = later_starts(narrow, size, bits, shards).withColumnsRenamed({"key": "__key", "hash": "__hash", "starts": "__starts"})
    # rows equal in id and text: one is judged like any other, the rest repeat it
    several = staged(source.groupBy(*row).agg(F.count("*").alias("n")).filter("n > 1").select(*row), "several")
    copy = F.row_number().over(Window.partitionBy(*row).orderBy(F.lit(0)))
    again = source.join(several, row, "left_semi").withColumn("__again", copy > 1)
    source = source.join(several, row, "left_anti").withColumn("__again", F.lit(False)).unionByName(again)
    joined = source.join(starts, row, "left")
    kept = [c for c in docs.columns if c not in (*results, text)]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*[f"`{c}`" for c in kept]).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(part.num_columns - 3).cast(pa.binary()).to_pylist()
                starts, copies = (part.column(part.num_columns - k).to_pylist() for k in (2, 1))
                n_words, n_removed, left = [], [], []
                for t, s, copy in zip(texts, starts, copies, strict=True):
                    words = (t or b"").split()
                    if copy:
                        s = np.arange(max(0, len(words) - size + 1), dtype=np.int32).tobytes()
                    gone = 0
                    if s:
                        edges = np.zeros(len(words) + 1, np.int64)
                        begin = np.frombuffer(s, np.int32)
                        np.add.at(edges, np.minimum(begin, len(words)), 1)
                        np.add.at(edges, np.minimum(begin + size, len(words)), -1)
                        keep = np.cumsum(edges[:-1]) <= 0
                        gone = len(words) - int(keep.sum())
                        n_words.append(len(words))
                        words = [words[i] for i in np.flatnonzero(keep).tolist()]
                    else:
                        n_words.append(len(words))
                    n_removed.append(gone)
                    left.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-3], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.string())],
                    names=[*kept, "n_words", "n_removed", "kept"])

    ordered = joined.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").alias("__text"), "__starts", "__again")
    return ordered.mapInArrow(cut, f"{fields}n_words long, n_removed long, kept string")


QUERY = "op8_substring_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d WHERE len(w) >= 20),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(w[pos:pos + 19], ' ') ORDER BY doc_id, pos) AS n FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM r WHERE n > 1),
k AS (
  SELECT x.doc_id, count(*) AS n_words, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (c.pos IS NULL) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d) x LEFT JOIN c ON x.doc_id = c.doc_id AND x.pos = c.pos GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
