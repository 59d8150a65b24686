"""6. Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every training text: each task adds up a fixed table of ``buckets`` per language, and
Spark sums those tables by (language, bucket). The log-probability matrix (buckets x languages, float32) is broadcast;
its size is fixed by ``buckets`` and ``max_languages``, and more languages than that are an error. Scoring gathers the
matrix rows of a slice of texts at a time and sums them per document in numpy.

N-grams are byte n-grams (1 to 4) of the text in lower case (A-Z only), so every text has them whatever its script.
``score`` is the posterior of the predicted language, tempered by the number of n-grams over ``TEMPER`` so that long
texts do not all come out as 1.

Cases: null texts and texts without a letter are ``und`` with score 0. Training rows with a null language or text do
not count; without training rows every text is ``und``. Ties go to the first language in order. Other columns stay,
and columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.registry import table
from chatloom.llm.words import _LOWER, SLICE_BYTES
from chatloom.session import ship_package

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
MAX_LANGUAGES = 512
SMOOTHING = 0.5
TEMPER = 64.0
UNKNOWN = "und"

_U = np.uint32


def _grams(data: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each order n the buckets of all byte n-grams, by their first byte."""
    packed = data.astype(np.uint64)
    grown = packed.copy()
    for n in ORDERS:
        if n > 1:
            if len(data) < n:
                return
            grown = (grown[:-1] << np.uint64(8)) | packed[n - 1:]
        yield n, ((grown + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes in lower case, offsets) of runs of texts; each text is followed by one blank."""
    padded = pc.binary_join_element_wise(" ", texts.fill_null(""), " ", "")
    offsets = np.frombuffer(padded.buffers()[1], np.int32, len(padded) + 1 + padded.offset)[padded.offset:].astype(np.int64)
    data = np.frombuffer(padded.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(padded):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, _LOWER[data[offsets[at]:offsets[to]]], offsets[at:to + 1] - offsets[at]
        at = to


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> DataFrame:
    """``(lang, bucket, n)`` over all rows with a language and a text."""
    ship_package(docs.sparkSession)
    bits = buckets.bit_length() - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for at, data, offsets in _slices(batch.column(1)):
                own = langs[at:at + len(offsets) - 1]
                for name in set(own.tolist()):
                    # n-grams over the border of two texts of one slice hold a blank and are not counted apart
                    chosen = np.repeat(own == name, np.diff(offsets))
                    total = totals.setdefault(name, np.zeros(buckets, np.int64))
                    for _, gram in _grams(data[chosen], bits):
                        total += np.bincount(gram, minlength=buckets)
        for name, total in totals.items():
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(total[there])], names=["lang", "bucket", "n"])

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return known.mapInArrow(work, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """The learned languages in order, and log probabilities (bucket x language). The result has a fixed maximal size."""
    counts = count_grams(docs, text, lang, buckets)
    # A task's rows are bounded by buckets x languages; so is what comes to the driver.
    packed = counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("x")).limit(max_languages + 1)
    rows = sorted(packed.select("lang", "x.bucket", "x.n").toLocalIterator(), key=lambda r: r["lang"])
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    matrix = np.full((buckets, len(rows)), SMOOTHING)
    for k, r in enumerate(rows):
        matrix[r["bucket"], k] += r["n"]
    return [r["lang"] for r in rows], np.log(matrix / matrix.sum(axis=0, keepdims=True)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``lang_pred`` and ``score``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*[f"`{c}`" for c in kept]).schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = sent.value
        bits = matrix.shape[0].bit_length() - 1
        columns = [np.ascontiguousarray(matrix[:, k]) for k in range(len(names))]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sums = np.zeros((len(texts), max(1, len(names))), np.float64)
            sizes = np.zeros(len(texts), np.int64)
            for at, data, offsets in _slices(texts):
                sizes[at:at + len(offsets) - 1] = np.diff(offsets)
                for n, gram in _grams(data, bits):
                    first = np.minimum(offsets[:-1], len(gram))
                    # an n-gram belongs to the text of its first byte; the ones over a border are left out
                    last = np.minimum(np.maximum(offsets[1:] - n + 1, offsets[:-1]), len(gram))
                    for k, column in enumerate(columns):
                        total = np.concatenate([[0.0], np.cumsum(column[gram], dtype=np.float64)])
                        sums[at:at + len(first), k] += total[last] - total[first]
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            known = lettered & (len(names) > 0)
            best = sums.argmax(axis=1)
            spread = np.exp((sums - sums.max(axis=1, keepdims=True)) * (TEMPER / np.maximum(TEMPER, sizes))[:, None])
            score = np.where(known, spread.max(axis=1) / spread.sum(axis=1), 0.0)
            picked = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(picked, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    source = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(work, f"{fields}lang_pred string, score double")


QUERY = "op6_language_id"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))  # learns from rows without an id
    model = fit(docs.filter(~held_out).select("text", "lang"))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
