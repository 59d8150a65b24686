"""2. LM scoring by context-tree weighting over bytes.

A text is a row of tokens: words, each followed by a blank byte, and one end byte. The model codes it byte by byte,
each byte as eight binary decisions. For every decision (a bit prefix) there is a context tree over the ``DEPTH`` bytes
before it, back to the last ``SUFFIX`` bytes of the word before; every node holds a Krichevsky-Trofimov estimator of
its counts, and context-tree weighting mixes the estimators of all depths. The prediction for a bit walks the contexts
that training has seen; contexts it never saw have nothing to weigh, so the walk ends at the deepest seen one. The walk
does not depend on the bit to come, so the bits' probabilities, and those of all texts, sum to 1.

A token's code length has two parts: the *head*, its first bytes, whose contexts reach into the word before, and the
rest, which depends on the word alone. So counts and look-ups shuffle distinct things: distinct heads and words of each
block of documents, distinct (context, byte) symbols of each bucket of those. Trees are built in buckets of whole
subtrees (last two context bytes); only depths 0 and 1 are put together on the driver, 256 x 255 nodes at most, and
only they are broadcast. Counts cover every training document.

Cases: null and empty texts are one end token. A null id counts as training. Repeated rows count and score as often as
they occur. Without training documents every bit has probability 1/2. An empty table gives an empty one. Extra columns
stay; those named like a result are replaced.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.graph import staged
from chatloom.llm.registry import table
from chatloom.session import ship_package

DEPTH, SUFFIX = 5, 2
#: Bytes of a token whose context holds bytes of the word before: of DEPTH bytes, one is the blank between.
HEAD = DEPTH - 1
BLOCK_BYTES = 24 << 20
UNITS_A_BUCKET, SYMBOLS_A_BUCKET = 400_000, 300_000
_WORD, _HEAD, _END = b"w", b"h", b"\n"
#: Words that are looked up at a time.
_TOGETHER = 200_000
_HALF = math.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series eight steps up."""
    y = x + 8
    up = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    return up - np.log(product)


def log_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1.0)


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, without the end."""
    return (text or "").encode().lower().split()


def heads(words: list[bytes]) -> list[bytes]:
    """The head unit of every word, and of the end after them."""
    before = [b"", *(w[-SUFFIX:] for w in words)]
    return [*(_HEAD + p + b" " + (w + b" ")[:HEAD] for p, w in zip(before, words)), _HEAD + before[-1] + b" \n"]


def units(words: list[bytes]) -> list[bytes]:
    """The word units; the end is the one without letters."""
    return [*(_WORD + w for w in words), _WORD]


class Numbering:
    """Numbers for words, for their last ``SUFFIX`` bytes and for their first bytes, so that arrays stand for texts."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.suffixes: dict[bytes, int] = {b"": 0}
        self.heads: dict[bytes, int] = {_END: 0}
        #: per word its suffix and its head, packed in an integer
        self._of = array("q")

    def add(self, words: Iterable[bytes]) -> None:
        for w in words:
            if w not in self.words:
                self.words[w] = len(self.words)
                self._of.append(self.suffixes.setdefault(w[-SUFFIX:], len(self.suffixes)) << 32 | self.heads.setdefault((w + b" ")[:HEAD], len(self.heads)))

    def batches(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of runs of texts, by number, and the number of words of each text; a run has about ``_TOGETHER`` words."""
        held, sizes = [], []
        for text in texts:
            found = tokens(text)
            sizes.append(len(found))
            held += found
            if len(held) >= _TOGETHER:
                yield self._numbered(held), np.array(sizes, np.int64)
                held, sizes = [], []
        if sizes:
            yield self._numbered(held), np.array(sizes, np.int64)

    def _numbered(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.words.get, words, repeat(-1)), np.int32, len(words))
        new = np.flatnonzero(found < 0)  # most words are known, only the others are looked at one by one
        if len(new):
            missing = [words[i] for i in new.tolist()]
            self.add(missing)
            found[new] = list(map(self.words.__getitem__, missing))
        return found

    def head_pairs(self, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For every token, ends included: the suffix before it and its head, packed in an integer."""
        of = np.array(self._of, np.int64)
        own, inside = np.zeros(len(words) + len(sizes), np.int64), np.ones(len(words) + len(sizes), bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        own[inside] = of[words]
        pairs = own & 0xFFFFFFFF
        pairs[1:] |= own[:-1] & ~0xFFFFFFFF  # an end leaves nothing to the text after it
        return pairs


def symbols(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte packed in an integer, number of the unit) of all bytes that the units code."""
    parts, skip = [], np.empty(len(found), np.int64)
    pad = b"\0" * DEPTH
    for i, unit in enumerate(found):
        if unit[:1] == _WORD:
            parts.append(b" " + unit[1:] + b" ")
            skip[i] = DEPTH
        else:
            parts.append(pad + unit[1:])
            skip[i] = DEPTH + unit.index(b" ")
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    coded = np.maximum(sizes - skip, 0)
    owner = np.repeat(np.arange(len(parts)), coded)
    first = np.cumsum(sizes) - sizes + skip
    at = np.arange(len(owner)) - np.repeat(np.cumsum(coded) - coded, coded) + first[owner]
    packed = np.zeros(len(at), np.int64)
    for k in range(DEPTH, -1, -1):
        packed = (packed << 8) | data[at - k]
    return packed, owner


class Subtrees:
    """All nodes of depth 2 to DEPTH over distinct symbols with counts: their estimates and weights.

    A node is a run of the symbols sorted by context and byte: those that share the context bytes of its depth and the
    first bits of the byte. One sort a depth finds the nodes of its eight levels. Symbols with count 0, which only texts
    outside of training have, make nodes without counts; these weigh nothing.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray) -> None:
        self.key = key
        #: per depth: its symbols, their counts, where each of one depth more is among them, and where each of ``key``
        self.depths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        here, times, at = key, n.astype(np.float64), np.arange(len(key))
        for depth in range(DEPTH, 1, -1):
            here, back = np.unique(here & ((1 << (8 * depth + 8)) - 1), return_inverse=True)
            times, at = np.bincount(back, times, len(here)), back[at]
            self.depths[depth] = here, times, back, at

    def nodes(self, level: int) -> dict[int, tuple[np.ndarray, ...]]:
        """Per depth the nodes of one bit: (first symbol of each, node of each symbol, zeros, ones, log, leaf weight)."""
        found: dict[int, tuple[np.ndarray, ...]] = {}
        for depth in range(DEPTH, 1, -1):
            here, times, back, _ = self.depths[depth]
            prefix = here >> (8 - level)
            starts = np.concatenate([[True], prefix[1:] != prefix[:-1]])
            first, run = np.flatnonzero(starts), np.cumsum(starts) - 1
            ones = np.add.reduceat(times * ((here >> (7 - level)) & 1), first)
            zeros = np.add.reduceat(times, first) - ones
            log, leaf = log_estimate(zeros, ones), np.ones(len(first))
            if depth < DEPTH:
                # a child's parent drops the farthest context byte
                children = found[depth + 1]
                own, split = _HALF + log, _HALF + np.bincount(run[back[children[0]]], children[4], len(first))
                log = np.logaddexp(own, split)
                leaf = np.exp(own - log)
            found[depth] = first, run, zeros, ones, log, leaf
        return found

    def upper(self) -> tuple[np.ndarray, ...]:
        """(node, zeros, ones, sum of the logs) of the seen nodes of depth 2, by their parent of depth 1."""
        here, parts = self.depths[2][0], []
        for level in range(8):
            first, _, zeros, ones, log, _ = self.nodes(level)[2]
            parts.append(((here[first] & 0xFF00) | _prefix(here[first], level), zeros, ones, log))
        node, *sums = (np.concatenate(x) for x in zip(*parts, strict=True))
        found, back = np.unique(node, return_inverse=True)
        zeros, ones, logs = (np.bincount(back, x, len(found)) for x in sums)
        seen = zeros + ones > 0
        return found[seen], zeros[seen], ones[seen], logs[seen]

    def predict(self, top: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Log probability (base 10) of each symbol's byte after its context. ``top``: see ``tops``."""
        total = np.zeros(len(self.key))
        for level in range(8):
            p = np.full(len(self.key), np.nan)
            for depth, (_, run, zeros, ones, _, leaf) in self.nodes(level).items():
                here, at = self.depths[depth][0], self.depths[depth][3]
                p = _mixed(p, *(x[at] for x in (*_own(here, level, zeros[run], ones[run]), leaf[run])))
            prefix = _prefix(self.key, level)
            for nodes, table_ in (((self.key & 0xFF00) | prefix, top[1]), (prefix, top[0])):
                zeros, ones, leaf = table_[nodes].T
                p = _mixed(p, *_own(self.key, level, zeros, ones), leaf)
            total += np.log10(np.where(np.isnan(p), 0.5, p))
        return total


def _prefix(key: np.ndarray, level: int) -> np.ndarray:
    """The first ``level`` bits of a symbol's byte after a one."""
    return (1 << level) | ((key & 0xFF) >> (8 - level))


def _own(key: np.ndarray, level: int, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's estimate for the bit of each symbol, and whether training has seen the node."""
    n = zeros + ones
    return (np.where((key >> (7 - level)) & 1 == 1, ones, zeros) + 0.5) / (n + 1), n > 0


def _mixed(deeper: np.ndarray, own: np.ndarray, seen: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Deeper predictions, not a number where there is none, mixed with those of seen nodes."""
    return np.where(seen, np.where(np.isnan(deeper), own, leaf * own + (1 - leaf) * deeper), deeper)


def tops(one: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Dense (zeros, ones, leaf weight) of depths 0 (by bit prefix) and 1 (by context * 256 + bit prefix).

    ``one``: node, a, b and the children's log probability ``split`` of every node of depth 1.
    """
    first, root = np.zeros((1 << 16, 3)), np.zeros((256, 3))
    node, a, b = one["node"].to_numpy(np.int64), one["a"].to_numpy(np.float64), one["b"].to_numpy(np.float64)
    own = log_estimate(a, b)
    log = np.logaddexp(_HALF + own, _HALF + one["split"].to_numpy(np.float64))
    first[node] = np.stack([a, b, np.exp(_HALF + own - log)], axis=1)
    prefix = node & 0xFF
    a, b, split = (np.bincount(prefix, x, 256) for x in (a, b, log))
    own = log_estimate(a, b)
    root[:] = np.stack([a, b, np.exp(_HALF + own - np.logaddexp(_HALF + own, _HALF + split))], axis=1)
    return root, first


def block_units(docs: DataFrame) -> DataFrame:
    """``(block, unit, c)``: distinct units of each block of documents, with their occurrences in training ones."""

    def work(part: pa.Table) -> pa.Table:
        numbering = Numbering()
        counts, met, times, n_texts = np.zeros(0, np.int64), [], [], 0
        for train in (True, False):
            # texts stay in Arrow's buffers, a run of them at a time is made words
            texts = (text.as_py() for text, own in zip(part.column("text"), part.column("train").to_pylist(), strict=True) if own == train)
            for words, sizes in numbering.batches(texts):
                pairs, n = np.unique(numbering.head_pairs(words, sizes), return_counts=True)
                met.append(pairs)
                times.append(n if train else np.zeros(len(n), np.int64))
                if train:
                    own = np.bincount(words, minlength=len(numbering.words))
                    own[:len(counts)] += counts
                    counts, n_texts = own, n_texts + len(sizes)
        counts = np.concatenate([counts, np.zeros(len(numbering.words) - len(counts), np.int64)])
        pairs, back = np.unique(np.concatenate(met), return_inverse=True)
        times = np.bincount(back, np.concatenate(times), len(pairs)).astype(np.int64)
        suffixes, heads_ = list(numbering.suffixes), list(numbering.heads)
        found = pa.chunked_array([
            pa.array((_WORD + w for w in numbering.words), pa.binary(), size=len(numbering.words)), pa.array([_WORD], pa.binary()),
            pa.array((_HEAD + suffixes[x >> 32] + b" " + heads_[x & 0xFFFFFFFF] for x in pairs.tolist()), pa.binary(), size=len(pairs))])
        c = np.concatenate([counts, [n_texts], times])
        block = np.full(len(c), part.column("block")[0].as_py(), np.int32)
        return pa.table({"block": block, "unit": found, "c": c})

    return docs.select("block", "text", "train").groupBy("block").applyInArrow(work, "block int, unit binary, c long")


def symbol_counts(vocabulary: DataFrame) -> DataFrame:
    """``(key, n)`` of all symbols of all units; n counts training occurrences and may be 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, owner = symbols(batch.column(0).to_pylist())
            found, back = np.unique(key, return_inverse=True)
            n = np.bincount(back, batch.column(1).to_numpy()[owner], len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["key", "n"])

    return vocabulary.select("unit", "c").mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def symbol_logs(counted: DataFrame) -> DataFrame:
    """``(key, log)``: the model's log10 probability of every symbol. ``counted`` is read twice."""
    buckets = max(16, math.ceil(counted.count() / SYMBOLS_A_BUCKET))
    bucketed = counted.withColumn("bucket", F.pmod(F.xxhash64(F.expr("shiftright(key, 8) & 65535")), F.lit(buckets)).cast("int"))

    def upper(part: pd.DataFrame) -> pd.DataFrame:
        found = Subtrees(part["key"].to_numpy(), part["n"].to_numpy()).upper()
        return pd.DataFrame(dict(zip(("node", "a", "b", "split"), found, strict=True)))

    one = bucketed.groupBy("bucket").applyInPandas(upper, "node long, a double, b double, split double")
    one = one.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("split").alias("split"))
    sent = counted.sparkSession.sparkContext.broadcast(tops(one.toPandas()))  # 256 x 255 rows at most

    def predicted(part: pd.DataFrame) -> pd.DataFrame:
        key = part["key"].to_numpy()
        return pd.DataFrame({"key": key, "log": Subtrees(key, part["n"].to_numpy()).predict(sent.value)})

    return bucketed.groupBy("bucket").applyInPandas(predicted, "key long, log double")


def unit_logs(vocabulary: DataFrame, logs: DataFrame) -> DataFrame:
    """``(unit, c, log)``: the model's log10 probability of what each unit codes. ``vocabulary`` has (bucket, unit, c)."""

    def wanted(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": part["bucket"].iloc[0], "key": np.unique(symbols(part["unit"].tolist())[0])})

    def summed(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        key, owner = symbols(own["unit"].tolist())
        known = known.sort_values("key")
        log = known["log"].to_numpy()[np.searchsorted(known["key"].to_numpy(), key)]
        return pd.DataFrame({"unit": own["unit"], "c": own["c"], "log": np.bincount(owner, log, len(own))})

    asked = vocabulary.groupBy("bucket").applyInPandas(wanted, "bucket int, key long").join(logs, "key")
    return vocabulary.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(summed, "unit binary, c long, log double")


def score_texts(docs: DataFrame, train: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with n_tokens, n_known, train_tokens, base_score and score; ``train`` is a boolean column."""
    spark = docs.sparkSession
    ship_package(spark)
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c not in (*results, text)]
    octets = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    blocks = max(6, math.ceil(octets / BLOCK_BYTES))
    # Copies of one text are spread over the blocks by their other columns.
    narrow = docs.select(
        F.pmod(F.xxhash64(*[f"`{c}`" for c in kept], F.length(text)), F.lit(blocks)).cast("int").alias("block"),
        F.col(text).alias("text"), F.coalesce(F.col(train), F.lit(True)).alias("train"), *[F.col(f"`{c}`").alias(f"own_{k}") for k, c in enumerate(kept)],
    )
    listed = staged(block_units(narrow), "block-units")
    size = listed.agg(F.approx_count_distinct("unit", 0.05)).first()[0]
    buckets = max(4, math.ceil(size / UNITS_A_BUCKET))
    bucket = F.pmod(F.xxhash64("unit"), F.lit(buckets)).cast("int")
    vocabulary = staged(listed.groupBy("unit").agg(F.sum("c").alias("c")).withColumn("bucket", bucket), "units")
    words = vocabulary.filter(F.col("unit").substr(1, 1) == F.lit(_WORD))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    logs = symbol_logs(staged(symbol_counts(vocabulary), "symbols"))
    known = listed.select("block", "unit").join(unit_logs(vocabulary, logs), "unit")

    def work(part: pa.Table, there: pa.Table) -> pa.Table:
        units_, c, log = there.column("unit").to_pylist(), there.column("c").to_numpy(), there.column("log").to_numpy()
        base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
        numbering = Numbering()
        numbering.add([u[1:] for u in units_ if u[:1] == _WORD and len(u) > 1])
        of_word = np.array([i for i, u in enumerate(units_) if u[:1] == _WORD and len(u) > 1], np.int64)
        of_end = next(i for i, u in enumerate(units_) if u == _WORD)
        of_pair = np.array([i for i, u in enumerate(units_) if u[:1] == _HEAD], np.int64)
        cuts = [units_[i].index(b" ") for i in of_pair.tolist()]
        pairs = np.array([numbering.suffixes[units_[i][1:at]] << 32 | numbering.heads[units_[i][at + 1:]] for i, at in zip(of_pair.tolist(), cuts, strict=True)], np.int64)
        order = np.argsort(pairs)
        pairs, of_pair = pairs[order], of_pair[order]
        del units_
        done = []
        for words, sizes in numbering.batches(x.as_py() for x in part.column("text")):
            head = of_pair[np.searchsorted(pairs, numbering.head_pairs(words, sizes))]
            own, inside = np.full(len(head), of_end), np.ones(len(head), bool)
            inside[np.cumsum(sizes + 1) - 1] = False
            own[inside] = of_word[words]
            text = np.repeat(np.arange(len(sizes)), sizes + 1)
            done.append((sizes + 1, np.bincount(text, c[own] > 0, len(sizes)).astype(np.int64), np.bincount(text, base[own], len(sizes)),
                         np.bincount(text, log[own] + log[head], len(sizes))))
        found = [np.concatenate(x) for x in zip(*done, strict=True)] if done else [[]] * 4
        columns = [pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
        return pa.Table.from_arrays([*(part.column(o) for o in owned), *columns], names=[*owned, "n_tokens", "n_known", "base_score", "score"])

    owned = [f"own_{k}" for k in range(len(kept))]
    fields = "".join(f"own_{k} {f.dataType.simpleString()}, " for k, f in enumerate(docs.select(*[f"`{c}`" for c in kept]).schema))
    scored = narrow.drop("train").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        work, f"{fields}n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        *[F.col(o).alias(c) for o, c in zip(owned, kept, strict=True)], "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


QUERY = "op2_lm_scoring"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text").withColumn("train", ~F.col("held_out"))
    return score_texts(docs, "train").drop("train")
