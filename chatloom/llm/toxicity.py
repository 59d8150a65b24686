"""9. Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Every word is an input vector of word and character features: the log odds that a toxic text holds this word, how often
training met it, and largest, mean and smallest log odds of its character n-grams (3 to 5 bytes, with word borders),
so unseen forms of a word are recognised by their characters. Near copies in the sample count as one text. A window of ``WINDOW`` words runs through both directions; attention
pools the states into one logit. All overlapping windows of the whole text are scored (each word is in two), and a
logistic read-out of a text's highest, third and fifth highest windows and their number gives its score: one word
that chance made is not yet a toxic text.

Fitting takes a bounded sample of the labelled rows: ``SAMPLE`` of each class by hash of the id, at most
``SAMPLE_BYTES`` together; only their ids are sent to the texts, so no other text is shuffled. One task trains on that sample. Log odds are cross-fitted in two halves, so that the network learns how far to trust them.
Labels are per text, so each step trains on the highest window of a text. The model is a few MB of fixed size.

Cases: null and empty texts have no word and get the score of an empty window. Without both classes in training every
score is 0. Repeated texts have equal scores. Empty tables give empty tables. Other columns stay; ``score`` and
``predicted`` are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import words as W
from chatloom.llm.registry import table
from chatloom.session import ship_package

WINDOW, STRIDE = 32, 16
HIDDEN, ATTENTION, FEATURES = 8, 8, 6
BUCKET_BITS = 18
GRAMS = (3, 4, 5)
SAMPLE, SAMPLE_BYTES = 2_000, 24 << 20
STEPS, BATCH, RATE = 600, 32, 0.01
THRESHOLD = 0.7
PLACES = (0, 2, 4)
_GROUP, _CLIP = 1_024, 8.0


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class Lexicon:
    """Words of a run of texts: each distinct word's bucket, length and character n-grams, and the sequence of words."""

    ids: np.ndarray
    first: np.ndarray
    bucket: np.ndarray
    length: np.ndarray
    grams: np.ndarray
    gram_word: np.ndarray

    @staticmethod
    def of(words: W.Words) -> Lexicon:
        hashes = words.hashes()
        distinct, at, ids = np.unique(hashes, return_index=True, return_inverse=True)
        start, length = words.start[at], words.end[at] - words.start[at]
        # distinct words one after the other, each between borders (byte 0)
        stop = np.cumsum(length + 2)
        begin = stop - length - 2
        owner = np.repeat(np.arange(len(at)), length + 2)
        inside = np.arange(int(stop[-1]) if len(stop) else 0) - begin[owner]
        data = np.zeros(len(owner), np.uint64)
        real = (inside > 0) & (inside <= length[owner])
        data[real] = words.data[(start[owner] + inside - 1)[real]]
        grams, gram_word = [], []
        for n in GRAMS:
            here = np.flatnonzero(inside + n <= length[owner] + 2)
            packed = np.full(len(here), n, np.uint64)
            for k in range(n):
                packed = (packed << np.uint64(8)) | data[here + k]
            grams.append(_bucket(W.mix(packed)))
            gram_word.append(owner[here])
        grams, gram_word = np.concatenate(grams), np.concatenate(gram_word)
        order = np.argsort(gram_word, kind="stable")
        bucket = _bucket(W.mix(distinct))
        small = (x.astype(np.int32) for x in (ids, words.first, bucket, length, grams[order], gram_word[order]))
        return Lexicon(*small)


@dataclass
class Odds:
    """Log odds and numbers of texts of word and n-gram buckets."""

    word: np.ndarray
    seen: np.ndarray
    gram: np.ndarray

    @staticmethod
    def of(lexicons: list[Lexicon], labels: np.ndarray, groups: np.ndarray) -> Odds:
        """Every bucket counts once for a group of near copies and label."""
        counts = np.zeros((2, 2, 1 << BUCKET_BITS), np.float64)
        for label in (0, 1):
            own = np.flatnonzero(labels == label)
            own = own[np.argsort(groups[own], kind="stable")]
            for part in np.split(own, np.flatnonzero(np.diff(groups[own])) + 1):
                if len(part):
                    for kind, found in enumerate(([lexicons[i].bucket for i in part], [lexicons[i].grams for i in part])):
                        counts[kind, label][np.unique(np.concatenate(found))] += 1
        totals = np.array([len(np.unique(groups[labels == label])) for label in (0, 1)])
        share = (counts + 0.5) / (totals[None, :, None] + 1.0)
        odds = np.clip(np.log(share[:, 1]) - np.log(share[:, 0]), -5, 5).astype(np.float32)
        return Odds(odds[0], np.log1p(counts[0].sum(axis=0)).astype(np.float32), odds[1])

    def features(self, lexicon: Lexicon) -> np.ndarray:
        """One row per distinct word, and a last one of zeros that stands for no word."""
        n = len(lexicon.bucket)
        out = np.zeros((n + 1, FEATURES), np.float32)
        if n:
            odds = self.gram[lexicon.grams]
            # a word has n-grams of three bytes at least: it has a letter and two borders
            cuts = np.searchsorted(lexicon.gram_word, np.arange(n))
            out[:n, 0] = self.word[lexicon.bucket]
            out[:n, 1] = self.seen[lexicon.bucket] / 4
            out[:n, 2] = np.maximum.reduceat(odds, cuts)
            out[:n, 3] = np.add.reduceat(odds, cuts) / np.bincount(lexicon.gram_word, minlength=n)
            out[:n, 4] = np.minimum.reduceat(odds, cuts)
            out[:n, 5] = np.log1p(lexicon.length) / 3
        return out


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window, and its text; every text has one at least."""
    counts = np.diff(first)
    each = np.maximum(1, -(-(counts - (WINDOW - STRIDE)) // STRIDE))
    text = np.repeat(np.arange(len(counts)), each)
    step = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    return first[:-1][text] + step * STRIDE, text


def gather(lexicon: Lexicon, starts: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Word of every window and place; the number of distinct words where there is none."""
    at = starts[:, None] + np.arange(WINDOW)
    end = lexicon.first[1:][text][:, None]
    ids = np.append(lexicon.ids, len(lexicon.bucket))
    return np.where(at < end, ids[np.minimum(at, len(ids) - 1)], len(lexicon.bucket))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    """Two gated recurrent layers, attention and a logit. Gates stand in the order update, reset, candidate."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        shape = {"x0": (FEATURES, 3 * HIDDEN), "h0": (HIDDEN, 3 * HIDDEN), "b0": (3 * HIDDEN,), "x1": (FEATURES, 3 * HIDDEN), "h1": (HIDDEN, 3 * HIDDEN),
                 "b1": (3 * HIDDEN,), "aw": (2 * HIDDEN, ATTENTION), "ab": (ATTENTION,), "av": (ATTENTION,), "ow": (2 * HIDDEN,), "ob": (1,)}
        net = Network({k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in ("av", "ow") else np.zeros(s)).astype(np.float32) for k, s in shape.items()})
        net.p["ob"][:] = -2
        return net

    def forward(self, ids: np.ndarray, inputs: np.ndarray, keep: bool = False):  # noqa: ANN201
        """Logits of windows (rows of ``ids``), and what the backward pass needs."""
        p, n = self.p, len(ids)
        there = (ids < len(inputs) - 1).astype(np.float32)
        states = np.zeros((WINDOW, n, 2 * HIDDEN), np.float32)
        tape = []
        for d in (0, 1):
            fed = inputs @ p[f"x{d}"] + p[f"b{d}"]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                x, g, m = fed[ids[:, t]], h @ p[f"h{d}"], there[:, t:t + 1]
                gates = _sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
                if keep:
                    tape.append((d, t, h, z, r, c, g[:, 2 * HIDDEN:], m))
                h = h + m * (1 - z) * (c - h)
                states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
        keys = np.tanh(states @ p["aw"] + p["ab"])
        weight = keys @ p["av"] + np.where(there.T > 0, np.float32(0), np.float32(-30))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logit = pooled @ p["ow"] + p["ob"]
        return (logit, (ids, inputs, tape, states, keys, weight, pooled)) if keep else logit

    def backward(self, grad: np.ndarray, saved: tuple) -> dict[str, np.ndarray]:
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        ids, inputs, tape, states, keys, weight, pooled = saved
        g["ow"], g["ob"] = pooled.T @ grad, grad.sum(keepdims=True)
        d_pool = grad[:, None] * p["ow"]
        d_states = weight[:, :, None] * d_pool
        d_weight = (states * d_pool).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["av"] = (keys * d_score[:, :, None]).sum(axis=(0, 1))
        d_keys = d_score[:, :, None] * p["av"] * (1 - keys**2)
        g["aw"] = np.einsum("tnh,tna->ha", states, d_keys)
        g["ab"] = d_keys.sum(axis=(0, 1))
        d_states = d_states + d_keys @ p["aw"].T
        d_h = [np.zeros((len(ids), HIDDEN), np.float32) for _ in (0, 1)]
        for d, t, h, z, r, c, gc, m in reversed(tape):
            up = d_h[d] + d_states[t, :, d * HIDDEN:(d + 1) * HIDDEN]
            step = up * m
            d_z = step * (h - c) * z * (1 - z)
            d_c = step * (1 - z) * (1 - c**2)
            d_r = d_c * gc * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_x = np.concatenate([d_z, d_r, d_c], axis=1)
            g[f"h{d}"] += h.T @ d_g
            g[f"x{d}"] += inputs[ids[:, t]].T @ d_x
            g[f"b{d}"] += d_x.sum(axis=0)
            d_h[d] = up - step * (1 - z) + d_g @ p[f"h{d}"].T
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p, self.t = p, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        for k, x in g.items():
            x = x * scale
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def tops(logits: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Read-out features of n texts: chosen places in the order of their window logits, number of windows, one."""
    order = np.lexsort((-logits, text))
    first = np.searchsorted(text[order], np.arange(n + 1))
    count = np.diff(first)
    out = np.full((n, len(PLACES) + 2), -_CLIP)
    for k, place in enumerate(PLACES):
        there = count > place
        out[there, k] = np.clip(logits[order[first[:-1][there] + place]], -_CLIP, _CLIP)
    out[:, -2], out[:, -1] = np.log1p(count), 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        beta += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - 0.1 * beta)
    return beta


@dataclass
class Model:
    odds: Odds
    net: Network
    readout: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability that each text is toxic."""
        out = np.zeros(len(texts))
        for row, words in W.split(texts, lower=True):
            lexicon = Lexicon.of(words)
            inputs = self.odds.features(lexicon)
            starts, text = windows_of(lexicon.first)
            parts = [slice(at, at + _GROUP) for at in range(0, len(starts), _GROUP)]
            logits = np.concatenate([self.net.forward(gather(lexicon, starts[p], text[p]), inputs) for p in parts])
            n = len(lexicon.first) - 1
            out[row:row + n] = 1 / (1 + np.exp(-np.clip(tops(logits, text, n) @ self.readout, -30, 30)))
        return out


def near_copies(texts: list[str]) -> np.ndarray:
    """A group number for each text: texts that share one of eight smallest hashes of word runs are one group."""
    up = list(range(len(texts)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    salts = np.random.default_rng(3).integers(1, 2**63, 8, dtype=np.uint64)
    met: dict[tuple[int, int], int] = {}
    for i, text in enumerate(texts):
        _, words = next(iter(W.split(pa.array([text], pa.string()), lower=True)))
        runs, _, _ = W.windows(words.hashes(), words.first, 3)
        for k, salt in enumerate(salts if len(runs) else ()):
            a, b = root(met.setdefault((k, int(W.mix(runs ^ salt).min())), i)), root(i)
            up[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(texts))])


def train(texts: list[str], labels: list[int], shares: tuple[float, float] = (1.0, 1.0)) -> Model | None:
    """None without examples of both classes. ``shares``: how many labelled texts a sampled one stands for, by class;
    the read-out weighs by the root of that, between even classes and their natural shares."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return None
    lexicons = [Lexicon.of(next(iter(W.split(pa.array([t], pa.string()), lower=True)))[1]) for t in texts]
    groups = near_copies(texts)
    # halves of groups, by label, so that both halves have both classes wherever there are two groups of each
    half = np.zeros(len(y), np.int64)
    for label in (0, 1):
        own = np.random.default_rng(11).permutation(np.unique(groups[y == label]))
        half[np.isin(groups, own[::2])] = 1
    prepared: list[tuple[np.ndarray, np.ndarray]] = [None] * len(y)
    for side in (0, 1):
        other = np.flatnonzero(half != side) if (half != side).any() else np.arange(len(y))
        odds = Odds.of([lexicons[i] for i in other], y[other], groups[other])
        for i in np.flatnonzero(half == side):
            prepared[i] = (gather(lexicons[i], *windows_of(lexicons[i].first)), odds.features(lexicons[i]))
    net = Network.fresh()
    adam = Adam(net.p)
    rng = np.random.default_rng(5)
    weight = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum()))).astype(np.float32)
    queue = np.zeros(0, np.int64)
    for step in range(STEPS):
        if len(queue) < BATCH:
            queue = np.concatenate([queue, rng.permutation(len(y))])
        chosen, queue = queue[:BATCH], queue[BATCH:]
        ids, rows, inputs = _joined([prepared[i] for i in chosen])
        logits = net.forward(ids, inputs)
        top = np.array([lo + int(logits[lo:hi].argmax()) for lo, hi in rows])
        logit, saved = net.forward(ids[top], inputs, keep=True)
        grad = (_sigmoid(logit) - y[chosen]) * weight[chosen] / len(chosen)
        adam.step(net.backward(grad.astype(np.float32), saved), RATE * (0.5 if step >= STEPS // 2 else 1.0))
    seen = [tops(net.forward(*x), np.zeros(len(x[0]), np.int64), 1)[0] for x in prepared]
    readout = logistic(np.stack(seen), y, np.sqrt(np.where(y == 1, shares[1], shares[0])))
    return Model(Odds.of(lexicons, y, groups), net, readout)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Windows and inputs of several texts as one; the row of zeros stays last."""
    ids, rows, inputs, base, at = [], [], [], 0, 0
    total = sum(len(x) - 1 for _, x in parts)
    for own, x in parts:
        ids.append(np.where(own == len(x) - 1, total, own + base))
        inputs.append(x[:-1])
        rows.append((at, at + len(own)))
        base, at = base + len(x) - 1, at + len(own)
    return np.concatenate(ids), rows, np.concatenate([*inputs, np.zeros((1, FEATURES), np.float32)])


def fitting_ids(chosen: list[tuple], sizes: dict, sample_bytes: int) -> list[tuple]:
    """Of ``(id, label)``, those whose texts fit into half the bytes for their label; one that does not takes nothing from the others."""
    out = []
    for value in (0, 1):
        left = sample_bytes // 2
        for own in [x for x in chosen if x[1] == value]:
            if (size := sizes.get(own[0], 0)) <= left:
                left -= size
                out.append(own)
    return out


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """Train on a bounded sample of ``docs`` with a label 0 or 1; the highest label of a document counts."""
    spark = docs.sparkSession
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label")).join(docs.select(F.col(doc_id).alias("id")).distinct(), "id")
    there = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [
        (r["id"], value) for value in (0, 1)
        for r in known.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    ]
    if {value for _, value in chosen} != {0, 1}:
        return None
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def of(wanted: list[tuple]) -> DataFrame:  # 2 x sample ids at most
        return source.join(F.broadcast(spark.createDataFrame(wanted, f"id {kind}, label int")), "id")

    # of the rows of one id, the first by length and text stands for it
    sizes = {r["id"]: r["size"] for r in of(chosen).groupBy("id").agg(F.min(F.octet_length("text")).alias("size")).collect()}
    fitting = fitting_ids(chosen, sizes, sample_bytes)
    if {value for _, value in fitting} != {0, 1}:
        return None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["id"], r["label"], r["text"]) for batch in batches for r in batch.to_pylist())
        if not rows:
            return
        found = [r[1] for r in rows]
        model = train([r[2] for r in rows], found, tuple(there[v] / max(1, found.count(v)) for v in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # the bounded sample meets in one task, not on the driver
    ship_package(spark)
    shortest = F.min(F.struct(F.octet_length("text").alias("size"), "text")).alias("row")
    taken = of(fitting).groupBy("id", "label").agg(shortest).select("id", "label", F.col("row.text").alias("text"))
    fitted = taken.repartition(1).mapInArrow(work, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else None


def score(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` with ``score`` and ``predicted``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        at = kept.index(text)
        for batch in batches:
            found = own.score(batch.column(at)) if own else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=[*kept, "score", "predicted"])

    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(work, f"{fields}score double, predicted int")


def held_out():  # noqa: ANN201
    """Whether a document is held out; one without an id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


QUERY = "op9_toxicity"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
