"""Operators over many texts or vectors: language model, decontamination, neighbours, joins, repeats."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F

from chatloom.llm import ann, decontamination, jaccard_join, lm_scoring, substring_dedup
from chatloom.llm.graph import components

BLANKS = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class PlainTree:
    """Context-tree weighting one bit at a time over dictionaries, with the context bytes nearest first."""

    def __init__(self):
        self.n = defaultdict(lambda: [0, 0])
        self.below = defaultdict(set)
        self.kept = {}

    def see(self, context, prefix, bit):
        for depth in range(len(context) + 1):
            self.n[context[:depth], prefix][bit] += 1
            if depth:
                self.below[context[:depth - 1], prefix].add(context[:depth])

    def logs(self, context, prefix):
        """Logs of a node's own estimate and of its weighted probability."""
        if (context, prefix) not in self.kept:
            zeros, ones = self.n[context, prefix]
            own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)
            children = self.below.get((context, prefix))
            if children:
                other = sum(self.logs(c, prefix)[1] for c in children)
                high = max(own, other)
                self.kept[context, prefix] = own, high + math.log((math.exp(own - high) + math.exp(other - high)) / 2)
            else:
                self.kept[context, prefix] = own, own
        return self.kept[context, prefix]

    def probability(self, context, prefix, bit, depth=0):
        if (context[:depth], prefix) not in self.n:
            return None
        counts = self.n[context[:depth], prefix]
        own = (counts[bit] + 0.5) / (sum(counts) + 1)
        deeper = self.probability(context, prefix, bit, depth + 1) if depth < len(context) else None
        if deeper is None:
            return own
        log_own, log_all = self.logs(context[:depth], prefix)
        leaf = math.exp(log_own - log_all) / 2
        return leaf * own + (1 - leaf) * deeper


def coded_bits(text):
    """(five bytes before, nearest first; bits of the byte so far after a one; next bit) of every bit that codes a text."""
    before = b""
    for word in [*re.findall(rb"[^ \t-\r]+", (text or "").translate(LOWER).encode()), None]:
        whole = bytes(5) + before + b" " + (b"\n" if word is None else word + b" ")
        for at in range(6 + len(before), len(whole)):
            prefix = 1
            for shift in range(7, -1, -1):
                bit = whole[at] >> shift & 1
                yield whole[at - 5:at][::-1], prefix, bit
                prefix = 2 * prefix + bit
        before = b"" if word is None else word[-2:]


def brute_scores(rows):
    """The contract's counts, and the model by its definition."""
    tree, count = PlainTree(), Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update([*re.findall(BLANKS, (text or "").translate(LOWER)), None])
            for at in coded_bits(text):
                tree.see(*at)
    total, distinct = sum(count.values()), len(count)
    for i, text in rows:
        found = [*re.findall(BLANKS, (text or "").translate(LOWER)), None]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in found)
        log = sum(math.log10(tree.probability(*at) or 0.5) for at in coded_bits(text))
        yield i, len(found), sum(count[w] > 0 for w in found), total, base, log


def score(docs):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lm_scoring.score_texts(docs.select("doc_id", held.alias("held_out"), "text").withColumn("train", ~F.col("held_out")), "train")


def test_scores_against_plain_trees(spark, small):
    odd_texts = [(1_000_001, None), (1_000_002, ""), (1_000_003, "Zürich x"), (1_000_004, "unseenwordsonly \u65e5\u672c"), (1_000_004, "unseenwordsonly \u65e5\u672c")]
    docs = small["documents"].select("doc_id", "text").limit(25)
    docs = spark.createDataFrame([*map(tuple, docs.collect()), *odd_texts], "doc_id long, text string")
    got = {r.doc_id: r for r in score(docs).collect()}
    for i, n, known, total, base, log in brute_scores([(r.doc_id, r.text) for r in docs.collect()]):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, log, rel_tol=1e-9)


def test_probabilities_of_all_bytes_sum_to_one():
    words = [lm_scoring.tokens(t) for t in ("the cat and the hat", "a cat", "thé")]
    found = Counter(u for w in words for u in lm_scoring.units(w) + lm_scoring.heads(w))
    key, owner = lm_scoring.symbols(list(found))
    keys, back = np.unique(key, return_inverse=True)
    counts = dict(zip(keys.tolist(), np.bincount(back, np.array(list(found.values()))[owner]).astype(int).tolist(), strict=True))
    for context in (keys[0] >> 8, keys[-1] >> 8, 0x7A7A7A7A7A):
        every = np.array(sorted({*counts, *range(int(context) << 8, (int(context) << 8) + 256)}), np.int64)
        trees = lm_scoring.Subtrees(every, np.array([counts.get(k, 0) for k in every.tolist()]))
        one = pd.DataFrame(dict(zip(("node", "a", "b", "split"), trees.upper(), strict=True)))
        log = trees.predict(lm_scoring.tops(one))[every >> 8 == context]
        assert len(log) == 256 and abs((10**log).sum() - 1) < 1e-9


def test_scores_of_odd_rows(odd, none):
    got = score(odd).collect()
    assert len(got) == odd.count() and all(r.n_tokens >= 1 and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert score(none).count() == 0


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog"), (2, "Fox"), (3, None), (4, ""), (5, "é 日本")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.find_hits(odd, items).collect() if r.doc_id}
    assert sorted((h.at, h.gram_size, tuple(h.item_ids)) for h in got[6].hits) == sorted(
        [(9 * k, 9, (1,)) for k in range(6)] + [(9 * k + 3, 1, (2,)) for k in range(6)])
    assert [(h.at, h.gram_size) for h in got[8].hits] == [(1, 2)] and got[1].n_words == 0
    shuffled = decontamination.find_hits(odd, items, max_broadcast=0)
    assert {(r.doc_id, len(r.hits)) for r in shuffled.collect()} == {(r.doc_id, len(r.hits)) for r in decontamination.find_hits(odd, items).collect()}
    assert {r.doc_id for r in odd.select("doc_id").collect()} - {r.doc_id for r in decontamination.drop_contaminated(odd, items).collect()} == {6, 7, 8}
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(odd, items).collect()}
    assert cut[6].strip() == "" and cut[8] == "ÄÖ   \U0001f600 word" and cut[1] is None and cut[5] == "a b c d"
    assert decontamination.drop_contaminated(odd, none.selectExpr("doc_id AS item_id", "text")).count() == odd.count()
    assert decontamination.drop_contaminated(none, items).count() == 0


def test_decontamination_of_rows_that_share_an_id_or_have_none(spark):
    gram, clean = " ".join(f"g{i}" for i in range(13)), " ".join(f"c{i}" for i in range(30))
    rows = [(None, gram), (None, clean), (1, gram), (1, clean), (1, gram), (2, f"a {gram}"), (2, f"a b {gram}"), (3, clean), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, gram), (2, "g0")], "item_id long, text string")
    bad = [gram in (t or "") for _, t in rows]
    n_words = [len((t or "").split()) for _, t in rows]
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontamination.verdicts(docs, items).collect())
    assert got == sorted((repr(i), n, 13 * b, 2 * b, b) for (i, _), n, b in zip(rows, n_words, bad, strict=True))
    left = decontamination.drop_contaminated(docs, items).collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(repr(r) for r, b in zip(rows, bad, strict=True) if not b)
    cut = sorted((repr(r.doc_id), " ".join((r.text or "").split())) for r in decontamination.remove_spans(docs, items).collect())
    assert cut == sorted((repr(i), (t or "").replace(gram, "").strip()) for i, t in rows)


def test_neighbours_against_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in small["embeddings"].collect()]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, [0.0] * 64), (1004, [float("nan")] * 64), (1005, [1.0]), (1100, [None] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score")
    got = ann.search(df.filter("vec_id % 20 = 0"), df, shard_rows=200, block_rows=10).toPandas()
    good = {i: np.array(v, float) for i, v in rows if v and len(v) == 64 and v[0] is not None and np.isfinite(v).all() and any(v)}
    ids = np.array(list(good))
    hits = 0
    for query, part in got.groupby("query_id"):
        distance = np.sqrt(((np.stack(list(good.values())) - good[query]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, distance)) if ids[i] != query][:10]
        hits += len(set(ids[order]) & set(part["vec_id"]))
        assert part.sort_values("rank")["rank"].tolist() == list(range(1, 11))
        assert all(abs(distance[list(ids).index(v)] - s) < 1e-12 for v, s in zip(part["vec_id"], part["score"], strict=True))
    assert hits >= 0.9 * len(got) and got.query_id.nunique() == sum(1 for i in good if i % 20 == 0)
    few = df.filter("vec_id in (0, 1, 2, 1002)")
    assert [r.vec_id for r in ann.search(few.filter("vec_id = 0"), few).orderBy("rank").collect()] in ([1, 2], [2, 1])
    assert ann.search(df, df.filter("false")).count() == 0


def test_repeated_query_rows_and_ids_ask_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i if i else None, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 8)))] + [(2**60 + 1, [1.0] * 8), (2**60 + 2, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    once = df.filter("vec_id IN (5, 6)")
    want = sorted(map(tuple, ann.search(once, df).collect()))
    assert sorted(map(tuple, ann.search(once.unionByName(once).unionByName(once), df).collect())) == want
    assert len(want) == 20 and [r[1] for r in want] == [*range(1, 11)] * 2
    assert ann.search(df.filter("vec_id IS NULL"), df).count() == 0
    big = ann.search(df.filter(f"vec_id = {2**60 + 1}"), df).orderBy("rank").first()
    assert big.query_id == 2**60 + 1 and big.vec_id == 2**60 + 2 and big.score == 0


def brute_components(rows, size=5):
    sets = {}
    for i, text in rows:
        w = re.findall(BLANKS, (text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    met, up = defaultdict(list), {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, own in sets.items():
        shared = Counter(j for s in own for j in met[s])
        for j, both in shared.items():
            if 100 * both >= 75 * (len(own) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for s in own:
            met[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.fixture(scope="module")
def copies(spark):
    """Near copies at all distances, over shared passages."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choices(words, k=40)) for _ in range(3)]
    rows = []
    for g in range(12):
        base = rng.choices(words, k=rng.randint(30, 300))
        for _ in range(rng.randint(1, 25)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text) + " " + rng.choice([*passages, ""])))
    return rows


@pytest.mark.parametrize("tile", [2_048, 4])
def test_join_against_brute_force(spark, copies, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rows = copies + [(9_000 + i, copies[i][1].upper()) for i in range(5)]
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_the_sketch_grows_with_the_corpus(spark):
    for gb in (1, 6, 10):  # at least a cell for ten tokens: fuller cells tell rare tokens from frequent ones no more, and families merge
        assert (1 << jaccard_join.sketch_bits(gb * 10**9)) * 10 >= gb * 10**9 // 6
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(3)] + [(3, None), (4, "one two")], "doc_id long, text string")
    name = jaccard_join.token_levels(docs, 5)
    levels = np.fromfile(SparkFiles.get(name), np.uint8)
    assert len(levels) == 1 << 16 and sorted(levels[levels > 0].tolist()) == [16, 16]


def test_join_of_odd_rows(odd, none):
    got = jaccard_join.join(odd).collect()
    assert len(got) == odd.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id}
    assert [found[i] for i in (1, 2, 3, 4)] == [(0, 1), (0, 2), (0, 3), (1, 4)]
    assert found[7] == (9, 6) and found[11] == (1, 5) and found[10] == (1, 10)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.join(none).count() == 0


def test_copies_that_share_an_id_or_have_none(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(None, a), (2, a + " end"), (3, a), (2, a + " end"), (None, b), (7, b), (7, c), (None, b), (None, d), (None, d), (None, d + " end"), (None, None), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, ((r.doc_id, r.component_id) for r in jaccard_join.join(docs).collect())))
    assert got == sorted(map(repr, zip([i for i, _ in rows], [2, 2, 2, 2, 7, 7, 7, 7, None, None, None, None, None, 9], strict=True)))
    left = [tuple(r) for r in jaccard_join.drop_copies(docs).collect()]
    only_d = [r for r in left if r[0] is None and r[1]]
    assert len(only_d) == 1 and only_d[0][1] in (d, d + " end")
    assert sorted(map(repr, set(left) - set(only_d))) == sorted(map(repr, [(2, a + " end"), (7, b), (7, c), (None, None), (9, "")])) and len(left) == 7


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(12)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def brute_cut(rows, size):
    place, cover = {}, {i: set() for i, _ in rows}
    for i, text in sorted(rows):
        w = re.findall(BLANKS, text or "")
        for s in range(len(w) - size + 1):
            if place.setdefault(tuple(w[s:s + size]), (i, s)) != (i, s):
                cover[i].update(range(s, s + size))
    return {i: (len(w := re.findall(BLANKS, t or "")), len(cover[i]), " ".join(x for k, x in enumerate(w) if k not in cover[i])) for i, t in rows}


@pytest.mark.parametrize("bits", [6, 20])
def test_repeats_against_brute_force(spark, copies, monkeypatch, bits):
    """A sketch of a few cells estimates nearly every window repeated; the result is the same."""
    monkeypatch.setattr(substring_dedup, "plan_bits", lambda docs: (bits, 5))
    rows = copies + [(8_000, "a b " * 60), (8_001, "a b " * 12 + "c"), (8_002, "A b " * 12)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 20)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()} == brute_cut(rows, 20)


def test_repeats_of_odd_rows(odd, none):
    got = substring_dedup.remove_repeats(odd).collect()
    assert len(got) == odd.count() and got[0].asDict().keys() >= {"doc_id", "score", "n_words", "n_removed", "kept"}
    found = {r.doc_id: (r.n_words, r.n_removed) for r in got if r.doc_id}
    assert found[1] == found[2] == found[3] == (0, 0) and found[9] == (80_000, 79_978 + 0) or found[9][1] > 79_900
    assert substring_dedup.remove_repeats(none).count() == 0


def test_repeats_of_rows_that_share_an_id_or_have_none(spark):
    noisy, clean, other = "a b " * 30, " ".join(f"c{k}" for k in range(60)), " ".join(f"d{k}" for k in range(25))
    rows = [(None, noisy), (None, clean), (1, clean), (2, other), (2, other), (2, "short"), (2, "short"), (None, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed) for r in got) == sorted(
        [("None", 60, 58), ("None", 60, 0), ("1", 60, 60), ("2", 25, 0), ("2", 25, 25), ("2", 1, 0), ("2", 1, 0), ("None", 0, 0)])


def test_cells_survive_packing():
    rng = np.random.default_rng(1)
    for n, width in ((0, 10), (1, 10), (50, 1 << 18), (4_000, 1 << 14), (9, 1 << 18)):
        cells = np.sort(np.repeat(rng.integers(0, width, n), rng.integers(1, 3, n)))
        assert substring_dedup.unpack(substring_dedup.pack(cells)).tolist() == cells.tolist()
