"""Divergence of sources against counts in plain Python, and pointer sorting against sorted()."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from chatloom.llm import source_audit as audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_documents=10, ranks=10):
    groups, counts, docs, total = set(), defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang, source].update(found)
        total[lang].update(found)
        docs[lang].update(set(found))
    out = []
    kept = {lang: [t for t, n in docs[lang].items() if n >= min_documents] for lang, _ in groups}

    def rates(count, lang):
        n, v = sum(count[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept[lang]}

    p = {g: rates(counts[g], g[0]) for g in groups}
    for lang, source in groups:
        own, q = p[lang, source], rates(total[lang], lang)
        pairs = [(s, sum((own[t] - x) ** 2 // (own[t] + x) for t, x in p[lang, s].items())) for other, s in groups if other == lang and s != source]
        terms = [(t, (own[t] - q[t]) ** 2 // (own[t] + q[t])) for t in kept[lang] if counts[lang, source][t] and own[t] > q[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < ranks]
    return sorted(out)


def ours(df, *args):
    got = audit.divergence(df, *args)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in got.collect())


def test_equal_runs_are_sorted_terms():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé日") for _ in range(rng.choice([1, 3, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))).encode() for _ in range(50)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, end = audit.pointers(data, offsets)
    terms = [bytes(data[a:b]) for a, b in zip(start, end, strict=True)]
    assert terms == [w for t in texts for w in t.split()]
    group = np.array([i % 3 for i in range(len(start))])
    got = Counter()
    for order, bounds in audit.equal_runs(data, start, end, group):
        for a, b in zip(bounds, bounds[1:], strict=False):
            run = order[a:b]
            assert len({(group[i], terms[i]) for i in run}) == 1 and list(run) == sorted(run)
            got[group[run[0]], terms[run[0]]] += len(run)
    assert got == Counter(zip(group, terms, strict=True))


def test_random_documents(spark, monkeypatch):
    monkeypatch.setattr(audit, "SLICE_BYTES", 200)
    rng = random.Random(6)
    words = ["a", "b", "B", "éa", "Éa", "longerthaneight", "longerthaneighu", "exactly8", "exactly8s", "日本", "don't", "x1y", "{z}", "~q~"]
    rows = [(rng.choice([None, "", "1 2 3"]) if rng.random() < 0.1 else " ".join(rng.choices(words, weights=range(1, 15), k=rng.randint(0, 12))),
             rng.choice(["en", "fr", None, ""]), rng.choice(["s0", "s1", "s2", None])) for _ in range(250)]
    rows += [("only here", "rare", "s9"), (None, "rare", "s8")] + rows[:20]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert ours(df) == plain(rows)
    assert ours(df, 1, 3) == plain(rows, 1, 3)


def test_odd_rows(spark, odd, none):
    named = odd.withColumnRenamed("kept", "lang").withColumnRenamed("score", "source")
    rows = [(r.text, r.lang, None if r.source is None else str(r.source)) for r in named.collect()]
    assert ours(named, 1) == plain(rows, 1)
    assert ours(named.filter("false")) == []


def test_rates_are_exact_beyond_64_bit_products():
    counts, totals = np.array([0, 5, 10**13, 3 * 10**14]), np.array([7, 11, 3 * 10**13 + 1, 3 * 10**14 + 9])
    assert audit.rate(counts, totals).tolist() == [1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts, totals, strict=True)]


def test_given_documents(spark, small):
    rows = [(r.text, r.lang, r.source) for r in small["documents"].collect()]
    assert ours(small["documents"]) == plain(rows)
