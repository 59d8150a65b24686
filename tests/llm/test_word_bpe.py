"""BPE by rank arrays against the library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from chatloom.llm import word_bpe


@pytest.fixture(scope="module")
def vocabulary():
    return word_bpe.vocabulary_bytes()


@pytest.fixture(scope="module")
def codec(vocabulary):
    return word_bpe.RankCodec(vocabulary)


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_str(vocabulary.decode())


def _library(library, texts):
    ids = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return ids, [library.decode(i, skip_special_tokens=False) for i in ids]


def _ours(codec, texts):
    flat, sizes, decoded = codec.encode_and_decode_all(texts)
    flat, out = flat.tolist(), []
    for size in sizes.tolist():
        out.append(flat[:size])
        del flat[:size]
    return out, decoded


def test_random_texts(codec, library):
    rng = random.Random(4)
    letters = " \n\tabcdethE,.!|:_-é日\U0001f600﻿́<>/s0x1AZ\x00ΣσİÅ\x1c\x85'sdtre½٣　"
    texts = [None, "", " \n"]
    for _ in range(4_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))
        texts.append(f"{text[:5]}<|startoftext|>{text[5:]}<|endoftext|>" if rng.random() < 0.2 else text)
    assert _ours(codec, texts) == _library(library, texts)


def test_every_code_point(codec, library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0 or 0x10D00 <= c < 0x11C00)]
    texts = [f"a{chr(c)}b1{chr(c)}" for c in codes]
    assert _ours(codec, texts) == _library(library, texts)


def test_long_words_take_the_same_merges(codec, library):
    rng = random.Random(5)
    texts = ["x" * 5_000, "ab" * 3_000, "the" * 2_000, "éa" * 900]
    texts += ["".join(rng.choice("etaoinsrhld") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    assert _ours(codec, texts) == _library(library, texts)


def test_a_full_cache_is_emptied(vocabulary, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHED", 50)
    codec = word_bpe.RankCodec(vocabulary)
    for at in range(0, 200, 20):
        texts = [f"word{i} other{i % 7}" for i in range(at, at + 20)]
        assert _ours(codec, texts) == _library(library, texts)
        assert len(codec.texts) <= 100


def test_documents(spark, vocabulary, library, odd, none, small):
    for docs in (odd, small["documents"]):
        rows = docs.select("doc_id", "text").collect()
        ids, texts = _library(library, [r.text for r in rows])
        want = sorted(repr((r.doc_id, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
                      for r, i, t in zip(rows, ids, texts, strict=True))
        got = word_bpe.digests(docs.select("doc_id", "text")).collect()
        assert sorted(repr((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got) == want
    assert word_bpe.digests(none).count() == 0
    clashing = odd.withColumnRenamed("kept", "ids").withColumnRenamed("score", "n_tokens")
    assert word_bpe.encode_documents(clashing, vocabulary).columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert word_bpe.digests(clashing).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    coded = word_bpe.encode_documents(odd, vocabulary)
    assert all(r.decoded == r.again for r in word_bpe.decode_documents(coded.withColumnRenamed("decoded", "again"), vocabulary).collect())
