"""11. BPE encoding and decoding by contiguous rank arrays.

A text is normalised and cut into words; each word is a row of parts, at first its bytes, the last one marked as the
end of the word. Two short contiguous arrays describe it: its parts between the boundaries that still stand, and for
each boundary the rank of the merge across it. The smallest rank is looked for by a scan, the leftmost first; its
boundary is deleted from both arrays and the two ranks next to it are refreshed. The new words of a slice of texts
take these steps together, as rows of padded matrices of their length class. Words beyond ``SHORT`` bytes take the
same merges from a heap, since a scan per merge would be quadratic in them.

Texts repeat words, so a worker keeps the ids of words it has met in a bounded cache. Rows are independent: one pass
over Arrow batches without a shuffle, in slices of ``SLICE_BYTES`` of text.

Cases: null and empty texts have no ids and decode to ''. Other columns stay; ``ids`` and ``decoded`` are replaced
where the input has such columns. Very long texts and words are encoded whole. Repeated rows give repeated results,
and an empty table an empty one. Strings of special tokens in a text become their ids. Letters, digits and lower-case
forms are those of Unicode 16; the normal form is that of this Python, which composes a letter and an accent across
some marks newer than Unicode 10 that the library leaves apart.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.registry import table
from chatloom.llm.sentencepiece import _IntMap
from chatloom.session import ship_package

#: Longer words (in bytes) are merged from a heap.
SHORT = 128
#: Words kept by a worker, and their bytes; a full cache is emptied.
CACHED, CACHED_BYTES = 600_000, 32_000_000
SLICE_BYTES = 4_000_000
NEVER = np.int32(1 << 30)

# Letters and digits of Unicode 16 that older character tables lack, as ranges of code points.
NEW_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 "
    "113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
)
NEW_DIGITS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
# First and last capital of a range, and the small letter of the first.
NEW_CAPITALS = (
    "1C89 1C89 1C8A", "A7CB A7CB 0264", "A7CC A7CC A7CD", "A7CE A7CE A7CF", "A7D2 A7D2 A7D3", "A7D4 A7D4 A7D5",
    "A7DA A7DA A7DB", "A7DC A7DC 019B", "10D50 10D65 10D70", "16EA0 16EB8 16EBB",
)
# White space, endings that are words of their own, and the end mark of a word.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
END = "</w>"


def _members(kind: str, new: str, top: int) -> str:
    """The inside of a character class: all code points of a general category below ``top``, as ranges."""
    codes = {c for c in range(top) if unicodedata.category(chr(c))[0] == kind}
    for part in new.split():
        first, _, last = part.partition("-")
        codes.update(c for c in range(int(first, 16), int(last or first, 16) + 1) if c < top)
    ordered = sorted(codes)
    starts = [c for c in ordered if c - 1 not in codes]
    ends = [c for c in ordered if c + 1 not in codes]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends, strict=True))


def _pattern(letters: str, digits: str) -> str:
    return "|".join([f"[{letters}]+", f"[{digits}]", *ENDINGS, f"[^{SPACES}{letters}{digits}]+"])


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next one from U+0100."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shift = accumulate(b not in kept for b in range(256))
    return [chr(b) if b in kept else chr(0xFF + n) for b, n in zip(range(256), shift, strict=True)]


class RankCodec:
    def __init__(self, vocabulary: bytes) -> None:
        told = json.loads(vocabulary)
        ids: dict[str, int] = told["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.token_of = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + END] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.rank_of = _IntMap(keys, np.arange(len(pairs), dtype=np.int32))
        self.ranks = dict(zip(keys.tolist(), range(len(pairs)), strict=True))
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.patterns = [re.compile(_pattern(_members("L", NEW_LETTERS, top), _members("N", NEW_DIGITS, top))).findall for top in (0x80, 0x10000, 0x110000)]
        self.apart = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.small = {}
        for row in NEW_CAPITALS:
            first, last, to = (int(x, 16) for x in row.split())
            self.small |= {c: to + c - first for c in range(first, last + 1)}
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search
        self.newer = re.compile("[" + "".join(chr(c) for c in self.small if c < 0x10000) + "]").search
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        self.ids, self.first, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def words(self, text: str) -> list[str]:
        """Words in their normal form, and special tokens."""
        if "<|" in text:
            parts = self.apart(text)
            if len(parts) > 1:
                return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.words_between(part))]
        return self.words_between(text)

    def words_between(self, text: str) -> list[str]:
        if text.isascii():
            return self.patterns[0](text.lower())
        text = unicodedata.normalize("NFC", text)
        beyond = self.beyond(text) is not None
        if beyond or self.newer(text):
            text = text.translate(self.small)
        # lower() takes note of a word's end for the sigma only; here every letter counts alone
        return self.patterns[2 if beyond else 1](text.replace("\u03a3", "\u03c3").lower())

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and the number of ids of each."""
        coded = [w.encode() for w in words]
        sizes = np.array([0 if w in self.special else len(c) for w, c in zip(words, coded, strict=True)], np.int64)
        counts = np.zeros(len(coded), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # (words, their ids as rows padded by -1)
        low, high = 0, 8
        while low < SHORT:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(rows), 1 << 16):
                found += self._scan(rows[at:at + (1 << 16)], coded, sizes, high)
            low, high = high, high * 2
        for i in np.flatnonzero((sizes == 0) | (sizes > SHORT)).tolist():
            ids = self._heap(coded[i]) if sizes[i] else [self.special[words[i]]]
            found.append((np.array([i]), np.array([ids], np.int32)))
        for rows, ids in found:
            counts[rows] = (ids >= 0).sum(axis=1)
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        for rows, ids in found:
            there = ids >= 0
            flat[(starts[rows][:, None] + np.arange(ids.shape[1]))[there]] = ids[there]
        return flat, counts

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.rank_of.get((left.astype(np.int64) << 32 | np.maximum(right, 0)).ravel()).reshape(left.shape)
        return np.where((found < 0) | (right < 0), NEVER, found)

    def _scan(self, rows: np.ndarray, coded: list[bytes], sizes: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge words of at most ``width`` bytes; rows are given back as they come to an end."""
        out = []
        data = np.frombuffer(b"".join([coded[i].ljust(width, b"\0") for i in rows.tolist()]), np.uint8).reshape(-1, width)
        parts = np.where(np.arange(width) < sizes[rows][:, None], self.inner[data], np.int32(-1))
        own = np.arange(len(rows))
        parts[own, sizes[rows] - 1] = self.last[data[own, sizes[rows] - 1]]
        ranks = np.full(parts.shape, NEVER)  # of the merge of a part and the next one
        ranks[:, :-1] = self._ranks(parts[:, :-1], parts[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            low = ranks[own, at]
            live = low < NEVER
            if not live.all():
                out.append((rows[~live], parts[~live]))
                rows, parts, ranks, at, low = rows[live], parts[live], ranks[live], at[live], low[live]
                own = np.arange(len(rows))
                if not len(rows):
                    break
            parts[own, at] = self.merged[low]
            keep = np.ones(parts.shape, bool)
            keep[own, at + 1] = False  # the boundary goes
            parts = np.concatenate([parts[keep].reshape(len(rows), -1), np.full((len(rows), 1), -1, np.int32)], axis=1)
            ranks = np.concatenate([ranks[keep].reshape(len(rows), -1), np.full((len(rows), 1), NEVER)], axis=1)
            ranks[own, at] = self._ranks(parts[own, at], parts[own, at + 1])
            back = np.flatnonzero(at)
            ranks[back, at[back] - 1] = self._ranks(parts[back, at[back] - 1], parts[back, at[back]])
        return out

    def _heap(self, word: bytes) -> list[int]:
        ids = self.inner[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.last[word[-1]])
        rank, n = self.ranks.get, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := rank(a << 32 | b)) is not None]
        heapify(heap)
        while heap:
            low, at = heappop(heap)
            to = after[at]
            if to < 0 or ids[at] < 0 or rank(ids[at] << 32 | ids[to]) != low:
                continue  # one of the two has been merged since
            ids[at], ids[to] = int(self.merged[low]), -1
            after[at] = to = after[to]
            if to >= 0:
                before[to] = at
                if (r := rank(ids[at] << 32 | ids[to])) is not None:
                    heappush(heap, (r, at))
            back = before[at]
            if back >= 0 and (r := rank(ids[back] << 32 | ids[at])) is not None:
                heappush(heap, (r, back))
        return [i for i in ids if i >= 0]

    def _learn(self, words: list[str]) -> None:
        flat, counts = self.merge(words)
        tokens, bounds = list(map(self.token_of.__getitem__, flat.tolist())), [0, *np.cumsum(counts).tolist()]
        for i, word in enumerate(words):
            self.numbers[word] = len(self.texts)
            self.texts.append(" ".join(tokens[bounds[i]:bounds[i + 1]]))
        self.ids = np.concatenate([self.ids, flat])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        self.held += sum(map(len, words))

    def encode_and_decode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts in a row, the number of ids of each, and the texts that these ids decode to."""
        words, ends = [], []
        for text in texts:
            if text:
                words += self.words(text)
            ends.append(len(words))
        numbers = list(map(self.numbers.get, words))
        if None in numbers:
            new = dict.fromkeys(w for w, number in zip(words, numbers, strict=True) if number is None)
            if len(self.texts) + len(new) > CACHED or self.held > CACHED_BYTES:
                self.forget()
                new = dict.fromkeys(words)
            self._learn(list(new))
            numbers = list(map(self.numbers.__getitem__, words))
        at, decoded, text_of = 0, [], self.texts
        for end in ends:
            decoded.append(" ".join([text_of[i] for i in numbers[at:end]]))
            at = end
        index = np.array(numbers, np.int64)
        first, sizes = self.first[index], np.diff(self.first)[index]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(first - total[:-1], sizes)]
        return ids, np.diff(total[[0, *ends]]), decoded

    def encode(self, text: str | None) -> list[int]:
        return self.encode_and_decode_all([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens, special ones included, with a blank between; ids that stand for nothing are left out."""
        token = self.token_of.get
        return " ".join([t for i in ids if (t := token(i)) is not None])


_codecs: dict[int, RankCodec] = {}


def _codec(vocabulary: bytes) -> RankCodec:
    """One per worker process."""
    key = hash(vocabulary)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = RankCodec(vocabulary)
    return _codecs[key]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES of text."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if i > at and size + n > SLICE_BYTES:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def encode_documents(df: DataFrame, vocabulary: bytes, text: str = "text") -> DataFrame:
    """The columns of ``df`` but ``text``, with ``ids`` (array of int) and ``decoded`` (the text these ids stand for)."""
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c not in (text, "ids", "decoded")]
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)  # a fixed vocabulary, 1.7 MB
    columns = [F.col(f"`{c}`") for c in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema), "ids array<int>", "decoded string"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at, to in _slices(texts):
                flat, sizes, decoded = codec.encode_and_decode_all(texts.slice(at, to - at).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                own = [c.slice(at, to - at) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, ids, pa.array(decoded, pa.string())], names=[*kept, "ids", "decoded"])

    return df.select(*columns, F.col(f"`{text}`").alias("__text")).mapInArrow(work, schema)


def decode_documents(df: DataFrame, vocabulary: bytes, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its column of ids (null: '')."""
    ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def decoded(column):  # noqa: ANN001, ANN202
        codec = _codec(sent.value)
        return column.map(lambda x: codec.decode(x) if x is not None else "")

    return df.withColumn("decoded", decoded(F.col(f"`{ids}`")))


def vocabulary_bytes(path: str | None = None) -> bytes:
    """The vocabulary file, read on the driver; the path defaults to the public 49k word vocabulary of this machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as file:
        return file.read()


QUERY = "op11_word_bpe"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def digests(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, with the number of ids and digests of the ids and of their text."""
    coded = encode_documents(docs, vocabulary_bytes())
    return coded.select(
        *[F.col(f"`{c}`") for c in coded.columns if c not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
