"""1. SentencePiece encoding and decoding by a prefix table.

A merge tokenizer has one encoding for every prefix of a text, and the encoding of a prefix ends with the only token
that (a) ends there, as an automaton finds, and (b) is *compatible* with the last token of the prefix before it:
merging the two tokens' characters alone gives these two tokens again. Compatible neighbours suffice, because a merge
across a border of the whole text would also happen within the two tokens next to it. So one token per prefix is
stored, and the ids are read from the table backwards.

No piece has a blank mark after another character, nor a comma or the like after a letter, so texts are cut there. The
cuts of a batch that are not in the worker's bounded cache fill their prefix tables together, one position of all cuts
at a time; long cuts take the same steps one by one.

Cases: null and empty texts have no ids and decode to ''. Characters outside the vocabulary become byte pieces. Other
columns stay; ``ids`` and ``decoded`` are replaced where the input has such columns. Rows are independent, so repeated rows give
repeated results, and an empty table an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.registry import table
from chatloom.session import ship_package

BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
#: Entries kept by a worker; a full cache is emptied.
CACHED_CUTS, CACHED_PAIRS = 600_000, 1_000_000
#: Longer cuts are encoded alone.
TOGETHER = 48


class _IntMap:
    """A fixed map from non-negative integers, looked up many at a time; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.shift = np.uint64(64 - (len(keys) * 8).bit_length())
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            slots = np.where(self.keys[slots] >= 0, (slots + 1) % size, slots)
            free = self.keys[slots] < 0
            got, first = np.unique(np.where(free, slots, -1), return_index=True)
            first = first[got >= 0]
            self.keys[slots[first]], self.values[slots[first]] = keys[left[first]], values[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slots = left[rest], slots[rest]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], np.int32(-1))
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            there = self.keys[slots[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[slots[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return out


class PrefixCodec:
    """Encoder and decoder of one merge model (bytes of a .model file) without normalisation rules."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != trainer.BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only merge models without normalisation are supported")
        if any(p.type in (_USER, _UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = BLANK if rules.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.sizes = [len(p.piece) for p in proto.pieces]
        self.texts = {i: p.piece.replace(BLANK, " ") for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.unknown_text = trainer.unk_surface
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self._grow_trie()
        self.pairs: dict[int, bool] = {}
        self.seen_pairs = np.full(1 << 20, -1, np.int64)
        self.seen_fits = np.zeros(1 << 20, bool)
        self._forget()
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("pieces with a blank mark inside are not supported")
        # Marks that no piece has after a letter or digit: no token reaches over that border.
        marks = set(",.;:!?") - {y for p in self.ids for x, y in zip(p, p[1:]) if re.match(r"\w", x)}
        line = "" if any("\n" in p for p in self.ids) else "\n"  # a character of no piece stands alone
        other = rf"[^\w {BLANK}{line}]"
        not_mark = f"(?![{''.join(map(re.escape, sorted(marks)))}])" if marks else ""
        self.cutter = re.compile((r"\n|(?=[^\n])" if line else r"(?=[\s\S])") + rf"[ {BLANK}]*{other}*(?:\w+(?:{not_mark}{other}+)?)*")

    def _forget(self) -> None:
        """Empty the cache: the number of each known cut, and by number its text, first id and ids."""
        self.cuts: dict[str, int] = {}
        self.cut_texts: list[str] = []
        self.cut_ids = np.zeros(0, np.int32)
        self.cut_first = np.zeros(1, np.int64)

    def _grow_trie(self) -> None:
        """The automaton's goto steps as a map (state, character) -> state, for many texts at a time."""
        steps: dict[int, int] = {}
        ends = [-1]
        for piece, token in self.ids.items():
            state = 0
            for c in piece:
                key = (state << 21) + ord(c)
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(-1)
                state = steps[key]
            ends[state] = token
        self.steps = _IntMap(np.array(list(steps), np.int64), np.array(list(steps.values()), np.int32))
        self.ends = np.array(ends, np.int32)
        self.size_of = np.array(self.sizes, np.int64)
        self.text_of = np.array([self.texts.get(i, "\0") for i in range(len(self.pieces))], object)

    def merged(self, text: str) -> list[str]:
        """Merge by the rule: the pair with the best score first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """left: a token, or -1 where no merge can reach over the border."""
        key = (left + 1) * len(self.pieces) + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            want = [self.pieces[right]] if left < 0 else [self.pieces[left], self.pieces[right]]
            found = self.pairs[key] = self.merged("".join(want)) == want
        return found

    def encode_cut(self, text: str) -> list[int]:
        last = [-1] * (len(text) + 1)  # of each prefix: the last token; -1: nothing, or a character as bytes
        n, known, done = len(self.pieces), self.pairs.get, -1
        for end, (token, length) in self.automaton.iter(text):
            if end != done:
                left = last[end + 1 - length]
                fits = known((left + 1) * n + token)
                if fits or fits is None and self.compatible(left, token):
                    last[end + 1], done = token, end
        out: list[int] = []
        at = len(text)
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= self.sizes[token]
            else:
                out += reversed(self._unknown_ids(text[at - 1]))
                at -= 1
        out.reverse()
        return out

    def _fits(self, keys: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs."""
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.seen_fits[slots]
        new = np.flatnonzero(self.seen_pairs[slots] != keys)
        if len(new):
            distinct, back = np.unique(keys[new], return_inverse=True)
            fits = np.array([self.compatible(k // len(self.pieces) - 1, k % len(self.pieces)) for k in distinct.tolist()])
            out[new] = fits[back]
            self.seen_pairs[slots[new]], self.seen_fits[slots[new]] = keys[new], fits[back]
        return out

    def _encode_cuts(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short cuts, and their numbers."""
        codes = np.frombuffer("".join(cuts).replace(" ", BLANK).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        stop = np.cumsum(sizes)
        begin = stop - sizes
        own_begin, own_stop = np.repeat(begin, sizes), np.repeat(stop, sizes)
        at, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        found, depth = [], 0
        while len(at):  # every piece that occurs
            state = self.steps.get((state << 21) + codes[at + depth])
            going = state >= 0
            at, state = at[going], state[going].astype(np.int64)
            token = self.ends[state]
            hit = token >= 0
            found.append((at[hit], at[hit] + depth, token[hit]))
            depth += 1
            inside = at + depth < own_stop[at]
            at, state = at[inside], state[inside]
        first, end, token = (np.concatenate(x) for x in zip(*found, strict=True))
        length = (end - own_begin[first]).astype(np.int16)
        order = np.argsort(length, kind="stable")
        first, end, token = first[order], end[order], token[order].astype(np.int64)
        bounds = np.searchsorted(length[order], np.arange(int(sizes.max()) + 1))
        last = np.full(len(codes), -1, np.int64)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):  # the prefix tables
            f, t = first[lo:hi], token[lo:hi]
            left = np.where(f == own_begin[f], -1, last[f - 1])
            fits = self._fits((left + 1) * len(self.pieces) + t)
            last[end[lo:hi][fits]] = t[fits]
        word, place = np.arange(len(cuts)), stop.copy()
        words, tokens, lengths = [], [], np.zeros(len(cuts), np.int64)
        while len(word):  # backwards
            token = last[place - 1]
            words.append(word)
            tokens.append(np.where(token < 0, -1 - codes[place - 1], token))
            lengths[word] += 1
            place = place - np.where(token < 0, 1, self.size_of[token])
            going = place > begin[word]
            word, place = word[going], place[going]
        ids = np.empty(int(lengths.sum()), np.int64)
        slot = np.cumsum(lengths)
        for word, token in zip(words, tokens, strict=True):
            slot[word] -= 1
            ids[slot[word]] = token
        if (ids < 0).any():
            return self._with_bytes(ids, lengths)
        return ids.astype(np.int32), lengths

    def _with_bytes(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put byte pieces where an id says -1 - character."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        out: list[int] = []
        times = np.ones(len(ids), np.int64)
        done = 0
        for i in np.flatnonzero(ids < 0).tolist():
            own = self._unknown_ids(chr(-1 - int(ids[i])))
            out += ids[done:i].tolist() + own
            times[i], done = len(own), i + 1
        out += ids[done:].tolist()
        return np.array(out, np.int32), np.bincount(owner, times, len(lengths)).astype(np.int64)

    def _unknown_ids(self, character: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in character.encode()] if self.bytes else [self.unknown]

    def _learn(self, cuts: set[str]) -> None:
        short = [cut for cut in cuts if len(cut) <= TOGETHER]
        long_ = [cut for cut in cuts if len(cut) > TOGETHER]
        ids, lengths = self._encode_cuts(short) if short else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        alone = [self.encode_cut(cut.replace(" ", BLANK)) for cut in long_]
        ids = np.concatenate([ids, *(np.array(x, np.int32) for x in alone)])
        lengths = np.concatenate([lengths, np.array([len(x) for x in alone], np.int64)])
        bounds, flat = [0, *np.cumsum(lengths).tolist()], ids.tolist()
        text_of = self.text_of
        for i, cut in enumerate(short + long_):
            own = flat[bounds[i]:bounds[i + 1]]
            text = "".join([text_of[j] for j in own])
            if "\0" in text:
                text = self.decode_pieces(own)
            self.cuts[cut] = len(self.cut_texts)
            self.cut_texts.append(cut if text == cut else text)  # one object for both
        self.cut_ids = np.concatenate([self.cut_ids, ids])
        self.cut_first = np.concatenate([self.cut_first, self.cut_first[-1] + np.cumsum(lengths)])

    def encode_and_decode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts in a row, the number of ids of each, and the texts that these ids decode to."""
        cuts: list[str] = []
        ends = []
        for t in texts:
            if t:
                cuts += self.cutter.findall(" " + t if self.prefix else t)
            ends.append(len(cuts))
        numbers = list(map(self.cuts.get, cuts))
        if None in numbers:
            new = {cut for cut, number in zip(cuts, numbers, strict=True) if number is None}
            if len(self.cuts) + len(new) > CACHED_CUTS:
                self._forget()
                new = set(cuts)
            self._learn(new)
            numbers = list(map(self.cuts.__getitem__, cuts))
        text_of, at, decoded = self.cut_texts, 0, []
        for end in ends:
            decoded.append(self._unprefixed("".join([text_of[i] for i in numbers[at:end]])))
            at = end
        index = np.array(numbers, np.int64)
        first, sizes = self.cut_first[index], np.diff(self.cut_first)[index]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.cut_ids[np.arange(total[-1]) + np.repeat(first - total[:-1], sizes)]
        return ids, np.diff(total[[0, *ends]]), decoded

    def encode(self, text: str | None) -> list[int]:
        return self.encode_and_decode_all([text])[0].tolist()

    def _unprefixed(self, text: str) -> str:
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode_pieces(self, ids: Iterable[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if self.types[i] == _BYTE:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if self.types[i] == _UNKNOWN:
                out.append(self.unknown_text)
            elif self.types[i] != _CONTROL:
                out.append(self.texts[i])
        return "".join(out) + (_utf8(bytes(run)) if run else "")

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        text = self.decode_pieces(ids)
        first = next((i for i in ids if self.types[i] != _CONTROL), self.unknown)
        return self._unprefixed(text) if self.pieces[first].startswith(BLANK) else text


def _utf8(run: bytes) -> str:
    """Every byte that starts no valid character is one replacement character."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_codecs: dict[int, PrefixCodec] = {}


def _codec(model: bytes) -> PrefixCodec:
    """One per worker process."""
    key = hash(model)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = PrefixCodec(model)
    return _codecs[key]


def encode_documents(df: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """The columns of ``df`` but ``text``, with ``ids`` (array of int) and ``decoded`` (the text these ids stand for)."""
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c not in (text, "ids", "decoded")]
    sent = df.sparkSession.sparkContext.broadcast(model)  # a fixed vocabulary, about 0.5 MB
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*_quoted(kept)).schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for at in range(0, len(texts), 512):
                flat, sizes, decoded = codec.encode_and_decode_all(texts.slice(at, 512).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                own = [c.slice(at, 512) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, ids, pa.array(decoded, pa.string())], names=[*kept, "ids", "decoded"])

    source = df.select(*_quoted(kept), F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(work, f"{columns}{', ' if columns else ''}ids array<int>, decoded string")


def decode_documents(df: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its column of ids (null: '')."""
    ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != "decoded"]

    @F.pandas_udf("string")
    def decoded(column):  # noqa: ANN001, ANN202
        codec = _codec(sent.value)
        return column.map(lambda x: codec.decode(x) if x is not None else "")

    return df.select(*_quoted(kept), decoded(F.col(f"`{ids}`")).alias("decoded"))


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; the path defaults to the public 32k merge model of this machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


QUERY = "op1_sentencepiece"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def digests(docs: DataFrame) -> DataFrame:
    coded = encode_documents(docs, model_bytes())
    return coded.select(
        *[c for c in coded.columns if c not in ("ids", "decoded")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
