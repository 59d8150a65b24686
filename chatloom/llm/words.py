"""Words of many texts at once: boundaries and 64-bit hashes, computed on whole Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are hashed in slices of about this many bytes, so memory does not follow the batch.
SLICE_BYTES = 1_000_000

_U = np.uint64
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE, _BASE2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _inverse(base: np.uint64) -> np.uint64:
    return _U(pow(int(base), -1, 2**64))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, self.base)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = _inverse(self.base)
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(_BASE2)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all bits."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(32)
    return x


@dataclass
class Words:
    """Words of a run of documents: word i is data[start[i]:end[i]]; document d has words first[d]:first[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        up, down = _BYTES.of(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:-1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one document, with each run's first word and its document."""
    n = len(hashes)
    counts = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    up, down = _WORDS.of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[at + size] - total[at]) * down[at] + _U(size)), at, doc


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of one whole sequence of words."""
    up, _ = _WORDS.of(len(hashes) + 1)
    return mix(np.array([(hashes * up[:-1]).sum(dtype=np.uint64) + _U(len(hashes))]))[0]


def split(texts: pa.Array, lower: bool) -> Iterator[tuple[int, Words]]:
    """Words between blanks (bytes 0x20 and 0x09-0x0D) of slices of the texts, each with its first row. Null has none."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32, len(texts) + 1 + texts.offset)
    offsets = offsets[texts.offset:].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, _slice(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], lower)
        at = to


def _slice(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    if lower:
        data = _LOWER[data]
    word = np.zeros(len(data) + 2, bool)
    np.logical_not(_SEPARATOR[data], out=word[1:-1])
    edge = np.zeros(len(data) + 1, bool)  # a document's words end with it, even without a blank
    edge[offsets] = True
    start = np.flatnonzero(word[1:] & (edge | ~word[:-1]))
    end = np.flatnonzero(word[:-1] & (edge | ~word[1:]))
    return Words(data, start, end, np.searchsorted(start, offsets))
