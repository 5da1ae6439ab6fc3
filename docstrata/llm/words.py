"""Words of whole texts, vectorised: the helper of the operators that hash words or shingles.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D; A-Z is
lower-cased.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SOLID = np.ones(256, dtype=bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
# Odd multipliers modulo 2**64, the first with its inverse.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK_BYTES = 2 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base, grown to the longest block seen."""

    size = 0
    power = inverse = np.zeros(0, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > cls.size:
            cls.size = max(n, min(n + n // 8, _BLOCK_BYTES) + (1 << 16))
            cls.power, cls.inverse = _powers(_BASE, cls.size), _powers(_BASE_INVERSE, cls.size)
        return cls.power[:n], cls.inverse


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a permutation of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: ``hashes[bounds[i]:bounds[i + 1]]`` are those of text i."""

    hashes: np.ndarray
    bounds: np.ndarray
    tails: np.ndarray  # the last three bytes of each word as an integer


def hash_words(texts: pa.Array) -> Words:
    """64-bit hashes of the lower-cased words of each text of a string array."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
    offsets = offsets - first
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    if not len(raw):
        return Words(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(0, np.uint32))
    solid = _SOLID[raw]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[heads] = solid[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[tails] = solid[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, inverse = _Tables.of(len(raw))
    lowered = _LOWER[raw]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(lowered * power, out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))
    tail = lowered[ends - 1].astype(np.uint32)
    for back in (2, 3):
        there = ends - back >= starts
        tail = (tail << np.uint32(9)) | np.where(there, lowered[np.maximum(ends - back, 0)], 0).astype(np.uint32)
    return Words(hashes, np.searchsorted(starts, offsets), tail)


def blocks(texts: pa.Array, size: int = _BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of an array with about ``size`` bytes of text each (a longer text stands alone)."""
    if not len(texts):
        return
    sizes = np.array(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    group = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for begin, end in zip(cuts[:-1], cuts[1:]):
        yield begin, texts.slice(begin, end - begin)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    for _, block in blocks(texts):
        words = hash_words(block)
        h, n = words.hashes, len(words.hashes)
        rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            rolled = rolled * np.uint64(0xC2B2AE3D27D4EB4F) + h[k : k + len(rolled)]
        rolled = mix(rolled)
        for begin, end in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            if end - begin >= width:
                yield np.unique(rolled[begin : end - width + 1])
            elif end > begin:
                whole = np.zeros(1, dtype=np.uint64)
                for value in h[begin:end]:
                    whole = whole * np.uint64(0xC2B2AE3D27D4EB4F) + value
                yield mix(whole + np.uint64(end - begin))
            else:
                yield np.zeros(0, dtype=np.uint64)
