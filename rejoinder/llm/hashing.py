"""Hashes of words and shingles of many texts at once, over arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from rejoinder.llm.frames import chunks, text_bytes

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=4)
def _powers(bits: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, ``2**bits`` of each."""
    inverse = pow(base, -1, 1 << 64)
    both = []
    for b in (base, inverse):
        p = np.ones(1, np.uint64)
        step = b
        while len(p) < 1 << bits:
            p = np.concatenate([p, p * _U(step)])
            step = step * step % (1 << 64)
        both.append(p)
    return both[0], both[1]


def prefix_sums(data: np.ndarray, base: int = _BASE, values: np.ndarray = _VALUES) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a polynomial over the bytes, and the factors that shift a difference to 0."""
    up, down = _powers(max(10, int(len(data)).bit_length()), base)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return sums, down


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte of every word, and the number of words before each text (one entry more).

    Words are runs of bytes other than ASCII white space; a text's end ends a word.
    """
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums, down = prefix_sums(data)
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return h, starts, np.searchsorted(starts, offsets)


_STEP = [_U(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(64)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    words, _, before = word_hashes(data, offsets)
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h += words[k : k + n] * _STEP[k]
    h = mix(h)
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= size:
            own = np.sort(h[a : b - size + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            total = _U(b - a)
            for k in range(b - a):
                total = total + words[a + k] * _STEP[k]
            sets.append(mix(np.array([total ^ _U(0xA5A5A5A5A5A5A5A5)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def texts_in_chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with the bytes of their texts and where each begins."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in chunks(batch, text, limit):
                yield part, *text_bytes(part.column(text))
