"""Vectorised word splitting and hashing of whole Arrow batches, without a Python object per word.

A word is a maximal run of bytes other than ASCII white space; A-Z are lower-cased first. Each word gets a 64-bit hash:
the sum of table[byte] * P**position modulo 2**64, taken from prefix sums and then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240131))
_TABLE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
EXACT = _TABLE  # for words that keep their case
_TABLE = _TABLE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and of its inverse modulo 2**64, n of each at least."""
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, BLOCK + 1)
        up, down = np.full(n, _P), np.full(n, np.uint64(pow(int(_P), -1, 2**64)))
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _STEP[0]
    h = (h ^ (h >> np.uint64(27))) * _STEP[1]
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the len+1 offsets into them; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(texts) else (data[:0], np.zeros(1, np.int64))


def bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the len+1 offsets of each text's words; space: whether a byte separates words."""
    inside = ~space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words in order, the len+1 offsets of each text's words)."""
    data, offsets = buffers(texts)
    starts, ends, doc = bounds(data, offsets)
    return hashed(data, starts, ends), doc


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """64-bit hashes of the words at these places; table: EXACT keeps A-Z apart from a-z."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + BLOCK, side="right")))
        s, e = starts[at:to] - lo, ends[at:to] - lo
        up, down = _pow(int(e[-1]) + 1)
        sums = np.empty(int(e[-1]) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(table[data[lo : lo + e[-1]]] * up[: e[-1]], out=sums[1:])
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def shingles(words: np.ndarray, doc: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the n-word shingles of each text in order, the len+1 offsets). A text of 1 to n-1 words is one shingle."""
    size = np.diff(doc)
    step = np.array([int(_STEP[i % 5]) * (2 * (i // 5) + 1) % 2**64 for i in range(n)], dtype=np.uint64)
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    to = np.concatenate([[0], np.cumsum(count)])
    if not len(words):
        return words[:0], to
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    h = np.zeros(len(words), dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + padded[i : i + len(words)] * step[i]
    for d in np.flatnonzero((size > 0) & (size < n)):  # shorter texts: all their words
        v = np.uint64(0)
        with np.errstate(over="ignore"):
            for i in range(n):
                v = v * np.uint64(0x100000001B3) + (words[doc[d] + i] * step[i] if i < size[d] else np.uint64(0))
        h[doc[d]] = v
    at = np.repeat(doc[:-1] - to[:-1], count) + np.arange(to[-1])
    return mix(h[at]), to
