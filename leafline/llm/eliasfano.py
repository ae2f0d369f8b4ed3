"""Elias-Fano sequences over numpy arrays, with vectorised access and search, and flat files that hold named arrays."""

from __future__ import annotations

import json
import os
import uuid
from functools import lru_cache

import numpy as np

_BIT = np.array([[next((p for p in range(8) if (b >> p) & 1 and bin(b & ((1 << p) - 1)).count("1") == r), 0) for r in range(8)] for b in range(256)], dtype=np.uint8)
_ONE, _63 = np.uint64(1), np.uint64(63)
_1, _2, _4, _BYTES, _TOPS = map(np.uint64, (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x0101010101010101, 0x8080808080808080))


def _bit_in_word(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Position of the r-th (from 0) set bit of each word: bit counts of all bytes at once, summed from the low byte on."""
    r = r.astype(np.uint64)
    s = x - ((x >> _ONE) & _1)
    s = (s & _2) + ((s >> np.uint64(2)) & _2)
    s = ((s + (s >> np.uint64(4))) & _4) * _BYTES
    full = np.bitwise_count(((r * _BYTES | _TOPS) - s) & _TOPS).astype(np.uint64) * np.uint64(8)
    rank = r - (((s << np.uint64(8)) >> full) & np.uint64(255))
    return (full + _BIT[((x >> full) & np.uint64(255)).astype(np.int64), rank.astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of 64-bit values: `width` low bits each, packed, and the high parts in unary.

    Arrays: low and high (64-bit words), ones and zeros (set and clear bits before each word of high).
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones, self.zeros = n, width, low, high, ones, zeros

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
        if width:
            bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & _ONE).astype(np.uint8) if n * width < 1 << 24 else None
            if bits is not None:
                raw = np.packbits(bits.ravel(), bitorder="little")
            else:  # in slices whose bits end on bytes
                step = (1 << 17) * 8
                raw = np.concatenate([np.packbits(((values[i : i + step, None] >> np.arange(width, dtype=np.uint64)) & _ONE).astype(np.uint8).ravel(), bitorder="little") for i in range(0, n, step)])
        else:
            raw = np.zeros(0, np.uint8)
        low = np.zeros(len(raw) // 8 + 2, dtype=np.uint64)
        low.view(np.uint8)[: len(raw)] = raw
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) // 64 + 2 if n else 1, dtype=np.uint64)
        np.bitwise_or.at(high, at >> 6, _ONE << (at & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]])
        kind = np.uint32 if len(high) < 1 << 26 else np.int64
        return cls(n, width, low, high, ones.astype(kind), (np.arange(len(high)) * 64 - ones).astype(kind))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.shape": np.array([self.n, self.width]), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def of(cls, held: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = held[f"{name}.shape"].tolist()
        return cls(n, width, held[f"{name}.low"], held[f"{name}.high"], held[f"{name}.ones"], held[f"{name}.zeros"])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & _63
        over = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & _63), np.uint64(0))
        return ((self.low[word] >> shift) | over) & np.uint64((1 << self.width) - 1)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position in high of the k-th (from 0) set or clear bit."""
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, k.astype(before.dtype), side="right") - 1
        x = self.high[word] if ones else ~self.high[word]
        return word * 64 + _bit_in_word(x, k - before[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at indexes i."""
        i = np.asarray(i, dtype=np.int64)
        if not len(i):
            return np.zeros(0, dtype=np.uint64)
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.width)) | self._lows(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The first index of each value x, -1 where it is absent: the successor among the values that share its high part."""
        x = np.asarray(x, dtype=np.uint64)
        out = np.full(len(x), -1, dtype=np.int64)
        high = x >> np.uint64(self.width)
        ok = np.flatnonzero(high <= np.uint64(max(len(self.high) * 64 - self.n - 1, 0))) if self.n else np.zeros(0, np.int64)
        if not len(ok):
            return out
        h, low = high[ok].astype(np.int64), x[ok] & np.uint64((1 << self.width) - 1)
        bit = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) + 1, 0)
        lo = bit - h
        rest = ~(self.high[bit >> 6] >> (bit & 63).astype(np.uint64))  # a clear bit ends the bucket, mostly in the same word
        hi = end = lo + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        far = np.flatnonzero((bit & 63) + hi - lo >= 64)
        if len(far):
            hi[far] = self._select(h[far], False) - h[far]
        live = np.flatnonzero(lo < hi)
        while len(live):  # bisect the low parts of the bucket: a frequent context's successors crowd into few buckets
            mid = (lo[live] + hi[live]) >> 1
            less = self._lows(mid) < low[live]
            lo[live[less]] = mid[less] + 1
            hi = hi.copy() if hi is end else hi
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        some = np.flatnonzero(lo < end)
        some = some[self._lows(lo[some]) == low[some]]
        out[ok[some]] = lo[some]
        return out


def write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A flat file of named arrays; a task that runs again replaces the file as a whole."""
    head, at = {}, 0
    for k, v in arrays.items():
        head[k] = [str(v.dtype), list(v.shape), at]
        at += -(-v.nbytes // 64) * 64
    text = json.dumps(head).encode()
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(np.array([len(text)], dtype=np.int64).tobytes() + text)
        f.write(b"\0" * (-f.tell() % 64))
        for v in arrays.values():
            f.write(np.ascontiguousarray(v).tobytes())
            f.write(b"\0" * (-f.tell() % 64))
    os.replace(part, path)


@lru_cache(maxsize=4096)
def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    data = np.memmap(path, dtype=np.uint8, mode="r")
    n = int(data[:8].view(np.int64)[0])
    base = -(-(8 + n) // 64) * 64
    out = {}
    for k, (dtype, shape, at) in json.loads(bytes(data[8 : 8 + n])).items():
        size = int(np.prod(shape)) * np.dtype(dtype).itemsize
        out[k] = data[base + at : base + at + size].view(dtype).reshape(shape).view(np.ndarray)
    return out
