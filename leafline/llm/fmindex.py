"""An FM-index over the words of a shard of texts, as numpy arrays that a table's row can hold.

The shard is one sequence: the numbers of its texts' words, a separator after each text. Suffixes are sorted whole, with
separators as the smallest symbols and each different from the others, so that no comparison passes the end of a text. The
words before the sorted suffixes (the transform) stand in a wavelet matrix: a level of bits for each bit of a word's number,
with counts of set bits at each 64-bit word. One rank in it steps from the range of suffixes that begin with a phrase to those
that begin with the phrase and the word before it. Positions are kept for every RATE-th suffix and for each text's first; others
step back by ranks until one is known.
"""

from __future__ import annotations

import numpy as np

RATE = 16
ONE = np.uint64(1)


def suffixes(sym: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in their order. sym: 0 separates texts and stands at the end; equal separators are told apart
    by their place."""
    n = len(sym)
    gap = sym == 0
    rank = sym + int(gap.sum())
    rank[gap] = np.arange(1, int(gap.sum()) + 1)
    base = int(rank.max()) + 1
    h = max(1, min(8, int(62 / np.log2(base))))  # symbols that fit a key
    key, ahead = rank.copy(), rank
    for _ in range(h - 1):
        ahead = np.append(ahead[1:], 0)
        key = key * base + ahead
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = first
    live = order[~(new & np.append(new[1:], True))]
    while len(live):  # of suffixes that begin alike: by what follows, twice as far each time
        key = (rank[live] << 32) | rank[live + h]
        order = np.argsort(key)
        live, key = live[order], key[order]
        new = np.ones(len(live), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        group = np.ones(len(live), dtype=bool)
        group[1:] = (key[1:] >> 32) != (key[:-1] >> 32)
        at = np.arange(len(live))
        rank[live] = (key >> 32) + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        live = live[~(new & np.append(new[1:], True))]
        h *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, with a word more than needed, so that every rank has one to read."""
    out = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
    out[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
    return out.view(np.uint64)


def build(texts: list[np.ndarray]) -> dict[str, bytes | int]:
    """The index of texts, each the 64-bit hashes of its words, as the fields of FmIndex."""
    size = np.array([len(x) for x in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(size + 1)])
    flat = np.concatenate([*texts, np.zeros(0, np.uint64)])
    vocabulary, ids = np.unique(flat, return_inverse=True)
    sym = np.zeros(starts[-1], dtype=np.int64)
    word = np.ones(len(sym), dtype=bool)
    word[starts[1:] - 1] = False
    sym[word] = ids + 1
    order = suffixes(sym)
    row = sym[order - 1].astype(np.uint32)
    row[order == 0] = 0
    marked = order % RATE == 0
    marked |= row == 0  # a text's first word: stepping back ends there
    levels = []
    for b in range(len(vocabulary).bit_length() - 1, -1, -1):
        bit = (row >> np.uint32(b)) & np.uint32(1) != 0
        levels.append(packed(bit))
        row = np.concatenate([row[~bit], row[bit]])
    counts = np.concatenate([[0], np.cumsum(np.bincount(sym, minlength=len(vocabulary) + 1))])
    return {
        "size": len(sym),
        "starts": starts.tobytes(),
        "vocabulary": vocabulary.tobytes(),
        "counts": counts.astype(np.int64).tobytes(),
        "levels": b"".join(x.tobytes() for x in levels),
        "marked": packed(marked).tobytes(),
        "positions": order[marked].astype(np.uint32).tobytes(),
    }


class FmIndex:
    """A built index: phrases are looked up by backward search, and their occurrences located."""

    def __init__(self, size: int, starts: bytes, vocabulary: bytes, counts: bytes, levels: bytes, marked: bytes, positions: bytes) -> None:
        self.size = size
        self.starts, self.vocabulary, self.first = (np.frombuffer(x, dtype=t) for x, t in ((starts, np.int64), (vocabulary, np.uint64), (counts, np.int64)))
        self.positions = np.frombuffer(positions, dtype=np.uint32)
        self.levels = np.frombuffer(levels, dtype=np.uint64).reshape(-1, size // 64 + 1)
        self.marked = np.frombuffer(marked, dtype=np.uint64)
        self.before = [self._sums(x) for x in self.levels]
        self.zeros = [size - int(b[-1]) - int(np.bitwise_count(x[-1])) for b, x in zip(self.before, self.levels, strict=True)]
        self.marked_before = self._sums(self.marked)

    @staticmethod
    def _sums(words: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)])

    @staticmethod
    def _rank(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits in front of each place."""
        k = at >> 6
        return before[k] + np.bitwise_count(words[k] & ((ONE << (at & 63).astype(np.uint64)) - ONE))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The symbols of word hashes; 0 for words that the shard lacks."""
        if not len(self.vocabulary):
            return np.zeros(words.shape, dtype=np.int64)
        k = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[k] == words, k + 1, 0)

    def _preceded(self, sym: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For each place among the sorted suffixes, how many in front of it follow the symbol."""
        at = [np.zeros(len(sym), dtype=np.int64), *places]
        for k, (words, before, zeros) in enumerate(zip(self.levels, self.before, self.zeros, strict=True)):
            bit = (sym >> (len(self.levels) - 1 - k)) & 1 != 0
            ones = [self._rank(words, before, x) for x in at]
            at = [np.where(bit, zeros + r, x - r) for x, r in zip(at, ones, strict=True)]
        return [x - at[0] for x in at[1:]]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase, empty where there is none. phrases: word hashes, a row each,
        filled from the right; length: words of each, one at least."""
        n, width = phrases.shape
        used = np.arange(width) >= (width - length)[:, None]
        sym = self.numbers(phrases)
        low, high = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        live = np.flatnonzero((sym > 0).all(axis=1, where=used))
        low[live], high[live] = self.first[sym[live, -1]], self.first[sym[live, -1] + 1]
        for k in range(width - 2, -1, -1):
            live = live[low[live] < high[live]]
            step = live[used[live, k]]
            if not len(step):
                break
            s = sym[step, k]
            a, b = self._preceded(s, low[step], high[step])
            low[step], high[step] = self.first[s] + a, self.first[s] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places in the sequence of sorted suffixes."""
        out, steps = np.empty(len(rows), dtype=np.int64), 0
        pending = np.arange(len(rows))
        while len(pending):
            known = (self.marked[rows >> 6] >> (rows & 63).astype(np.uint64)) & ONE != 0
            out[pending[known]] = self.positions[self._rank(self.marked, self.marked_before, rows[known])].astype(np.int64) + steps
            pending, rows = pending[~known], rows[~known]
            rows = self._back(rows)
            steps += 1
        return out

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The suffixes one word longer."""
        at, low, sym = rows, np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        for words, before, zeros in zip(self.levels, self.before, self.zeros, strict=True):
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & ONE != 0
            r, r0 = self._rank(words, before, at), self._rank(words, before, low)
            at, low = np.where(bit, zeros + r, at - r), np.where(bit, zeros + r0, low - r0)
            sym = 2 * sym + bit
        return self.first[sym] + at - low
