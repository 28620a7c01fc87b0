"""An n-gram trie in Elias-Fano coded, memory-mapped levels, looked up for many n-grams at once."""

from __future__ import annotations

import os

import numpy as np

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Place of the (k+1)-th zero bit, counted from the least, of a byte.
_ZERO_AT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if not _b >> i & 1):
        _ZERO_AT[_b, _k] = _i


class EliasFano:
    """A non-decreasing sequence of n numbers below u: log2(u / n) low bits each, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        values = values.astype(np.uint64)
        self.n = n
        self.low_bits = max(0, min(56, (max(1, universe) // max(1, n)).bit_length() - 1))
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.top = int(universe >> self.low_bits) + 1  # zeros in the high part
        bits = np.zeros((n + self.top + 7) // 8 * 8, np.uint8)
        bits[high + np.arange(n)] = 1
        self.high = np.packbits(bits, bitorder="little")
        zeros = 8 - _POPCOUNT[self.high].astype(np.int64)
        per = np.add.reduceat(zeros, np.arange(0, len(zeros), 8)) if len(zeros) else zeros
        self.rank = np.concatenate([[0], np.cumsum(per)])  # zeros before each group of eight bytes
        if self.low_bits:
            shifts = np.arange(self.low_bits, dtype=np.uint64)
            low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1)
            self.low = np.concatenate([np.packbits(low, bitorder="little"), np.zeros(8, np.uint8)])
        else:
            self.low = np.zeros(8, np.uint8)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"high": self.high, "rank": self.rank, "low": self.low}

    def lows(self, at: np.ndarray) -> np.ndarray:
        """The low bits of the numbers at those places."""
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low_bits
        word = np.zeros(len(at), np.uint64)
        for i in range(8):
            word |= self.low[(bit >> 3) + i].astype(np.uint64) << np.uint64(8 * i)
        return (word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def zero(self, k: np.ndarray) -> np.ndarray:
        """The place of the zero of number k (from 0) in the high part."""
        group = np.searchsorted(self.rank, k, "right") - 1
        rest = k - self.rank[group]
        out = np.full(len(k), -1, np.int64)
        at = group * 8
        for _ in range(8):
            byte = self.high[np.minimum(at, len(self.high) - 1)]
            zeros = 8 - _POPCOUNT[byte].astype(np.int64)
            here = (out < 0) & (rest < zeros)
            out[here] = at[here] * 8 + _ZERO_AT[byte[here], rest[here]]
            rest = rest - zeros
            at = at + 1
        return out

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upto = self.zero(high) - high
        before = np.zeros(len(high), np.int64)
        some = high > 0
        before[some] = self.zero(high[some] - 1) - (high[some] - 1)
        return before, upto

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first number >= x within x's bucket of high bits, or the bucket's end."""
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        lo, hi = self._bucket(high)
        want = x & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) // 2
            less = open_ & (self.lows(np.minimum(mid, max(0, self.n - 1))) < want)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of x in the sequence, or -1."""
        at = np.full(len(x), -1, np.int64)
        ok = (x >> np.uint64(self.low_bits)).astype(np.int64) < self.top
        some = np.flatnonzero(ok)
        if not len(some) or not self.n:
            return at
        x = x[some]
        got = self.successor(x)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        _, end = self._bucket(high)
        hit = (got < end) & (self.lows(np.minimum(got, self.n - 1)) == (x & np.uint64((1 << self.low_bits) - 1)))
        at[some] = np.where(hit, got, -1)
        return at

    def access(self, at: np.ndarray) -> np.ndarray:
        """The numbers at those places: the high part by a search over its directory of zeros."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.top - 1)
        while np.any(lo < hi):
            mid = (lo + hi) // 2
            beyond = self.zero(mid) - mid > at
            hi, lo = np.where(beyond, mid, hi), np.where(beyond, lo, mid + 1)
        return (lo.astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(at)


class Quantiser:
    """log10 values from `least` to 0 in 255 steps; code 0 is left for "absent"."""

    def __init__(self, least: float = -7.0):
        self.least = least

    def codes(self, logs: np.ndarray) -> np.ndarray:
        return (1 + np.rint((np.clip(logs, self.least, 0.0) - self.least) / -self.least * 254)).astype(np.uint8)

    def logs(self, codes: np.ndarray) -> np.ndarray:
        return self.least + (codes.astype(np.float64) - 1) / 254 * -self.least


class Trie:
    """Successors of each context, each with a quantised log10 probability.

    Level 1 has the contexts by rank; monotone Elias-Fano pointers give the range of a context's successors in level
    2. There a successor is its number in the sorted list of successor words, relative to its context: numbers of a
    range have the sum of the greatest numbers of the ranges before added, so the level is one monotone sequence in
    which a lookup is one successor search. With a folder, all levels are files that are mapped into memory.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, logs: np.ndarray, contexts: int, folder: str | None = None):
        """context, word: distinct pairs in order; context ranks are below `contexts`; logs: log10 values of them."""
        self.quantiser = Quantiser(min(-1.0, float(logs.min())) if len(logs) else -1.0)  # nothing is clipped
        self.words = np.unique(word)
        number = np.searchsorted(self.words, word).astype(np.uint64)
        counts = np.bincount(context, minlength=contexts)
        ends = np.cumsum(counts)
        self.pointers = EliasFano(np.concatenate([[0], ends]), int(ends[-1]) + 1 if contexts else 1)
        width = np.zeros(contexts, np.uint64)
        some = counts > 0
        width[some] = number[ends[some] - 1] + np.uint64(1)
        self.base = np.concatenate([[np.uint64(0)], np.cumsum(width, dtype=np.uint64)])
        self.level = EliasFano(self.base[context] + number, int(self.base[-1]) + 1)
        self.codes = self.quantiser.codes(logs)
        if folder is not None:
            self._map(folder)

    def _map(self, folder: str) -> None:
        def mapped(name: str, array: np.ndarray) -> np.ndarray:
            path = os.path.join(folder, name)
            np.save(path, array)
            return np.load(f"{path}.npy", mmap_mode="r")

        for name in ("words", "base", "codes"):
            setattr(self, name, mapped(name, getattr(self, name)))
        for name in ("pointers", "level"):
            for part, array in getattr(self, name).arrays().items():
                setattr(getattr(self, name), part, mapped(f"{name}_{part}", array))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The codes of the pairs; 0 where the trie has none."""
        out = np.zeros(len(context), np.uint8)
        if not len(self.words):
            return out
        number = np.searchsorted(self.words, word)
        known = self.words[np.minimum(number, len(self.words) - 1)] == word
        x = self.base[context] + number.astype(np.uint64)
        known &= x < self.base[context + 1]
        rows = np.flatnonzero(known)
        at = self.level.find(x[rows])
        out[rows[at >= 0]] = self.codes[at[at >= 0]]
        return out

    def successors(self, context: int) -> np.ndarray:
        """The words of a context's range."""
        a, b = self.pointers.access(np.array([context, context + 1])).astype(np.int64)
        return self.words[(self.level.access(np.arange(a, b)) - self.base[context]).astype(np.int64)]
