"""Elias-Fano coded monotone sequences, searched for many values at once."""

import numpy as np

_ALL, _ONE = ~np.uint64(0), np.uint64(1)
_MASKS = [(w, np.uint64((1 << w) - 1)) for w in (32, 16, 8, 4, 2, 1)]


def _nth_one(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit, from 0, of each word."""
    x, n, at = words.copy(), n.astype(np.uint8), np.zeros(len(words), np.uint64)
    for width, mask in _MASKS:
        below = np.bitwise_count(x & mask)
        up = n >= below
        n = n - below * up
        step = up.astype(np.uint64) * np.uint64(width)
        x >>= step
        at += step
    return at.astype(np.int64)


class EliasFano:
    """n values in rising order, repeats allowed: low bits packed, high parts in unary, and a count per word."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str, facts: dict):
        self.low, self.high = arrays[f"{name}.low"], arrays[f"{name}.high"]
        self.ones, self.zeros = arrays[f"{name}.ones"], arrays[f"{name}.zeros"]
        self.n, self.bits, self.top = facts[name]

    @staticmethod
    def build(values: np.ndarray, name: str) -> tuple[dict[str, np.ndarray], dict]:
        """Arrays and facts to store."""
        n, last = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (last // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        top = last >> bits
        high = np.zeros(-(-(n + top + 2) // 64), np.uint64)
        at = (values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        np.bitwise_or.at(high, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])[:-1]
        zeros = np.arange(len(high), dtype=np.int64) * 64 - ones
        kind = np.uint32 if n + top < 1 << 31 else np.int64
        return (
            {f"{name}.low": low, f"{name}.high": high, f"{name}.ones": ones.astype(kind), f"{name}.zeros": zeros.astype(kind)},
            {name: (n, bits, int(top))},
        )

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        place = i * self.bits
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        out = self.low[word] >> shift
        over = shift + np.uint64(self.bits) > 64
        out[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return (out & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        at = word * 64 + _nth_one(self.high[word], i - self.ones[word].astype(np.int64))
        return ((at - i) << self.bits) | self._low(i)

    def _part(self, h: np.ndarray) -> np.ndarray:
        """How many values have a high part below h, from the place of zero number h - 1."""
        out = np.zeros(len(h), np.int64)
        later = np.flatnonzero(h)
        k = h[later] - 1
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1
        zero = word * 64 + _nth_one(~self.high[word], k - self.zeros[word].astype(np.int64))
        out[later] = zero - k
        return out

    def _end(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many values have a high part up to h: the next zero is mostly in the same word or the next one."""
        at = first + h
        word = at >> 6
        x = ~self.high[word] & (_ALL << (at & 63).astype(np.uint64))
        for _ in range(3):
            dry = np.flatnonzero(x == 0)
            if not len(dry):
                break
            word[dry] += 1
            x[dry] = ~self.high[word[dry]]
        out = word * 64 + np.bitwise_count((x & (~x + _ONE)) - _ONE) - h
        if len(dry := np.flatnonzero(x == 0)):
            out[dry] = self._part(h[dry] + 1)
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each x, or -1: the successor of x is looked for among the values of its high part, by halves."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        who = np.flatnonzero((x >= 0) & (x >> self.bits <= self.top))
        h, low = x[who] >> self.bits, x[who] & ((1 << self.bits) - 1)
        first = self._part(h)
        last = self._end(h, first)
        end = last.copy()
        on = np.flatnonzero(first < end)
        while len(on):
            middle = (first[on] + end[on]) >> 1
            below = self._low(middle) < low[on]
            first[on[below]], end[on[~below]] = middle[below] + 1, middle[~below]
            on = on[first[on] < end[on]]
        # first is the successor now; it may lie in a later part
        inside = np.flatnonzero(first < last)
        hit = inside[self._low(first[inside]) == low[inside]]
        out[who[hit]] = first[hit]
        return out
