"""A compressed FM-index over integer sequences: suffixes sorted to a bounded depth, their BWT in a wavelet matrix of packed bits.

Backward search narrows the suffix interval of a pattern from its last symbol to its first; all patterns of a batch go
in step, so each level of the matrix is one vector operation. Patterns may be as long as the depth.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit sequence with rank: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bool)), bitorder="little").view("<u8")
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Of text, positive integers with 0 between sequences and at its end."""

    def __init__(self, text: np.ndarray, depth: int = 32):
        self.n = n = len(text)
        order = np.argsort(text, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], text[order][1:] != text[order][:-1])))
        width = 1
        while width < depth and rank.max() < n - 1:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            both = rank * (n + 1) + after
            order = np.argsort(both, kind="stable")
            rank = np.empty(n, np.int64)
            held = both[order]
            rank[order] = np.cumsum(np.concatenate(([0], held[1:] != held[:-1])))
            width *= 2
        bwt = text[order - 1]  # the suffix at 0 is preceded by the last separator
        self.levels: list[tuple[Bits, int]] = []
        symbols = int(text.max(initial=0)) + 1
        self.height = max(1, (symbols - 1).bit_length())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        for level in range(self.height - 1, -1, -1):
            bit = (bwt >> level & 1).astype(bool)
            zeros = int(n - bit.sum())
            self.levels.append((Bits(bit), zeros))
            bwt = np.concatenate((bwt[~bit], bwt[bit]))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern from those of the patterns."""
        base, at, end = np.zeros(len(symbol), np.int64), low, high
        for i, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.height - 1 - i) & 1).astype(bool)
            r, s, b = bits.rank(at), bits.rank(end), bits.rank(base)
            at = np.where(one, zeros + r, at - r)
            end = np.where(one, zeros + s, end - s)
            base = np.where(one, zeros + b, base - b)
        start = self.first[symbol]
        return start + at - base, start + end - base

    def search(self, text: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the pattern text[s : s + size] of each start: its matching statistic (symbols from its end that stand at
        two places or more, at most size) and its interval, which is only followed while there are two places."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        matched = np.zeros(len(starts), np.int64)
        active = np.arange(len(starts))
        for back in range(1, size + 1):
            a, b = self.extend(text[starts[active] + size - back], low[active], high[active])
            many = b - a > 1
            active, a, b = active[many], a[many], b[many]
            low[active], high[active], matched[active] = a, b, back
            if not len(active):
                break
        return matched, low, high
