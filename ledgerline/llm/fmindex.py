"""FM-index over word numbers: wavelet matrix, backward search, matching statistics.

The text is a sequence of whole numbers; 0 is a separator that no pattern
contains. Suffixes are sorted by their first ``depth`` symbols (prefix doubling):
intervals of patterns up to that length are exact. All searches run for many
patterns in step, as array operations.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits with a count before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels):
            bit = (symbols >> (levels - 1 - level)) & 1
            self.bits.append(BitRank(bit.astype(np.uint8)))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i places end up when each level follows the symbol's bit."""
        for level in range(self.levels):
            one = self.bits[level].ones(i)
            i = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + one, i - one)
        return i


class FMIndex:
    def __init__(self, text: np.ndarray, depth: int):
        """text: symbols from 0 (separator) up; one is added at the end."""
        text = np.append(text, 0).astype(np.int64)
        self.n, self.depth = len(text), depth
        self.sa, self.lcp = self._suffixes(text, depth)
        bwt = text[self.sa - 1]
        top = int(text.max())
        self.wavelet = WaveletMatrix(bwt, max(1, top.bit_length()))
        counts = np.bincount(text, minlength=top + 1)
        self.begin = np.cumsum(counts) - counts
        self.base = self.wavelet.place(np.arange(top + 1), np.zeros(top + 1, np.int64))
        self.top = top
        self._jump: list[np.ndarray] = []

    def _suffixes(self, text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order by the first depth symbols, and common prefix lengths with
        the suffix before (never more than depth; -1 at both ends)."""
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        ranks, span = [rank], 1
        while span < depth and rank.max() < self.n - 1:
            later = np.full(self.n, 0, np.int64)
            later[:-span] = rank[span:] + 1
            rank = np.unique(rank * (self.n + 1) + later, return_inverse=True)[1].astype(np.int64)
            ranks.append(rank)
            span *= 2
        order = np.argsort(rank, kind="stable")
        a, b = order[:-1], order[1:]
        common = np.zeros(self.n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            i, j = a + common, b + common
            inside = (i < self.n) & (j < self.n)
            same = np.zeros(len(i), bool)
            same[inside] = ranks[level][i[inside]] == ranks[level][j[inside]]
            common += same * (1 << level)
        common = np.minimum(common, np.minimum(self.n - a, self.n - b))
        return order, np.concatenate([[-1], np.minimum(common, depth), [-1]])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of symbol + pattern. Unknown symbols give empty ones."""
        known = (symbol > 0) & (symbol <= self.top)
        s = np.where(known, symbol, 0)
        shift = self.begin[s] - self.base[s]
        new_lo = self.wavelet.place(s, lo) + shift
        new_hi = self.wavelet.place(s, hi) + shift
        return np.where(known, new_lo, 0), np.where(known, new_hi, 0)

    def _widen(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest intervals around these whose suffixes agree in ``length`` symbols."""
        if not self._jump:  # least lcp of 2**j neighbours from each place on
            table = [self.lcp]
            while (2 << (len(table) - 1)) <= self.n:
                half = 1 << (len(table) - 1)
                t = np.full_like(self.lcp, -1)
                t[:-half] = np.minimum(table[-1][:-half], table[-1][half:])
                table.append(t)
            self._jump = table
        lo, hi = lo.copy(), hi.copy()
        for j in range(len(self._jump) - 1, -1, -1):
            size = 1 << j
            left = lo - size + 1
            ok = (left >= 1) & (self._jump[j][np.maximum(left, 0)] >= length)
            lo = np.where(ok, lo - size, lo)
            ok = (hi + size <= self.n) & (self._jump[j][np.minimum(hi, self.n)] >= length)
            hi = np.where(ok, hi + size, hi)
        return lo, hi

    def matching_statistics(self, symbols: np.ndarray, first: np.ndarray, cap: int):
        """For every place of the patterns symbols[first[i]:first[i+1]]: length (at
        most cap) of the longest match that starts there, and a place in suffix
        order that holds it. All patterns advance in step, from their ends."""
        if cap > self.depth:
            raise ValueError("cap beyond the index's depth")
        best = np.zeros(len(symbols), np.int64)
        where = np.zeros(len(symbols), np.int64)
        size = np.diff(first)
        by = np.argsort(-size, kind="stable")
        lo, hi, length = np.zeros(len(by), np.int64), np.full(len(by), self.n), np.zeros(len(by), np.int64)
        ends, size = first[1:][by], size[by]
        capped = self.lcp >= cap  # runs of suffixes that agree in cap symbols
        run = np.cumsum(~capped[: self.n]) - 1
        run_lo = np.flatnonzero(~capped[: self.n])
        run_hi = np.append(run_lo[1:], self.n)
        for step in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -step, "left"))  # patterns with more than step symbols
            c = symbols[ends[:live] - 1 - step]
            todo = np.arange(live)
            while len(todo):
                a, b = self.extend(c[todo], lo[todo], hi[todo])
                found = b > a
                done = todo[found]
                lo[done], hi[done] = a[found], b[found]
                length[done] += 1
                over = done[length[done] > cap]
                if len(over):
                    lo[over], hi[over], length[over] = run_lo[run[lo[over]]], run_hi[run[lo[over]]], cap
                todo = todo[~found]
                todo = todo[length[todo] > 0]  # nothing matches: start again at the next symbol
                if len(todo):  # drop symbols at the far end until the interval grows
                    shorter = np.maximum(np.maximum(self.lcp[lo[todo]], self.lcp[hi[todo]]), 0)
                    shorter = np.minimum(shorter, length[todo] - 1)
                    lo[todo], hi[todo] = self._widen(lo[todo], hi[todo], shorter)
                    length[todo] = shorter
            best[ends[:live] - 1 - step] = length[:live]
            where[ends[:live] - 1 - step] = lo[:live]
        return best, where

    def least_in_runs(self, value: np.ndarray, cap: int) -> np.ndarray:
        """For each place in suffix order: least value (given by text place) among the
        suffixes that agree with it in cap symbols."""
        starts = self.lcp[: self.n] < cap
        least = np.minimum.reduceat(value[self.sa], np.flatnonzero(starts))
        return least[np.cumsum(starts) - 1]
