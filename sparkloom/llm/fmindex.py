"""FM-index over an integer sequence: suffix order, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; a suffix that is a prefix of another comes first."""
    n = text.size
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    step = text[order]
    rank[order] = np.cumsum(np.concatenate(([0], step[1:] != step[:-1])))
    k = 1
    while rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        step = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], step[1:] != step[:-1])))
        k *= 2
    return order


class BitRank:
    """Bits packed in 64-bit words with running counts."""

    def __init__(self, bits: np.ndarray):
        self.n = bits.size
        padded = np.zeros((bits.size // 64 + 1) * 64, np.uint8)
        padded[: bits.size] = bits
        self.words = np.packbits(padded, bitorder="little").view(_U)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = self.n - int(self.before[-1])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(_U)) & _U(1)).astype(bool)


class Wavelet:
    """Wavelet matrix: access and rank of a symbol in one step per symbol bit."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels: list[tuple[int, BitRank]] = []
        for shift in reversed(range(max(1, int(symbols - 1).bit_length()))):
            bits = (values >> shift) & 1
            self.levels.append((shift, BitRank(bits)))
            values = np.concatenate((values[bits == 0], values[bits == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in the first ``i`` values, elementwise."""
        base = np.zeros_like(i)
        for shift, bits in self.levels:
            one = (symbol >> shift) & 1 == 1
            hi, lo = bits.rank1(i), bits.rank1(base)
            i = np.where(one, bits.zeros + hi, i - hi)
            base = np.where(one, bits.zeros + lo, base - lo)
        return i - base

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value at ``i``, its occurrences before ``i``)."""
        base, value = np.zeros_like(i), np.zeros_like(i)
        for shift, bits in self.levels:
            one = bits.get(i)
            hi, lo = bits.rank1(i), bits.rank1(base)
            value |= one.astype(np.int64) << shift
            i = np.where(one, bits.zeros + hi, i - hi)
            base = np.where(one, bits.zeros + lo, base - lo)
        return value, i - base


class FMIndex:
    """Counts and locates phrases of ``text``; symbol 0 separates and is never searched."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        order = suffix_array(text)
        self.n = text.size
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        before = text[order - 1]
        marked = ((order % sample == 0) | (before == 0)).astype(np.uint8)  # a walk never passes a separator
        self.wavelet = Wavelet(before.astype(np.int64), symbols)
        self.marked = BitRank(marked)
        self.sampled = order[marked == 1]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (rows): found rows, first and last suffix."""
        row = np.arange(phrases.shape[0])
        last = phrases[:, -1]
        lo, hi = self.first[last], self.first[last + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            live = hi > lo
            row, lo, hi = row[live], lo[live], hi[live]
            if not row.size:
                break
            c = phrases[row, j]
            lo, hi = self.first[c] + self.wavelet.rank(c, lo), self.first[c] + self.wavelet.rank(c, hi)
        live = hi > lo
        return row[live], lo[live], hi[live]

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step backwards to a sampled position."""
        out = np.zeros(suffix.size, np.int64)
        todo, at, steps = np.arange(suffix.size), suffix.copy(), 0
        while todo.size:
            done = self.marked.get(at)
            out[todo[done]] = self.sampled[self.marked.rank1(at[done])] + steps
            todo, at = todo[~done], at[~done]
            if todo.size:
                symbol, before = self.wavelet.access(at)
                at = self.first[symbol] + before
            steps += 1
        return out
