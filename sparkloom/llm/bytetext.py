"""Vectorised words over UTF-8 buffers: boundaries and 64-bit hashes.

A word's hash is a polynomial in its bytes modulo 2**64, read off prefix sums,
then mixed.  Words are found block by block, so memory is bounded by the block
and the words of the rows given, whatever the length of a text.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BLOCK = 1 << 18

_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]

WHITESPACE_WORDS = np.ones(256, bool)
WHITESPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False

ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x41:0x5B] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers[0].size < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first word of each text and the total).

    ``table`` marks the bytes of words; a word never crosses two texts.
    """
    hashes, starts, ends = [], [], []
    at, stop = int(offsets[0]), int(offsets[-1])
    size = BLOCK
    while at < stop:
        end = min(at + size, stop)
        block = data[at:end]
        inside = table[block]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        lo, hi = np.searchsorted(offsets, (at, end))
        cuts = offsets[lo:hi] - at
        before[cuts] = False
        first = np.flatnonzero(inside & ~before)
        if end < stop and inside[-1] and table[data[end]] and not (hi < offsets.size and offsets[hi] == end):
            if first[-1] == 0:
                size *= 2
                continue
            end = at + int(first[-1])
            block, inside, first = block[: first[-1]], inside[: first[-1]], first[:-1]
            cuts = cuts[cuts < block.size]
        size = BLOCK
        if first.size:
            after = np.empty_like(inside)
            after[-1] = False
            after[:-1] = inside[1:]
            after[cuts[cuts > 0] - 1] = False
            last = np.flatnonzero(inside & ~after) + 1
            power, inverse = _tables(block.size)
            sums = np.zeros(block.size + 1, _U)
            np.cumsum((fold[block].astype(_U) + _U(1)) * power, out=sums[1:])
            hashes.append(mix((sums[last] - sums[first]) * inverse[first]))
            starts.append(first + at)
            ends.append(last + at)
        at = end
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offsets.size, np.int64)
    h, s, e = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
    return h, s, e, np.searchsorted(s, offsets)


def hash_word(word: str, fold: bool = True) -> int:
    """The hash that ``words`` gives to one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(words(raw, np.array([0, raw.size]), np.ones(256, bool), LOWER if fold else SAME)[0][0])
