"""BWT and common prefixes of many short documents, built column by column.

Round j puts the j-th symbol from the end of every document that long in front
of its suffix and inserts the new suffixes into the collection: their places
follow from the symbol and the row of the suffix they extend, their common
prefixes from the minimum between the extended rows.

The collection's columns are external files that are only read and written from
begin to end, a block of rows at a time: a round reads the keys to find places,
then the common prefixes for the minima, and at last writes all columns anew
with the new rows merged in.  Memory holds a block and a few numbers for each
document, never the collection.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np

from sparkloom.llm.common import file_system

#: Rows of a block of the files.
ROWS = 1 << 16
_BLOCK = 32
_LOW = np.int64(0xFFFFFFFF)
#: First symbol << 32 | row of the suffix without it; common prefix with the row before; and what a row stands for.
_COLUMNS = {"key": np.dtype(np.int64), "common": np.dtype(np.uint16), "rest": np.dtype([("bwt", np.int32), ("document", np.int32), ("offset", np.int32)])}


class Files:
    """The columns of one collection, a new file for each in every round."""

    def __init__(self, folder: str):
        self.fs, base = file_system(folder)
        self.fs.create_dir(base, recursive=True)
        self.prefix = f"{base}/{uuid.uuid4().hex}"
        self.round = 0

    def _path(self, column: str, round_: int) -> str:
        return f"{self.prefix}-{column}-{round_}"

    def read(self, column: str) -> Iterator[np.ndarray]:
        kind = _COLUMNS[column]
        with self.fs.open_input_stream(self._path(column, self.round), compression=None) as f:
            while True:
                part = f.read(ROWS * kind.itemsize)
                while 0 < len(part) < ROWS * kind.itemsize and (more := f.read(ROWS * kind.itemsize - len(part))):
                    part += more
                if not part:
                    return
                yield np.frombuffer(part, kind)

    def write(self, blocks: Iterator[dict[str, np.ndarray]]) -> None:
        """The next round's columns, block by block; the last round's files go."""
        out = {c: self.fs.open_output_stream(self._path(c, self.round + 1), compression=None) for c in _COLUMNS}
        for block in blocks:
            for c, f in out.items():
                f.write(np.ascontiguousarray(block[c]).view(np.uint8))
        for f in out.values():
            f.close()
        if self.round:
            self.remove()
        self.round += 1

    def remove(self) -> None:
        for c in _COLUMNS:
            self.fs.delete_file(self._path(c, self.round))


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo..hi] for each query, lo <= hi."""
    out = np.minimum(values[lo], values[hi])
    first, last = lo // _BLOCK, hi // _BLOCK
    wide = np.flatnonzero(last - first >= 2)
    if wide.size:
        level = [np.minimum.reduceat(values, np.arange(0, values.size, _BLOCK))]
        a, b = first[wide] + 1, last[wide] - 1
        span = np.frexp((b - a + 1).astype(float))[1] - 1
        while len(level) <= span.max():
            half = 1 << (len(level) - 1)
            level.append(np.minimum(level[-1][:-half], level[-1][half:]))
        for k in np.unique(span).tolist():
            q = span == k
            w = wide[q]
            out[w] = np.minimum(out[w], np.minimum(level[k][a[q]], level[k][b[q] - (1 << k) + 1]))
    head = np.minimum(hi, (first + 1) * _BLOCK - 1)
    tail = np.where(last > first, last * _BLOCK, hi)
    for start, stop in ((lo + 1, head), (tail, hi - 1)):
        todo = np.flatnonzero(start <= stop)
        at, end = start[todo], stop[todo]
        while todo.size:
            out[todo] = np.minimum(out[todo], values[at])
            at = at + 1
            more = at <= end
            todo, at, end = todo[more], at[more], end[more]
    return out


def streamed_min(blocks: Iterator[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``range_min`` over a column that is read once, in blocks of ``ROWS``."""
    out = np.zeros(lo.size, np.uint16)
    if not lo.size:
        return out
    first, last = lo // ROWS, hi // ROWS
    by_lo, by_hi = np.argsort(lo, kind="stable"), np.argsort(hi, kind="stable")
    least = []
    for b, block in enumerate(blocks):
        least.append(block.min())
        base = b * ROWS
        mine = by_lo[slice(*np.searchsorted(first[by_lo], (b, b + 1)))]
        within = last[mine] == b
        q = mine[within]
        if q.size:
            out[q] = range_min(block, lo[q] - base, hi[q] - base)
        q = mine[~within]
        if q.size:
            out[q] = np.minimum.accumulate(block[::-1])[::-1][lo[q] - base]
        mine = by_hi[slice(*np.searchsorted(last[by_hi], (b, b + 1)))]
        q = mine[first[mine] < b]
        if q.size:
            out[q] = np.minimum(out[q], np.minimum.accumulate(block)[hi[q] - base])
    q = np.flatnonzero(last - first >= 2)
    if q.size:
        out[q] = np.minimum(out[q], range_min(np.array(least), first[q] + 1, last[q] - 1))
    return out


class Collection:
    """Suffixes of ``documents`` in order: preceding symbol, common prefix, document and offset.

    ``symbols`` holds the documents one after another, ``bounds`` where each
    begins (and the end).  Ends of documents sort below all symbols, in order
    of the documents.  ``folder`` takes the files; ``remove`` deletes them.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, folder: str):
        self.files = Files(folder)
        n_docs = bounds.size - 1
        length = np.diff(bounds)
        self.files.write(self._ends(length))
        row = np.arange(n_docs, dtype=np.int64)
        n = n_docs
        for j in range(int(length.max()) if n_docs else 0):
            active = np.flatnonzero(length > j)
            symbol = symbols[bounds[active + 1] - 1 - j].astype(np.int64)
            new = ((symbol + 1) << 32) | row[active]
            order = np.argsort(new)
            new, active, symbol = new[order], active[order], symbol[order]
            parent = row[active]
            place, before, after = self._places(new, n)
            common, closing, update = self._common(new, parent, place, before, after, n)
            shifted = lambda r, place=place: r + np.searchsorted(place, r, side="right")
            rest = np.empty(active.size, _COLUMNS["rest"])
            rest["bwt"], rest["document"], rest["offset"] = -1, active, length[active] - 1 - j
            fresh = {"key": (new & ~_LOW) | shifted(parent), "common": common, "rest": rest}
            self.files.write(self._merged(place, fresh, shifted, parent, symbol, closing, update, n))
            row = shifted(row)
            row[active] = place + np.arange(active.size)
            n += active.size
        self.size = n

    @staticmethod
    def _ends(length: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
        for lo in range(0, length.size, ROWS):
            at = np.arange(lo, min(lo + ROWS, length.size))
            rest = np.empty(at.size, _COLUMNS["rest"])
            rest["bwt"], rest["document"], rest["offset"] = -1, at, length[at]  # -1: nothing precedes
            yield {"key": at.astype(np.int64), "common": np.zeros(at.size, np.uint16), "rest": rest}

    def _places(self, new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Old row that each new one comes before, the key that will stand before it, and the old row's key."""
        place, before, after = np.full(new.size, n), np.zeros(new.size, np.int64), np.zeros(new.size, np.int64)
        lo, base, last = 0, 0, np.int64(0)
        for block in self.files.read("key"):
            hi = int(np.searchsorted(new, block[-1], side="right"))
            p = np.searchsorted(block, new[lo:hi])
            place[lo:hi], after[lo:hi] = base + p, block[p]
            before[lo:hi] = np.where(p > 0, block[np.maximum(p - 1, 0)], last)
            lo, base, last = hi, base + block.size, block[-1]
        before[lo:] = last
        inner = np.flatnonzero(place[1:] == place[:-1]) + 1
        before[inner] = new[inner - 1]
        return place, before, after

    def _common(self, new, parent, place, before, after, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Common prefixes of the new rows, and of the old rows that come after new ones: (rows' places, values)."""
        first = np.flatnonzero(before >> 32 == new >> 32)
        closing = np.flatnonzero(np.concatenate((place[1:] != place[:-1], [True])) & (place < n))
        second = np.flatnonzero(after[closing] >> 32 == new[closing] >> 32)
        of = closing[second]
        lo = np.concatenate(((before[first] & _LOW) + 1, parent[of] + 1))
        hi = np.concatenate((parent[first], after[of] & _LOW))
        least = streamed_min(self.files.read("common"), lo, hi) + np.uint16(1)
        common, update = np.zeros(new.size, np.uint16), np.zeros(closing.size, np.uint16)
        common[first], update[second] = least[: first.size], least[first.size :]
        return common, place[closing], update

    def _merged(self, place, fresh, shifted, parent, symbol, closing, update, n: int) -> Iterator[dict[str, np.ndarray]]:
        order = np.argsort(parent)
        parent, symbol = parent[order], symbol[order]
        base = 0
        for key, common, rest in zip(*(self.files.read(c) for c in _COLUMNS), strict=True):
            key, common, rest = key.copy(), common.copy(), rest.copy()
            longer = key >> 32 > 0
            key[longer] = (key[longer] & ~_LOW) | shifted(key[longer] & _LOW)
            mine = slice(*np.searchsorted(closing, (base, base + key.size)))
            common[closing[mine] - base] = update[mine]
            mine = slice(*np.searchsorted(parent, (base, base + key.size)))
            rest["bwt"][parent[mine] - base] = symbol[mine]
            stop = base + key.size
            lo, hi = np.searchsorted(place, (base, stop))
            if stop == n:
                hi = place.size
            ahead = np.cumsum(np.bincount(place[lo:hi] - base, minlength=key.size + 1))[: key.size]
            at_old, at_new = np.arange(key.size) + ahead, place[lo:hi] - base + np.arange(hi - lo)
            block = {}
            for c, column in (("key", key), ("common", common), ("rest", rest)):
                block[c] = np.empty(key.size + hi - lo, _COLUMNS[c])
                block[c][at_old], block[c][at_new] = column, fresh[c][lo:hi]
            yield block
            base = stop

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(common prefix, the rest) of all rows in order, block by block."""
        yield from zip(self.files.read("common"), self.files.read("rest"), strict=True)

    def remove(self) -> None:
        self.files.remove()
