"""Removal of long repeated byte strings across a corpus.

Every ``window``-byte string is looked at.  Its least k-gram (by hash, leftmost
of equals) is its anchor, so equal strings have equal anchors at equal places.
Starts with one anchor form an interval; only intervals whose anchor occurs
elsewhere can hold a repeated string and go on.

Live intervals are cut on a grid fixed to the anchor into pieces of at most
``GRID`` starts.  All strings of a grid cell share a core of
``window - GRID + 1`` bytes or more; pieces are dealt out by the core, and equal
pieces are merged before, so that a passage copied many times is one row.
Pieces of a core with very many surroundings are cut again on a grid of
``FINE`` starts, whose longer cores are dealt out anew.

In a task the core of a piece becomes one symbol between its left and right
bytes, taken ``STEP`` at a time, and the column-wise construction
(``columnbwt``) sorts the suffixes of all pieces and gives their common
prefixes: a string is repeated where its suffix shares enough symbols with a
neighbour.  Its columns are sequential files in the shared folder.  Bytes beside
a core are compared as they are, cores and whole pieces by BLAKE2 digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import bytetext
from sparkloom.llm.columnbwt import Collection
from sparkloom.llm.common import bounded, discard, fresh_path, hot_keys, join_spread, map_arrow, materialize, release, remove, slices, string_buffers

_U = np.uint64
GRID = 64
GRAM = 24
#: Starts of a cell of the finer grid, and the bytes of pieces from which a core is cut by it.
FINE = 8
HOT_BYTES = 1 << 20
#: Bytes of a symbol.
STEP = 8
#: Bytes of pieces whose collections are built at a time in a task, and of a task.
COLLECTION_BYTES = 2 << 20
TASK_BYTES = 4 << 20
#: Starts looked at, and intervals cut into pieces, at a time.
_STARTS = 1 << 20
_CUT = 1 << 13


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of the k bytes from each place on, block by block."""
    n = data.size - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.empty(n, _U)
    for lo in range(0, n, bytetext.BLOCK):
        part = data[lo : min(lo + bytetext.BLOCK, n) + k - 1]
        power, inverse = bytetext._tables(part.size)
        sums = np.zeros(part.size + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * power, out=sums[1:])
        out[lo : lo + part.size - k + 1] = bytetext.mix((sums[k:] - sums[:-k]) * inverse[: part.size - k + 1])
    return out


def span_hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of each byte range [lo, hi)."""
    out = np.zeros(lo.size, _U)
    order = np.argsort(lo, kind="stable")
    at = 0
    while at < lo.size:
        base = int(lo[order[at]])
        stop = int(np.searchsorted(lo[order], base + bytetext.BLOCK))
        mine = order[at:stop]
        part = data[base : int(hi[mine].max())]
        power, inverse = bytetext._tables(part.size + 1)
        sums = np.zeros(part.size + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * power[: part.size], out=sums[1:])
        out[mine] = (sums[hi[mine] - base] - sums[lo[mine] - base]) * inverse[lo[mine] - base]
        at = stop
    return bytetext.mix(out + (hi - lo).astype(_U) * _U(0x9FB21C651E98DF25))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on."""
    size, step = 1, values
    while size * 2 <= width:
        step = np.minimum(step[:-size], step[size:])
        size *= 2
    return np.minimum(step[: values.size - width + 1], step[width - size : width - size + values.size - width + 1])


def intervals(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``_intervals`` of some starts at a time, however long the texts; one that spans two goes in two parts."""
    for lo in range(int(offsets[0]), int(offsets[-1]), _STARTS):
        hi = min(lo + _STARTS + window - 1, int(offsets[-1]))
        first, last = int(np.searchsorted(offsets, lo, side="right")) - 1, int(np.searchsorted(offsets, hi))
        d, *rest = _intervals(data, np.clip(offsets[first : last + 1], lo, hi), window, gram)
        yield d + first, *rest


def _intervals(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first and last start, anchor place (all in ``data``) and anchor hash of every interval."""
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, _U),)
    base = int(offsets[0])
    body = data[base : int(offsets[-1])]
    if body.size < window:
        return empty
    hashes = gram_hashes(body, gram)
    least = np.empty(body.size - window + 1, np.int64)
    width = window - gram + 1
    for lo in range(0, least.size, bytetext.BLOCK):
        hi = min(lo + bytetext.BLOCK, least.size)
        keyed = (hashes[lo : hi + width - 1] & ~_U(0xFFFFFFFF)) | np.arange(hi + width - 1 - lo, dtype=_U)
        least[lo:hi] = (sliding_min(keyed, width) & _U(0xFFFFFFFF)).astype(np.int64) + lo
    ends = offsets[1:] - base
    doc = np.searchsorted(ends, np.arange(least.size), side="right")
    valid = np.flatnonzero(np.arange(least.size) + window <= ends[np.minimum(doc, ends.size - 1)])
    if not valid.size:
        return empty
    p, d = least[valid], doc[valid]
    first = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (d[1:] != d[:-1]))))
    last = np.append(first[1:], valid.size) - 1
    return d[first], valid[first] + base, valid[last] + base, p[first] + base, hashes[p[first]]


class _Intervals:
    """mapInArrow on (k1, k2, text): (anchor, k1, k2, s, e, p), places within the text."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                data, offsets = string_buffers(batch.column(2))
                for d, s, e, p, anchor in intervals(data, offsets, self.window, self.gram):
                    at, own = pa.array(d), offsets[d]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), *[pa.array((x - own).astype(np.int32)) for x in (s, e, p)]], names=["anchor", "k1", "k2", "s", "e", "p"])


_PIECE = "core bigint, core2 bigint, width int, c bigint, left int, sym binary"
_NAMES = [x.split()[0] for x in _PIECE.split(", ")]


def _digests(parts: Iterator[bytes], n: int) -> np.ndarray:
    """128-bit digests as two columns."""
    return np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in parts), np.int64).reshape(n, 2)


def _bytes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[bytes]:
    view = memoryview(data)
    return (view[s:e] for s, e in zip(lo.tolist(), hi.tolist(), strict=True))


def _gathered(data: np.ndarray, lo: np.ndarray, mid: np.ndarray, again: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data[lo:mid] + data[again:hi] of every row, one after another, and the bounds."""
    left = mid - lo
    size = left + hi - again
    bounds = np.concatenate(([0], np.cumsum(size)))
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
    source = within + np.where(within < np.repeat(left, size), np.repeat(lo, size), np.repeat(again - left, size))
    return (data[source] if source.size else np.zeros(0, np.uint8)), bounds


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), bounds.size - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(values.tobytes())])


class _Pieces:
    """mapInArrow on (k1, k2, live, text): pieces (k1, k2, s and ``_PIECE``)."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, reach = self.window, self.window - self.gram
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                data, offsets = string_buffers(batch.column(3))
                live = batch.column(2)
                flat = live.flatten()
                every = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(live.offsets)))
                for at in range(0, every.size, _CUT):
                    d = every[at : at + _CUT]
                    own = offsets[d]
                    s, e, p = (np.asarray(flat.field(n))[at : at + _CUT].astype(np.int64) + own for n in ("s", "e", "p"))
                    parts = []
                    for cell in range(reach // GRID + 1):
                        lo = p - reach + cell * GRID
                        hi = np.minimum(p, lo + GRID - 1)
                        a, b = np.maximum(s, lo), np.minimum(e, hi)
                        ok = a <= b
                        parts.append((d[ok], a[ok], b[ok], lo[ok], hi[ok]))
                    d, a, b, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
                    yield self._batch(batch, data, offsets, d, a, b, lo, hi, w)

    @staticmethod
    def _batch(batch, data, offsets, d, a, b, lo, hi, w) -> pa.RecordBatch:
        core = _digests(_bytes(data, hi, lo + w), d.size)
        whole = _digests(_bytes(data, a, b + w), d.size)
        sym, bounds = _gathered(data, a, hi, lo + w, b + w)
        at = pa.array(d)
        numbers = [pa.array(x.astype(k)) for x, k in ((core[:, 0], np.int64), (core[:, 1], np.int64), (hi - lo + 1, np.int32), (whole[:, 0] ^ (hi - a), np.int64), (hi - a, np.int32))]
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array((a - offsets[d]).astype(np.int32)), *numbers, _binary(sym, bounds)], names=["k1", "k2", "s", *_NAMES])


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return raw, offsets


class _Recut:
    """mapInArrow on pieces of hot cores: their parts on the finer grid, with the parent's key and the shift of its starts."""

    def __init__(self, window: int):
        self.window = window

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core, core2, width, c, left, several = (np.asarray(batch.column(n)) for n in ("core", "core2", "width", "c", "left", "several"))
            sym, bounds = _buffers(batch.column(batch.schema.get_field_index("sym")))
            # A start with k bytes left of the core has width - 1 - k right of it.
            least = left - (np.diff(bounds) - width + 1)
            middle = bounds[:-1] + left
            for j in range(GRID // FINE):
                low = FINE * j
                high = np.minimum(low + FINE, width) - 1
                most, fewest = np.minimum(left, high), np.maximum(least, low)
                at = np.flatnonzero(most >= fewest)
                if not at.size:
                    continue
                m, kept = middle[at], width[at] - 1 - high[at]
                inner, edges = _gathered(sym, m - low, m, m, m + kept)
                head = np.stack((core[at], core2[at], np.full(at.size, j), width[at]), axis=1).astype(np.int64)
                name = _digests((h.tobytes() + x.tobytes() for h, x in zip(head, np.split(inner, edges[1:-1]), strict=True)), at.size)
                outer, edges = _gathered(sym, m - most[at], m - low, m + kept, m + width[at] - 1 - fewest[at])
                rows = [pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array((high[at] - low + 1).astype(np.int32)), pa.array((most[at] - low).astype(np.int32)), _binary(outer, edges), pa.array(several[at])]
                parent = [pa.array(x[at]) for x in (core, core2, c)] + [pa.array((left[at] - most[at]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*rows, *parent], names=["deal", "deal2", "width", "left", "sym", "several", "core", "core2", "c", "shift"])


def _packed(padded: np.ndarray, at: np.ndarray, size) -> np.ndarray:
    """Up to 7 bytes from each place on as one number."""
    out = np.zeros(at.size, _U)
    for k in range(STEP - 1):
        out |= np.where(k < size, padded[np.minimum(at + k, padded.size - 1)] << _U(8 * k), _U(0))
    return out


def repeated_starts(group: np.ndarray, width: np.ndarray, left: np.ndarray, sym: np.ndarray, bounds: np.ndarray, several: np.ndarray, folder: str) -> np.ndarray:
    """For each piece a mask of its starts whose string occurs elsewhere too.

    ``group`` numbers the cores.  A piece becomes up to ``STEP`` documents, one
    for each distance of a start to the core modulo ``STEP``: symbols of
    ``STEP`` bytes, and one symbol for the core with the few bytes that fill up
    on either side.  Documents of one distance are a collection; every start of
    a document then needs the same number of symbols.  A document alone with
    its core symbol repeats only as a whole piece does.
    """
    size = np.diff(bounds)
    right = size - left
    starts = size - width + 2  # left + right = width - 1 + starts - 1
    full = np.where(starts >= 64, ~_U(0), (_U(1) << np.minimum(starts, 63).astype(_U)) - _U(1))
    out = np.where(several, full, _U(0))
    padded = np.concatenate((sym, np.zeros(STEP, np.uint8))).astype(_U)
    for f in range(STEP):
        fill = (width - 1 - f) % STEP
        most = (left - f) // STEP
        least = np.maximum(0, -((right + 1 + f - width) // STEP))
        piece = np.flatnonzero((left >= f) & (f < width) & (least <= most) & (right >= fill))
        core_at = bounds[piece] + left[piece]
        name = np.stack((group[piece].astype(_U), _packed(padded, core_at - f, f), _packed(padded, core_at, fill[piece])), axis=1)
        _, core_id, count = np.unique(name, axis=0, return_inverse=True, return_counts=True)
        core_id = core_id.ravel()
        shared = count[core_id] > 1
        if not shared.any():
            continue
        piece, core_at, core_id = piece[shared], core_at[shared], core_id[shared]
        most, least, fill, reach = most[piece], least[piece], fill[piece], width[piece]
        length = most + 1 + (right[piece] - fill) // STEP
        at = np.concatenate(([0], np.cumsum(length)))
        within = np.arange(at[-1]) - np.repeat(at[:-1], length)
        source = np.where(within <= np.repeat(most, length), np.repeat(core_at - f - STEP * most, length), np.repeat(core_at + fill - STEP * (most + 1), length)) + STEP * within
        mark = at[:-1] + most
        source[mark] = 0
        blocks = np.zeros(source.size, _U)
        for k in range(STEP):
            blocks |= padded[source + k] << _U(8 * k)
        dense = np.unique(blocks, return_inverse=True)[1].astype(np.int64)
        dense[mark] = core_id + dense.max() + 1
        found = Collection(dense, at, folder)
        need = 1 + (reach - 1 - f - fill) // STEP
        for d, k in _long(found, need, most - least):
            bit = left[piece[d]] - STEP * (most[d] - k) - f
            np.bitwise_or.at(out, piece[d], _U(1) << bit.astype(_U))
        found.remove()
    return out


def _long(found: Collection, need: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, offset) of suffixes, from offsets up to ``last``, that share ``need`` symbols with a neighbour."""
    held = None
    for common, rest in found.rows():
        if held is not None:
            common, rest = np.concatenate((held[0], common)), np.concatenate((held[1], rest))
        held = common[-1:], rest[-1:]  # its right neighbour is in the next block
        yield _hits(common[:-1], common[1:], rest[:-1], need, last)
    if held is not None:
        yield _hits(held[0], np.zeros(1, np.uint16), held[1], need, last)


def _hits(common, follow, rest, need, last) -> tuple[np.ndarray, np.ndarray]:
    d, k = rest["document"], rest["offset"]
    hit = (k <= last[d]) & ((common >= need[d]) | (follow >= need[d]))
    return d[hit], k[hit]


class _Construct:
    """mapInArrow on unique pieces, dealt and sorted by core: the parents' keys and masks of their starts."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            lo, core = 0, np.asarray(batch.column(0))
            ends = np.append(np.flatnonzero(core[1:] != core[:-1]) + 1, core.size)
            weight = (np.diff(_buffers(batch.column(4))[1]) + 1).cumsum()
            while lo < core.size:
                if held and held[-1].column(0)[-1].as_py() != int(core[lo]) and size >= COLLECTION_BYTES:
                    yield self._solve(held)
                    held, size = [], 0
                done = weight[lo - 1] if lo else 0
                hi = int(ends[min(ends.size - 1, np.searchsorted(weight[ends - 1], done + max(1, COLLECTION_BYTES - size)))])
                held.append(batch.slice(lo, hi - lo))
                size += int(weight[hi - 1] - done)
                lo = hi
        if held:
            yield self._solve(held)

    def _solve(self, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        deal, deal2, width, left, several, shift = (np.asarray(t.column(n)) for n in ("deal", "deal2", "width", "left", "several", "shift"))
        sym = t.column("sym").combine_chunks()
        raw, offsets = _buffers(sym.chunk(0) if isinstance(sym, pa.ChunkedArray) else sym)
        group = np.unique(np.stack((deal, deal2, width), axis=1), axis=0, return_inverse=True)[1].ravel()
        mask = repeated_starts(group, width.astype(np.int64), left.astype(np.int64), raw[offsets[0] : offsets[-1]], offsets - offsets[0], several, self.folder)
        some = np.flatnonzero(mask)
        mask = mask[some] << shift[some].astype(_U)
        return pa.RecordBatch.from_arrays([*[pa.array(np.asarray(t.column(n))[some]) for n in ("core", "core2", "c")], pa.array(mask.view(np.int64))], names=["core", "core2", "c", "mask"])


class _Cut:
    """mapInArrow on (row, text, marks, copied): what is removed and what stays."""

    def __init__(self, window: int, text: bool):
        self.window, self.text = window, text

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                data, offsets = string_buffers(batch.column(1))
                gone = self._gone(data, offsets, batch.column(2), np.asarray(batch.column(3).fill_null(False)))
                begin = gone & ~np.concatenate(([False], gone[:-1]))
                begin[offsets[:-1][np.diff(offsets) > 0] - offsets[0]] |= gone[offsets[:-1][np.diff(offsets) > 0] - offsets[0]]
                of = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[offsets - offsets[0]])
                removed, spans = of(gone), of(begin)
                rest = data[offsets[0] : offsets[-1]][~gone]
                bounds = np.concatenate(([0], np.cumsum(np.diff(offsets) - removed)))
                kept = list(_bytes(rest, bounds[:-1], bounds[1:]))
                cols = [pa.array(x, pa.int64()) for x in (np.diff(offsets), removed, spans)] + [pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if self.text:
                    cols.append(pa.array([bytes(x) for x in kept], pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["row", *names])

    def _gone(self, data: np.ndarray, offsets: np.ndarray, marks: pa.Array, copied: np.ndarray) -> np.ndarray:
        """For each byte of the texts whether it goes."""
        base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
        flat = marks.flatten()
        doc = np.repeat(np.arange(len(marks)), np.asarray(pc.list_value_length(marks).fill_null(0)))
        mask = np.ascontiguousarray(np.asarray(flat.field("mask")), np.int64)
        which, bit = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        start = offsets[doc[which]] - base + np.asarray(flat.field("s")).astype(np.int64)[which] + bit
        gone = (np.bincount(start, minlength=n + 1) - np.bincount(start + self.window, minlength=n + 1))[: n + 1].cumsum()[:n] > 0
        for d in np.flatnonzero(copied & (np.diff(offsets) >= self.window)).tolist():
            gone[offsets[d] - base : offsets[d + 1] - base] = True
        return gone


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 200, text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and,
    if ``text``, the remaining bytes as ``kept``.

    A byte goes when a ``window``-byte string that covers it starts anywhere
    else too, in the same text or another; all strings are judged on the input.

    A null text is empty; shorter texts than the window lose nothing.  Rows
    that repeat a text, with whatever id, null too, are copies of each other.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    gram = min(GRAM, window)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(11), body).alias("k2"), body.alias("text"))
    found = materialize(map_arrow(keyed.select("k1", "k2", "text"), _Intervals(window, gram), "anchor bigint, k1 bigint, k2 bigint, s int, e int, p int"), "intervals")
    place = F.xxhash64("k1", "k2", "s")
    live = found.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("count")).where("lo <> hi").select("anchor", "count")
    live = materialize(live, "anchors")
    release(spark)
    several_times = join_spread(found, live.select("anchor"), ["anchor"], hot_keys(live, ["anchor"]))
    per_text = several_times.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e", "p")).alias("live"))
    copies = keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("id").alias("rep"))
    per_text = per_text.join(copies, ["k1", "k2"])
    source = keyed.join(per_text, (keyed.k1 == per_text.k1) & (keyed.k2 == per_text.k2) & keyed.id.eqNullSafe(per_text.rep)).select(keyed.k1, keyed.k2, "live", "text")
    pieces = materialize(map_arrow(source, _Pieces(window, gram), "k1 bigint, k2 bigint, s int, " + _PIECE), "pieces")
    discard(found, live)
    release(spark)
    unique = pieces.groupBy("core", "core2", "width", "c").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.first("left").alias("left"), F.first("sym").alias("sym"))
    unique = materialize(unique.select("core", "core2", "width", "c", "left", (F.col("lo") != F.col("hi")).alias("several"), "sym"), "unique")
    release(spark)
    sizes = unique.groupBy("core").agg(F.sum(F.octet_length("sym") + 1).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    hot = sizes.where(F.col("size") > HOT_BYTES).select("core")
    hot = bounded(hot) or hot
    dealt = unique.join(hot, "core", "left_anti").select(F.col("core").alias("deal"), F.col("core2").alias("deal2"), "width", "left", "sym", "several", "core", "core2", "c", F.lit(0).alias("shift"))
    fine = map_arrow(unique.join(hot, "core", "left_semi"), _Recut(window), "deal bigint, deal2 bigint, width int, left int, sym binary, several boolean, core bigint, core2 bigint, c bigint, shift int")
    dealt = dealt.unionByName(fine).repartition(max(1, int(total // TASK_BYTES) + 1), "deal").sortWithinPartitions("deal", "deal2")
    columns = fresh_path(spark, "columns")
    masks = materialize(map_arrow(dealt, _Construct(columns), "core bigint, core2 bigint, c bigint, mask bigint"), "masks")
    remove(spark, columns)
    discard(unique)
    release(spark)
    keys = ["core", "core2", "c"]
    marks = pieces.select("k1", "k2", "s", *keys).join(masks, keys).groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "mask")).alias("marks"))
    marks = materialize(marks, "marks")
    discard(pieces, masks)
    release(spark)
    whole = copies.where("copies > 1").select("k1", "k2", F.lit(True).alias("copied"))
    row = F.struct("id").alias("row")
    rows = keyed.join(marks, ["k1", "k2"], "left").join(whole, ["k1", "k2"], "left")
    kind = keyed.select(row).schema["row"].dataType.simpleString()
    names = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if text else "")
    out = map_arrow(rows.select(row, "text", "marks", "copied"), _Cut(window, text), f"row {kind}, {names}")
    return out.select(F.col("row.id").alias(id_col), *[n.split()[0] for n in names.split(", ")])
