"""Substring dedup by level-wise doubling.

Short windows are compared first, over the whole corpus.  A window of twice the
length can only repeat where both its halves do, so only windows that repeat
are extended, level by level, until none survives.  At the level of the wanted
length every repeated window also learns whether an equal one starts earlier,
and the words of those that do go; the levels beyond tell how long the longest
repeats are.

A level is two shuffles.  Slices of the corpus send the fingerprints of their
surviving windows, each once, to buckets by leading bits; a bucket answers every
slice with a bit per fingerprint.  So neither a common window nor a large group
of copies gathers in one task: a slice counts once however often it has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.bytetext import SAME, WHITESPACE_WORDS, mix, words
from sparkloom.llm.common import discard, map_arrow, materialize, string_buffers, trim

#: Bytes and rows of text of a slice; a longer text is one by itself.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 1 << 16

#: Fingerprints that a bucket holds on average, when 4 bytes of each are sent and when all of it is.
SHORT_PER_BUCKET, FULL_PER_BUCKET = 1 << 22, 1 << 19

_U = np.uint64
_SEEDS = (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344))
_ODD = _U(0x9E3779B97F4A7C15)

#: A window of the wanted length as a bucket gets it: its 128 bits and the row of its first occurrence in the slice.
_FULL = np.dtype([("x", "<u8"), ("y", "<u8"), ("missing", "u1"), ("id", "<i8"), ("tie", "<i8"), ("doc", "<i4")])

_SLICE = "sid bigint, ids array<bigint>, ties array<bigint>, ends array<bigint>, text binary"
_SENT = "bucket bigint, sid bigint, entries binary"
_ANSWER = "sid bigint, bucket bigint, repeated binary, earlier binary"
_STATE = "sid bigint, n bigint, words binary, doc array<int>, first array<bigint>, length array<bigint>, missing array<tinyint>, id array<bigint>, tie array<bigint>, starts binary"
_MARKS = "in_doc array<int>, m_doc array<int>, m_start array<bigint>, m_end array<bigint>"
_OUT = "doc_id bigint, n_words bigint, n_removed bigint, longest bigint, kept string"


def _row(schema: str, **values) -> pa.RecordBatch:
    """One row; arrays become lists and bytes binaries."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "tinyint": pa.int8()}
    columns, names = [], []
    for field in schema.split(", "):
        name, kind = field.split(" ")
        value = values[name]
        if kind == "binary":
            column = pa.array([value], pa.binary())
        elif kind.startswith("array"):
            column = pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value if isinstance(value, pa.Array) else pa.array(value, kinds[kind[6:-1]]))
        else:
            column = pa.array([value], kinds[kind])
        columns.append(column)
        names.append(name)
    return pa.RecordBatch.from_arrays(columns, names)


def _fields(rows: pa.Table | pa.RecordBatch, i: int = 0) -> dict:
    """A row's values: lists as arrays (``ids``, which has nulls, as an Arrow one), the rest as they are."""
    out = {}
    for name in rows.schema.names:
        cell = rows.column(name).slice(i, 1)
        cell = cell.combine_chunks() if isinstance(cell, pa.ChunkedArray) else cell
        if pa.types.is_list(cell.type):
            values = cell.flatten()
            out[name] = values if name == "ids" else values.to_numpy(zero_copy_only=False)
        else:
            out[name] = cell[0].as_py()
    return out


def cut_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tie, text) rows as slices of about ``SLICE_BYTES`` of compressed text."""
    task, number = TaskContext.get().partitionId(), 0
    ids, ties, lengths, texts = [], [], [], []
    size = rows = 0

    def out() -> pa.RecordBatch:
        ends = np.cumsum(np.concatenate(lengths))
        text = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
        return _row(_SLICE, sid=(task << 32) + number, ids=pa.concat_arrays(ids), ties=np.concatenate(ties), ends=ends, text=text)

    for batch in batches:
        data, offsets = string_buffers(batch.column("text"))
        lo = 0
        while lo < batch.num_rows:
            room = max(0, SLICE_BYTES - size)
            hi = int(np.searchsorted(offsets, offsets[lo] + room, side="right")) - 1
            hi = min(batch.num_rows, lo + SLICE_ROWS - rows, max(lo + (rows == 0), hi))
            if hi > lo:
                ids.append(batch.column("doc_id").slice(lo, hi - lo))
                ties.append(batch.column("tie").slice(lo, hi - lo).to_numpy(zero_copy_only=False))
                lengths.append(np.diff(offsets[lo : hi + 1]))
                texts.append(data[offsets[lo] : offsets[hi]].tobytes())
                size, rows, lo = size + int(offsets[hi] - offsets[lo]), rows + hi - lo, hi
            if lo < batch.num_rows or size >= SLICE_BYTES or rows >= SLICE_ROWS:
                yield out()
                ids, ties, lengths, texts, size, rows = [], [], [], [], 0, 0
                number += 1
    if rows:
        yield out()


def slice_texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a slice's texts."""
    offsets = np.concatenate(([0], row["ends"]))
    raw = pa.decompress(row["text"], decompressed_size=int(offsets[-1]), codec="zstd", asbytes=True) if offsets[-1] else b""
    return np.frombuffer(raw, np.uint8), offsets


class Piece:
    """What is still looked at of a slice: runs of words, and the words where a window starts."""

    def __init__(self, sid: int, hashes: np.ndarray, doc, first, length, missing, ids, ties, starts: np.ndarray):
        self.sid, self.words, self.starts = sid, hashes, starts
        self.doc, self.first, self.length = np.asarray(doc, np.int32), np.asarray(first, np.int64), np.asarray(length, np.int64)
        self.missing, self.id, self.tie = np.asarray(missing, np.uint8), np.asarray(ids, np.int64), np.asarray(ties, np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.run = np.repeat(np.arange(self.length.size), self.length)

    @staticmethod
    def of_texts(row: dict, least: int, base: int) -> "Piece":
        """All windows of ``base`` words of the texts with ``least`` words or more."""
        data, offsets = slice_texts(row)
        hashes, _, _, at = words(data, offsets, WHITESPACE_WORDS, SAME)
        counts = np.diff(at)
        docs = np.flatnonzero(counts >= least)
        hashes = hashes[np.repeat(counts >= least, counts)]
        missing = row["ids"].is_null().to_numpy(zero_copy_only=False)[docs]
        ids = row["ids"].fill_null(0).to_numpy(zero_copy_only=False)[docs]
        length = counts[docs]
        room = np.repeat(np.cumsum(length), length) - np.arange(hashes.size)
        return Piece(row["sid"], hashes, docs, np.zeros(docs.size), length, missing, ids, row["ties"][docs], room >= base)

    @staticmethod
    def of_state(row: dict) -> "Piece":
        hashes = np.frombuffer(row["words"], _U)
        starts = np.unpackbits(np.frombuffer(row["starts"], np.uint8), count=hashes.size).astype(bool)
        return Piece(row["sid"], hashes, row["doc"], row["first"], row["length"], row["missing"], row["id"], row["tie"], starts)

    def extended(self, starts: np.ndarray, size: int) -> "Piece":
        """The runs of words that windows of ``size`` at ``starts`` cover; windows do not leave their run."""
        change = np.zeros(self.words.size + 1, np.int64)
        at = np.flatnonzero(starts)
        change[at] += 1
        change[at + size] -= 1
        inside = np.cumsum(change[:-1]) > 0
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1] | (self.run[1:] != self.run[:-1])
        lo = np.flatnonzero(fresh)
        length = np.diff(np.append(np.flatnonzero(fresh[inside]), int(inside.sum())))
        run = self.run[lo]
        return Piece(self.sid, self.words[inside], self.doc[run], self.first[run] + lo - self.begin[run], length, self.missing[run], self.id[run], self.tie[run], starts[inside])

    def state(self) -> dict:
        return {"sid": self.sid, "n": int(self.starts.sum()), "words": self.words.tobytes(), "doc": self.doc, "first": self.first, "length": self.length, "missing": self.missing.astype(np.int8), "id": self.id, "tie": self.tie, "starts": np.packbits(self.starts).tobytes()}


def window_hashes(hashes: np.ndarray, size: int, base: int, seed: np.uint64) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from every word on; ``size`` is ``base`` doubled some times."""
    n = hashes.size - base + 1
    if n <= 0:
        return np.zeros(0, _U)
    x = mix(hashes[:n] ^ seed)
    for j in range(1, base):
        x = mix(x * _ODD + hashes[j : j + n])
    while base < size:
        x = mix(x[: max(0, x.size - base)] * _ODD + x[base:])
        base *= 2
    return x


class Level:
    """One level: what a slice sends, how a bucket answers, what survives."""

    def __init__(self, size: int, base: int, window: int, bits: int):
        self.size, self.base, self.window, self.bits = size, base, window, bits
        #: At the wanted length windows are told apart by 128 bits and know their order; else 4 bytes beside the bucket do up to it, 8 beyond.
        self.full = size == window
        self.entry = np.dtype("<u4") if size < window else np.dtype("<u8")

    def piece(self, row: dict) -> Piece:
        return Piece.of_texts(row, self.window, self.base) if "ends" in row else Piece.of_state(row)

    def groups(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bucket of each distinct window, its entry, group of each start, whether a start is its group's first)."""
        at = np.flatnonzero(piece.starts)
        x = window_hashes(piece.words, self.size, self.base, _SEEDS[0])[at]
        if not self.full:
            key = x >> _U(32 - self.bits) if self.entry.itemsize == 4 else x
            distinct, group = np.unique(key, return_inverse=True)
            bucket = distinct >> _U(32 if self.entry.itemsize == 4 else 64 - self.bits)
            return bucket, distinct.astype(self.entry), group, np.zeros(at.size, bool)
        y = window_hashes(piece.words, self.size, self.base, _SEEDS[1])[at]
        rank = np.empty(piece.doc.size, np.int64)
        rank[np.lexsort((piece.first, piece.doc, piece.tie, piece.id, piece.missing))] = np.arange(piece.doc.size)
        order = np.lexsort((at, rank[piece.run[at]], y, x))
        head = np.ones(at.size, bool)
        head[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
        group, first = np.empty(at.size, np.int64), np.zeros(at.size, bool)
        group[order] = np.cumsum(head) - 1
        first[order[head]] = True
        entry = np.empty(int(head.sum()), _FULL)
        one = order[head]
        run = piece.run[at[one]]
        for name, values in (("x", x[one]), ("y", y[one]), ("missing", piece.missing[run]), ("id", piece.id[run]), ("tie", piece.tie[run]), ("doc", piece.doc[run])):
            entry[name] = values
        return entry["x"] >> _U(64 - self.bits), entry, group, first

    def send(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = self.piece(_fields(batch, i))
                bucket, entry, _, _ = self.groups(piece)
                numbers, at = np.unique(bucket, return_index=True)
                ends = np.append(at, bucket.size)[1:]
                blobs = [entry[lo:hi].tobytes() for lo, hi in zip(at, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int64)), pa.array(np.full(numbers.size, piece.sid)), pa.array(blobs, pa.binary())], ["bucket", "sid", "entries"])

    def answer(self, sent: pa.Table) -> pa.Table:
        """For every slice: which of its windows other slices have too, and of which another holds the first."""
        blobs, sids = sent.column("entries").to_pylist(), sent.column("sid").to_numpy()
        counts = np.array([len(b) for b in blobs]) // (_FULL if self.full else self.entry).itemsize
        if self.full:
            entry, sid = np.frombuffer(b"".join(blobs), _FULL), np.repeat(sids, counts)
            order = np.lexsort((entry["doc"], sid, entry["tie"], entry["id"], entry["missing"], entry["y"], entry["x"]))
            x, y = entry["x"][order], entry["y"][order]
            head = np.ones(order.size, bool)
            head[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            alone = head & np.append(head[1:], True)
            repeated, earlier = np.empty(order.size, bool), np.empty(order.size, bool)
            repeated[order], earlier[order] = ~alone, ~head
        else:
            values = np.frombuffer(b"".join(blobs), self.entry)
            order = np.argsort(values, kind="stable")
            ranked = values[order]
            same = ranked[1:] == ranked[:-1]
            repeated, earlier = np.empty(order.size, bool), np.zeros(order.size, bool)
            repeated[order] = np.append(same, False) | np.insert(same, 0, False)
        cuts = np.cumsum(counts)[:-1]
        bits = lambda flags: pa.array([np.packbits(f).tobytes() for f in np.split(flags, cuts)], pa.binary())
        return pa.table([sent.column("sid"), sent.column("bucket"), bits(repeated), bits(earlier)], ["sid", "bucket", "repeated", "earlier"])

    def survive(self, mine: pa.Table, answers: pa.Table) -> pa.Table:
        """A slice's next state, and from the wanted length on the documents with repeats and at that length the words that go."""
        piece = self.piece(_fields(mine))
        bucket, entry, group, first = self.groups(piece)
        sizes = np.unique(bucket, return_counts=True)[1]
        told = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        flags = lambda name: np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(np.frombuffer(r[name], np.uint8), count=int(n)) for r, n in zip(told, sizes, strict=True)]]).astype(bool)
        at = np.flatnonzero(piece.starts)
        here = np.bincount(group, minlength=entry.size) > 1
        repeated = np.zeros(piece.words.size, bool)
        repeated[at] = (flags("repeated") | here)[group]
        marks = {"in_doc": [], "m_doc": [], "m_start": [], "m_end": []}
        if self.size >= self.window:
            marks["in_doc"] = np.unique(piece.doc[piece.run[repeated]])
        if self.full:
            again = np.zeros(piece.words.size, bool)
            again[at] = flags("earlier")[group] | ~first
            gone = piece.extended(again, self.size)
            marks |= {"m_doc": gone.doc, "m_start": gone.first, "m_end": gone.first + gone.length}
        twice = np.zeros(piece.words.size, bool)
        room = (piece.begin + piece.length)[piece.run] - np.arange(piece.words.size)
        if piece.words.size > self.size:
            twice[: -self.size] = repeated[: -self.size] & repeated[self.size :] & (room[: -self.size] >= 2 * self.size)
        return pa.Table.from_batches([_row(f"{_STATE}, {_MARKS}", **piece.extended(twice, 2 * self.size).state(), **marks)])


def _of_group(function):
    """``function`` of a group, handing freed memory back after it."""

    def run(group: pa.Table) -> pa.Table:
        out = function(group)
        trim()
        return out

    return run


def _of_groups(function):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = function(left, right)
        trim()
        return out

    return run


def cut_words(row: pa.Table, found: pa.Table) -> pa.Table:
    """The rows of a slice without the words that go."""
    row = _fields(row)
    data, offsets = slice_texts(row)
    gone: dict[int, list[tuple[int, int]]] = {}
    longest: dict[int, int] = {}
    for r in found.to_pylist():
        for d, lo, hi in zip(r["m_doc"], r["m_start"], r["m_end"], strict=True):
            gone.setdefault(d, []).append((lo, hi))
        for d in r["in_doc"]:
            longest[d] = max(longest.get(d, 0), r["size"])
    raw, counts, removed, kept = data.tobytes(), [], [], []
    for d, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        # What bytes.split() cuts at are the characters that end a word.
        ws = raw[lo:hi].split()
        counts.append(len(ws))
        for a, b in sorted(gone.get(d, ()), reverse=True):
            del ws[a:b]
        removed.append(counts[-1] - len(ws))
        kept.append(b" ".join(ws).decode())
    columns = [row["ids"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array([longest.get(d, 0) for d in range(len(counts))], pa.int64()), pa.array(kept, pa.string())]
    return pa.table(columns, ["doc_id", "n_words", "n_removed", "longest", "kept"])


def first_size(window: int) -> int:
    """The length to begin with: ``window`` halved while it is even and 4 words or more are left."""
    while window % 2 == 0 and window >= 8:
        window //= 2
    return window


def remove_repeats(docs: DataFrame, window: int = 20, id: str = "doc_id", text: str = "text", beyond: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, longest, kept) of every row.

    ``kept`` are the words, joined by one space, that no window covers of which
    an equal one starts earlier: in a row with a smaller id, or before it in the
    same row.  ``longest`` is the greatest length, ``window`` doubled some
    times, of which the row has a window that repeats anywhere, 0 without any;
    with ``beyond`` False the levels end at ``window``.

    Null texts have no words, texts with fewer than ``window`` none that goes.
    Rows without id come after all others.  Of rows that share an id the order
    is that of a hash of their texts; of equal rows one comes first.  An empty
    table gives no rows; other columns are ignored.  The tables that the result
    reads are listed as its ``_reads``; ``discard`` them when it is used.  Words are known by 64-bit,
    windows by 128-bit hash; shorter fingerprints only rule windows out.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    slices = materialize(map_arrow(rows, cut_slices, _SLICE), "slices")
    base = size = first_size(window)
    state, before, found = slices, slices, []
    left = int(slices.agg(F.sum(F.element_at("ends", -1) / 6)).first()[0] or 0)
    while left:
        per_bucket = FULL_PER_BUCKET if size >= window else SHORT_PER_BUCKET
        level = Level(size, base, window, max(1, (left // per_bucket).bit_length()))
        sent = map_arrow(state, level.send, _SENT)
        told = sent.groupBy("bucket").applyInArrow(_of_group(level.answer), _ANSWER)
        out = materialize(state.groupBy("sid").cogroup(told.groupBy("sid")).applyInArrow(_of_groups(level.survive), f"{_STATE}, {_MARKS}"), f"repeats{size}")
        if size >= window:
            found.append((size, out))
        if size > base and size <= window:
            discard(before)
        before, state = out, out.where("n > 0")
        left = int(state.agg(F.sum("n")).first()[0] or 0) if beyond or size < window else 0
        size *= 2
    names = [f.split(" ")[0] for f in _MARKS.split(", ")]
    marks = docs.sparkSession.createDataFrame([], f"sid bigint, size int, {_MARKS}")
    for n, t in found:
        marks = marks.unionByName(t.where(F.size("in_doc") > 0).select("sid", F.lit(n).alias("size"), *names))
    out = slices.groupBy("sid").cogroup(marks.groupBy("sid")).applyInArrow(_of_groups(cut_words), _OUT)
    out._reads = [slices, *[t for _, t in found]]
    return out
