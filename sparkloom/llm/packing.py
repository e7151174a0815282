"""Sequence packing as a cutting-stock problem solved by column generation.

1. Texts are tokenised once; a document longer than a sequence is cut at
   multiples of it, shorter ones are never cut.  What is kept of a piece is its
   place, length and checksum.
2. The histogram of piece lengths (classes of ``GRAIN`` ids, so at most
   ``length / GRAIN`` rows whatever the input) is the demand.  A linear program
   over patterns - multisets of classes that fit a sequence - covers it; a
   knapsack dynamic program over the dual prices finds each new pattern.
3. Patterns are rounded down; what they leave, fewer pieces than patterns have
   places, is laid out first-fit decreasing.
4. Pieces are ranked within their class and take the places of the patterns by
   rank; ranks come from counts per (class, chunk), so no class meets in a task.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm import bytetext
from sparkloom.llm.common import map_arrow, materialize, slices, string_buffers

#: Ids of a length class; a sequence of k pieces wastes k * (GRAIN - 1) ids at most.
GRAIN = 4
#: Pieces of a chunk in which ranks are counted.
CHUNK_ROWS = 50_000
#: Words whose ids a worker process remembers; beyond, it starts anew.
_CACHED_WORDS = 1 << 19

_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
_CLASS = np.zeros(256, np.uint8)  # 1 letter, 2 other ASCII, 3 apostrophe, 0 white space and the rest
_CLASS[0x21:0x7F] = 2
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[0x27] = 3
# Fixed value: how a tokenizer cuts words for which ``WordTokenizer``'s rule holds.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokenizer:
    """Ids of whole texts from the ids of their parts, each part encoded once.

    A tokenizer that folds case, drops white space and cuts words by
    ``_WORD_PATTERN`` never joins a letter with other ASCII characters but in a
    contraction after an apostrophe.  So a text's ids are those of its parts in
    a row, cut at white space and between ASCII letters and other ASCII
    characters, not after an apostrophe.  Texts beside a special token's string
    are only cut at white space.  With any other tokenizer texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_parts = self._cuts_words(json.loads(self.tokenizer.to_str()))
        self._clear()

    @staticmethod
    def _cuts_words(config: dict) -> bool:
        normal = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers", ())]
        cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", ())
        special = {x["content"].encode() for x in config.get("added_tokens", ())}
        by_pattern = len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": _WORD_PATTERN} and cuts[0]["behavior"] == "Removed" and cuts[1]["type"] == "ByteLevel" and not cuts[1]["add_prefix_space"]
        return by_pattern and normal == ["NFC", "Replace", "Lowercase"] and special <= set(_SPECIAL) and not config.get("post_processor")

    def _clear(self) -> None:
        self.key = np.zeros(0, np.uint64)  # hashes of the words known, sorted
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row and how many each has."""
        parts, sizes = [], []
        for lo in range(0, len(texts), 512):
            ids = [e.ids for e in self.tokenizer.encode_batch(texts[lo : lo + 512], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            parts.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
        return (np.concatenate(parts), np.concatenate(sizes)) if parts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _learn(self, key: np.ndarray, words: list[str]) -> None:
        """Keep the ids of new words, which come sorted by key."""
        ids, length = self._ids(words)
        start = self.ids.size + np.cumsum(length) - length
        self.ids = np.concatenate((self.ids, ids))
        at = np.searchsorted(self.key, key)
        self.key, self.start, self.length = np.insert(self.key, at, key), np.insert(self.start, at, start), np.insert(self.length, at, length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (and the end)."""
        if not self.by_parts:
            ids, length = self._ids([data[s:e].tobytes().decode() for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            return ids, np.concatenate(([0], np.cumsum(length)))
        body = data[offsets[0] : offsets[-1]]
        if any(body.tobytes().find(x) >= 0 for x in _SPECIAL):
            h, begin, end, at = bytetext.words(data, offsets, bytetext.WHITESPACE_WORDS, bytetext.SAME)
        else:
            kind = _CLASS[body]
            cut = ((kind[:-1] == 1) & (kind[1:] >= 2)) | ((kind[:-1] == 2) & (kind[1:] == 1))
            h, begin, end, _ = bytetext.words(data, np.union1d(offsets, np.flatnonzero(cut) + 1 + offsets[0]), bytetext.WHITESPACE_WORDS)
            at = np.searchsorted(begin, offsets)
        if not h.size:
            return np.zeros(0, np.uint32), np.zeros(offsets.size, np.int64)
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        missing = ~np.isin(unique, self.key, assume_unique=True)
        if self.key.size and self.key.size + missing.sum() > _CACHED_WORDS:
            self._clear()
            missing[:] = True
        if missing.any():
            where = first[missing]
            self._learn(unique[missing], [data[s:e].tobytes().decode() for s, e in zip(begin[where].tolist(), end[where].tolist(), strict=True)])
        k = np.searchsorted(self.key, unique)[inverse]
        length = self.length[k]
        bounds = np.concatenate(([0], np.cumsum(length)))
        ids = self.ids[np.repeat(self.start[k] - bounds[:-1], length) + np.arange(bounds[-1])]
        return ids, bounds[at]


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that later tasks find the words of earlier ones."""
    return WordTokenizer(path)


class _Pieces:
    """mapInArrow: texts to (row, start, length, crc, doc_tokens)."""

    def __init__(self, path: str, length: int, end_id: int):
        self.path, self.length, self.end_id = path, length, end_id

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(self.path)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, at = tokenizer.encode(*string_buffers(batch.column(1)))
                row, start, size, crc, total = [], [], [], [], []
                bounds = at.tolist()
                for i in range(batch.num_rows):
                    mine = np.append(ids[bounds[i] : bounds[i + 1]], self.end_id).astype("<u4")
                    for s in range(0, mine.size, self.length):
                        piece = mine[s : s + self.length]
                        row.append(i)
                        start.append(s)
                        size.append(piece.size)
                        crc.append(zlib.crc32(piece))
                        total.append(mine.size)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, size, crc, total)]], names=["id", "start", "length", "crc", "doc_tokens"])


def knapsack(price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and counts of items 1..capacity (item i has size i) that fit."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    gain = price[1:]
    for c in range(1, capacity + 1):
        values = gain[:c] + best[c - 1 :: -1] if c > 0 else gain[:0]
        k = int(values.argmax())
        if values[k] > best[c - 1]:
            best[c], pick[c] = values[k], k + 1
        else:
            best[c] = best[c - 1]
    counts = np.zeros(capacity + 1, np.int64)
    c = capacity
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def column_generation(demand: np.ndarray, capacity: int, rounds: int = 6000, gap: float = 5e-4) -> tuple[list[np.ndarray], np.ndarray]:
    """Patterns of a basic solution and how often each is used (fractions).

    Revised simplex on: cover ``demand[s]`` pieces of each size s with the fewest
    patterns.  Stops when no cover can be smaller by ``gap`` (the best column's
    value bounds that); ``rounds`` only bounds the time, any basis
    reached is a valid cover.
    """
    sizes = np.flatnonzero(demand)
    m = sizes.size
    patterns = [np.where(np.arange(capacity + 1) == s, capacity // s, 0) for s in sizes]
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand[sizes]
    cost = np.ones(m)
    for _ in range(rounds):
        dual = cost @ inverse
        if dual.min() < -1e-9:
            worst = int(dual.argmin())
            column, entering, price = -np.eye(m)[worst], None, 0.0
        else:
            prices = np.zeros(capacity + 1)
            prices[sizes] = dual
            value, entering = knapsack(prices, capacity)
            if value <= 1 + gap:
                break
            column, price = entering[sizes].astype(float), 1.0
        u = inverse @ column
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        pivot = inverse[out] / u[out]
        inverse -= np.outer(u, pivot)
        inverse[out] = pivot
        step = ratio[out]
        x -= u * step
        x[out] = step
        x = np.maximum(x, 0)
        patterns[out] = np.zeros(capacity + 1, np.int64) if entering is None else entering
        cost[out] = price
    return patterns, x


@dataclass
class Plan:
    """For each class: bounds of the ranks of each pattern that has it, and that pattern's places."""

    bounds: dict[int, np.ndarray]
    places: dict[int, np.ndarray]  # first sequence, pieces of the class in the pattern, first place
    sequences: int

    @staticmethod
    def build(demand: np.ndarray, capacity: int) -> "Plan":
        uses: list[tuple[np.ndarray, int]] = []
        left = demand.copy()
        if left.any():
            for pattern, x in zip(*column_generation(demand, capacity), strict=True):
                held = pattern > 0
                n = int(np.floor(x + 1e-7))
                if held.any():
                    n = min(n, int((left[held] // pattern[held]).min()))
                    if n:
                        left -= pattern * n
                        uses.append((pattern, n))
        bins: list[tuple[int, np.ndarray]] = []
        for size in np.repeat(np.arange(capacity, 0, -1), left[:0:-1]).tolist():
            for i, (room, pattern) in enumerate(bins):
                if room >= size:
                    pattern[size] += 1
                    bins[i] = room - size, pattern
                    break
            else:
                pattern = np.zeros(capacity + 1, np.int64)
                pattern[size] = 1
                bins.append((capacity - size, pattern))
        uses += [(p, 1) for _, p in bins]
        bounds: dict[int, list[int]] = {}
        places: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for pattern, n in uses:
            place = 0
            for size in np.flatnonzero(pattern)[::-1].tolist():
                k = int(pattern[size])
                bounds.setdefault(size, [0]).append(bounds.get(size, [0])[-1] + k * n)
                places.setdefault(size, []).append((first, k, place))
                place += k
            first += n
        return Plan({s: np.array(b) for s, b in bounds.items()}, {s: np.array(p) for s, p in places.items()}, first)

    def assign(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, place in it) of pieces by class and rank."""
        sequence, place = np.empty(size.size, np.int64), np.empty(size.size, np.int64)
        for s in np.unique(size).tolist():
            at = np.flatnonzero(size == s)
            p = np.searchsorted(self.bounds[s], rank[at], side="right") - 1
            first, k, start = self.places[s][p].T
            within = rank[at] - self.bounds[s][p]
            sequence[at], place[at] = first + within // k, start + within % k
        return sequence, place


class _Assign:
    def __init__(self, plan):
        self.plan = plan

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, place = self.plan.value.assign(np.asarray(batch.column(1)).astype(np.int64), np.asarray(batch.column(2)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(place)], names=["row", "sequence_id", "place"])


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are the tokenizer's and then ``end_id``; a null or empty
    text is ``end_id`` alone.  Every row of ``docs`` is a document, also one
    that repeats an id or has none.  Pieces of a sequence follow one another
    from offset 0; sequences are numbered from 0.  No documents give no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = map_arrow(src, _Pieces(tokenizer_path, length, end_id), f"id {kind}, start bigint, length bigint, crc bigint, doc_tokens bigint")
    size = F.ceil(F.col("length") / GRAIN).cast("int")
    pieces = materialize(cut.withColumn("size", size), "pieces")
    histogram = pieces.groupBy("size").count().collect()
    capacity = length // GRAIN
    demand = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        demand[r["size"]] = r["count"]
    chunks = max(1, int(demand.sum()) // CHUNK_ROWS)
    chunked = pieces.withColumn("chunk", F.pmod(F.xxhash64("id", "start", "crc"), F.lit(chunks)))
    within = Window.partitionBy("size", "chunk").orderBy("id", "start", "crc")
    before = Window.partitionBy("size").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = chunked.groupBy("size", "chunk").count().select("size", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    ranked = chunked.withColumn("n", F.row_number().over(within) - 1).join(firsts, ["size", "chunk"]).withColumn("rank", F.col("first") + F.col("n"))
    row = F.struct("id", "start", "length", "crc", "doc_tokens").alias("row")
    plan = spark.sparkContext.broadcast(Plan.build(demand, capacity))
    keyed = ranked.select(row, "size", "rank")
    placed = map_arrow(keyed, _Assign(plan), f"row {keyed.schema['row'].dataType.simpleString()}, sequence_id bigint, place bigint")
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.select("row.*", "sequence_id", "place").withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    return out.select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
