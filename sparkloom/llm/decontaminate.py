"""Benchmark decontamination by an FM-index per shard of the training texts.

A shard (some megabytes of texts) is coded with the vocabulary of the phrases;
words that no phrase has become separators, and runs too short for any phrase
are left out, so the index holds exactly the words that a phrase can match.
Phrases are found by backward search over wavelet ranks, located by sampled
suffix positions, and the hit words are merged into removal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import bytetext
from sparkloom.llm.common import map_arrow, materialize, slices, string_buffers
from sparkloom.llm.fmindex import FMIndex

#: Text bytes of the benchmark that are searched, and broadcast, at a time.
BLOCK_BYTES = 16 << 20
#: Text bytes of a shard.
SHARD_BYTES = 2 << 20


@dataclass
class Phrases:
    """The windows of a block of benchmark items."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = place + 1
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # windows, items of each as slices
    names: list[str]

    @staticmethod
    def build(items: list[tuple[str, str]], window: int) -> "Phrases":
        names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(names)}
        coded, vocabulary = [], np.zeros(0, np.uint64)
        for name, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            coded.append((place[name], bytetext.words(raw, np.array([0, raw.size]), bytetext.ALNUM_WORDS)[0]))
        if coded:
            vocabulary = np.unique(np.concatenate([h for _, h in coded]))
        found: dict[int, list[np.ndarray]] = {}
        for item, h in coded:
            if h.size:
                m = min(window, h.size)
                symbols = np.searchsorted(vocabulary, h) + 1
                rows = np.lib.stride_tricks.sliding_window_view(symbols, m)
                found.setdefault(m, []).append(np.column_stack((rows, np.full(len(rows), item))))
        by_length = {}
        for m, parts in found.items():
            rows = np.unique(np.concatenate(parts), axis=0)
            windows, first = np.unique(rows[:, :m], axis=0, return_index=True)
            by_length[m] = windows, np.append(first, len(rows)), rows[:, m]
        return Phrases(vocabulary, by_length, names)


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def _shard(data: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, dict, dict, np.ndarray, np.ndarray]:
    """Words of each text, hit word ranges and items by text, byte bounds of the words."""
    h, begin, end, at = bytetext.words(data, offsets, bytetext.ALNUM_WORDS)
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    if h.size and phrases.by_length:
        place = np.searchsorted(phrases.vocabulary, h)
        place[place == phrases.vocabulary.size] = 0
        symbol = np.where(phrases.vocabulary[place] == h, place + 1, 0)
        starts = at[:-1][at[:-1] < at[1:]]
        known = symbol > 0
        edge = np.zeros(h.size, bool)
        edge[starts] = True
        run = np.cumsum(edge | ~known | np.concatenate(([True], ~known[:-1])))
        lengths = np.bincount(run[known], minlength=run[-1] + 1)
        keep = np.flatnonzero(known & (lengths[run] >= min(phrases.by_length)))
        if keep.size:
            breaks = np.flatnonzero(np.diff(run[keep])) + 1
            text = np.insert(symbol[keep], breaks, 0)
            where = np.insert(keep, breaks, -1)
            text, where = np.append(text, 0), np.append(where, -1)
            index = FMIndex(text, phrases.vocabulary.size + 1)
            hits = []
            for m, (windows, first, owner) in phrases.by_length.items():
                row, lo, hi = index.search(windows)
                if row.size:
                    count = hi - lo
                    suffix = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                    word = where[index.locate(suffix)]
                    doc = np.searchsorted(at, word, side="right") - 1
                    hits.append((doc, word - at[doc], np.full(word.size, m)))
                    for d, w in np.unique(np.column_stack((doc, np.repeat(row, count))), axis=0).tolist():
                        items.setdefault(d, set()).update(phrases.names[i] for i in owner[first[w] : first[w + 1]])
            if hits:
                doc, word, m = (np.concatenate(x) for x in zip(*hits, strict=True))
                order = np.argsort(doc, kind="stable")
                doc, word, m = doc[order], word[order], m[order]
                cut = np.flatnonzero(np.diff(doc)) + 1
                for d, s, k in zip(doc[np.concatenate(([0], cut))].tolist(), np.split(word, cut), np.split(m, cut), strict=True):
                    spans[d] = _merge(s, s + k)
    return np.diff(at), spans, items, begin, end


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(batches: Iterator[pa.RecordBatch], phrases: Phrases, last: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SHARD_BYTES, 8192):
            data, offsets = string_buffers(batch.column(1))
            n_words, spans, items, begin, end = _shard(data, offsets, phrases)
            first = np.concatenate(([0], np.cumsum(n_words)))
            old = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            merged, named = [], []
            for d in range(batch.num_rows):
                before = [(x["start"], x["end"]) for x in old[0][d] or ()]
                both = [*before, *spans.get(d, ())]
                merged.append(_merge(*np.array(both).T) if both else [])
                named.append(sorted({*(old[1][d] or ()), *items.get(d, ())}))
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([[{"start": s, "end": e} for s, e in x] for x in merged], _SPANS), pa.array(named, pa.list_(pa.string()))], names=["row", "text", "spans", "items"])
                continue
            cut = [[{"start": int(begin[first[d] + s] - offsets[d]), "end": int(end[first[d] + e - 1] - offsets[d])} for s, e in x] for d, x in enumerate(merged)]
            hit = [sum(e - s for s, e in x) for x in merged]
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in named]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()), pa.array(cut, _SPANS), pa.array(named, pa.list_(pa.string())), pa.array(digest)], names=["row", "n_words", "n_hit", "spans", "items", "items_sha256"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items, items_sha256, spans, contaminated.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  ``spans`` are the removal spans: maximal runs of hit words as
    UTF-8 byte ranges, end exclusive.  A document is contaminated when 5 % of
    its words or more are hit, at least one.

    The benchmark is searched in blocks of about ``block_bytes``; each block is
    a pass over the texts and the only thing broadcast.  Null and empty texts
    have no words; items without words have no window; an item with a null id
    is named by the empty string; items that share an id are one item.  An empty benchmark hits nothing.  ``carry`` names
    further columns of ``docs`` to return; others are ignored, whatever their names.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    carried = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry or [])]).alias("row")
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    state = docs.select(carried, F.col(text_col).cast("string").alias("text"), no_spans, F.array().cast("array<string>").alias("items"))
    kind = state.schema["row"].dataType.simpleString()
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        phrases = Phrases.build([(r.item, r.text) for r in part.toLocalIterator()], window)
        last = block == blocks - 1
        kept = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, items_sha256 string" if last else "text string, spans array<struct<start:bigint,end:bigint>>, items array<string>"
        state = map_arrow(state, _Search(docs.sparkSession.sparkContext.broadcast(phrases), last), f"row {kind}, {kept}")
        if not last:
            state = materialize(state, "decontaminate")
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return state.select(F.col("row.id").alias(id_col), *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry or [])], "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "items_sha256", "spans", contaminated.alias("contaminated"))


class _Search:
    """Picklable pass over a block of phrases."""

    def __init__(self, phrases, last: bool):
        self.phrases, self.last = phrases, last

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, self.phrases.value, self.last)
