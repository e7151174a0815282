"""Language identification: known words first, then shorter and shorter n-grams.

A word that the model knows adds its log frequency in every language.  For any
other word each position adds the log frequency of the longest known character
n-gram that starts there, down to single characters; the mean over positions
stands for the word.

Words and n-grams are kept by 64-bit hash with the languages that have them
only, so the model grows with what was learned and not with the number of
languages times that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import bytetext
from sparkloom.llm.common import bounded, discard, in_parts, map_arrow, materialize, slices, string_buffers

#: Bound of the fit: expected rows learned from for each language.
SAMPLE_ROWS = 3000
#: Weight in all languages that an n-gram of two characters or more needs.
LEAST_WEIGHT = 2.0
LONGEST = 5
UNKNOWN = "und"
#: Bytes of the scores of unseen words that a worker remembers.
_CACHE_BYTES = 16 << 20
#: Scores (texts times languages) held at a time.
_CELLS = 1 << 22
#: Values of a sample's key that are broadcast; more are joined.
_MOST_KEYS = 1 << 14

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = True
_U = np.uint64
_BEGIN, _END = "^", "$"


@dataclass
class Table:
    """Keys with what each adds to the languages that have it."""

    keys: np.ndarray  # sorted
    start: np.ndarray  # of each key's entries, and the end
    lang: np.ndarray
    gain: np.ndarray

    @staticmethod
    def build(key: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> "Table":
        """Weights added up by key and language; a gain is log((w + 0.1) / 0.1)."""
        order = np.lexsort((lang, key))
        key, lang, weight = key[order], lang[order], weight[order]
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (lang[1:] != lang[:-1])))) if key.size else np.zeros(0, np.int64)
        total = np.add.reduceat(weight, first) if key.size else weight
        key, lang = key[first], lang[first]
        keys, start = np.unique(key, return_index=True)
        return Table(keys, np.append(start, key.size), lang.astype(np.int32), np.log1p(10.0 * total).astype(np.float32))

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether there) of each key."""
        if not self.keys.size:
            return np.zeros(key.size, np.int64), np.zeros(key.size, bool)
        place = np.searchsorted(self.keys, key)
        place[place == self.keys.size] = 0
        return place, self.keys[place] == key

    def add_up(self, place: np.ndarray, owner: np.ndarray, n: int, languages: int) -> np.ndarray:
        """Gains of the entries at ``place`` by owner and language."""
        length = self.start[place + 1] - self.start[place]
        entry = np.repeat(self.start[place] - np.cumsum(length) + length, length) + np.arange(length.sum())
        cell = np.repeat(owner, length) * languages + self.lang[entry]
        return np.bincount(cell, self.gain[entry], n * languages).astype(np.float64).reshape(n, languages)


def _grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams of sizes 1.. that start at each place of the words between marks, word of each place, and places left in it."""
    code = np.frombuffer((_BEGIN + (_END + _BEGIN).join(words) + _END).encode("utf-32-le"), np.uint32).astype(_U)
    owner = np.cumsum(code == _U(ord(_BEGIN))) - 1
    last = np.flatnonzero(code == _U(ord(_END)))
    left = last[owner] + 1 - np.arange(code.size)
    out, h = [], np.zeros(code.size, _U)
    for size in range(1, LONGEST + 1):
        h = h * _U(0x9E3779B97F4A7C15)
        h[: max(0, code.size - size + 1)] += code[size - 1 :] + _U(1)
        out.append(bytetext.mix(h + _U(size)))
    return out, owner, left


def learned(words: list[str], lang: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, key, language, weight): words as kind 0 by their occurrences, n-grams by size with the logarithm of their words'."""
    data, offsets = string_buffers(pa.array(words, pa.string()))
    lang, count = lang.astype(np.int32), count.astype(np.float64)
    parts = [(0, bytetext.words(data, offsets, np.ones(256, bool))[0], lang, count)]
    if words:
        hashes, owner, left = _grams(words)
        for size, h in enumerate(hashes, 1):
            inside = np.flatnonzero(left >= size)
            of = owner[inside]
            parts.append((size, h[inside], lang[of], np.log1p(count[of])))
    out = []
    for kind, h, k, w in parts:  # added up by key and language
        order = np.lexsort((k, h))
        h, k, w = h[order], k[order], w[order]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])))) if h.size else np.zeros(0, np.int64)
        out.append((np.full(first.size, kind, np.int8), h[first], k[first], np.add.reduceat(w, first) if h.size else w))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class _Learn:
    """mapInArrow on (lang, w, count): rows of ``learned``."""

    def __init__(self, place):
        self.place = place

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = self.place.value
        for batch in batches:
            lang = np.fromiter((place[x] for x in batch.column(0).to_pylist()), np.int32, batch.num_rows)
            kind, key, lang, weight = learned(batch.column(1).to_pylist(), lang, np.asarray(batch.column(2)))
            yield from in_parts(pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(lang), pa.array(weight)], names=["kind", "key", "lang", "weight"]))


@dataclass
class Model:
    languages: list[str]
    words: Table
    word_base: np.ndarray  # log frequency of a known word in a language that lacks it
    grams: Table
    gram_base: np.ndarray  # the same by size and language; size 1 is also the floor
    cached: tuple[np.ndarray, np.ndarray] | None = None  # hashes of unseen words, sorted, and their rows

    @staticmethod
    def build(kind: np.ndarray, key: np.ndarray, lang: np.ndarray, weight: np.ndarray, languages: list[str]) -> "Model":
        """From what ``learned`` gives for all words and languages, rare n-grams left out."""
        n = len(languages)
        known = kind == 0
        table = Table.build(key[known], lang[known], weight[known])
        totals = np.bincount(lang[known], weight[known], n) if n else np.zeros(0)
        word_base = np.log(0.1 / (totals + 0.1 * max(1, table.keys.size)))
        by_size = np.ones((LONGEST + 1, n))
        for size in range(1, LONGEST + 1) if n else ():
            by_size[size] += np.bincount(lang[kind == size], weight[kind == size], n)
        return Model(languages, table, word_base, Table.build(key[~known], lang[~known], weight[~known]), np.log(0.1 / by_size))

    @staticmethod
    def fit(words: list[str], lang: np.ndarray, count: np.ndarray, languages: list[str]) -> "Model":
        """From rows of (word, language by place, occurrences)."""
        kind, key, lang, weight = learned(words, lang, count)
        _, inverse = np.unique(np.stack((kind.astype(np.int64), key.view(np.int64)), axis=1), axis=0, return_inverse=True)
        total = np.bincount(inverse.ravel(), weight)[inverse.ravel()]
        kept = (kind < 2) | (total >= LEAST_WEIGHT)
        return Model.build(kind[kept], key[kept], lang[kept], weight[kept], languages)

    def backoff(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word, from its longest known n-grams."""
        n = len(self.languages)
        if not words:
            return np.zeros((0, n))
        hashes, owner, left = _grams(words)
        size = np.ones(owner.size, np.int64)
        place = np.full(owner.size, -1, np.int64)
        for s in range(LONGEST, 0, -1):
            todo = np.flatnonzero((place < 0) & (left >= s))
            at, there = self.grams.find(hashes[s - 1][todo])
            place[todo[there]], size[todo[there]] = at[there], s
        found = place >= 0
        total = self.grams.add_up(place[found], owner[found], len(words), n)
        for s in range(1, LONGEST + 1):
            total += np.bincount(owner[size == s], minlength=len(words))[:, None] * self.gram_base[s]
        return total / np.bincount(owner)[:, None]

    def _unseen(self, key: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rows of scores for distinct unseen words, remembered from slice to slice."""
        rows = np.empty((key.size, len(self.languages)), np.float32)
        missing = np.ones(key.size, bool)
        if self.cached is not None:
            keys, old = self.cached
            place = np.minimum(np.searchsorted(keys, key), keys.size - 1)
            missing = keys[place] != key
            rows[~missing] = old[place[~missing]]
        at = np.flatnonzero(missing)
        if at.size:
            words = [bytetext.LOWER[data[s:e]].tobytes().decode() for s, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            rows[at] = self.backoff(words)
            new, fresh = key[at], rows[at]  # sorted by key
            if self.cached is not None and (self.cached[0].size + new.size) * (8 + fresh.itemsize * fresh.shape[1]) <= _CACHE_BYTES:
                place = np.searchsorted(self.cached[0], new)
                new, fresh = np.insert(self.cached[0], place, new), np.insert(self.cached[1], place, fresh, axis=0)
            self.cached = new, fresh
        return rows

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        h, begin, end, at = bytetext.words(data, offsets, bytetext.ALNUM_WORDS)
        n, languages = offsets.size - 1, len(self.languages)
        letters = self._letters(data, offsets)
        if not self.languages or not h.size:
            ok = letters if self.languages else np.zeros(n, bool)
            return [self.languages[0] if x else UNKNOWN for x in ok], np.where(ok, 1.0 / max(1, languages), 0.0)
        doc = np.repeat(np.arange(n), np.diff(at))
        place, known = self.words.find(h)
        sums = self.words.add_up(place[known], doc[known], n, languages)
        sums += np.bincount(doc[known], minlength=n)[:, None] * self.word_base
        strange = np.flatnonzero(~known)
        if strange.size:
            key, first, inverse = np.unique(h[strange], return_index=True, return_inverse=True)
            rows = self._unseen(key, data, begin[strange[first]], end[strange[first]])
            for k in range(languages):
                sums[:, k] += np.bincount(doc[strange], rows[inverse, k], n)
        z = sums / np.sqrt(np.maximum(1, np.diff(at)))[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, np.where(letters, p.max(axis=1), 0.0)

    @staticmethod
    def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text has a letter of any script."""
        out = np.zeros(offsets.size - 1, bool)
        for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            step = s
            while step < e and not out[i]:
                out[i] = _LETTERS[data[step : min(e, step + 4096)]].any()
                step += 4096
            if not out[i] and e > s and (data[s:e] >= 0x80).any():
                out[i] = any(c.isalpha() for c in data[s:e].tobytes().decode("utf-8", "replace"))
        return out


class _Predict:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = self.model.value
        for whole in batches:
            rows = max(1, _CELLS // max(1, len(model.languages)))
            for batch in (part.slice(lo, rows) for part in slices(whole, "text") for lo in range(0, part.num_rows, rows)):
                names, score = model.predict(*string_buffers(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])


def bounded_sample(rows: DataFrame, key: str, id_col: str, bound: int, name: str = "sample") -> DataFrame:
    """About ``bound`` rows of each value of ``key``, by hash of the id and the sample's ``name``."""
    share = rows.groupBy(key).count().select(key, F.least(F.lit(1.0), bound / F.col("count")).alias("share"))
    share = bounded(share, _MOST_KEYS) or share
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(name)), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(share, key).where(place < F.col("share")).drop("share")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows: about ``sample_rows`` of every language, all words of these.

    Rows without text or language teach nothing; repeated rows count each.
    Words and n-grams are counted by the workers; the driver gets the tables.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    words = F.explode(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")).alias("w")
    counts = bounded_sample(rows, "lang", "id", sample_rows).select("lang", words).where("w <> ''").groupBy("lang", "w").count()
    counts = materialize(counts, "words")
    languages = sorted(x.lang for x in counts.select("lang").distinct().collect())
    place = docs.sparkSession.sparkContext.broadcast({x: i for i, x in enumerate(languages)})
    parts = map_arrow(counts, _Learn(place), "kind int, key bigint, lang int, weight double")
    keys = parts.groupBy("kind", "key").agg(F.sum("weight").alias("total"), F.collect_list(F.struct("lang", "weight")).alias("of")).where((F.col("kind") < 2) | (F.col("total") >= LEAST_WEIGHT))
    table = keys.select("kind", "key", F.explode("of").alias("x")).select("kind", "key", "x.lang", F.col("x.weight").cast("float").alias("weight")).toArrow()
    kind, key, lang, weight = (np.asarray(table.column(c)) for c in ("kind", "key", "lang", "weight"))
    discard(counts)
    return Model.build(kind, key.astype(np.int64).view(_U), lang, weight.astype(np.float64), languages)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with the predicted language and its probability.

    A null text, or one without a letter of any script, is ``und`` with score 0
    whatever else it holds; of equally likely languages the first in order of
    name is taken.  Texts of any length are read whole, word by word; every row,
    repeated ones too, gets its own result.  ``carry`` names the columns to return (all by default);
    columns of ``docs`` named like the new ones are replaced.
    """
    keep = [c for c in (carry or docs.columns) if c not in (lang_name, score_name)]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row")
    src = docs.select(row, F.col(text_col).cast("string").alias("text"))
    kind = src.schema["row"].dataType.simpleString()
    out = map_arrow(src, _Predict(docs.sparkSession.sparkContext.broadcast(model)), f"row {kind}, lang_pred string, score double")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], F.col("lang_pred").alias(lang_name), F.col("score").alias(score_name))


def held_out(id_col: str) -> Column:
    """crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
