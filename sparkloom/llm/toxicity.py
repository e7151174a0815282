"""Toxicity by a factorization machine over hashed terms.

Terms - words and their prefixes - are hashed into 2**20 buckets.  Features are
the buckets that go with the label beyond chance (root of the G statistic on the
training sample), and those of two words near each other whose pair does,
whatever each says alone.  The machine has a weight for each feature and factors
whose products weigh every pair, so that two terms may count together for more,
or less, than the sum of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import bytetext
from sparkloom.llm.common import discard, list_array, map_arrow, materialize, slices, string_buffers
from sparkloom.llm.langid import bounded_sample

BUCKET_BITS = 20
#: Bytes of the prefixes that are terms beside whole words.
PREFIXES = (4, 5, 6)
#: Bounds of the fit: expected rows of each label, features, factors.
SAMPLE_ROWS = 6000
FEATURES = 1024
FACTORS = 8
#: Words that a pair may lie apart, root of G and rows that a feature needs, and expected rows of each label that pairs are counted on.
NEAR = 4
LEAST_G, LEAST_ROWS = 5.5, 8
PAIR_ROWS = 2000


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term buckets of every word - one row for the word, one for each prefix - and the first word of each text.

    A prefix stands for the forms of a word; a word no longer than it stands for itself.
    """
    h, begin, end, at = bytetext.words(data, offsets, bytetext.ALNUM_WORDS)
    rows = [h]
    for size in PREFIXES:
        long = np.flatnonzero(end - begin > size)
        packed = np.full(long.size, size, np.uint64)
        for k in range(size):
            packed = (packed << np.uint64(8)) | bytetext.LOWER[data[begin[long] + k]]
        row = h.copy()
        row[long] = bytetext.mix(packed * np.uint64(0x9E3779B97F4A7C15))
        rows.append(row)
    return (np.stack(rows) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), at


@dataclass
class Machine:
    chosen: np.ndarray  # sorted buckets
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability for rows of 0/1 features."""
        s = x @ self.factor
        pairs = 0.5 * (s * s - x @ (self.factor * self.factor)).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + x @ self.weight + pairs, -30, 30)))

    @staticmethod
    def fit(rows: list[np.ndarray], label: np.ndarray, chosen: np.ndarray, shares: dict[int, float] | None = None, factors: int = FACTORS, epochs: int = 40, decay: float = 1e-4, seed: int = 7) -> "Machine":
        """Adam on the logistic loss over the ``chosen`` buckets; ``shares`` undoes the sampling of the labels."""
        label = label.astype(np.float64)
        n1, n0 = int(label.sum()), int((1 - label).sum())
        if not n1 or not n0:
            prior = (n1 + 0.5) / (n1 + n0 + 1.0) if n1 + n0 else 0.02
            return Machine(np.zeros(0, np.int32), float(np.log(prior / (1 - prior))), np.zeros(0), np.zeros((0, factors)))
        chosen = np.sort(chosen).astype(np.int32)
        x = np.stack([np.isin(chosen, r) for r in rows]).astype(np.float32) if chosen.size else np.zeros((len(rows), 0), np.float32)
        shares = shares or {}
        row_weight = np.where(label == 1, 1.0 / shares.get(1, 1.0), 1.0 / shares.get(0, 1.0))
        row_weight /= row_weight.mean()
        rng = np.random.default_rng(seed)
        w, v = np.zeros(chosen.size), rng.normal(0, 0.05, (chosen.size, factors))
        prior = np.average(label, weights=row_weight)
        b = np.array([np.log(prior / (1 - prior))])
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (b, w, v)]
        step = 0
        for _ in range(max(epochs, min(400, 256_000 // len(rows)))):  # few rows: more rounds
            for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 256)):
                part = x[at].astype(np.float64)
                s = part @ v
                out = b + part @ w + 0.5 * (s * s - part @ (v * v)).sum(axis=1)
                g = row_weight[at] * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label[at]) / len(at)
                grads = (g.sum(keepdims=True), part.T @ g + decay * w, part.T @ (g[:, None] * s) - (part.T @ g)[:, None] * v + decay * v)
                step += 1
                for p, d, m in zip((b, w, v), grads, moments, strict=True):
                    m[0] += 0.1 * (d - m[0])
                    m[1] += 0.001 * (d * d - m[1])
                    p -= 0.02 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
        return Machine(chosen, float(b[0]), w, v)


def g_root(n1: np.ndarray, n0: np.ndarray, rows1: int, rows0: int) -> np.ndarray:
    """Root of the G statistic of being in ``n1`` of the rows of label 1 and ``n0`` of those of label 0."""
    both, total = n1 + n0, rows1 + rows0
    g = np.zeros(both.size)
    for seen, n in ((n1, rows1), (n0, rows0)):
        for k, expected in ((seen, both * n / total), (n - seen, (total - both) * n / total)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g += np.where(k > 0, 2 * k * np.log(k / expected), 0.0)
    return np.sqrt(np.maximum(g, 0))


class _Terms:
    """mapInArrow on (label, text): (label, the terms that ``wanted`` marks)."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted = wanted

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                term, at = buckets(*string_buffers(batch.column(1)))
                sets = [np.unique(term[:, lo:hi]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
                if self.wanted is not None:
                    sets = [x[self.wanted[x]] for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0), list_array(np.concatenate(sets), np.array([s.size for s in sets]), pa.int32())], names=["label", "terms"])


class _Pairs:
    """mapInArrow on (label, text): (label, pairs of ``frequent`` words at most ``NEAR`` apart, as one number)."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                term, at = buckets(*string_buffers(batch.column(1)))
                sets = []
                for lo, hi in zip(at[:-1], at[1:], strict=True):
                    w = term[0, lo:hi].astype(np.int64)
                    parts = [np.zeros(0, np.int64)]
                    for k in range(1, min(NEAR, w.size - 1) + 1):
                        a, b = np.minimum(w[:-k], w[k:]), np.maximum(w[:-k], w[k:])
                        ok = (a != b) & self.frequent[a] & self.frequent[b]
                        parts.append(a[ok] << BUCKET_BITS | b[ok])
                    sets.append(np.unique(np.concatenate(parts)))
                yield pa.RecordBatch.from_arrays([batch.column(0), list_array(np.concatenate(sets), np.array([s.size for s in sets]), pa.int64())], names=["label", "terms"])


def _counted(rows: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, rows of label 1, of label 0) of the keys in ``least`` rows or more."""
    n = lambda k: F.sum((F.col("label") == k).cast("int")).alias(f"n{k}")
    counts = rows.select("label", F.explode("terms").alias("key")).groupBy("key").agg(n(1), n(0)).where(F.col("n1") + F.col("n0") >= least)
    table = counts.orderBy("key").toArrow()
    return np.asarray(table.column("key")), np.asarray(table.column("n1")).astype(np.float64), np.asarray(table.column("n0")).astype(np.float64)


class _Score:
    def __init__(self, machine):
        self.machine = machine

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Machine = self.machine.value
        column = np.full(1 << BUCKET_BITS, -1, np.int32)
        column[m.chosen] = np.arange(m.chosen.size)
        for whole in batches:
            for batch in slices(whole, "text"):
                term, at = buckets(*string_buffers(batch.column(1)))
                word, feature = [], []
                for row in term:
                    of = column[row]
                    seen = np.flatnonzero(of >= 0)
                    word.append(seen)
                    feature.append(of[seen])
                word, feature = np.concatenate(word), np.concatenate(feature)
                order = np.argsort(word, kind="stable")
                doc, feature = np.searchsorted(at, word[order], side="right") - 1, feature[order]
                score = np.empty(batch.num_rows)
                for lo in range(0, batch.num_rows, 1024):
                    x = np.zeros((min(1024, batch.num_rows - lo), m.chosen.size))
                    mine = slice(*np.searchsorted(doc, (lo, lo + x.shape[0])))
                    x[doc[mine] - lo, feature[mine]] = 1.0
                    score[lo : lo + x.shape[0]] = m.score(x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, pair_rows: int = PAIR_ROWS, features: int = FEATURES) -> Machine:
    """Fit on a bounded sample of the labelled rows of ``docs``.

    About ``sample_rows`` rows of each label, and ``pair_rows`` of each for the
    pairs, are learned from; the machine has ``features`` buckets at most.  The
    driver gets counts by bucket, counts of the pairs that are frequent enough,
    and of each sampled row the buckets that are features, whatever the length
    of its text.

    Null labels and ids teach nothing; of labels that disagree on an id, 1 wins.
    Rows that repeat an id are each learned from; texts are read whole.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")).where("label in (0, 1)")
    sizes = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    shares = {k: min(1.0, sample_rows / n) for k, n in sizes.items()}
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = materialize(text.join(F.broadcast(bounded_sample(marks, "label", "id", sample_rows)), "id").select("id", "label", "text"), "sample")
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    texts = sample.select("label", "text")
    if len(n) < 2:
        label = np.repeat(np.array([*n] or [0]), [*n.values()] or [0])
        return Machine.fit([np.zeros(0, np.int32)] * label.size, label, np.zeros(0, np.int32))
    key, n1, n0 = _counted(map_arrow(texts, _Terms(), "label int, terms array<int>"), LEAST_ROWS)
    g = g_root(n1, n0, n[1], n[0])
    frequent = np.zeros(1 << BUCKET_BITS, bool)
    frequent[key] = True
    some = materialize(bounded_sample(sample, "label", "id", pair_rows, "pairs").select("label", "text"), "pairs")
    m = {r["label"]: r["count"] for r in some.groupBy("label").count().collect()}
    pair, p1, p0 = _counted(map_arrow(some, _Pairs(frequent), "label int, terms array<bigint>"), 4 * LEAST_ROWS)
    h = g_root(p1, p0, m.get(1, 0), m.get(0, 0)) if len(m) == 2 else np.zeros(pair.size)
    # A pair that says no more than one of its words adds nothing; it must beat both on the same rows.
    alone = np.zeros(1 << BUCKET_BITS)
    alone[key] = g * np.sqrt(sum(m.values()) / sum(n.values()))
    a, b = pair >> BUCKET_BITS, pair & ((1 << BUCKET_BITS) - 1)
    telling = (h >= LEAST_G) & (h > alone[a] + 1) & (h > alone[b] + 1)
    score_of = np.zeros(1 << BUCKET_BITS)
    score_of[key] = np.where(g >= LEAST_G, g, 0.0)
    for word in (a, b):
        np.maximum.at(score_of, word[telling], h[telling])
    order = np.argsort(-score_of, kind="stable")[:features]
    chosen = order[score_of[order] > 0]
    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[chosen] = True
    rows = map_arrow(texts, _Terms(wanted), "label int, terms array<int>").toArrow().combine_chunks()
    terms = rows.column("terms").combine_chunks()
    flat, offsets = np.asarray(terms.flatten()), np.asarray(terms.offsets) - terms.offsets[0].as_py()
    sets = [flat[x:y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
    label = np.asarray(rows.column("label"))
    order = sorted(range(len(sets)), key=lambda i: (int(label[i]), sets[i].tobytes()))  # the fit doesn't depend on the order of tasks
    discard(sample, some)
    return Machine.fit([sets[i] for i in order], label[order], chosen, shares)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", score_name: str = "score", predicted_name: str = "predicted", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with a probability of being toxic and the decision at 0.5.

    Null and empty texts have no terms and get the machine's base rate.
    ``carry`` names the columns to return (all by default); columns of ``docs``
    named like the new ones are replaced.
    """
    keep = [c for c in (carry or docs.columns) if c not in (score_name, predicted_name)]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row")
    src = docs.select(row, F.col(text_col).cast("string").alias("text"))
    kind = src.schema["row"].dataType.simpleString()
    out = map_arrow(src, _Score(docs.sparkSession.sparkContext.broadcast(machine)), f"row {kind}, score double")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias(score_name), (F.col("score") >= 0.5).cast("int").alias(predicted_name))
