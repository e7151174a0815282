"""Part-of-speech tagging by a hidden Markov model with suffix emissions.

Transitions between tags and emissions of words are counted over tagged
sentences.  A word that was not seen is emitted by its longest known suffix,
learned from rare words.  Every distinct word gets its emissions once; the
sentences of a chunk of texts are decoded where they lie, by Viterbi's
recursion over many of them at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.operators.dictionary import Chunk, encode, groups, sums
from sparkloom.sources.workspace import bounded, written

#: Added to every count.
SMOOTH = 0.1

#: Words seen up to this often teach suffixes, which have up to so many letters.
RARE, LONGEST_SUFFIX = 10, 3

#: Tags of a model: transitions are part of a plan.
MOST_TAGS = 100

#: Numbers of a step of the decoding: sentences times tags times tags.
STEP = 1 << 18


@dataclass
class Tagger:
    """Log probabilities: ``start`` and ``moves`` [from][to] by tag number, tables (word, e) and (suffix, e) with one number a tag."""

    tags: list[str]
    start: list[float]
    moves: list[list[float]]
    words: DataFrame
    suffixes: DataFrame

    def save(self, path: str) -> None:
        spark = self.words.sparkSession
        spark.createDataFrame([(i, t, s, m) for i, (t, s, m) in enumerate(zip(self.tags, self.start, self.moves, strict=True))], "number int, tag string, start double, moves array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/tags")
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        self.suffixes.write.mode("overwrite").parquet(f"{path}/suffixes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Tagger":
        rows = spark.read.parquet(f"{path}/tags").orderBy("number").collect()
        return Tagger([r.tag for r in rows], [r.start for r in rows], [list(r.moves) for r in rows], spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/suffixes"))


def _emissions(counts: DataFrame, by: str, tags: list[str], total: dict[str, int], n: int) -> DataFrame:
    """(by, e) from (by, tag, n) counts: log P(by | tag), smoothed over the ``n`` values of ``by``."""
    of = counts.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("of"))
    one = lambda t: F.log((F.coalesce(F.col("of")[t], F.lit(0)) + SMOOTH) / (total.get(t, 0) + SMOOTH * n))
    return of.select(by, F.array(*[one(t) for t in tags]).alias("e"))


def train(tagged: DataFrame, sentence: list[str], place: str = "place", word: str = "word", tag: str = "tag") -> Tagger:
    """A model of tagged words; ``sentence`` names the columns that a sentence's words share, ``place`` their order.

    Rows without word or tag are left out; at most ``MOST_TAGS`` tags.
    """
    rows = tagged.where(F.col(word).isNotNull() & F.col(tag).isNotNull()).select(*sentence, F.col(place).alias("place"), F.col(word).alias("word"), F.col(tag).alias("tag"))
    return _model(rows.withColumn("before", F.lag("tag").over(Window.partitionBy(*sentence).orderBy("place"))))


def train_sentences(tagged: DataFrame, sentence: str = "tagged") -> Tagger:
    """As ``train``, of a row a sentence, an array of (word, tag): only counts are shuffled."""
    full = tagged.select(F.filter(sentence, lambda x: x["word"].isNotNull() & x["tag"].isNotNull()).alias("ws"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("ws", lambda x: x["tag"]))
    pairs = F.zip_with("ws", before, lambda x, b: F.struct(x["word"].alias("word"), x["tag"].alias("tag"), b.alias("before")))
    return _model(full.select(F.inline(pairs)).where("word IS NOT NULL"))


def _model(rows: DataFrame) -> Tagger:
    """A model of (word, tag, before) rows, which are counted in one pass."""
    seen, _ = written(rows.groupBy("word", "tag", "before").agg(F.count("*").alias("n")), "moves")
    moves = {(r.before, r.tag): r.n for r in seen.groupBy("before", "tag").agg(F.sum("n").alias("n")).limit((MOST_TAGS + 1) ** 2 + 1).collect()}
    tags = sorted({t for _, t in moves})
    if len(tags) > MOST_TAGS:
        raise ValueError(f"more than {MOST_TAGS} tags")
    row = lambda b: [moves.get((b, t), 0) + SMOOTH for t in tags]
    logs = lambda xs: [math.log(x / sum(xs)) for x in xs]
    counts, _ = written(seen.groupBy("word", "tag").agg(F.sum("n").alias("n")), "tagged")
    total = {r.tag: r.n for r in counts.groupBy("tag").agg(F.sum("n").alias("n")).collect()}
    words, _ = written(_emissions(counts, "word", tags, total, counts.select("word").distinct().count()), "emissions")
    rare = counts.join(counts.groupBy("word").agg(F.sum("n").alias("all")).where(F.col("all") <= RARE), "word")
    ends = rare.select("tag", "n", F.explode(F.array(*suffixes(F.col("word")))).alias("suffix")).where("suffix IS NOT NULL")
    ends, _ = written(ends.groupBy("suffix", "tag").agg(F.sum("n").alias("n")), "suffixes")
    learnt = {r.tag: r.n for r in ends.where("suffix = ''").collect()}
    return Tagger(tags, logs(row(None)), [logs(row(b)) for b in tags], words, _emissions(ends, "suffix", tags, learnt, max(1, ends.select("suffix").distinct().count())))


def suffixes(word: Column) -> list[Column]:
    """The endings of a word, longest first, the empty one last; null where the word is no longer than the ending."""
    return [*[F.when(F.length(word) > k, F.right(word, F.lit(k))) for k in range(LONGEST_SUFFIX, 0, -1)], F.lit("")]


def emit(words: DataFrame, model: Tagger) -> DataFrame:
    """``words`` (word, n) with ``e``: the word's own emissions, else those of its longest known suffix, else all tags alike."""
    out = words.join(bounded(model.words), "word", "left")
    known = bounded(written(model.suffixes.select("suffix", F.col("e").alias("by_suffix")), "suffixes")[0])
    for suffix in suffixes(F.col("word")):
        near = out.withColumn("suffix", F.when(F.col("e").isNull(), suffix)).join(known, "suffix", "left")
        out = near.select("word", "n", F.coalesce("e", "by_suffix").alias("e"))
    flat = F.array(*[F.lit(0.0)] * len(model.tags)).cast("array<double>")
    return out.select("word", "n", F.coalesce("e", flat).alias("e"))


def decode(emissions: np.ndarray, at: np.ndarray, sizes: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The numbers of the likeliest tags of all words; of equal ones the smaller number, from the end.

    ``emissions`` has a row a distinct word and ``at`` names the one of each
    word, ``sizes`` the words of each sentence.  Sentences of like length go
    together, a step takes the next word of each.
    """
    k, begin, out = len(start), sums(sizes)[:-1], np.empty(len(at), np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    many = max(1, STEP // (k * k))
    for block in (order[i : i + many] for i in range(0, len(order), many)):
        first, size, back = begin[block], sizes[block], []
        alive = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]
        cells = start + emissions[at[first]]
        for t in range(1, len(alive)):
            ways = cells[: alive[t], :, None] + moves
            back.append(ways.argmax(axis=1).astype(np.int8))
            cells[: alive[t]] = np.take_along_axis(ways, back[-1][:, None, :].astype(np.intp), 1)[:, 0] + emissions[at[first[: alive[t]] + t]]
        tag = cells.argmax(axis=1)
        for t in range(len(alive) - 1, 0, -1):
            n = alive[t]
            out[first[:n] + t] = tag[:n]
            tag[:n] = back[t - 1][np.arange(n), tag[:n]]
        out[first] = tag
    return out


def tag(docs: DataFrame, keys: list[str], text: str, model: Tagger) -> DataFrame:
    """(keys, sentence, tagged): (word, tag) of the lower-case words of every sentence of every row; a text without words gives no row.

    A sentence is decoded in one task, in time and memory that grow with its words.
    """
    coded = encode(docs.select(*keys, F.lower(text).alias("text")), keys, "text")
    facts, _ = written(emit(coded.words(), model), "emitted")
    start, moves, names = np.array(model.start), np.array(model.moves), pa.array(model.tags, pa.string())

    def tagged(chunk: Chunk) -> tuple[np.ndarray, dict]:
        emissions = chunk.column("e").flatten().to_numpy().reshape(-1, max(1, len(names)))
        tags = names.take(pa.array(decode(emissions, chunk.at, chunk.sizes, start, moves))) if len(names) else pa.nulls(len(chunk.words), pa.string())
        full = chunk.sizes > 0
        rows = np.repeat(np.arange(len(chunk.lines)), chunk.lines)
        number = np.arange(len(rows)) - sums(chunk.lines)[rows]
        pairs = pa.StructArray.from_arrays([chunk.words, tags], names=["word", "tag"])
        return rows[full], {"sentence": pa.array(number[full], pa.int32()), "tagged": groups(chunk.sizes[full], pairs)}

    return coded.rebuild(facts, ["e"], tagged, "sentence int, tagged array<struct<word: string, tag: string>>")


def tag_texts(docs: DataFrame, key: str, text: str, model: Tagger) -> DataFrame:
    """(key, tagged): the tagged sentences of every key that has words, as one array."""
    each = tag(docs, [key], text, model)
    return each.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("sentence", "tagged"))), lambda s: s["tagged"]).alias("tagged"))
