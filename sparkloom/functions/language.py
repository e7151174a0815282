"""Language detection by rank profiles of character trigrams.

A profile is a table (lang, gram, rank) of each language's most frequent
trigrams, learned from labelled texts.  A text's own trigrams are ranked the
same way; a language is as far from it as these ranks are out of place (Cavnar
and Trenkle), and the nearest one wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkloom.sources.workspace import written

#: Ranks of a profile and of a text.
RANKS = 300

#: A text is of no known language if it is nearer to the worst distance than this share of it.
LEAST = 0.12

#: Rows of a profile table up to which it is broadcast.
BROADCAST_ROWS = 1 << 18

SCHEMA = "lang string, gram string, rank int"


def trigrams(text: Column) -> Column:
    """Overlapping trigrams around every letter of the lower-case words; ``_`` stands for what is between words."""
    return F.regexp_extract_all(_marked(text), F.lit("(?=(.[^_].))"), F.lit(1))


def _marked(text: Column) -> Column:
    return F.concat(F.lit("_"), F.regexp_replace(F.lower(text), r"[^\p{L}]+", "_"), F.lit("_"))


def ranked(counts: DataFrame, keys: list[str], ranks: int) -> DataFrame:
    """The ``ranks`` most frequent trigrams of each key with their rank from 1, ties by trigram."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("count"), "gram"))
    return counts.withColumn("rank", place).where(F.col("rank") <= ranks)


def profiles(labelled: DataFrame, lang: str = "lang", text: str = "text", ranks: int = RANKS) -> DataFrame:
    """(lang, gram, rank) of every language of ``labelled``; rows without a language or text teach nothing."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(text))).alias("gram"))
    return ranked(rows.groupBy("lang", "gram").count(), ["lang"], ranks).select("lang", "gram", "rank")


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", ranks: int = RANKS) -> DataFrame:
    """The profiles, written once."""
    return written(profiles(labelled, lang, text, ranks), "profiles")[0]


def detect(rows: DataFrame, keys: list[str], text: str, known: DataFrame, ranks: int = RANKS, least: float = LEAST) -> DataFrame:
    """(keys, detected) of every key: the nearest language of the ``known`` profiles, by name where equal.

    Null where a text has no letter (null, digits, marks) or is far from all
    profiles.  Rows that share a key are one text.  Where a count shows that
    the profiles are few, a text is ranked and compared where it is, and only
    those of repeated keys are dealt out; else trigrams are counted before
    they are shuffled and joined to the profiles.
    """
    known_rows = known.where("length(gram) = 3 AND lang IS NOT NULL AND rank IS NOT NULL").select("lang", "gram", F.col("rank").alias("known_rank"))
    profile = known_rows.limit(BROADCAST_ROWS + 1).collect()  # bounded
    if len(profile) > BROADCAST_ROWS:
        return _detect_joined(rows, keys, text, known_rows, ranks, least)
    again = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    if again.isEmpty():
        return _detect_here(rows, keys, text, profile, ranks, least)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    once = _detect_here(rows.join(again, same, "left_anti"), keys, text, profile, ranks, least)
    return once.unionByName(_detect_joined(rows.join(again, same, "left_semi"), keys, text, F.broadcast(known_rows), ranks, least))


def _detect_joined(rows: DataFrame, keys: list[str], text: str, named: DataFrame, ranks: int, least: float) -> DataFrame:
    """``detect`` for any number of profiles and rows a key: every trigram is a row."""
    counts = rows.select(*keys, F.explode_outer(trigrams(F.col(text))).alias("gram")).groupBy(*keys, "gram").count()
    # Texts without a letter have a row without a trigram, which takes no rank from others of their key.
    near = ranked(counts.withColumn("count", F.when(F.col("gram").isNotNull(), F.col("count")).otherwise(0)), keys, ranks + 1).join(named, "gram", "left")
    near = near.where(F.col("gram").isNull() | (F.col("rank") <= ranks))
    agreed = F.sum(ranks - F.abs(F.col("rank") - F.col("known_rank")))
    each = near.groupBy(*keys, "lang").agg(agreed.alias("agreed"), F.max(F.when(F.col("gram").isNotNull(), F.col("rank"))).alias("n"))
    # The least (-agreed, name) is the nearest language, the first by name.
    best = F.min(F.when(F.col("agreed").isNotNull(), F.struct((-F.col("agreed")).alias("against"), "lang")))
    top = each.groupBy(*keys).agg(best.alias("best"), F.max("n").alias("n"))
    sure = -F.col("best.against") >= least * ranks * F.col("n")
    return top.select(*keys, F.when(sure, F.col("best.lang")).alias("detected"))


def _detect_here(rows: DataFrame, keys: list[str], text: str, profile: list, ranks: int, least: float) -> DataFrame:
    """``detect`` where a row is a key: every text is ranked in place, by numbers of its trigrams."""
    langs = sorted({r.lang for r in profile})
    number = {x: i for i, x in enumerate(langs)}
    entries = sorted((_packed(r.gram), number[r.lang], r.known_rank) for r in profile)
    grams, lang, place = (np.array([e[i] for e in entries], dtype="i8") for i in range(3))
    names = [f"k{i}" for i in range(len(keys))]
    marked = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], _marked(F.col(text)).alias("marked"))

    def nearest(marked: str | None) -> str | None:
        c = np.frombuffer((marked or "").encode("utf-32-le"), dtype="u4").astype("i8")
        found, counts = np.unique(((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[c[1:-1] != ord("_")], return_counts=True)
        top = found[np.argsort(-counts, kind="stable")[:ranks]]  # of equal counts the first trigram
        first, last = np.searchsorted(grams, top), np.searchsorted(grams, top, side="right")
        width = last - first
        at = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
        if not len(at):
            return None
        near = ranks - np.abs(np.repeat(np.arange(1, len(top) + 1), width) - place[at])
        agreed = np.bincount(lang[at], weights=near, minlength=len(langs))
        agreed[np.bincount(lang[at], minlength=len(langs)) == 0] = -np.inf
        best = int(np.argmax(agreed))  # of equal ones the first by name
        return langs[best] if agreed[best] >= least * ranks * len(top) else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([nearest(x.as_py()) for x in b.column("marked")], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], found], [*names, "detected"])

    schema = StructType([*marked.schema.fields[:-1], StructField("detected", StringType())])
    return marked.mapInArrow(each, schema).select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "detected")


def _packed(gram: str) -> int:
    """A trigram as a number whose order is that of the trigrams."""
    a, b, c = (ord(x) for x in gram)
    return a << 42 | b << 21 | c


def of_language(rows: DataFrame, keys: list[str], text: str, known: DataFrame, target: str) -> DataFrame:
    """The rows whose text is in the ``target`` language; ``keys`` name a text and are not null."""
    found = detect(rows, keys, text, known).where(F.col("detected") == target)
    return rows.join(found.select(*keys), keys, "left_semi")
