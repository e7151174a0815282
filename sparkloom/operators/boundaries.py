"""Sentence boundaries by what the corpus shows of its abbreviations.

After Kiss and Strunk: a word that nearly always comes with a full stop is an
abbreviation, the likelier the shorter it is.  A second pass decides each mark
by the word before and the word after it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.dictionary import Chunk, encode, groups
from sparkloom.sources.workspace import bounded, written

#: Share of an abbreviation's occurrences that have the stop, and the least score of one.
WITH_STOP, LEAST_SCORE = 0.99, 0.3


def kind(word: Column) -> Column:
    """The word in small letters without its last full stop."""
    return F.regexp_replace(F.lower(word), "[.]$", "")


def abbreviations(words: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(kind, score) of the abbreviations among (word, n) rows, distinct words with their counts.

    The score is twice the logarithm of how much likelier the stops of a kind
    are for an abbreviation than for any word, less for longer ones, more for
    stops inside, and much less for every occurrence without a stop.
    """
    dotted = F.col("word").endswith(".")
    kinds = words.groupBy(kind(F.col("word")).alias("kind")).agg(F.sum(F.when(dotted, F.col("n")).otherwise(0)).alias("dot"), F.sum("n").alias("n"))
    share = words.agg(F.sum(F.when(dotted, F.col("n")).otherwise(0)) / F.sum("n")).first()[0] or 0.0
    some = kinds.where("dot > 0").where(F.col("kind").rlike(r"^[\p{L}.]*\p{L}[\p{L}.]*$"))
    rest, inner = F.col("n") - F.col("dot"), F.length("kind") - F.length(F.replace("kind", F.lit("."), F.lit("")))
    size = F.length("kind") - inner
    odds = F.col("dot") * (math.log(WITH_STOP / share) if share else 0.0) + rest * (math.log((1.0 - WITH_STOP) / (1.0 - share)) if share < 1 else 0.0)
    score = 2 * odds * F.exp(-size - rest * F.log(size.cast("double"))) * (inner + 1)
    return some.withColumn("score", score).where(F.col("score") >= least).select("kind", "score")


def split(docs: DataFrame, keys: list[str], text: str, least: float = LEAST_SCORE) -> DataFrame:
    """(keys, sentence, text) of the sentences of every row, words with one space between.

    A word that ends with ! or ? ends a sentence.  One with a full stop does,
    but for a number before a word in small letters or a digit, and an
    abbreviation that is not before a capital of a word that the corpus has in
    small letters too.  The last word of a text ends one.  Stops inside a word,
    as in decimals, are none.  A row without words has no sentence.
    """
    coded = encode(docs, keys, text, by_sentence=False)
    words, _ = written(coded.words(), "words")
    known = bounded(written(abbreviations(words, least).select("kind", F.lit(True).alias("short")), "short")[0])
    small = words.where(F.col("word").rlike(r"^\p{Ll}")).select(kind(F.col("word")).alias("kind"), F.lit(True).alias("small")).distinct()
    small = bounded(written(small, "small")[0])
    facts = words.withColumn("kind", kind(F.col("word"))).join(known, "kind", "left").join(small, "kind", "left")
    word, known_as = F.col("word"), lambda c: F.coalesce(c, F.lit(False))
    marks = {"short": known_as("short"), "mark": word.rlike("[!?]$"), "dot": word.endswith("."), "number": word.rlike("^[0-9]+[.]$"), "low": word.rlike(r"^[\p{Ll}0-9]"), "opens": word.rlike(r"^\p{Lu}") & known_as("small")}
    facts, _ = written(facts.select("word", "n", *[c.alias(k) for k, c in marks.items()]), "kinds")
    return coded.rebuild(facts, list(marks), _sentences, "sentence int, text string")


def _sentences(chunk: Chunk) -> tuple[np.ndarray, dict]:
    """The sentences of a chunk's texts, by what is known of each word and the one after it."""
    of = {k: np.asarray(chunk[k]) for k in ("short", "mark", "dot", "number", "low", "opens")}
    after = {k: np.append(of[k], False)[1:] for k in ("low", "opens")}
    last = np.zeros(len(chunk.words), bool)
    last[np.cumsum(chunk.totals)[chunk.totals > 0] - 1] = True
    stop = np.where(of["number"], ~after["low"], ~of["short"] | after["opens"])
    ends = np.flatnonzero(last | of["mark"] | (of["dot"] & stop))
    rows = np.repeat(np.arange(len(chunk.totals)), chunk.totals)[ends]
    number = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows, {"sentence": pa.array(number, pa.int32()), "text": pc.binary_join(groups(np.diff(ends, prepend=-1), chunk.words), " ")}
