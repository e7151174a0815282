"""Formal words for informal ones within one edit, by an index of symmetric deletions.

Two words are one insertion, deletion or replacement apart only if deleting one
letter or none of each gives the same string.  So words meet by equal strings,
never all with all; what meets is verified by edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.sources.workspace import bounded

#: Letters that a word needs to be replaced: shorter ones have too many neighbours.
SHORTEST = 4


def deletions(word: Column) -> Column:
    """The word and all strings that lack one of its letters."""
    without = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), F.when(F.length(word) > 0, without).otherwise(F.array().cast("array<string>"))))


def formal_words(words: DataFrame, formal: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, formal): for every distinct word that is not formal the formal one within one edit, where there is one.

    ``formal`` has word and n, how often it occurs: the most frequent wins, of
    equally frequent ones the first by name.  Words of fewer than ``shortest``
    letters have none, nor are short words proposed.  A word longer than all
    formal ones by two letters or more can have none and makes no deletions.
    """
    known = formal.where(F.length("word") >= shortest).groupBy("word").agg(F.max("n").alias("n"))
    longest = known.agg(F.max(F.length("word"))).first()[0] or 0
    rest = words.select("word").distinct().where(F.length("word").between(shortest, longest + 1)).join(bounded(formal.select("word").distinct()), "word", "left_anti")
    index = known.select(F.col("word").alias("formal"), "n", F.explode(deletions(F.col("word"))).alias("part"))
    pairs = rest.select("word", F.explode(deletions(F.col("word"))).alias("part")).join(bounded(index), "part").where(F.levenshtein("word", "formal", 1) >= 0)
    return pairs.groupBy("word").agg(F.min(F.struct((-F.col("n")).alias("rare"), "formal")).alias("best")).select("word", "best.formal")
