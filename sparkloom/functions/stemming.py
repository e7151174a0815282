"""Confix-stripping stems of Indonesian words with a table of roots.

After Nazief and Adriani's method as published by Asian, Williams and
Tahaghoghi: suffixes come off in their order, then up to three prefixes, where
a prefix may have swallowed the root's first letter, which is put back.  All
ways are tried; what counts is only a way that ends at a known root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.sources.workspace import bounded

#: Inflectional endings, then derivational ones; at most one of each group comes off, in this order.
PARTICLES, POSSESSIVES, DERIVATIONS = ("lah", "kah", "tah", "pun"), ("ku", "mu", "nya"), ("kan", "an", "i")

#: Prefix, the pattern of a word that has it, and what is left; of a nasal prefix also with the letter that it swallows.
PREFIXES = (
    ("di", "^di(.{3,})$", "$1"),
    ("ke", "^ke(.{3,})$", "$1"),
    ("se", "^se(.{3,})$", "$1"),
    ("be", "^ber(.{3,})$", "$1"),
    ("be", "^be(r[aiueo].{2,})$", "$1"),
    ("be", "^bel(ajar)$", "$1"),
    ("be", "^be([^aiueorl]er[^aiueo].*)$", "$1"),
    ("te", "^ter(.{3,})$", "$1"),
    ("te", "^te(r[aiueo].{2,})$", "$1"),
    *(
        (p, pattern.format(p), to)
        for p in ("me", "pe")
        for pattern, to in (
            ("^{}([lrwy].{{2,}})$", "$1"),
            ("^{}m([bfvp].{{2,}})$", "$1"),
            ("^{}(m[aiueo].{{2,}})$", "$1"),
            ("^{}m([aiueo].{{2,}})$", "p$1"),
            ("^{}n([cdjstz].{{2,}})$", "$1"),
            ("^{}(n[aiueo].{{2,}})$", "$1"),
            ("^{}n([aiueo].{{2,}})$", "t$1"),
            ("^{}ng([ghkq].{{2,}})$", "$1"),
            ("^{}ng([aiueo].{{2,}})$", "$1"),
            ("^{}ng([aiueo].{{2,}})$", "k$1"),
            ("^{}nge(.{{3,}})$", "$1"),
            ("^{}ny([aiueo].{{2,}})$", "s$1"),
        )
    ),
    ("pe", "^per(.{3,})$", "$1"),
    ("pe", "^pel(ajar)$", "$1"),
)

#: First prefix and derivational ending that never surround a root together.
NEVER = frozenset({("be", "i"), ("di", "an"), ("ke", "i"), ("ke", "kan"), ("me", "an"), ("se", "i"), ("se", "kan"), ("te", "an")})

#: Prefixes that can come off one after another.
MOST_PREFIXES = 3


def _first(words: DataFrame) -> DataFrame:
    return words.select("word", F.col("word").alias("form"), F.lit(0).alias("steps"), F.lit("").alias("ending"), F.lit("").alias("prefix"))


def _grow(ways: DataFrame, each: list[Column]) -> DataFrame:
    """The ways and those one step further: ``each`` is (form, ending, prefix) or null."""
    same = F.struct("form", "steps", "ending", "prefix")
    more = [F.when(e.isNotNull(), F.struct(e["form"].alias("form"), (F.col("steps") + 1).alias("steps"), e["ending"].alias("ending"), e["prefix"].alias("prefix"))) for e in each]
    return ways.select("word", F.explode(F.array_distinct(F.array_compact(F.array(same, *more)))).alias("w")).select("word", "w.*")


def _without(ending: str, kept: Column) -> Column:
    """The form without an ending, where three letters are left."""
    fits = F.col("form").endswith(ending) & (F.length("form") >= len(ending) + 3)
    return F.when(fits, F.struct(F.substring("form", F.lit(1), F.length("form") - len(ending)).alias("form"), kept.alias("ending"), F.col("prefix").alias("prefix")))


def _without_prefix(name: str, pattern: str, to: str) -> Column:
    """The form without a prefix: not the same one twice, nor one that its ending excludes."""
    never = [e for p, e in NEVER if p == name]
    outer = F.when(F.col("prefix") == "", F.lit(name)).otherwise(F.concat("prefix", F.lit(" "), F.lit(name)))
    allowed = F.col("form").startswith(name) & ~F.array_contains(F.split("prefix", " "), name) & ((F.col("prefix") != "") | ~F.col("ending").isin(never) if never else F.lit(True))
    return F.when(allowed & F.col("form").rlike(pattern), F.struct(F.regexp_replace("form", pattern, to).alias("form"), F.col("ending").alias("ending"), outer.alias("prefix")))


def ways(words: DataFrame) -> DataFrame:
    """(word, form, steps, ending, prefix): every way to take affixes off each word, the word itself with none."""
    out = _first(words)
    out = _grow(out, [_without(e, F.col("ending")) for e in PARTICLES])
    out = _grow(out, [_without(e, F.col("ending")) for e in POSSESSIVES])
    out = _grow(out, [_without(e, F.lit(e)) for e in DERIVATIONS])
    for _ in range(MOST_PREFIXES):
        out = _grow(out, [_without_prefix(*rule) for rule in PREFIXES])
    return out


def stems(words: DataFrame, roots: DataFrame) -> DataFrame:
    """(word, stem) of the distinct ``words``: the root that the fewest steps lead to, of these the longest, then the first by name.

    A word that is a root is its own stem; one that no way leads to a root
    stays as it is.  ``roots`` is a table (word) of any size.
    """
    known = bounded(roots.where("word IS NOT NULL").select(F.col("word").alias("form")).distinct())
    found = ways(words.select("word").distinct()).join(known, "form", "left_semi")
    best = found.groupBy("word").agg(F.min(F.struct("steps", (-F.length("form")).alias("long"), "form")).alias("best"))
    return words.select("word").distinct().join(best, "word", "left").select("word", F.coalesce("best.form", "word").alias("stem"))
