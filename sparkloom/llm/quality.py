"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Rules compare simple statistics of a text with cutoffs.  Cutoffs are chosen
from labelled rows, per stratum: half of them (by hash of the id) rank cutoffs
by use, the other half - the holdout - certifies them.  A cutoff is certified
when the exact binomial test rejects "this rule rejects more than its share of
good texts"; along a rule's grid cutoffs are tested from the mildest on and
testing stops at the first failure (fixed sequence), and over rules and strata
the error level is split (Bonferroni).  So with confidence 1 - ``delta`` no
stratum loses more than ``alpha`` of its good texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

#: Cutoffs in per mille, mildest first; a text fails a rule above its cutoff.
GRID = {
    "symbol_rate": [900, 700, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20],
    "dup_line_rate": [900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100],
    "repeat_rate": [900, 800, 700, 600, 500, 400, 350, 300, 250, 200],
    "capital_rate": [900, 800, 700, 600, 500, 400, 300, 250, 200],
    "shout_rate": [900, 700, 500, 400, 300, 200, 150, 100, 80, 60, 40],
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(positions: Column) -> Column:
    """Words in the 3-word windows that start at the ascending ``positions``."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    step = lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(3), p - acc["last"])).alias("total"))
    return F.aggregate(positions, start, step, lambda acc: acc["total"])


def _repeats(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes.  Few repeated windows are looked up
    directly; many are found by sorting (hash, position).
    """

    def of(t: Column) -> Column:
        def marked(twice: Column) -> Column:
            few = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.array_contains(twice, F.get(t, i)))

            def many(s: Column) -> Column:
                same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
                return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

            pairs = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return F.when(F.size(twice) == 0, F.lit(0)).when(F.size(twice) <= 24, _covered(few)).otherwise(_covered(let(pairs, many)))

        return let(let(F.sort_array(t), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))), marked)

    windows = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(let(hashed, windows), of)).cast("bigint")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Counts of each text: id, stratum, the base counts and those of the rules."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    base = docs.select(F.col(id_col).alias("id"), stratum.alias("stratum"), text.alias("t"))
    words = F.filter(F.split("t", SPACE), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c: c.cast("bigint")
    without = lambda pattern: long(F.length("t") - F.length(F.regexp_replace("t", pattern, "")))
    counted = base.select(
        "id",
        "stratum",
        let(words, lambda w: F.struct(long(F.size(w)).alias("n_words"), _repeats(w).alias("n_repeat_words"), long(F.size(F.filter(w, lambda x: x.endswith("!!")))).alias("n_shouts"))).alias("w"),
        let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("l"),
        long(F.length(F.regexp_replace("t", SPACE, ""))).alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        without("[A-Z]+").alias("n_capitals"),
    )
    return counted.select("id", "stratum", "w.*", "l.*", "word_chars", "n_symbols", "n_capitals")


def rates(counts: DataFrame) -> dict[str, Column]:
    """The rules' statistics in per mille, 0 for texts without words."""
    per = lambda a, b: F.when(F.col(b) > 0, 1000.0 * F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbol_rate": per("n_symbols", "word_chars"),
        "dup_line_rate": per("n_dup_lines", "n_lines"),
        "repeat_rate": per("n_repeat_words", "n_words"),
        "capital_rate": per("n_capitals", "word_chars"),
        "shout_rate": per("n_shouts", "n_words"),
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact; 1 where k reaches the mean.

    Summed downwards from the term at k, whose logarithm is a sum of ratios.
    """
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    top = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.log((n - i + 1) / i)) + k * math.log(p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p
    inner = F.aggregate(steps, F.lit(1.0), lambda acc, i: 1.0 + acc * (i / (n - i + 1)) * odds)
    return F.when(k >= p * n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * inner))


def certify(counts: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05, label_col: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff): the certified cutoff of most use of each rule.

    ``labels`` has id and ``label_col`` (1 good, 0 bad).  Use is counted on the
    fitting half as bad texts rejected less ten times good ones; a rule that is
    of no use, or has no certified cutoff, is absent from its stratum.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max(label_col).alias("good"))
    known = counts.join(marks, "id").withColumn("held", F.pmod(F.xxhash64("id", F.lit("holdout")), F.lit(2)) == 1)
    rated = known.select("stratum", "good", "held", *[v.alias(k) for k, v in rates(known).items()])
    rules = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("value"), F.array(*[F.lit(c) for c in g]).alias("grid")) for k, g in GRID.items()])).alias("r")
    per_rule = rated.select("stratum", "good", "held", rules).select("stratum", "good", "held", "r.rule", "r.value", F.posexplode("r.grid").alias("place", "cutoff"))
    over = F.col("value") > F.col("cutoff")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    tests = per_rule.groupBy("stratum", "rule", "place", "cutoff").agg(
        count(F.col("held") & (F.col("good") == 1)).alias("n"),
        count(F.col("held") & (F.col("good") == 1) & over).alias("k"),
        count(~F.col("held") & (F.col("good") == 0) & over).alias("bad"),
        count(~F.col("held") & (F.col("good") == 1) & over).alias("lost"),
    )
    strata = tests.agg(F.countDistinct("stratum").alias("strata"))
    level = delta / len(GRID) / F.greatest(F.col("strata"), F.lit(1))
    tests = tests.crossJoin(F.broadcast(strata)).withColumn("passed", binomial_tail(F.col("k"), F.col("n"), alpha / len(GRID)) <= level)
    first = Window.partitionBy("stratum", "rule").orderBy("place")
    certified = tests.withColumn("passed", F.min("passed").over(first)).where("passed")
    use = F.col("bad") - 10 * F.col("lost")
    best = certified.groupBy("stratum", "rule").agg(F.max(F.struct(use.alias("use"), F.col("cutoff").alias("cutoff"))).alias("b"))
    return best.where("b.use > 0").select("stratum", "rule", "b.cutoff")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", label_id_col: str = "doc_id", label_col: str = "quality", alpha: float = 0.05, delta: float = 0.05, min_words: int = 50) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, failed_rules, kept.

    ``base_failed``: fewer than ``min_words`` words, or more than half of the
    words in repeated 3-word windows.  ``kept`` is false then, and where a
    certified rule fires; ``failed_rules`` names those.

    A null text is empty and fails the base; a null stratum is a stratum of its
    own; unlabelled strata, or too few labels, certify nothing and so reject
    nothing more.  A row with a null id is judged but never used to certify;
    of labels that disagree on an id, good wins.  Other columns are ignored.
    """
    counts = materialize(features(docs, id_col, text_col, stratum_col), "quality")
    marks = labels.select(F.col(label_id_col).alias("id"), F.col(label_col))
    cutoffs = certify(counts, marks, alpha, delta, label_col).groupBy("stratum").pivot("rule", list(GRID)).agg(F.max("cutoff"))
    wide = counts.join(cutoffs.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in GRID]), "stratum", "left")
    fired = F.array(*[F.when(v > F.col(f"cut_{r}"), F.lit(r)) for r, v in rates(counts).items()])
    wide = wide.withColumn("failed_rules", F.array_compact(fired))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = wide.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept")
