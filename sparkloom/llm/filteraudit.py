"""Filter interaction audit: what every filter removes in every order, alone, and beside the others.

A document is a mask, bit k set where it fails filter k.  Counts per part and
mask are all that the audit needs: a subset-zeta transform turns them into the
survivors of every subset of the filters, and a step of an order is the
difference between two neighbouring subsets, for all documents as for the
labelled ones.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is counted of a part and mask.
COUNTS = ("n", "good", "toxic")


def text_mask(text: Column) -> Column:
    """The filters that look at one text, as bits: 1 few words, 2 repeated words, 4 capitals, 8 symbols."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    failed = (n < 100, 100 * distinct < 80 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed[1:], 1)), F.when(failed[0], 1).otherwise(0))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail, 16 being a copy of a smaller doc_id's text.

    A null ``part`` counts as the empty string, a null text as an empty one.  A
    row without doc_id is no copy, nor is anything a copy of it, and it has no
    labels; rows with the smallest id of their text are none of them copies.  An
    id is good or toxic if any of its label rows says so.  Ids that repeat are
    documents of their own.

    Texts go no further than the scan: rows carry a digest, and those that are
    alike are counted before each shuffle, so neither a large group of copies
    nor a repeated id meets in one task as rows.  Null ids are dealt out by
    digest.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.xxhash64("digest")), "no_id": F.col("doc_id").isNull()})
    is_ = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(c)
    named = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("key")).agg(is_("quality"), is_("toxic")).withColumn("no_id", F.lit(False))
    both = rows.join(named, ["key", "no_id"], "left")
    of = lambda flag: F.when(F.col(flag), F.col("n")).otherwise(0)
    both = both.select("doc_id", "part", "digest", "mask", "no_id", "n", of("quality").alias("good"), of("toxic").alias("toxic"))
    groups = both.groupBy("digest", "part", "mask", "no_id").agg(*[F.sum(c).alias(c) for c in COUNTS], F.min(F.struct("doc_id", *COUNTS)).alias("first"))
    # A row for each part that has the text; in one of them is its smallest id.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    groups = groups.withColumn("holds", F.col("no_id") | (F.col("first.doc_id") == least))
    own = {c: F.when(F.col("no_id"), F.col(c)).when(F.col("holds"), F.col(f"first.{c}")).otherwise(0) for c in COUNTS}
    unique = F.struct(F.col("mask"), *[own[c].alias(c) for c in COUNTS])
    copies = F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(c) - own[c]).alias(c) for c in COUNTS])
    each = groups.select("part", F.explode(F.array(unique, copies)).alias("x")).select("part", "x.*").where("n > 0")
    return each.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def zeta(values: Column, bits: int) -> Column:
    """Sums over the subsets of every index, for an array of structs of ``COUNTS`` with 2**bits elements: one pass over the array a bit."""

    def one_round(bit: Column):
        def of(a: Column) -> Column:
            def cell(x: Column, i: Column) -> Column:
                other, has = F.get(a, i.bitwiseXOR(bit)), i.bitwiseAND(bit) != 0
                return F.struct(*[F.when(has, x[c] + other[c]).otherwise(x[c]).alias(c) for c in COUNTS])

            return F.transform(a, cell)

        return of

    for k in range(bits):
        # An array of one is a name for it: the round reads it twice.
        values = F.element_at(F.transform(F.array(values), one_round(F.lit(1 << k))), 1)
    return values


def audit(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """A row per part, order of the filters and step, from (part, mask, n, good, toxic) with a row per part and mask at most.

    Columns: kept, removed, redundant (failing the step's filter, gone before),
    unique_fails (failing that filter only), good_lost, toxic_lost, and shapley
    (what the filter removes, summed over all orders).  No counts give no rows.
    """
    bits = len(filters)
    full = (1 << bits) - 1
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
    row = F.struct(F.col("mask").cast("int"), F.struct(*[F.col(c).cast("bigint").alias(c) for c in COUNTS]))
    parts = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(row)).alias("of"))
    by_mask = F.transform(F.sequence(F.lit(0), F.lit(full)), lambda m: F.coalesce(F.col("of")[m], nothing))
    parts = parts.select("part", by_mask.alias("exact")).select("part", "exact", zeta(F.col("exact"), bits).alias("within"))

    def survivors(gone: Column) -> Column:
        """Who fails none of the filters ``gone``: the sum over all masks within the others."""
        return F.get("within", gone.bitwiseXOR(F.lit(full)))

    weights = F.array(*[F.lit(factorial(k) * factorial(bits - 1 - k)) for k in range(bits)])

    def shapley(k: int) -> Column:
        bit = F.lit(1 << k)
        others = F.filter(F.sequence(F.lit(0), F.lit(full)), lambda s: s.bitwiseAND(bit) == 0)
        lost = lambda s: survivors(s)["n"] - survivors(s.bitwiseOR(bit))["n"]
        return F.aggregate(others, F.lit(0).cast("bigint"), lambda a, s: a + F.get(weights, F.bit_count(s)) * lost(s))

    parts = parts.withColumn("shares", F.array(*[shapley(k) for k in range(bits)]))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = parts.withColumn("filter_order", F.explode(orders)).select("*", F.explode(F.sequence(F.lit(1), F.lit(bits))).alias("step"))
    letters = F.split("filter_order", "")
    bit_of = F.create_map(*[F.lit(x) for k, c in enumerate(filters) for x in (c, 1 << k)])
    steps = steps.withColumns({"bit": F.element_at(bit_of, F.element_at(letters, F.col("step"))), "before": F.aggregate(F.slice(letters, 1, F.col("step") - 1), F.lit(0), lambda a, x: a + F.element_at(bit_of, x))})
    here, then = survivors(F.col("before")), survivors(F.col("before").bitwiseOR(F.col("bit")))
    removed = here["n"] - then["n"]
    failing = survivors(F.lit(0))["n"] - survivors(F.col("bit"))["n"]
    return steps.select(
        "part", "filter_order", "step",
        then["n"].alias("kept"), removed.alias("removed"), (failing - removed).alias("redundant"),
        F.get("exact", F.col("bit"))["n"].alias("unique_fails"),
        (here["good"] - then["good"]).alias("good_lost"), (here["toxic"] - then["toxic"]).alias("toxic_lost"),
        F.get("shares", F.log2(F.col("bit")).cast("int")).alias("shapley"),
    )
