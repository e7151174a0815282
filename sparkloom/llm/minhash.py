"""b-bit MinHash near-duplicate detection with exact confirmation.

1. One pass turns each text into its set of word shingles (64-bit hashes), a
   class key of the whole set, ``bands`` LSH keys of ``rows`` full minima each,
   and a packed signature that keeps ``BITS`` low bits of every minimum.
2. Texts with equal sets are one class.  A class is first paired with one
   centre only, the smallest it shares a bucket with.
3. A pair whose collision-corrected similarity estimate (bit counts of the
   packed signatures) is far below the threshold is dropped; every other pair
   is confirmed on the full sets.
4. Buckets whose classes still lie in several components get two rounds that
   pair classes outside the component of the bucket's centre with it, then all
   their cross-component pairs that pass sizes and estimate, each once; the join
   that finds these compares the sets folded to 31 bits, allowing for what that
   may merge, and so gives out few pairs but links.  Linked classes never need a
   pair, so no link that joins two components is lost while groups of copies
   stay linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import bytetext
from sparkloom.llm.common import bounded, hot_keys, join_spread, list_array, map_arrow, materialize, release, slices, string_buffers

_U = np.uint64
BITS = 2
ROWS = 4
BANDS = 32
#: Minima of a signature; the bands take the first ``ROWS * BANDS``.
HASHES = 512
WORDS = HASHES // 64
#: Nearly five standard deviations of the estimate from 512 hashes at a similarity of 0.75.
MARGIN = 0.11

_rng = np.random.default_rng(20240611)
_MULTIPLY = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | _U(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_SHINGLE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_BAND = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * _U(2) + _U(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, concatenated, and their counts."""
    h, _, _, at = bytetext.words(data, offsets, bytetext.WHITESPACE_WORDS)
    n = at.size - 1
    if h.size >= k:
        runs = h[: h.size - k + 1] * _SHINGLE[0]
        for j in range(1, k):
            runs += h[j : h.size - k + 1 + j] * _SHINGLE[j]
        runs = bytetext.mix(runs)
    sets = []
    for i in range(n):
        lo, hi = at[i], at[i + 1]
        if hi - lo >= k:
            sets.append(np.unique(runs[lo : hi - k + 1]))
        elif hi > lo:
            whole = (h[lo:hi] * _SHINGLE[: hi - lo]).sum(dtype=_U, keepdims=True) + _SHINGLE[16 + hi - lo : 17 + hi - lo]
            sets.append(bytetext.mix(whole))
        else:
            sets.append(np.zeros(0, _U))
    lengths = np.array([s.size for s in sets], np.int64)
    return (np.concatenate(sets) if n else np.zeros(0, _U)), lengths


def signatures(shingles: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Minima, one row of ``HASHES`` 32-bit values per non-empty set."""
    out = np.empty((HASHES, lengths.size), np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    lo = 0
    while lo < lengths.size:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + (1 << 16), side="right")) - 1)
        if starts[-1] < starts[lo] + (1 << 16):
            hi = lengths.size
        x = (shingles[starts[lo] : starts[hi - 1] + lengths[hi - 1]] >> _U(32)).astype(np.uint32)
        cut = starts[lo:hi] - starts[lo]
        work = np.empty_like(x)
        for j in range(HASHES):
            np.multiply(x, _MULTIPLY[j], out=work)
            work += _ADD[j]
            work ^= work >> np.uint32(15)
            out[j, lo:hi] = np.minimum.reduceat(work, cut)
        lo = hi
    return out


def _describe(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, k: int, sets: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text_col):
            data, offsets = string_buffers(batch.column(batch.schema.get_field_index(text_col)))
            shingles, lengths = shingle_sets(data, offsets, k)
            full = lengths > 0
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)[full]
            key = np.zeros((2, lengths.size), np.int64)
            if starts.size:
                key[0, full] = np.add.reduceat(shingles, starts).view(np.int64)
                key[1, full] = np.add.reduceat(bytetext.mix(shingles ^ _BAND[0]), starts).view(np.int64)
            head = [batch.column(batch.schema.get_field_index(id_col)), pa.array(lengths), pa.array(key[0]), pa.array(key[1])]
            if sets:
                tail = [list_array(shingles.view(np.int64), lengths, pa.int64())]
                names = ["id", "n", "k1", "k2", "shingles"]
            else:
                bands = np.zeros((lengths.size, BANDS), np.int64)
                packed = np.zeros((lengths.size, WORDS * BITS), np.int64)
                if starts.size:
                    minima = signatures(shingles, lengths[full]).astype(_U)
                    keyed = (minima[: ROWS * BANDS] * _BAND[: ROWS * BANDS, None]).reshape(BANDS, ROWS, -1).sum(axis=1, dtype=_U)
                    bands[full] = bytetext.mix(keyed + np.arange(BANDS, dtype=_U)[:, None]).view(np.int64).T
                    low = (minima & _U((1 << BITS) - 1)).astype(np.uint8).T
                    bits = np.unpackbits(low[:, :, None], axis=2, bitorder="little", count=BITS)
                    planes = np.packbits(bits.transpose(0, 2, 1).reshape(low.shape[0], BITS * HASHES), axis=1)
                    packed[full] = planes.copy().view(np.int64)
                some = np.where(full, BANDS, 0), np.where(full, WORDS * BITS, 0)
                tail = [list_array(bands[full].ravel(), some[0], pa.int64()), list_array(packed[full].ravel(), some[1], pa.int64())]
                names = ["id", "n", "k1", "k2", "bands", "sig"]
            yield pa.RecordBatch.from_arrays(head + tail, names=names)


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, sets: bool = False) -> DataFrame:
    """id, n, k1, k2 and, per text, either ``bands`` and ``sig`` or ``shingles``."""
    kind = docs.schema[id_col].dataType.simpleString()
    tail = "shingles array<bigint>" if sets else "bands array<bigint>, sig array<bigint>"
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(src, lambda it: _describe(it, "id", "text", k, sets), f"id {kind}, n bigint, k1 bigint, k2 bigint, {tail}")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for chance agreement.

    Plane p of the signature holds bit p of every minimum in ``WORDS`` longs;
    two minima agree where no plane differs.
    """
    plane = [[a[w + p * WORDS].bitwiseXOR(b[w + p * WORDS]) for p in range(BITS)] for w in range(WORDS)]
    differs = [F.bit_count(reduce(Column.bitwiseOR, word)) for word in plane]
    agree = F.lit(1.0) - reduce(Column.__add__, differs) / F.lit(float(HASHES))
    chance = 2.0**-BITS
    return (agree - chance) / (1.0 - chance)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node reachable, for all nodes of ``edges(a, b)``.

    Minimum labels spread over the edges and every round also jumps to the
    label's own label; each round is a written table.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges", 2 * edges.count())
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
    n = both.count()
    labels = materialize(first, "labels", n)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = materialize(step.join(jump, "label").select("node", "old", F.least("label", "up").alias("label")), "labels", n)
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Words are runs of non-whitespace with A-Z lower-cased; a set holds the
    distinct ``k``-word shingles, or the whole word sequence when there are
    fewer words.  Two texts are linked when 100 * intersection >= ``percent`` *
    union; ``component_id`` is the smallest id reachable over links.

    Null or empty texts have an empty set and form a component of their own.
    Rows that repeat an id each get a row; their ids count as one document.  A
    null id never becomes a component id while its class has another id; a
    class of null ids only has a null component and is kept.  Other columns of
    ``docs`` are ignored.
    """
    spark = docs.sparkSession
    rows = materialize(describe(docs, id_col, text_col, k), "minhash")
    full = rows.where("n > 0")
    classes = full.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("count"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = materialize(classes, "classes")
    named = classes.where("rep is not null")
    member = named.select("rep", F.explode("bands").alias("key"))
    buckets = member.groupBy("key").agg(F.min("rep").alias("centre"), F.min_by("rep", F.xxhash64("rep")).alias("centre2"), F.count("*").alias("m")).where("m > 1").drop("m")
    crowded = materialize(member.join(buckets, "key"), "buckets")
    n_crowded = crowded.count()
    release(spark)
    reps = crowded.select("rep").distinct()
    reps = bounded(reps) or reps
    facts = named.join(reps, "rep", "left_semi").select("rep", F.col("n").cast("int").alias("n"), "sig", "k1", "k2")
    source = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).join(reps, "rep", "left_semi")
    sets = describe(source, "rep", "text", k, sets=True)
    same = facts.select(F.col("rep").alias("id"), "k1", "k2")
    sets = materialize(sets.join(same, ["id", "k1", "k2"], "left_semi").dropDuplicates(["id"]).select("id", "shingles"), "sets")
    facts = materialize(facts.drop("k1", "k2"), "facts")
    release(spark)

    def plausible(pairs: DataFrame) -> DataFrame:
        """Distinct pairs that sizes and signatures do not rule out; only these fetch their sets."""
        x = facts.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("ga"))
        y = facts.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("gb"))
        per = pairs.groupBy("b").agg(F.collect_set("a").alias("as")).join(y, "b").select("b", "nb", "gb", F.explode("as").alias("a"))
        return per.alias("p").join(x.alias("x"), (F.col("p.a") == F.col("x.a")) & _worth(F.col("na"), F.col("nb"), F.col("ga"), F.col("gb"), percent)).select("p.a", "b")

    def pairs_with(rows: DataFrame, centre: str) -> DataFrame:
        return rows.where(F.col("rep") != F.col(centre)).select(F.col(centre).alias("a"), F.col("rep").alias("b"))

    def unresolved(labels: DataFrame) -> DataFrame:
        now = crowded.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        mixed = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        return materialize(now.join(mixed, "key", "left_semi"), "unresolved", n_crowded)

    def outside(rows: DataFrame, centre: str) -> DataFrame:
        """Rows of mixed buckets that lie in another component than their bucket's centre."""
        home = rows.where(F.col("rep") == F.col(centre)).select("key", F.col("label").alias("home"))
        return rows.join(home, "key").where("label <> home").drop("home")

    nearest = crowded.where("rep <> centre").groupBy("rep").agg(F.min("centre").alias("centre"))
    links = materialize(confirm(plausible(pairs_with(nearest, "centre")), sets, percent), "links")
    labels = components(links)
    for centre in ("centre", "centre2"):
        rest = unresolved(labels)
        again = materialize(confirm(plausible(pairs_with(outside(rest, centre), centre)), sets, percent), "links")
        links = links.union(again)
        labels = components(links)
    release(spark)
    folded = sets.select(F.col("id").alias("rep"), F.transform("shingles", lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int")).alias("fold"))
    rest = unresolved(labels).groupBy("rep", "label").agg(F.sort_array(F.collect_set("key")).alias("keys")).join(facts, "rep").join(folded, "rep")
    rest = rest.select("rep", "label", "n", "sig", "fold", "keys", F.explode("keys").alias("key"))
    x, y = rest.alias("x"), rest.alias("y")
    close = _worth(F.col("x.n"), F.col("y.n"), F.col("x.sig"), F.col("y.sig"), percent)
    once = F.element_at(F.array_intersect("x.keys", "y.keys"), 1) == F.col("x.key")  # a pair is compared in its first bucket
    common = F.size(F.array_intersect("x.fold", "y.fold"))
    slack = 1 + F.col("x.n").cast("double") * F.col("y.n") / float(1 << 30)  # twice what folding is expected to merge
    close = close & once & ((100 + percent) * (common + slack) >= percent * (F.col("x.n") + F.col("y.n")))
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & close)
    cross = cross.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    more = materialize(confirm(cross, sets, percent), "links")
    if more.limit(1).count():
        labels = components(links.union(more))

    label = classes.select("k1", "k2", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("label"))
    out = join_spread(full.select("id", "n", "k1", "k2"), label, ["k1", "k2"], hot_keys(classes.select("k1", "k2", "count"), ["k1", "k2"]))
    out = out.select("id", "n", "label").union(rows.where("n = 0").select("id", "n", F.col("id").alias("label")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("label").alias("component_id"), F.col("id").eqNullSafe(F.col("label")).alias("kept"))


def _worth(na: Column, nb: Column, ga: Column, gb: Column, percent: int) -> Column:
    """Sizes that can reach the threshold, and an estimate not far below it."""
    sizes = (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
    return sizes & (estimate(ga, gb) >= percent / 100.0 - MARGIN)
