"""Centroid clustering, level-wise doubling and the filter audit against plain versions."""

import hashlib
import math
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import centroids, doubling, filteraudit
from tests.llm.helpers import SPACE_WORD

# --- centroids ---


def plain_clusters(rows: list, k: int, rounds: int, dims: int) -> list:
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in ok if i is not None)
    centers = [list(v) for _, v in named[:k]]
    if not centers:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in ok:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centers[j] = [sum(col) // len(g) for col in zip(*g, strict=True)]
    found = [(i, *nearest(v)) for i, v in ok]
    total = sum(d for _, d, _ in found)
    each = {j: sum(d for _, d, c in found if c == j) for _, _, j in found}
    return [(i, j, d, each[j], total, hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest()) for i, d, j in found]


def vectors(seed: int, n: int = 150, dims: int = 16) -> list:
    r = random.Random(seed)
    centers = [[r.uniform(-2, 2) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in r.choice(centers)]) for i in range(n)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (3, rows[3][1]), (None, rows[5][1]), (None, [0.0] * dims)]
    rows += [(n + 2, None), (n + 3, []), (n + 4, [1.0] * (dims - 1)), (n + 5, [None] + [1.0] * (dims - 1)), (n + 6, [float("nan")] * dims), (n + 7, [float("-inf")] + [0.0] * (dims - 1))]
    return rows


def as_rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, k", [(1, 16), (3, 400)])
def test_clusters_against_plain(spark, seed, k):
    rows = vectors(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit("x").alias("cluster"), F.lit(1).alias("v")).repartition(4)
    assert as_rows(centroids.cluster(df, k, dims=16)) == sorted(plain_clusters(rows, k, 3, 16), key=repr)


def test_clusters_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(None, [0.5] * 64), (1, None)], schema)).count() == 0
    one = centroids.cluster(spark.createDataFrame([(7, [0.5] * 64), (7, [0.5] * 64), (None, [1.5] * 64)], schema), k=1, rounds=0)
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one.orderBy("distance").collect()] == [(7, 0, 0, 64 * 64**2), (7, 0, 0, 64 * 64**2), (None, 0, 64 * 64**2, 64 * 64**2)]
    huge = centroids.cluster(spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)], schema), rounds=1)
    assert huge.count() == 3 and all(r.distance == 0 for r in huge.collect())


def test_partial_distances_find_ties():
    r = np.random.default_rng(5)
    for _ in range(30):
        v, c = r.integers(-3, 4, (200, 24)), r.integers(-3, 4, (9, 24))
        c[7] = c[2]
        full = ((v[:, None, :] - c[None]) ** 2).sum(2)
        cluster, distance = centroids.assign(v, c, r.permutation(24))
        assert (cluster == full.argmin(1)).all() and (distance == full.min(1)).all()


# --- level-wise doubling ---


def plain_doubling(rows: list, window: int) -> list:
    """(id, words, removed, longest, kept) of each (id, text) row, rows in order."""
    texts = [(i, SPACE_WORD.findall(t or "")) for i, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, gone = set(), {k: set() for k in range(len(rows))}
    for k in order:
        w = texts[k][1]
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            if x in seen:
                gone[k] |= set(range(s, s + window))
            seen.add(x)
    longest = [0] * len(rows)
    size = window
    while True:
        count = {}
        for _, w in texts:
            for s in range(len(w) - size + 1):
                x = tuple(w[s : s + size])
                count[x] = count.get(x, 0) + 1
        if not any(n > 1 for n in count.values()):
            break
        for k, (_, w) in enumerate(texts):
            if any(count[tuple(w[s : s + size])] > 1 for s in range(len(w) - size + 1)):
                longest[k] = size
        size *= 2
    return [(i, len(w), len(gone[k]), longest[k], " ".join(x for j, x in enumerate(w) if j not in gone[k])) for k, (i, w) in enumerate(texts)]


def passages(seed: int, n: int = 50) -> list:
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = " ".join(r.choice("a b c d e f Ünd x y The the".split(" ")) for _ in range(r.randrange(0, 70)))
        if rows and r.random() < 0.5:
            other = (r.choice(rows)[1] or "").split(" ")
            cut = r.randrange(len(other) + 1)
            t = t + r.choice([" ", "\n\t", "  "]) + " ".join(other[cut : cut + 30])
        rows.append((i * 3, t))
    rows += [(n * 3, None), (n * 3 + 1, ""), (n * 3 + 2, " \t\n"), (n * 3 + 3, "la " * 50), (n * 3 + 4, rows[3][1]), (n * 3 + 5, " ".join(f"w{j}" for j in range(90)) + " " + " ".join(f"w{j}" for j in range(60)))]
    return rows


@pytest.mark.parametrize("window, small", [(7, False), (20, True)])
def test_doubling_against_plain(spark, monkeypatch, window, small):
    rows = passages(window)
    if small:
        # Buckets by more bits, and slices of one row: set in the workers too by what the driver sends.
        monkeypatch.setattr(doubling, "SHORT_PER_BUCKET", 64)
        monkeypatch.setattr(doubling, "FULL_PER_BUCKET", 16)
    random.Random(window).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("sid"), F.lit("x").alias("kept"), F.lit("y").alias("tie")).repartition(3)
    got = as_rows(doubling.remove_repeats(df, window))
    assert got == sorted(plain_doubling(sorted(rows), window), key=repr)


def test_doubling_odd_rows(spark):
    text = " ".join(f"w{j}" for j in range(30))
    schema = "doc_id long, text string"
    rows = [(5, text), (5, text), (None, text), (2, "x " + text), (2, None), (9, text + " z")]
    got = {}
    for r in doubling.remove_repeats(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.longest))
    assert {k: sorted(v) for k, v in got.items()} == {5: [(30, 30, 20), (30, 30, 20)], None: [(30, 30, 20)], 2: [(0, 0, 0), (31, 0, 20)], 9: [(31, 30, 20)]}
    # Different texts of one id: one of them is first, the same one whatever the order of the rows.
    two = [(1, "a " + text), (1, "b " + text), (0, "c")]
    results = {tuple(as_rows(doubling.remove_repeats(spark.createDataFrame(rows, schema).repartition(n)))) for n, rows in ((1, two), (3, two[::-1]))}
    assert len(results) == 1 and sum(r[2] for r in next(iter(results))) == 30
    assert doubling.remove_repeats(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in doubling.remove_repeats(spark.createDataFrame([(1, "one two")], schema)).collect()] == [(1, 2, 0, 0, "one two")]


def test_doubling_stops_at_its_window(spark):
    text = " ".join(f"w{j}" for j in range(100))
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert sorted(r.longest for r in doubling.remove_repeats(df, beyond=False).collect()) == [20, 20]
    assert sorted(r.longest for r in doubling.remove_repeats(df).collect()) == [80, 80]


def test_slices_hold_every_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(doubling, "SLICE_BYTES", 50)
    monkeypatch.setattr(doubling, "SLICE_ROWS", 4)
    monkeypatch.setattr(doubling.TaskContext, "get", lambda: type("T", (), {"partitionId": staticmethod(lambda: 3)}))
    texts = ["", "é" * 40, None, *["ab"] * 9, "x" * 200, "y"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [None, *range(1, len(texts))], "tie": list(range(len(texts))), "text": texts})
    slices = list(doubling.cut_slices(iter([batch, batch.slice(0, 0), batch])))
    seen = []
    for s in slices:
        row = doubling._fields(s)
        data, offsets = doubling.slice_texts(row)
        assert len(row["ids"]) <= 4
        seen += [(i, t, data[a:b].tobytes().decode()) for i, t, a, b in zip(row["ids"].to_pylist(), row["ties"], offsets[:-1], offsets[1:], strict=True)]
    assert seen == 2 * [(i or None, i, t or "") for i, t in enumerate(texts)]
    assert len({s.column("sid")[0].as_py() for s in slices}) == len(slices)


# --- filter audit ---


def plain_audit(docs: list, labels: list) -> list:
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))

    def fails(i, t):
        w = SPACE_WORD.findall(t)
        out = {"A"} if len(w) < 100 else set()
        out |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        out |= {"D"} if set(t) & set("#$%&*|") else set()
        return out | ({"E"} if i is not None and i > least[t] else set())

    rows = [(p or "", i, fails(i, t or "")) for i, t, p in docs]
    out = []
    for part in {r[0] for r in rows}:
        mine, shares, steps = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                shares[f] += len(removed)
                redundant = sum(f in r[2] for r in mine) - len(removed)
                steps.append(("".join(order), step, f, len(left), len(removed), redundant, sum(r[2] == {f} for r in mine), sum(r[1] in good for r in removed), sum(r[1] in toxic for r in removed)))
        out += [(part, o, s, *rest, shares[f]) for o, s, f, *rest in steps]
    return out


def audit_rows(seed: int) -> tuple[list, list]:
    r = random.Random(seed)
    words = [f"w{j}" for j in range(300)] + ["LOUD"] * 30 + ["a#b", "ÉÀ", "x|"]
    docs = []
    for i in range(80):
        t = " ".join(r.choice(words if r.random() < 0.5 else words[:300]) for _ in range(r.choice([5, 99, 100, 101, 140, 400])))
        docs.append((i, r.choice(docs)[1] if docs and r.random() < 0.4 else t, r.choice(["en", "fr", None, ""])))
    docs += [(80, None, "en"), (81, "", "en"), (82, " \n\t ", "fr"), (None, docs[0][1], "en"), (None, None, None), (5, docs[5][1], docs[5][2]), (5, docs[6][1], "de"), (83, "A" * 10, "en"), (84, "A" + "é" * 9, "en"), (85, "lang " * 20000, "xx")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 90, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("seed", [1])
def test_audit_against_plain(spark, seed):
    docs, labels = audit_rows(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").select("*", F.lit(1).alias("n"), F.lit("x").alias("mask"), F.lit("y").alias("part")).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("key", F.lit(1))
    assert as_rows(filteraudit.audit(filteraudit.mask_counts(df, marks))) == sorted(plain_audit(docs, labels), key=repr)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.mask_counts(docs, labels)).count() == 0
    some = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert filteraudit.audit(filteraudit.mask_counts(some, labels)).count() == 600


def test_zeta_sums_over_subsets(spark):
    r = random.Random(3)
    cells = [tuple(r.randrange(9) for _ in range(3)) for _ in range(16)]
    df = spark.createDataFrame([(cells,)], "a array<struct<n:bigint,good:bigint,toxic:bigint>>")
    got = df.select(filteraudit.zeta(F.col("a"), 4).alias("z")).first().z
    assert [tuple(x) for x in got] == [tuple(sum(cells[m][c] for m in range(16) if m & ~s == 0) for c in range(3)) for s in range(16)]
