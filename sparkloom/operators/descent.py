"""Hinge-loss descent where the terms are few: rows lie in chunks by the numbers of their terms, a step is a pass over the chunks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from sparkloom.sources.workspace import written

#: Weights up to which the driver holds them: 32 MB.
FEW_WEIGHTS = 1 << 22

#: Words of the rows of a chunk, about; a chunk ends with the row that passes them.
CHUNK_WORDS = 1 << 20


def few_terms(idf: DataFrame, targets: list[str]) -> pa.Table | None:
    """(term, idf) in the order of the terms, where all weights are few; else None."""
    most = FEW_WEIGHTS // max(1, len(targets))
    found = idf.select("term", "idf").limit(most + 1).toArrow()
    return found.sort_by("term") if found.num_rows <= most else None


def _numbered(rows: DataFrame, terms: pa.Array) -> DataFrame:
    """``rows`` with the numbers of their known terms in place of the terms, the last column."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("terms").flatten()
            found = pc.index_in(words, value_set=terms.cast(words.type))
            known = found.is_valid()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column("terms")), 0).to_numpy())
            before = np.r_[0, np.cumsum(known.to_numpy(zero_copy_only=False))].astype(np.int32)
            numbers = pa.ListArray.from_arrays(before[np.r_[0, ends].astype(np.int64)], found.filter(known))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], numbers], [*b.schema.names[:-1], "numbers"])

    return rows.mapInArrow(each, StructType([*rows.schema.fields[:-1], StructField("numbers", ArrayType(IntegerType()))]))


_INTS = ("own", "cells", "term", "tf", "at")


def _chunks(docs: DataFrame, key: str, terms: Column, label: str, targets: list[str], known: pa.Array) -> DataFrame:
    """A row a chunk: the numbers of its ``own`` terms, of each key how many ``cells`` it has, of each cell the place of its ``term`` there and ``tf``, of each row its key's place ``at`` and its ``sides``, 1 or -1 for every target.

    Rows that repeat a key share all of its terms.
    """
    size, wide = len(known), len(targets)
    sides = F.array(*[F.when(F.lower(label) == t, 1).otherwise(-1).cast("byte") for t in targets])
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), sides.alias("sides"), terms.alias("terms"))
    flat = lambda name: F.flatten(F.collect_list(name)).alias(name)
    keys = _numbered(rows, known).groupBy("key").agg(flat("sides"), flat("numbers")).drop("key")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(pc.list_value_length(b.column("numbers")).to_numpy())
            last = ends[-1] if len(ends) else 0
            cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(CHUNK_WORDS, last, CHUNK_WORDS)) + 1, len(ends)])
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(start, stop - start)
                numbers, side = part.column("numbers"), part.column("sides")
                place = np.repeat(np.arange(len(part)), pc.list_value_length(numbers).to_numpy())
                cell, tf = np.unique(place * size + numbers.flatten().to_numpy(), return_counts=True)
                cells = np.bincount(cell // size, minlength=len(part))
                at = np.repeat(np.arange(len(part)), pc.list_value_length(side).to_numpy() // wide)
                own, term = np.unique(cell % size, return_inverse=True)
                ints = [x.astype(np.int32).tobytes() for x in (own, cells, term, tf, at)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (*ints, side.flatten().to_numpy().astype(np.int8).tobytes())], [*_INTS, "sides"])

    return keys.mapInArrow(each, ", ".join(f"{n} binary" for n in (*_INTS, "sides")))


def _moves(chunks: DataFrame, factors: Broadcast, wide: int, size: int) -> DataFrame:
    """(number, m0, m1, ..): of every term that occurs the sum of side * tf, for each target, over the rows whose side times margin is below 1, by the terms' ``factors`` for each target.  The sums are whole numbers."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved, occurs = np.zeros((wide, size)), np.zeros(size, bool)
        for b in batches:
            for i in range(len(b)):
                own, cells, term, tf, at = (np.frombuffer(b.column(n)[i].as_buffer(), np.int32) for n in _INTS)
                sides = np.frombuffer(b.column("sides")[i].as_buffer(), np.int8).reshape(-1, wide)
                place = np.repeat(np.arange(len(cells)), cells)
                occurs[own] = True
                for k in range(wide):
                    margin = np.bincount(place, factors.value[k][own][term] * tf, len(cells))
                    missed = np.bincount(at, np.where(sides[:, k] * margin[at] < 1.0, sides[:, k], 0), len(cells))
                    moved[k][own] += np.bincount(term, missed[place] * tf, len(own))
        there = np.flatnonzero(occurs)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (there.astype(np.int32), *moved[:, there])], ["number", *names])

    names = [f"m{k}" for k in range(wide)]
    sums = chunks.mapInArrow(each, ", ".join(["number int", *[f"{n} double" for n in names]]))
    return sums.groupBy("number").agg(*[F.sum(n).alias(n) for n in names])


def train(docs: DataFrame, key: str, terms: Column, label: str, known: pa.Table, targets: list[str], iterations: int = 100, step: float = 1.0, penalty: float = 0.01) -> DataFrame:
    """The weights of ``classify.train`` over the TF-IDF of ``docs``, by the (term, idf) of ``few_terms``.

    Texts' numbers are shuffled once, by key; then a task sends a sum for each
    weight, and the driver, which holds the weights, sends them to the tasks.
    """
    spark, m, wide, size = docs.sparkSession, docs.count(), len(targets), known.num_rows
    schema = "label string, term string, weight double"
    if not (m and wide and size):
        return spark.createDataFrame([], schema)
    names, idf = known.column("term").combine_chunks(), known.column("idf").to_numpy()
    chunks = _chunks(docs, key, terms, label, targets, names).persist()
    weights, touched = np.zeros((wide, size)), np.zeros(size, bool)
    try:
        held = chunks.coalesce(spark.sparkContext.defaultParallelism)  # so partial sums grow with the cores, not with the rows
        for t in range(1, iterations + 1):
            rate = step / math.sqrt(t)
            factors = spark.sparkContext.broadcast(weights * idf)
            found = _moves(held, factors, wide, size).toArrow()
            factors.destroy()
            number, *moved = (c.to_numpy() for c in found.columns)
            touched[number] = True
            weights *= 1.0 - rate * penalty
            weights[:, number] += np.stack(moved) * idf[number] * (rate / m)
    finally:
        chunks.unpersist()
    there = np.flatnonzero(touched)
    table = pa.table({"label": np.repeat(targets, len(there)), "term": pa.concat_arrays([names.take(pa.array(there))] * wide), "weight": weights[:, there].ravel()})
    return written(spark.createDataFrame(table, schema), "weights")[0]


def margins(rows: DataFrame, key: str, terms: Column, weights: DataFrame, idf: DataFrame) -> DataFrame | None:
    """(key, label, margin) of ``classify.margins`` over the TF-IDF of ``rows``, where the weights are few; else None.

    A row is weighed where it is, only margins are shuffled: those of rows that repeat a key add up.
    """
    found = weights.where("label IS NOT NULL AND weight IS NOT NULL").join(idf.select("term", "idf"), "term").select("label", "term", "weight", "idf").limit(FEW_WEIGHTS + 1).toArrow()
    if found.num_rows > FEW_WEIGHTS:
        return None
    label, term = (found.column(n).combine_chunks().dictionary_encode() for n in ("label", "term"))
    labels, known = label.dictionary.to_pylist(), term.dictionary
    wide, size = len(labels), len(known)
    if wide * size > FEW_WEIGHTS:
        return None
    at = label.indices.to_numpy(), term.indices.to_numpy()
    factors, has, values = np.zeros((wide, size)), np.zeros((wide, size), bool), np.zeros(size)
    np.add.at(factors, at, found.column("weight").to_numpy())
    has[at], values[at[1]] = True, found.column("idf").to_numpy()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, n = b.column("numbers"), len(b)
            place = np.repeat(np.arange(n), pc.list_value_length(numbers).to_numpy())
            cell, tf = np.unique(place * size + numbers.flatten().to_numpy(), return_counts=True)
            place, number = cell // max(size, 1), cell % max(size, 1)
            for k in range(wide):
                hit = has[k][number]
                there = np.flatnonzero(np.bincount(place[hit], minlength=n))
                margin = np.bincount(place[hit], (tf * values[number] * factors[k][number])[hit], n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(there)), pa.array([labels[k]] * len(there), pa.string()), pa.array(margin[there])], [key, "label", "margin"])

    texts = _numbered(rows.select(F.col(key), terms.alias("terms")), known)
    schema = StructType([texts.schema[0], StructField("label", StringType()), StructField("margin", DoubleType())])
    return texts.mapInArrow(each, schema).groupBy(key, "label").agg(F.sum("margin").alias("margin"))
