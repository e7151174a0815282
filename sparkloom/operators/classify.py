"""One-vs-rest linear classifiers over TF-IDF with a margin of 1."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import descent
from sparkloom.operators.features import inverse_frequency, term_frequency, term_rows, tfidf
from sparkloom.sources.workspace import bounded, remove, written


def margins(values: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """(key, label, margin): weighted sums of the documents' features."""
    return values.join(weights, "term").groupBy(key, "label").agg(F.sum(F.col("value") * F.col("weight")).alias("margin"))


def label_lists(scores: DataFrame, docs: DataFrame, key: str, labels: list[str], least: float = 1.0, none: str = "none") -> DataFrame:
    """(key, classification): labels of margin ``least`` or more in the given order, else ``none``."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    hits = scores.where(F.col("margin") >= least).groupBy(key).agg(F.array_sort(F.collect_set(F.struct(place.alias("place"), F.col("label").alias("label")))).alias("hits"))
    named = F.array_join(F.transform("hits", lambda x: x["label"]), ",")
    return docs.select(key).join(hits, key, "left").select(key, F.coalesce(named, F.lit(none)).alias("classification"))


def labelled(label: Column, target: str) -> Column:
    return F.when(F.lower(label) == target, 1.0).otherwise(0.0)


def known_terms(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """The (.., term) rows whose term has a weight: no other counts in a margin."""
    return rows.join(bounded(weights.select("term").distinct()), "term", "left_semi")


def by_weights(rows: DataFrame, key: str, terms: Column, weights: DataFrame, idf: DataFrame, labels: list[str], least: float = 1.0, none: str = "none") -> DataFrame:
    """(key, classification) of every row by TF-IDF margins over (label, term, weight) rows; a row without terms is ``none``."""
    if (scores := descent.margins(rows, key, terms, weights, idf)) is not None:
        return label_lists(scores, rows, key, labels, least, none)
    counted = term_frequency(known_terms(term_rows(rows, key, terms), weights), key)
    return label_lists(margins(tfidf(counted, idf, key), weights, key), rows, key, labels, least, none)


def train(values: DataFrame, labels: DataFrame, targets: list[str], iterations: int = 100, step: float = 1.0, penalty: float = 0.01) -> DataFrame:
    """(label, term, weight) of a linear classifier for each of ``targets``, all trained in the same steps.

    ``values`` has (key, term, value), ``labels`` (key, label), a row a key.
    Descent on the hinge loss with an L2 ``penalty``: step t moves against the
    mean gradient over all rows by ``step`` / sqrt(t), from weights of 0.  A
    row without terms counts in the mean.  Rows lie by key for all steps, so a
    step shuffles partial gradients only; the weights, written each step, are
    broadcast where a count shows that they are few.
    """
    spark, m = values.sparkSession, labels.count()
    empty = spark.createDataFrame([], "label string, term string, weight double")
    if not m:
        return empty
    rows = values.select("key", "term", "value").repartition("key").persist()
    sides = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.when(F.lower("label") == t, 1.0).otherwise(-1.0).alias("y")) for t in targets])).alias("s")
    wanted = labels.select("key", sides).select("key", "s.target", "s.y").repartition("key").persist()
    weights, path = empty, None
    try:
        for t in range(1, iterations + 1):
            rate = step / math.sqrt(t)
            now = margins(rows, bounded(weights), "key").select("key", F.col("label").alias("target"), "margin")
            missed = wanted.join(now, ["key", "target"], "left").where(F.col("y") * F.coalesce("margin", F.lit(0.0)) < 1.0)
            moves = rows.join(missed.select("key", "target", "y"), "key").groupBy(F.col("target").alias("label"), "term").agg((F.sum(F.col("y") * F.col("value")) * (rate / m)).alias("weight"))
            kept = weights.withColumn("weight", F.col("weight") * (1.0 - rate * penalty))
            old = path
            weights, path = written(kept.unionByName(moves).groupBy("label", "term").agg(F.sum("weight").alias("weight")), "weights")
            if old:
                remove(spark, old)
        return weights
    finally:
        rows.unpersist()
        wanted.unpersist()


@dataclass
class Model:
    """Weights (label, term, weight) and the idf (term, df, idf) of their terms."""

    weights: DataFrame
    idf: DataFrame

    def save(self, path: str) -> None:
        """Both tables, the weights in a folder for each label, over earlier ones."""
        self.weights.write.mode("overwrite").partitionBy("label").parquet(f"{path}/weights")
        self.idf.write.mode("overwrite").parquet(f"{path}/idf")

    @staticmethod
    def load(spark: SparkSession, path: str, labels: list[str] | None = None) -> "Model":
        """The model of all labels or of some, of which only the folders are read."""
        weights = spark.read.schema("term string, weight double, label string").parquet(f"{path}/weights")
        return Model(weights if labels is None else weights.where(F.col("label").isin(labels)), spark.read.schema("term string, df bigint, idf double").parquet(f"{path}/idf"))


def build(docs: DataFrame, key: str, terms: Column, label: str, targets: list[str], least: int = 1, iterations: int = 100) -> Model:
    """A model from rows with a key, a label and terms: TF-IDF of the terms in ``least`` rows or more, all labels trained at once.

    Where a count shows that the weights are few, each row lies whole in a task
    (``descent``); else values and weights are joined in every step (``train``).
    """
    idf = inverse_frequency(docs, terms, least)
    if (known := descent.few_terms(idf, targets)) is not None:
        return Model(descent.train(docs, key, terms, label, known, targets, iterations), idf)
    values = tfidf(term_frequency(term_rows(docs, key, terms), key), idf, key).withColumnRenamed(key, "key")
    return Model(train(values, docs.select(F.col(key).alias("key"), F.col(label).alias("label")), targets, iterations), idf)
