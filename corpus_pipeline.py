"""Training-data pipeline over ``documents``: five stages, each an operator of ``sparkloom.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, langid, minhash, packing, pii
from sparkloom.llm.common import bounded, discard, materialize, release
from sparkloom.llm.queries import tokenizer_path

#: A language is accepted from this probability on.
LEAST_SCORE = 0.5


def boxed(docs: DataFrame, *read: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The columns that an operator reads and the row in one struct of numbered fields, so that no column of the caller's meets a name of the operator's."""
    fields = [F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(docs.columns) if c not in without]
    return docs.select(*read, F.struct(*fields).alias("whole"))


def unboxed(rows: DataFrame, docs: DataFrame, **own: Column) -> DataFrame:
    """``rows`` of boxed ``docs`` with the columns of these, ``own`` ones in their place."""
    return rows.select(*[own.get(c, F.col(f"whole.f{i}")).alias(c) for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, null ones too, and those whose language stays undecided.

    The model learns from rows with an id, a text and a language; rows that
    repeat an id are each judged by their own text.  Without any such row no
    language is known and nothing stays; no rows give none.
    """
    model = langid.train(docs.where(~langid.held_out("doc_id") & F.col("doc_id").isNotNull()))
    seen = langid.identify(boxed(docs, "text"), model, carry=["whole"])
    return unboxed(seen.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group: that with the smallest id.

    Texts without words are in no group and stay.  Where ids are repeated or
    null, rows are told apart by their content: different texts are different
    documents whatever their ids, null ids come after all others, and of equal
    rows one stays.
    """
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if odd.isEmpty():
        gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
        gone = materialize(gone, "dropped")
        return docs.join(bounded(gone) or gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
    others = [F.col(f"whole.f{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    known = boxed(docs, "doc_id", "text").withColumns({"t": F.xxhash64("text", F.col("text").isNull()), "r": F.xxhash64(F.lit(0), *others)})
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.col("t").alias("text"), F.col("r").alias("row"))
    flags = materialize(minhash.near_duplicates(known.select(key.alias("key"), "text"), "key").select("key", "kept"), "kept")
    parts = lambda df: df.select(F.col("key.doc_id").alias("_doc"), F.col("key.text").alias("_t"), F.col("key.row").alias("_r"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t")) & (F.col("r") == F.col("_r"))
    kept = known.join(parts(flags.where(~F.col("kept"))).distinct(), same, "left_anti")
    equal = parts(flags.where("kept").groupBy("key").count().where("count > 1"))
    once = kept.join(equal, same, "left_semi").dropDuplicates(["doc_id", "t", "r"])
    return unboxed(kept.join(equal, same, "left_anti").unionByName(once), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows cover 5 % of the words or more.

    Null and empty texts have no words and stay; every row is judged by its own
    text, so equal rows share their fate; an empty benchmark drops nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(boxed(docs, "doc_id", "text"), benchmark, carry=["whole"])
    return unboxed(found.where(~F.col("contaminated")), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every span of personal data, and credentials, by its kind; null texts stay null, no row goes."""
    out = pii.detect(boxed(docs, "text", without=("text", "n_chars")), carry=["whole"], masked=True)
    return unboxed(out, docs, text=F.col("masked"), n_chars=F.length("masked").cast("bigint"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences: a row per piece; a null or empty text is its end mark alone, no rows give none."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Language scores, the field's spans and tokenizer ids have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            out = materialize(out, name)
            discard(docs)
            release(spark)
        docs = out
    return docs
