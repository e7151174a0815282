"""Dictionary-encoded text: every distinct word is cleaned once, by rules and by word lists of any size.

Texts lie in chunks, each with a dictionary of its own words.  The distinct
words of all go through the rules of ``functions.text``; acronyms, slang, stop
words and words that stay unstemmed are tables that are joined to them.  The
results go to the dictionaries, and each chunk meets its own: words of a text
are neither dealt out nor brought together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkloom.functions import spelling, stemming
from sparkloom.functions import text as T
from sparkloom.sources.workspace import BROADCAST_ROWS, bounded, remove, written

#: A word is hot when more than one in so many of all words are it: fewer words than this.
HOT_SHARES = 1000

#: Bytes of text that share a dictionary; a chunk ends with the text that passes it.
CHUNK_BYTES = 1 << 25


@dataclass
class Lists:
    """Word lists: (word, to) of ``acronyms`` and ``slang``, (word) of ``stop``, ``keep`` and ``roots``.

    A repeated word counts by its least entry, null words not at all.  With
    ``roots`` words are stemmed to these (``functions.stemming``), without them
    by the affix rules of ``functions.text``.  With ``formal`` (word, n) a word
    that is neither formal nor in ``slang`` becomes the formal one that is one
    edit away (``functions.spelling``).
    """

    acronyms: DataFrame
    slang: DataFrame
    stop: DataFrame
    keep: DataFrame
    roots: DataFrame | None = None
    formal: DataFrame | None = None

    @staticmethod
    def own(spark: SparkSession, acronyms: DataFrame | None = None, slang: DataFrame | None = None, stop: DataFrame | None = None, keep: DataFrame | None = None, roots: DataFrame | None = None, formal: DataFrame | None = None) -> "Lists":
        """The engine's small lists where none is given."""
        pairs = lambda d: spark.createDataFrame(list(d.items()), "word string, to string")
        words = lambda ws: spark.createDataFrame([(w,) for w in ws], "word string")
        pick = lambda given, make, value: make(value) if given is None else given
        return Lists(pick(acronyms, pairs, T.ACRONYMS), pick(slang, pairs, T.SLANG), pick(stop, words, T.STOPWORDS), pick(keep, words, T.KEEP_UNSTEMMED), roots, formal)


def _mapped(words: DataFrame, by: str, entries: DataFrame, name: str) -> DataFrame:
    """``words`` with the entry of column ``by`` as ``name``, null without one."""
    one = entries.where("word IS NOT NULL").groupBy(F.col("word").alias(by)).agg(F.min("to").alias(name))
    return words.join(bounded(one), by, "left")


def _listed(words: DataFrame, by: str, listed: DataFrame, name: str) -> DataFrame:
    return _mapped(words, by, listed.select("word", F.lit("1").alias("to")), name).withColumn(name, F.col(name).isNotNull())


def clean_words(words: DataFrame, lists: Lists, remove: bool = True, compat: bool = True) -> DataFrame:
    """``words``, one row a word, with ``cleaned`` after all rules in order; without ``remove`` the last three are left out.

    A cleaned word can be empty, or several words with spaces between.
    """
    w = F.col
    rows = words.withColumn("_w", T.remove_url(F.lower(T.split_attached(w("word"))), compat))
    rows = _mapped(rows, "_w", lists.acronyms, "_to")
    rows = rows.withColumn("_w", F.when(w("_w").rlike(T.DOTTED), F.coalesce(w("_to"), F.replace("_w", F.lit("."), F.lit("")))).otherwise(w("_w"))).drop("_to")
    rows = _mapped(rows, "_w", lists.slang, "_to")
    if lists.formal is not None:
        near = spelling.formal_words(rows.where("_to IS NULL AND _w RLIKE '^[a-z]+$'").select(F.col("_w").alias("word")), lists.formal)
        rows = _mapped(rows, "_w", near.withColumnRenamed("formal", "to"), "_near").withColumn("_to", F.coalesce("_to", "_near")).drop("_near")
    rows = rows.withColumn("_w", T.pad_marks(T.remove_symbols(F.coalesce("_to", "_w")))).drop("_to")
    if remove:
        rows = rows.withColumn("_w", T.remove_punctuation(w("_w")))
        rows = _listed(_listed(rows, "_w", lists.stop, "_stop"), "_w", lists.keep, "_keep")
        gone = w("_stop") | w("_w").rlike(r"^[ ?0-9]+$")
        if lists.roots is None:
            rows = rows.withColumn("_w", F.when(gone, "").when(w("_keep"), w("_w")).otherwise(T.stem(w("_w"), ()))).drop("_stop", "_keep")
        else:
            rows = _stemmed(rows.withColumn("_w", F.when(gone, "").otherwise(w("_w"))).drop("_stop"), lists.roots)
    return rows.withColumnRenamed("_w", "cleaned").select(*words.columns, "cleaned")


def _stemmed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with each of the words in ``_w`` stemmed, those that ``_keep`` marks as they are."""
    pieces = rows.select("word", "_keep", F.posexplode(F.split("_w", " ")).alias("at", "piece"))
    found = stemming.stems(pieces.where("NOT _keep").select(F.col("piece").alias("word")), roots)
    both = pieces.join(found.withColumnRenamed("word", "piece"), "piece", "left")
    stem = F.when(F.col("_keep"), F.col("piece")).otherwise(F.coalesce("stem", "piece"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", stem.alias("stem")))), lambda x: x["stem"]), " ")
    return rows.drop("_w", "_keep").join(both.groupBy("word").agg(joined.alias("_w")), "word")


def _split(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all lines, and how many each line has."""
    parts = pc.split_pattern(lines, "\n")
    words = parts.flatten()
    full = pc.not_equal(words, "")
    return words.filter(full), np.diff(sums(full)[parts.offsets.to_numpy()])


def sums(values) -> np.ndarray:
    """0 and the running sums: of counts, where each group begins and ends."""
    return np.concatenate([[0], np.cumsum(np.asarray(values), dtype=np.int64)])


def groups(counts, values: pa.Array) -> pa.ListArray:
    """``values`` in lists of so many each."""
    return pa.ListArray.from_arrays(pa.array(sums(counts), pa.int32()), values)


def _chunked(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Texts with the number of their chunk, and the dictionary of each chunk: rows of (chunk, word, n)."""
    first, total, now, seen = TaskContext.get().partitionId() << 33, 0, None, []

    def rows(chunk, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), *[columns[f.name] if f.name in columns else pa.nulls(len(chunk), f.type) for f in list(schema)[1:]]], schema=schema)

    def ended() -> pa.RecordBatch:
        words = pa.concat_tables(seen).group_by("word").aggregate([("n", "sum")]).combine_chunks()
        seen.clear()
        return rows(np.full(len(words), now), word=words["word"].combine_chunks(), n=words["n_sum"].combine_chunks().cast(pa.int64()))

    for batch in batches:
        lines = batch.column(batch.schema.get_field_index("lines"))
        size = sums(pc.binary_length(lines.flatten()))[sums(pc.list_value_length(lines))]
        chunk = first + (total + size[:-1]) // most
        total += size[-1]
        yield rows(chunk, **dict(zip(batch.schema.names, batch.columns, strict=True)))
        edges = np.flatnonzero(np.diff(chunk)) + 1
        for at, to in zip([0, *edges], [*edges, len(chunk)], strict=True):
            if to == at:
                continue
            if seen and chunk[at] != now:
                yield ended()
            now, counts = chunk[at], _split(lines.slice(at, to - at).flatten())[0].value_counts()
            seen.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
    if seen:
        yield ended()


@dataclass
class Chunk:
    """Texts in a task: their ``keys``, ``lines`` a text, words a line in ``sizes``, all ``words``, and where each of them is ``at`` in the dictionary."""

    keys: list[pa.Array]
    lines: np.ndarray
    sizes: np.ndarray
    words: pa.Array
    at: np.ndarray
    dictionary: pa.Table

    @staticmethod
    def of(texts: pa.Table, dictionary: pa.Table, keys: list[str]) -> "Chunk":
        texts, dictionary = texts.combine_chunks(), dictionary.combine_chunks()
        one = lambda c: c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)
        lines = one(texts["lines"])
        words, sizes = _split(lines.flatten())
        at = pc.index_in(words, value_set=one(dictionary["word"]))
        if at.null_count:
            raise ValueError("a word is not in its chunk's dictionary")
        return Chunk([one(texts[k]) for k in keys], np.asarray(pc.list_value_length(lines)), sizes, words, at.to_numpy(), dictionary)

    def __getitem__(self, column: str) -> pa.Array:
        """What the dictionary has of a column, for every word of the texts."""
        return self.column(column).take(pa.array(self.at))

    def column(self, name: str) -> pa.Array:
        c = self.dictionary[name]
        return c.chunk(0) if c.num_chunks == 1 else c.combine_chunks()

    @property
    def totals(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(sums(self.sizes)[sums(self.lines)])


@dataclass
class Encoded:
    """Texts as a written table of (chunk, keys, lines), a line's words with line feeds between, and the chunks' dictionaries (chunk, word, n) in it."""

    table: DataFrame
    keys: list[str]
    path: str

    @property
    def tokens(self) -> DataFrame:
        """(chunk, word, n) of every chunk's distinct words."""
        return self.table.where("word IS NOT NULL").select("chunk", "word", "n")

    def words(self) -> DataFrame:
        """(word, n) of the distinct words."""
        return self.tokens.groupBy("word").agg(F.sum("n").alias("n"))

    def meet(self, facts: DataFrame, columns: list[str]) -> DataFrame:
        """The dictionaries (chunk, word) with ``columns`` of ``facts``, which has ``n`` and a row for each word.

        Facts that are few are broadcast.  Else the rows of hot words, fewer
        than ``HOT_SHARES``, meet theirs by broadcast where they are, and only
        the others are dealt out by word.
        """
        facts, tokens = facts.select("word", "n", *columns), self.tokens.drop("n")
        if facts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            return tokens.join(F.broadcast(facts.drop("n")), "word", "left")
        total = facts.agg(F.sum("n")).first()[0]
        hot = F.broadcast(facts.where(F.col("n") > total // HOT_SHARES).drop("n"))
        cold = tokens.join(hot.select("word"), "word", "left_anti").join(facts.drop("n"), "word", "left")
        return cold.unionByName(tokens.join(hot, "word").select(*cold.columns))

    def rebuild(self, facts: DataFrame, columns: list[str], each: Callable[[Chunk], tuple[np.ndarray | None, dict]], schema: str) -> DataFrame:
        """(keys, columns of ``schema``) of what ``each`` makes of a chunk and its dictionary with ``columns`` of ``facts``.

        ``each`` gives the numbers of the texts that its rows are of, None for
        a row a text, and the rows' columns.  A chunk meets its dictionary in
        one task, so the texts are shuffled once, as they are.
        """
        names = [f"k{i}" for i in range(len(self.keys))]
        texts = self.table.where("word IS NULL").select(F.col("chunk").alias("of"), *names, "lines")
        out = StructType([*[texts.schema[k] for k in names], *StructType.fromDDL(schema)])
        arrow = to_arrow_schema(out)

        def run(texts: pa.Table, dictionary: pa.Table) -> pa.Table:
            chunk = Chunk.of(texts, dictionary, names)
            rows, made = each(chunk)
            keys = chunk.keys if rows is None else [k.take(pa.array(rows)) for k in chunk.keys]
            return pa.table([*keys, *made.values()], names=[*names, *made]).cast(arrow)

        done = texts.groupBy("of").cogroup(self.meet(facts, columns).groupBy("chunk")).applyInArrow(run, out)
        return done.select(*[F.col(n).alias(k) for n, k in zip(names, self.keys, strict=True)], *out.names[len(names) :])

    def drop(self) -> None:
        """Delete the table; for when nothing reads it any more."""
        remove(self.table.sparkSession, self.path)


def encode(docs: DataFrame, keys: list[str], text: str, composites: list[str] = (), by_sentence: bool = True) -> Encoded:
    """The words of every row, a line a sentence or as one line; written once, so that chunks stay as they are."""
    joined = lambda s: F.array_join(T.compose(T.words(s), list(composites)), "\n") if composites else F.regexp_replace(s, r"\s+", "\n")
    lines = F.transform(T.sentences(F.col(text)) if by_sentence else F.array(text), joined)
    rows = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.when(F.col(text).isNotNull(), lines).otherwise(F.array().cast("array<string>")).alias("lines"))
    schema = StructType([*StructType.fromDDL("chunk long"), *rows.schema, *StructType.fromDDL("word string, n long")])
    for field in schema:
        field.nullable = True
    arrow, most = to_arrow_schema(schema), CHUNK_BYTES

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunked(batches, arrow, most)

    table, path = written(rows.mapInArrow(each, schema), "texts")
    return Encoded(table, list(keys), path)


def clean_terms(docs: DataFrame, keys: list[str], text: str, lists: Lists | None = None, composites: list[str] = (), compat: bool = True) -> DataFrame:
    """(keys, terms): the cleaned words of every row joined by commas, as ``functions.text.clean_terms`` has them; a null text has none."""
    coded = encode(docs, keys, text, composites, bool(composites))
    cleaned, _ = written(clean_words(coded.words(), lists or Lists.own(docs.sparkSession), compat=compat), "words")

    def joined(chunk: Chunk) -> tuple[None, dict]:
        value = chunk["cleaned"]
        kept = pc.fill_null(pc.not_equal(value, ""), False)
        counts = np.diff(sums(kept)[sums(chunk.totals)])
        return None, {"terms": pc.binary_join(groups(counts, value.filter(kept)), ",")}

    return coded.rebuild(cleaned, ["cleaned"], joined, "terms string")


def tagged_words(words: DataFrame, lists: Lists, tags: DataFrame, default: str = "NN") -> DataFrame:
    """(word, n, place, piece, tag): the words that cleaning without the last three rules makes of each, with their tags.

    ``tags`` is a table (word, tag) of any size; other words get ``default``.
    """
    pieces = clean_words(words, lists, remove=False).select("word", "n", F.posexplode(T.words(F.col("cleaned"))).alias("place", "piece"))
    return _mapped(pieces, "piece", tags.select("word", F.col("tag").alias("to")), "tag").select("word", "n", "place", "piece", F.coalesce("tag", F.lit(default)).alias("tag"))


def tag_table(spark: SparkSession) -> DataFrame:
    """The engine's own (word, tag) entries."""
    return spark.createDataFrame(list(T.TAGS.items()), "word string, tag string")
