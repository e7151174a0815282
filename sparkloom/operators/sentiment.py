"""Lexicon sentiment: prior of a term, word and sentence scores, document label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import sentences, standard_pos, stem
from sparkloom.functions.text import words as split_words
from sparkloom.sources.workspace import bounded, written

#: A small lexicon written for this engine: pos, id, positive, negative, term#rank list.
LEXICON = (
    ("n", "1", 0.500, 0.000, "the#1 of#2"),
    ("n", "2", 0.000, 0.375, "in#1 the#3"),
    ("a", "3", 0.750, 0.125, "good#1"),
    ("a", "4", 0.000, 0.625, "bad#1 to#2"),
    ("n", "5", 0.125, 0.050, "er#1"),
    ("n", "6", 0.250, 0.750, "on#1 er#2"),
    ("v", "7", 0.625, 0.000, "is#1 was#2"),
    ("n", "8", 0.000, 0.500, "de#1 le#2 la#1"),
    ("n", "9", 0.875, 0.000, "und#1 con#1"),
)


def prior(lines: DataFrame) -> DataFrame:
    """(term, pos, score): rank-weighted mean of positive less negative over the senses.

    ``lines`` has pos, pos_score, neg_score and terms ("term#rank ...").
    """
    each = lines.select("pos", (F.col("pos_score") - F.col("neg_score")).alias("s"), F.explode(F.split("terms", " ")).alias("t"))
    parts = each.select("pos", "s", F.split("t", "#")[0].alias("term"), F.split("t", "#")[1].cast("double").alias("rank"))
    return parts.groupBy("term", "pos").agg((F.sum(F.col("s") / F.col("rank")) / F.sum(1 / F.col("rank"))).alias("score"))


def turned(marks: Column, span: int = 4) -> Column:
    """Intervals (lo, hi) of places whose sign flips, for the (i, t) places of negations and conjunctions in order.

    Up to ``span`` words after a negation; another one or a conjunction ends it.
    """
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    start = F.struct(F.lit(None).cast("int").alias("neg"), none.alias("out"))
    closed = lambda acc, end: F.when(acc["neg"].isNotNull(), F.concat(acc["out"], F.array(F.struct((acc["neg"] + 1).alias("lo"), F.least(acc["neg"] + span, end).alias("hi"))))).otherwise(acc["out"])

    def step(acc: Column, x: Column) -> Column:
        active = F.coalesce(x["i"] <= acc["neg"] + span, F.lit(False))
        return F.struct(F.when((x["t"] == "NEG") & ~active, x["i"]).alias("neg"), closed(acc, x["i"] - 1).alias("out"))

    return F.aggregate(marks, start, step, lambda acc: closed(acc, F.lit(2**31 - 1)))


def flips(tags: Column, span: int = 4) -> Column:
    """Whether the sign of each word flips, for the tags of all words of a sentence."""
    marks = F.filter(F.transform(tags, lambda t, i: F.struct(i.alias("i"), t.alias("t"))), lambda x: x["t"].isin("NEG", "CC"))

    def of(spans: Column) -> Column:
        return F.transform(tags, lambda t, i: ~t.isin("NEG", "CC") & F.exists(spans, lambda s: (s["lo"] <= i) & (i <= s["hi"])))

    return F.element_at(F.transform(F.array(turned(marks, span)), of), 1)


def negate(scored: Column, span: int = 4) -> Column:
    """Scored words with the signs that ``flips`` names turned."""
    sign = flips(F.transform(scored, lambda x: x["tag"]), span)
    return F.zip_with(scored, sign, lambda x, f: F.struct(x["word"].alias("word"), x["tag"].alias("tag"), F.when(f, -x["score"]).otherwise(x["score"]).alias("score")))


def sentence_words(docs: DataFrame, key: str, tagged_sentences: Column, negation: str | None = None) -> DataFrame:
    """(key, sentence, word, pos, flip) of every word of the (word, tag) sentences."""
    each = docs.select(key, F.posexplode(tagged_sentences).alias("sentence", "s"))
    sign = flips(F.transform("s", lambda x: x["tag"])) if negation == "window4" else F.transform("s", lambda x: F.lit(False))
    rows = each.select(key, "sentence", F.explode(F.zip_with("s", sign, lambda x, f: F.struct(x["word"].alias("word"), x["tag"].alias("tag"), f.alias("flip")))).alias("w"))
    return rows.select(key, "sentence", "w.word", standard_pos(F.col("w.tag")).alias("pos"), "w.flip")


def word_scores(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, pos, score) of the distinct words that have one: that of word and pos, else of the word's stem; none within 0.1 of 0.

    ``lexicon`` has term, pos and score and is joined, so it may have any size.
    """
    once = words.select("word", "pos").distinct()
    named = lambda by, score: bounded(lexicon.select(F.col("term").alias(by), "pos", F.col("score").alias(score)))
    both = once.withColumn("stem", stem(F.col("word"))).join(named("word", "own"), ["word", "pos"], "left").join(named("stem", "stemmed"), ["stem", "pos"], "left")
    return both.select("word", "pos", F.coalesce("own", "stemmed").alias("score")).where(F.abs("score") > 0.1)


def _means(hits: DataFrame, key: str) -> DataFrame:
    """(key, sentence, pos, neg) of (key, sentence, score) rows: mean of the positive scores, and of the negative ones' size."""
    mean = lambda c: F.coalesce(F.avg(F.when(c > 0, c)), F.lit(0.0))
    return hits.groupBy(key, "sentence").agg(mean(F.col("score")).alias("pos"), mean(-F.col("score")).alias("neg"))


def sentence_scores(words: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """(key, sentence, pos, neg) of sentences that have a score, from tagged words.

    Distinct words are scored once and written; where those with a score are
    few, as a count shows, they are broadcast and no word of a text is shuffled.
    """
    scored = bounded(written(word_scores(words, lexicon), "scores")[0])
    score = F.when(F.col("flip"), -F.col("score")).otherwise(F.col("score"))
    return _means(words.join(scored, ["word", "pos"]).select(key, "sentence", score.alias("score")), key)


def vocabulary(docs: DataFrame, text: str, tags: DataFrame, default: str = "NN") -> DataFrame:
    """(word, n, tag, pos) of the distinct lower-case words, their tags from a table (word, tag) of any size."""
    each = docs.select(F.explode(split_words(F.lower(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    one = bounded(tags.where("word IS NOT NULL").groupBy("word").agg(F.min("tag").alias("tag")))
    tagged = each.join(one, "word", "left").withColumn("tag", F.coalesce("tag", F.lit(default)))
    return tagged.withColumn("pos", standard_pos(F.col("tag")))


def text_scores(docs: DataFrame, key: str, text: str, tags: DataFrame, lexicon: DataFrame, negation: str | None = None) -> DataFrame:
    """(key, sentence, pos, neg) of sentences that have a score, where a word's tag does not depend on its neighbours.

    So a distinct word is tagged and scored once, and of the texts' words only
    those go on that have a score, or end or begin a negation.  Rows that share
    a key are one text.
    """
    known = written(vocabulary(docs, text, tags), "vocabulary")[0]
    marks = F.col("tag").isin("NEG", "CC") if negation == "window4" else F.lit(False)
    facts = known.join(word_scores(known, lexicon), ["word", "pos"], "left").where(F.col("score").isNotNull() | marks)
    facts = bounded(written(facts.select("word", F.when(marks, F.col("tag")).alias("mark"), "score"), "scores")[0])
    each = docs.select(key, F.posexplode(sentences(F.lower(text))).alias("sentence", "s"))
    rows = each.select(key, "sentence", F.posexplode(split_words(F.col("s"))).alias("i", "word")).join(facts, "word")
    if negation != "window4":
        return _means(rows, key)
    found = rows.groupBy(key, "sentence").agg(F.sort_array(F.collect_list(F.struct("i", F.col("mark").alias("t"), "score"))).alias("ws"))
    spans = turned(F.filter("ws", lambda x: x["t"].isNotNull()))
    hits = found.withColumn("spans", spans).select(key, "sentence", "spans", F.explode(F.filter("ws", lambda x: x["score"].isNotNull())).alias("x"))
    flip = F.col("x.t").isNull() & F.exists("spans", lambda s: (s["lo"] <= F.col("x.i")) & (F.col("x.i") <= s["hi"]))
    return _means(hits.select(key, "sentence", F.when(flip, -F.col("x.score")).otherwise(F.col("x.score")).alias("score")), key)


def judge(docs: DataFrame, key: str, scores: DataFrame) -> DataFrame:
    """(key, pos, neg, sentiment) of every row: sentence averages added up."""
    total = scores.groupBy(key).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    out = docs.select(key).join(total, key, "left").na.fill(0.0, ["pos", "neg"])
    return out.select(key, "pos", "neg", label(F.round("pos", 9), F.round("neg", 9)).alias("sentiment"))


def detect(docs: DataFrame, key: str, tagged_sentences: Column, lexicon: DataFrame, negation: str | None = None) -> DataFrame:
    """(key, pos, neg, sentiment) of every row by its tagged sentences."""
    return judge(docs, key, sentence_scores(sentence_words(docs, key, tagged_sentences, negation), lexicon, key))


def detect_text(docs: DataFrame, key: str, text: str, tags: DataFrame, lexicon: DataFrame, negation: str | None = None) -> DataFrame:
    """(key, pos, neg, sentiment) of every row, words tagged by a table."""
    return judge(docs, key, text_scores(docs, key, text, tags, lexicon, negation))


def average(scored: Column) -> Column:
    """(pos, neg): mean of the positive scores, and of the negative ones' size; 0 without any."""
    mean = lambda xs: F.when(F.size(xs) > 0, F.aggregate(xs, F.lit(0.0), lambda a, v: a + v) / F.size(xs)).otherwise(F.lit(0.0))
    values = F.transform(scored, lambda x: x["score"])
    return F.struct(mean(F.filter(values, lambda v: v > 0)).alias("pos"), mean(F.transform(F.filter(values, lambda v: v < 0), lambda v: -v)).alias("neg"))


def label(pos: Column, neg: Column) -> Column:
    return F.when(pos > neg, "positif").when(pos < neg, "negatif").otherwise("netral")
