"""Term features, term clouds, classifiers and sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import classify, dictionary, sentiment
from sparkloom.operators import features as O
from sparkloom.plans.cleaning import sql_stem
from sparkloom.plans.common import Registry, sql_terms, sql_words, table
from sparkloom.session import EngineConfig
from sparkloom.sources.tables import lexicon_file
from sparkloom.sources.workspace import folder, written

QUERIES = Registry()
ORACLES = QUERIES.sql
CONFIG = EngineConfig()

#: Steps of a short descent, and rows that a term must occur in, in the queries.
STEPS, LEAST_ROWS = 4, 5

_TF = f"""WITH x AS (SELECT doc_id, lang, source, unnest({sql_terms()}) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM x GROUP BY 1, 2),
idf AS (SELECT term, count(*) AS df, ln(((SELECT count(DISTINCT doc_id) FROM f) + 1.0) / (count(*) + 1.0)) AS idf FROM f GROUP BY term HAVING count(*) >= {CONFIG.min_doc_freq})"""


def _frequency(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return O.term_frequency(O.term_rows(docs, "doc_id", T.simple_terms(F.col("text"))), "doc_id")


def _idf(spark, sf_dir) -> DataFrame:
    return O.inverse_frequency(table(spark, sf_dir, "documents"), T.simple_terms(F.col("text")), CONFIG.min_doc_freq)


def _cloud(spark, sf_dir, title: str) -> tuple[DataFrame, DataFrame]:
    rows = O.term_rows(table(spark, sf_dir, "documents"), title, T.simple_terms(F.col("text")))
    return O.term_cloud(O.term_frequency(rows, title), title, _idf(spark, sf_dir), CONFIG.top_terms)


def _sql_cloud(title: str) -> str:
    return f"""{_TF},
t AS (SELECT {title}, term, count(*) AS tf FROM x GROUP BY 1, 2),
v AS (SELECT {title}, term, tf * idf AS value FROM t JOIN idf USING (term)),
r AS (SELECT *, row_number() OVER (PARTITION BY {title} ORDER BY value DESC, term) AS rank FROM v),
c AS (SELECT * FROM r WHERE rank <= {CONFIG.top_terms})"""


@QUERIES.add(_TF + " SELECT term, count(*) AS df FROM f GROUP BY term")
def document_frequency(spark, sf_dir):
    return O.document_frequency(table(spark, sf_dir, "documents"), T.simple_terms(F.col("text")))


@QUERIES.add(_TF + " SELECT term, df, round(idf, 6) AS idf FROM idf")
def feature_selection(spark, sf_dir):
    return _idf(spark, sf_dir).withColumn("idf", F.round("idf", 6))


@QUERIES.add(_TF + " SELECT doc_id, term, round(tf * idf, 6) AS value FROM f JOIN idf USING (term)")
def tfidf_docs(spark, sf_dir):
    return O.tfidf(_frequency(spark, sf_dir), _idf(spark, sf_dir), "doc_id").withColumn("value", F.round("value", 6))


@QUERIES.add(_sql_cloud("lang") + " SELECT lang, term, rank, round(value, 6) AS value FROM c")
def termcloud_top_terms(spark, sf_dir):
    return _cloud(spark, sf_dir, "lang")[0].withColumns({"value": F.round("value", 6), "rank": F.col("rank").cast("bigint")})


@QUERIES.add(_sql_cloud("source") + " SELECT source, term, rank, round(value, 6) AS value FROM c")
def termcloud_by_host(spark, sf_dir):
    return _cloud(spark, sf_dir, "source")[0].withColumns({"value": F.round("value", 6), "rank": F.col("rank").cast("bigint")})


@QUERIES.add(_sql_cloud("lang") + f" SELECT term, round(sum(value), 6) AS value FROM c GROUP BY term ORDER BY sum(value) DESC, term LIMIT {CONFIG.top_terms}")
def termcloud_all(spark, sf_dir):
    return O.cloud_of_all(_cloud(spark, sf_dir, "lang")[0], CONFIG.top_terms).withColumn("value", F.round("value", 6))


@QUERIES.add(_TF + ", v AS (SELECT lang, term, count(*) * any_value(idf) AS value FROM x JOIN idf USING (term) GROUP BY 1, 2) SELECT lang, term, round(2 * value, 6) AS value FROM v")
def tfidf_combine_state(spark, sf_dir):
    """The same rows as saved state and as new rows: every value doubles."""
    state = _cloud(spark, sf_dir, "lang")[1]
    state, _ = written(state, "state")
    return O.combine([state, state], ["lang", "term"]).withColumn("value", F.round("value", 6))


#: Weights written for this engine; margins are compared with 1.
WEIGHTS = (("function", "the", 0.05), ("function", "of", 0.07), ("function", "and", 0.03), ("romance", "de", 0.2), ("romance", "la", 0.3), ("romance", "que", 0.15), ("german", "der", 0.4), ("german", "und", 0.35), ("german", "nicht", 0.2), ("romance", "the", -0.4))
LABELS = ["german", "romance", "function"]
_WEIGHTS = "w(label, term, weight) AS (VALUES " + ", ".join(f"('{a}', '{b}', CAST({c} AS DOUBLE))" for a, b, c in WEIGHTS) + ")"
_MARGINS = _TF + f", {_WEIGHTS}, m AS (SELECT doc_id, label, sum(tf * idf * weight) AS margin FROM f JOIN idf USING (term) JOIN w USING (term) GROUP BY 1, 2)"


def _margins(spark, sf_dir) -> DataFrame:
    weights = F.broadcast(spark.createDataFrame(WEIGHTS, "label string, term string, weight double"))
    rows = O.term_rows(table(spark, sf_dir, "documents"), "doc_id", T.simple_terms(F.col("text")))
    frequency = O.term_frequency(classify.known_terms(rows, weights), "doc_id")
    return classify.margins(O.tfidf(frequency, _idf(spark, sf_dir), "doc_id"), weights, "doc_id")


@QUERIES.add(_MARGINS + " SELECT doc_id, label, round(margin, 6) AS margin FROM m")
def classify_scores(spark, sf_dir):
    return _margins(spark, sf_dir).withColumn("margin", F.round("margin", 6))


@QUERIES.add(_MARGINS + f", h AS (SELECT doc_id, string_agg(label, ',' ORDER BY list_position({LABELS}, label)) AS l FROM m WHERE margin >= {CONFIG.margin} GROUP BY 1) SELECT doc_id, coalesce(l, 'none') AS classification FROM documents LEFT JOIN h USING (doc_id)")
def classify_labels(spark, sf_dir):
    return classify.label_lists(_margins(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id", LABELS, CONFIG.margin, CONFIG.none_label)


def _sql_train(steps: int = STEPS) -> str:
    """One common table for the weights after each step."""
    parts = [
        f"x AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'junk' END AS label, unnest({sql_terms()}) AS term FROM documents JOIN labels USING (doc_id))",
        "f AS (SELECT doc_id, term, count(*) AS tf FROM x GROUP BY 1, 2)",
        f"idf AS (SELECT term, ln(((SELECT count(DISTINCT doc_id) FROM f) + 1.0) / (count(*) + 1.0)) AS idf FROM f GROUP BY term HAVING count(*) >= {LEAST_ROWS})",
        "v AS MATERIALIZED (SELECT doc_id, term, tf * idf AS value FROM f JOIN idf USING (term))",
        "y AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'junk' END AS own, target, CASE WHEN own = target THEN 1.0 ELSE -1.0 END::DOUBLE AS y FROM documents JOIN labels USING (doc_id), (VALUES ('good'), ('junk')) t(target))",
        "w0 AS (SELECT '' AS label, '' AS term, 0.0::DOUBLE AS weight WHERE false)",
    ]
    for t in range(1, steps + 1):
        rate = t**-0.5
        parts += [
            f"m{t} AS MATERIALIZED (SELECT doc_id, label, sum(value * weight) AS margin FROM v JOIN w{t - 1} USING (term) GROUP BY 1, 2)",
            f"g{t} AS (SELECT target AS label, term, sum(y * value) * ({rate!r}::DOUBLE / (SELECT count(*) FROM documents JOIN labels USING (doc_id))) AS weight FROM y LEFT JOIN m{t} ON m{t}.doc_id = y.doc_id AND label = target JOIN v ON v.doc_id = y.doc_id WHERE y * coalesce(margin, 0) < 1 GROUP BY 1, 2)",
            f"w{t} AS MATERIALIZED (SELECT label, term, sum(weight) AS weight FROM (SELECT label, term, weight * {1.0 - rate * 0.01!r}::DOUBLE AS weight FROM w{t - 1} UNION ALL SELECT * FROM g{t}) GROUP BY 1, 2)",
        ]
    return "WITH " + ", ".join(parts)


def _model(spark, sf_dir, steps: int) -> tuple[DataFrame, classify.Model]:
    """Labelled documents, and a model of them after ``steps`` steps that was stored and read back."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows, _ = written(docs.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("junk").alias("label"), T.simple_terms(F.col("text")).alias("terms")), "terms")
    path = folder(spark, "models")
    classify.build(rows, "doc_id", F.col("terms"), "label", ["good", "junk"], LEAST_ROWS, steps).save(path)
    return rows, classify.Model.load(spark, path)


@QUERIES.add(_sql_train() + f" SELECT label, term, round(weight, 6) AS weight FROM w{STEPS}")
def svm_weights(spark, sf_dir):
    """Weights of the labels after some steps over all labelled documents."""
    return _model(spark, sf_dir, STEPS)[1].weights.select("label", "term", F.round("weight", 6).alias("weight"))


@QUERIES.add(_sql_train(CONFIG.svm_iterations) + f", s AS (SELECT doc_id, label, sum(value * weight) AS margin FROM v JOIN w{CONFIG.svm_iterations} USING (term) GROUP BY 1, 2), h AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM s WHERE margin >= 0 GROUP BY 1) SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'junk' END AS label, coalesce(l, 'none') AS classification FROM documents JOIN labels USING (doc_id) LEFT JOIN h USING (doc_id)")
def svm_train_predict(spark, sf_dir):
    """Train all labels at once in all of the descent's steps, store and read the model, and classify the same rows."""
    rows, model = _model(spark, sf_dir, CONFIG.svm_iterations)
    found = classify.by_weights(rows, "doc_id", F.col("terms"), model.weights, model.idf, ["good", "junk"], 0.0)
    return rows.select("doc_id", "label").join(found, "doc_id")


@QUERIES.add("SELECT doc_id, CASE WHEN quality = 1 THEN 'Good' ELSE 'Junk' END AS label, CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM labels")
def labelled_points(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "Good").otherwise("Junk").alias("label"))
    return rows.withColumn("y", classify.labelled(F.col("label"), "good"))


def _lexicon(spark) -> DataFrame:
    return sentiment.prior(spark.createDataFrame(sentiment.LEXICON, "pos string, id string, pos_score double, neg_score double, terms string"))


_LEX = "lx(pos, id, p, n, terms) AS (VALUES " + ", ".join(f"('{a}', '{b}', CAST({c} AS DOUBLE), CAST({d} AS DOUBLE), '{e}')" for a, b, c, d, e in sentiment.LEXICON) + "), le AS (SELECT pos, p - n AS s, unnest(string_split(terms, ' ')) AS t FROM lx), lp AS (SELECT split_part(t, '#', 1) AS term, pos, sum(s / CAST(split_part(t, '#', 2) AS DOUBLE)) / sum(1 / CAST(split_part(t, '#', 2) AS DOUBLE)) AS score FROM le GROUP BY 1, 2)"


_SENSES = f"""WITH x AS (SELECT DISTINCT doc_id, lang, term FROM (SELECT doc_id, lang, unnest({sql_terms()}) AS term FROM documents)),
s AS (SELECT term, lang, count(*) AS n, round(avg(quality), 3) AS p, round(avg(toxic), 3) AS q FROM x JOIN labels USING (doc_id) WHERE lang IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= {LEAST_ROWS}),
r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY n DESC, lang) AS rank FROM s)"""


@QUERIES.add(_SENSES + " SELECT term, 'n' AS pos, round(sum((p - q) / rank) / sum(1.0 / rank), 6) AS score FROM r GROUP BY term")
def lexicon_prior(spark, sf_dir):
    """Prior of every word of a lexicon file that is made of the labelled documents: a sense per language, its scores the shares of good and toxic ones."""
    docs = table(spark, sf_dir, "documents").where("lang IS NOT NULL").join(table(spark, sf_dir, "labels"), "doc_id")
    each = docs.select("lang", "quality", "toxic", F.explode(F.array_distinct(T.simple_terms(F.col("text")))).alias("term"))
    senses = each.groupBy("term", "lang").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 3).alias("p"), F.round(F.avg("toxic"), 3).alias("q")).where(F.col("n") >= LEAST_ROWS)
    rank = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("n"), "lang"))
    lines = senses.withColumn("rank", rank).select(F.concat_ws("\t", F.lit("n"), "lang", F.col("p").cast("string"), F.col("q").cast("string"), F.concat("term", F.lit("#"), F.col("rank").cast("string")), F.lit("made of documents")).alias("value"))
    path = folder(spark, "lexicon")
    lines.write.text(path)
    return sentiment.prior(lexicon_file(spark, path)).select("term", "pos", F.round("score", 6).alias("score"))


_TAGGED = {k: T.POS_CLASSES.get(v, v) for k, v in T.TAGS.items()}
_SCORES = f"""WITH {_LEX},
tags(w, pos) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _TAGGED.items())}),
d AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM documents),
s AS (SELECT doc_id, i, lower(ss[i]) AS sentence FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM d)),
w AS (SELECT doc_id, i, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM (SELECT doc_id, i, {sql_words("sentence")} AS ws FROM s)),
g AS (SELECT doc_id, i, j, w.w, coalesce(pos, 'n') AS pos FROM w LEFT JOIN tags ON w.w = tags.w),
v AS (SELECT w, pos, {sql_stem("w")} AS stem FROM (SELECT DISTINCT w, pos FROM g)),
x AS (SELECT v.w, v.pos, coalesce(a.score, b.score, 0) AS s FROM v LEFT JOIN lp a ON v.w = a.term AND v.pos = a.pos LEFT JOIN lp b ON v.stem = b.term AND v.pos = b.pos),
z AS (SELECT doc_id, i, j, g.w, g.pos, CASE WHEN abs(s) <= 0.1 THEN 0.0 ELSE s END AS score FROM g JOIN x ON g.w = x.w AND g.pos = x.pos),
e AS (SELECT doc_id, i, coalesce(avg(score) FILTER (score > 0), 0) AS pos, coalesce(avg(-score) FILTER (score < 0), 0) AS neg FROM z WHERE score <> 0 GROUP BY 1, 2)"""


def _text(spark, sf_dir, negation: str | None = None) -> tuple:
    """What the sentiment functions take after the documents."""
    return "text", dictionary.tag_table(spark), _lexicon(spark), *[negation] * bool(negation)


@QUERIES.add(_SCORES + " SELECT pos, round(score, 6) AS score, count(*) AS n FROM z GROUP BY 1, 2")
def word_scores(spark, sf_dir):
    """All words, scored by themselves, by their stem, or 0."""
    words = written(sentiment.vocabulary(table(spark, sf_dir, "documents"), "text", dictionary.tag_table(spark)), "vocabulary")[0]
    scored = words.join(sentiment.word_scores(words, _lexicon(spark)), ["word", "pos"], "left")
    return scored.groupBy("pos", F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score")).agg(F.sum("n").alias("n"))


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"pos": F.round("pos", 6), "neg": F.round("neg", 6)})


@QUERIES.add(_SCORES + ", t AS (SELECT doc_id, sum(pos) AS pos, sum(neg) AS neg FROM e GROUP BY 1), d2 AS (SELECT doc_id, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM documents LEFT JOIN t USING (doc_id)) SELECT doc_id, round(pos, 6) AS pos, round(neg, 6) AS neg, CASE WHEN round(pos, 9) > round(neg, 9) THEN 'positif' WHEN round(pos, 9) < round(neg, 9) THEN 'negatif' ELSE 'netral' END AS sentiment FROM d2")
def doc_sentiment(spark, sf_dir):
    return _rounded(sentiment.detect_text(table(spark, sf_dir, "documents"), "doc_id", *_text(spark, sf_dir)))


def _sql_negated() -> str:
    """Signs turn in the four words after a negation, up to the next negation or conjunction; a negation in such words begins nothing."""
    spans = """mk AS (SELECT doc_id, i, j, pos, row_number() OVER (PARTITION BY doc_id, i ORDER BY j) AS k FROM g WHERE pos IN ('NEG', 'CC')),
st AS (SELECT doc_id, i, k, CASE WHEN pos = 'NEG' THEN j END AS neg FROM mk WHERE k = 1 UNION ALL
  SELECT m.doc_id, m.i, m.k, CASE WHEN m.pos = 'NEG' AND NOT coalesce(m.j <= st.neg + 4, false) THEN m.j END FROM st JOIN mk m ON m.doc_id = st.doc_id AND m.i = st.i AND m.k = st.k + 1),
sp AS (SELECT st.doc_id, st.i, neg + 1 AS lo, least(neg + 4, coalesce(m.j - 1, neg + 4)) AS hi FROM st LEFT JOIN mk m ON m.doc_id = st.doc_id AND m.i = st.i AND m.k = st.k + 1 WHERE neg IS NOT NULL),
fl AS (SELECT DISTINCT doc_id, i, unnest(range(lo, hi + 1)) AS j FROM sp),
y AS (SELECT z.doc_id, z.i, CASE WHEN fl.j IS NOT NULL AND z.pos NOT IN ('NEG', 'CC') THEN -score ELSE score END AS score FROM z LEFT JOIN fl ON fl.doc_id = z.doc_id AND fl.i = z.i AND fl.j = z.j),
e AS ("""
    return _SCORES.replace("WITH ", "WITH RECURSIVE ", 1).replace("e AS (SELECT doc_id, i, coalesce(avg", spans + "SELECT doc_id, i, coalesce(avg").replace("FROM z WHERE score <> 0", "FROM y WHERE score <> 0")


_DOCUMENT = ", t AS (SELECT doc_id, sum(pos) AS pos, sum(neg) AS neg FROM e GROUP BY 1), d2 AS (SELECT doc_id, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM documents LEFT JOIN t USING (doc_id)) SELECT doc_id, round(pos, 6) AS pos, round(neg, 6) AS neg, CASE WHEN round(pos, 9) > round(neg, 9) THEN 'positif' WHEN round(pos, 9) < round(neg, 9) THEN 'negatif' ELSE 'netral' END AS sentiment FROM d2"


@QUERIES.add(_sql_negated() + _DOCUMENT)
def negation_window(spark, sf_dir):
    """Sentiment with signs turned after a negation."""
    return _rounded(sentiment.detect_text(table(spark, sf_dir, "documents"), "doc_id", *_text(spark, sf_dir, "window4")))


@QUERIES.add(_SCORES + " SELECT doc_id, CAST(i - 1 AS INTEGER) AS sentence, round(pos, 6) AS pos, round(neg, 6) AS neg FROM e")
def sentence_scores(spark, sf_dir):
    """Averages of every sentence that has a scored word."""
    return _rounded(sentiment.text_scores(table(spark, sf_dir, "documents"), "doc_id", *_text(spark, sf_dir)))
