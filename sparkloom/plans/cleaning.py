"""Every word-cleaning rule over all words of all documents, and their composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import spelling
from sparkloom.functions import stemming as S
from sparkloom.functions import text as T
from sparkloom.operators import boundaries, dictionary, features, tagger
from sparkloom.plans.common import Registry, sql_case, sql_list, sql_terms, sql_words, table
from sparkloom.sources.workspace import bounded, written

QUERIES = Registry()
ORACLES = QUERIES.sql

_URL = rf"^(?:{T.URL}|{T.W_WORD}|{T.MAIL})$"


def sql_split(w: str) -> str:
    return rf"regexp_replace(regexp_replace({w}, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '([^ ])([A-Z][a-z0-9])', '\1 \2', 'g')"


def sql_url(w: str) -> str:
    return f"CASE WHEN regexp_matches({w}, '{_URL}') THEN '' ELSE {w} END"


def sql_acronym(w: str) -> str:
    return f"CASE WHEN regexp_matches({w}, '{T.DOTTED}') THEN {sql_case(T.ACRONYMS, w, f'replace({w}, chr(46), chr(0))')} ELSE {w} END".replace("chr(0)", "''")


def sql_slang(w: str) -> str:
    return sql_case(T.SLANG, w, w)


def sql_symbols(w: str) -> str:
    return f"regexp_replace({w}, '[^a-z0-9@$!?.,; :-]', '', 'g')"


def sql_marks(w: str) -> str:
    for m in T.MARKS:
        m = m.replace("'", "''")
        w = f"replace({w}, '{m}', ' {m} ')"
    return w


def sql_punctuation(w: str) -> str:
    return rf"regexp_replace(regexp_replace({w}, '[^a-zA-Z0-9-]+(-|$)', '\1', 'g'), '[^a-zA-Z0-9-]+', ' ', 'g')"


def sql_stop(w: str) -> str:
    return f"CASE WHEN {w} IN {sql_list(T.STOPWORDS)} OR regexp_matches({w}, '^[ ?0-9]+$') THEN '' ELSE {w} END"


def sql_stem(w: str) -> str:
    out = w
    for pattern, to in T.AFFIXES:
        to = to.replace("$", "\\")
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return f"CASE WHEN {w} IN {sql_list(T.KEEP_UNSTEMMED)} THEN {w} ELSE {out} END"


def _each(name: str, rule, sql_rule) -> None:
    """A query that gives every document's words after one rule."""

    def query(spark, sf_dir):
        done = F.transform(T.words(F.col("text")), lambda w: rule(w))
        return table(spark, sf_dir, "documents").select("doc_id", F.array_join(done, "|").alias("words"))

    query.__name__ = name
    QUERIES.add(f"SELECT doc_id, array_to_string(list_transform({sql_words()}, lambda w: {sql_rule('w')}), '|') AS words FROM documents")(query)


_each("split_attached", T.split_attached, sql_split)
_each("lower_words", F.lower, lambda w: f"lower({w})")
_each("remove_url_tokens", T.remove_url, sql_url)
_each("acronym_lookup", T.expand_acronym, sql_acronym)
_each("formalise", T.formalise, sql_slang)
_each("remove_symbols", lambda w: T.remove_symbols(F.lower(w)), lambda w: sql_symbols(f"lower({w})"))
_each("normalise_punct", T.pad_marks, sql_marks)
_each("remove_punctuation", T.remove_punctuation, sql_punctuation)
_each("stopword_removal", lambda w: T.remove_stopword(F.lower(w)), lambda w: sql_stop(f"lower({w})"))
_each("stem_terms", lambda w: T.stem(T.remove_symbols(F.lower(w))), lambda w: sql_stem(sql_symbols(f"lower({w})")))

_STEPS = (lambda w: f"lower({sql_split(w)})", sql_url, sql_acronym, sql_slang, sql_symbols, sql_marks, sql_punctuation, sql_stop, sql_stem)


def _sql_clean() -> str:
    """One step per nested list, so that no expression is written out twice."""
    words = sql_words("regexp_replace(text, '([.!?])\\s+', '\\1 ', 'g')")
    for step in _STEPS:
        words = f"list_transform({words}, lambda w: {step('w')})"
    return f"array_to_string(list_filter({words}, lambda w: w <> ''), ',')"


@QUERIES.add(f"SELECT doc_id, {_sql_clean()} AS terms FROM documents")
def clean_text(spark, sf_dir):
    """Every distinct word cleaned once."""
    return dictionary.clean_terms(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@QUERIES.add(r"SELECT doc_id, array_to_string(string_split_regex(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), '|') AS sentences FROM documents")
def sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.sentences(F.col("text")), "|").alias("sentences"))


def _sql_tagged() -> str:
    """Words after the rules without the last three, split at the spaces these put in, and their tags."""
    words = sql_words("regexp_replace(text, '([.!?])\\s+', '\\1 ', 'g')")
    for step in _STEPS[:6]:
        words = f"list_transform({words}, lambda w: {step('w')})"
    tag = sql_case(T.TAGS, "w", "'NN'")
    return f"WITH x AS (SELECT unnest(string_split(array_to_string({words}, ' '), ' ')) AS w FROM documents), t AS (SELECT {tag} AS tag FROM x WHERE w <> ''), p AS (SELECT {sql_case(T.POS_CLASSES, 'tag', 'tag')} AS pos FROM t) "


def _tagged(spark, sf_dir):
    """Distinct words as the tagger gets them, counted and tagged."""
    each = table(spark, sf_dir, "documents").select(F.explode(T.words(F.col("text"))).alias("word"))
    words = each.groupBy("word").agg(F.count("*").alias("n"))
    return dictionary.tagged_words(words, dictionary.Lists.own(spark), dictionary.tag_table(spark))


@QUERIES.add(_sql_tagged() + "SELECT tag, count(*) AS n FROM t GROUP BY tag")
def pos_tags(spark, sf_dir):
    """Tags of the words that are cleaned for the tagger."""
    return _tagged(spark, sf_dir).groupBy("tag").agg(F.sum("n").alias("n"))


@QUERIES.add(_sql_tagged() + "SELECT pos, count(*) AS n FROM p GROUP BY pos")
def standard_pos(spark, sf_dir):
    return _tagged(spark, sf_dir).groupBy(T.standard_pos(F.col("tag")).alias("pos")).agg(F.sum("n").alias("n"))


@QUERIES.add(f"""WITH x AS (SELECT doc_id, unnest({sql_terms()}) AS word FROM documents), v AS (SELECT DISTINCT word FROM x),
f AS (SELECT word AS formal, count(DISTINCT doc_id) AS n FROM x GROUP BY word HAVING count(DISTINCT doc_id) >= 20),
p AS (SELECT word, formal, n FROM v JOIN f ON length(word) >= 4 AND length(formal) >= 4 AND abs(length(word) - length(formal)) <= 1 AND word NOT IN (SELECT formal FROM f) WHERE levenshtein(word, formal) <= 1)
SELECT word, formal FROM p QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, formal) = 1""")
def slang_words(spark, sf_dir):
    """Words that few documents have, with the frequent word one edit away."""
    docs = table(spark, sf_dir, "documents")
    frequent = features.document_frequency(docs, T.simple_terms(F.col("text")), 20).select(F.col("term").alias("word"), F.col("df").alias("n"))
    return spelling.formal_words(docs.select(F.explode(T.simple_terms(F.col("text"))).alias("word")), written(frequent, "formal")[0])


_SPLIT = rf"""WITH d AS (SELECT doc_id, {sql_words()} AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM d),
v AS (SELECT word, regexp_replace(lower(word), '[.]$', '') AS kind, count(*) AS n FROM t GROUP BY word),
q AS (SELECT sum(n) FILTER (word LIKE '%.') / sum(n) AS p FROM v),
k AS (SELECT kind, coalesce(sum(n) FILTER (word LIKE '%.'), 0) AS dot, sum(n) AS n, length(kind) - length(replace(kind, '.', '')) AS inside FROM v GROUP BY kind),
a AS (SELECT kind FROM (SELECT *, n - dot AS rest, length(kind) - inside AS size FROM k, q WHERE dot > 0 AND regexp_matches(kind, '^[\p{{L}}.]*\p{{L}}[\p{{L}}.]*$'))
  WHERE 2 * (dot * ln({boundaries.WITH_STOP} / p) + CASE WHEN p < 1 THEN rest * ln((1.0 - {boundaries.WITH_STOP}) / (1.0 - p)) ELSE 0 END) * exp(greatest(-size - rest * ln(size), -700)) * (inside + 1) >= {boundaries.LEAST_SCORE}),
m AS (SELECT DISTINCT kind FROM v WHERE regexp_matches(word, '^\p{{Ll}}'))"""


@QUERIES.add(_SPLIT + " SELECT kind FROM a")
def abbreviations(spark, sf_dir):
    """Abbreviations of the corpus."""
    words = table(spark, sf_dir, "documents").select(F.explode(T.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return boundaries.abbreviations(written(words, "words")[0]).select("kind")


@QUERIES.add(_SPLIT + rf""", f AS (SELECT doc_id, place, word, lead(word) OVER w AS nx, v.kind IN (SELECT kind FROM a) AS short FROM t JOIN v USING (word) WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
e AS (SELECT *, nx IS NULL OR regexp_matches(word, '[!?]$') OR (word LIKE '%.' AND CASE WHEN regexp_matches(word, '^[0-9]+[.]$') THEN NOT regexp_matches(nx, '^[\p{{Ll}}0-9]')
  WHEN short THEN regexp_matches(nx, '^\p{{Lu}}') AND regexp_replace(lower(nx), '[.]$', '') IN (SELECT kind FROM m) ELSE true END) AS ends FROM f),
g AS (SELECT doc_id, place, word, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM e)
SELECT doc_id, CAST(part AS INTEGER) AS sentence, string_agg(word, ' ' ORDER BY place) AS text FROM g GROUP BY doc_id, part""")
def trained_sentences(spark, sf_dir):
    """Sentences by the abbreviations of the corpus."""
    return boundaries.split(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@QUERIES.add()
def hmm_tags(spark, sf_dir):
    """Tags of every sentence by a model that learns from the good documents, tagged by dictionary; tests hold the decoding against all taggings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    good = docs.join(bounded(labels), "doc_id", "left_semi").select(F.explode(T.sentences(F.lower("text"))).alias("s"))
    model = tagger.train_sentences(good.select(T.tag_words(T.words(F.col("s"))).alias("tagged")))
    tags = tagger.tag(docs, ["doc_id"], "text", model)
    return tags.select("doc_id", "sentence", F.array_join(F.transform("tagged", lambda x: x["tag"]), " ").alias("tags"))


def _sql_stems() -> str:
    """Ways to roots: a common table per group of endings and per prefix."""
    ending = lambda es, new: f"SELECT word, left(form, length(form) - length(e)) AS form, steps + 1 AS steps, {new} AS ending, prefix FROM @ JOIN (SELECT unnest({list(es)}) AS e) ON form LIKE '%' || e AND length(form) >= length(e) + 3"
    rules = "(VALUES " + ", ".join(f"('{n}', '{p}', '{t.replace('$', chr(92))}')" for n, p, t in S.PREFIXES) + ") AS r(name, pattern, repl)"
    never = " OR ".join(f"(name = '{p}' AND ending = '{e}')" for p, e in sorted(S.NEVER))
    prefix = f"SELECT word, regexp_replace(form, pattern, repl) AS form, steps + 1 AS steps, ending, CASE prefix WHEN '' THEN name ELSE prefix || ' ' || name END AS prefix FROM @ JOIN {rules} ON form LIKE name || '%' AND regexp_matches(form, pattern) AND NOT list_contains(string_split(prefix, ' '), name) AND (prefix <> '' OR NOT ({never}))"
    steps = [ending(S.PARTICLES, "ending"), ending(S.POSSESSIVES, "ending"), ending(S.DERIVATIONS, "e"), *[prefix] * S.MOST_PREFIXES]
    parts = [f"y{i + 1} AS (SELECT * FROM y{i} UNION {step.replace('@', f'y{i}')})" for i, step in enumerate(steps)]
    return f"""WITH x AS (SELECT doc_id, unnest({sql_terms()}) AS word FROM documents), v AS (SELECT DISTINCT word FROM x),
r AS (SELECT word AS form FROM x GROUP BY word HAVING count(DISTINCT doc_id) >= 20), y0 AS (SELECT word, word AS form, 0 AS steps, '' AS ending, '' AS prefix FROM v), {", ".join(parts)},
b AS (SELECT word, min((steps, -length(form), form)) AS best FROM y{len(steps)} SEMI JOIN r USING (form) GROUP BY word)
SELECT word, coalesce(best[3], word) AS stem FROM v LEFT JOIN b USING (word)"""


@QUERIES.add(_sql_stems())
def stem_words(spark, sf_dir):
    """Stems of all words of the documents, their roots being the words that 20 documents have."""
    docs = table(spark, sf_dir, "documents")
    roots = features.document_frequency(docs, T.simple_terms(F.col("text")), 20).select(F.col("term").alias("word"))
    words = docs.select(F.explode(T.simple_terms(F.col("text"))).alias("word"))
    return S.stems(words, written(roots, "roots")[0])


_UNITS = "list_transform(regexp_extract_all(term, '(?s).'), lambda c: CASE WHEN unicode(c) < 65536 THEN [unicode(c)] ELSE [55296 + ((unicode(c) - 65536) >> 10), 56320 + ((unicode(c) - 65536) & 1023)] END)"


def sql_bucket(term: str) -> str:
    units = _UNITS.replace("term", term)
    return f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(flatten({units}), lambda u: CAST(u AS BIGINT))), lambda a, c: (a * 31 + c) & 4294967295) & 1048575"


@QUERIES.add(f"WITH x AS (SELECT unnest({sql_words()}) AS w FROM documents), a AS (SELECT DISTINCT lower(w) AS term FROM x) SELECT term, {sql_bucket('term')} AS bucket FROM a")
def hash_buckets(spark, sf_dir):
    """Bucket of every term of the documents."""
    words = table(spark, sf_dir, "documents").select(F.explode(T.words(F.col("text"))).alias("w"))
    return words.select(F.lower("w").alias("term")).distinct().select("term", T.java_bucket(F.col("term")).alias("bucket"))


COMPOSITES = ("the of", "in the", "of the and")


@QUERIES.add()
def composite_words(spark, sf_dir):
    """Words with composites joined; leftmost longest has no SQL form, tests hold it against brute force."""
    joined = T.compose(T.words(F.lower("text")), list(COMPOSITES))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(joined, "|").alias("words"))
