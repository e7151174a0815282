"""The operators bound to the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import centroids, decontaminate, doubling, filteraudit, langid, license, minhash, packing, pii, quality, suffixdedup, toxicity, warc
from sparkloom.llm.common import discard, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The installed vocabulary that packing counts in."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out("doc_id") & F.col("doc_id").isNotNull()))
    return langid.identify(docs.withColumn("held_out", langid.held_out("doc_id")), model, carry=["doc_id", "held_out"])


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_table(spark, sf_dir, "documents"), carry=["doc_id"])


def op6_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~langid.held_out("doc_id"))
    machine = toxicity.train(docs, labels)
    out = toxicity.score(docs, machine, carry=["doc_id"])
    return out.select("doc_id", langid.held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = doubling.remove_repeats(_table(spark, sf_dir, "documents"))
    out = materialize(cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")), "kept")
    discard(*cut._reads)
    return out


def op13_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(filteraudit.mask_counts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_langid": op2_langid,
    "op3_quality": op3_quality,
    "op4_license": op4_license,
    "op5_pii": op5_pii,
    "op6_suffixdedup": op6_suffixdedup,
    "op7_toxicity": op7_toxicity,
    "op8_minhash": op8_minhash,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_centroids": op11_centroids,
    "op12_doubling": op12_doubling,
    "op13_filteraudit": op13_filteraudit,
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS_AS_THEY_ARE = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"



def _sql_centroids(rounds: int = 3, dims: int = 64, k: int = 16) -> str:
    """One common table per assignment and per set of centroids."""
    usable = f"len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}"
    parts = [
        f"q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({dims} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {usable})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v FROM q WHERE vec_id IS NOT NULL ORDER BY k LIMIT {k})",
    ]
    for r in range(rounds + 1):
        far = "CAST(list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i]))) AS BIGINT)"
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT q.vec_id, q.v, c.k, {far} AS d FROM q CROSS JOIN c{r} c) GROUP BY vec_id)")
        if r < rounds:
            mean = f"SELECT k, list(m ORDER BY i) AS v FROM (SELECT k, i, CAST(floor(sum(x)::HUGEINT / count(*)) AS BIGINT) AS m FROM (SELECT k, unnest(range(1, {dims + 1})) AS i, unnest(v) AS x FROM a{r}) GROUP BY k, i) GROUP BY k"
            parts.append(f"m{r} AS MATERIALIZED ({mean}), c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k)")
    last = f"SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"
    return f"WITH {', '.join(parts)} {last}"


ORACLES: dict[str, str] = {
    "op11_centroids": _sql_centroids(),
    "op8_minhash": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS root, doc_id FROM s UNION SELECT r.root, p.b FROM r JOIN p ON r.doc_id = p.a),
c AS (SELECT root AS doc_id, min(doc_id) AS component_id FROM r GROUP BY root)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)""",
    "op9_decontaminate": f"""
WITH d AS (SELECT doc_id, {_ALNUM.format("text")} AS ws FROM documents),
i AS (SELECT item_id, {_ALNUM.format("text")} AS ws FROM benchmark),
m AS (SELECT item_id, ws, least(13, len(ws)) AS k FROM i WHERE len(ws) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(ws[s:s + k - 1], ' ') AS x FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM m)),
q AS (SELECT DISTINCT k FROM g),
t AS (SELECT doc_id, k, s, array_to_string(ws[s:s + k - 1], ' ') AS x
      FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d JOIN q ON len(ws) >= k)),
o AS (SELECT doc_id, item_id, s, t.k FROM t JOIN g ON t.x = g.x AND t.k = g.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM o) GROUP BY doc_id),
u AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM o GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN u USING (doc_id)""",
    "op10_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS h FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to FROM t""",
    "op12_doubling": f"""
WITH w AS (SELECT doc_id, {_WORDS_AS_THEY_ARE.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w)),
d AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS place FROM p) WHERE place > 1),
g AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(s, s + 20)) AS i FROM d) GROUP BY doc_id),
u AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM u ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM g) USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)""",
    "op13_filteraudit": f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS_AS_THEY_ARE.format("t")} AS ws FROM d),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, CAST(len(ws) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT) + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS INT)
      + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
s AS (SELECT o AS filter_order, unnest(range(1, 6)) AS step FROM (SELECT unnest({["".join(p) for p in permutations("ABCDE")]}) AS o)),
b AS (SELECT *, 1 << (ascii(filter_order[step]) - 65) AS bit, coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0) AS gone FROM s),
x AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (gone | bit) = 0) AS kept, sum(n) FILTER (mask & gone = 0 AND mask & bit <> 0) AS removed, sum(n) FILTER (mask & gone <> 0 AND mask & bit <> 0) AS redundant,
      sum(n) FILTER (mask = bit) AS unique_fails, sum(good) FILTER (mask & gone = 0 AND mask & bit <> 0) AS good_lost, sum(toxic) FILTER (mask & gone = 0 AND mask & bit <> 0) AS toxic_lost FROM c CROSS JOIN b GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM x""",
}
