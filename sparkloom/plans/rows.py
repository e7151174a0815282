"""Scans, predicates, projections and counts over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import language, text
from sparkloom.operators import counts, filters
from sparkloom.plans.common import Registry, table
from sparkloom.session import EngineConfig
from sparkloom.sources import sinks, tables

QUERIES = Registry()
ORACLES = QUERIES.sql
CONFIG = EngineConfig()
NOW_MS = 1_704_067_200_000 + 20 * 86_400_000

_CRAWL = "WITH c AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)) "


def crawl(spark, sf_dir) -> DataFrame:
    """documents with their labels as later-stage columns."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@QUERIES.add(_CRAWL + "SELECT doc_id, n_chars FROM c WHERE n_chars IS NOT NULL AND quality IS NULL")
def scan_unprocessed(spark, sf_dir):
    return tables.unprocessed(crawl(spark, sf_dir), "doc_id", "n_chars", "quality")


@QUERIES.add(_CRAWL + "SELECT doc_id, source, lang, quality FROM c WHERE quality IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
def scan_multi_column(spark, sf_dir):
    return tables.scan(crawl(spark, sf_dir), ["quality"], [], ["doc_id", "source", "lang", "quality"])


@QUERIES.add(_CRAWL + "SELECT doc_id, '1' AS termcloud_status FROM c WHERE quality IS NOT NULL")
def status_mark(spark, sf_dir):
    return sinks.mark(tables.scan(crawl(spark, sf_dir), ["quality"]), "doc_id", "termcloud_status")


@QUERIES.add("SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS domain FROM pages WHERE regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) <> ''")
def domain_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.domain(F.col("url")).alias("domain")).where("domain is not null")


@QUERIES.add(f"SELECT event_id, epoch_us(ts) // 1000 AS time_ms FROM events WHERE {NOW_MS} - epoch_us(ts) // 1000 >= {CONFIG.post_interval_ms}")
def interval_due(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", text.epoch_ms(F.col("ts")).alias("time_ms"))
    return filters.due(rows, "time_ms", NOW_MS, CONFIG.post_interval_ms)


@QUERIES.add("SELECT event_id, p[1] AS date, p[2] AS clock FROM (SELECT event_id, string_split(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ') AS p FROM events) WHERE len(p) >= 2")
def min_fields(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("line"))
    return tables.split_lines(lines, "line", " ", ["date", "clock"]).select("event_id", "date", "clock")


@QUERIES.add("SELECT page_id, concat_ws('. ', nullif(url, ''), nullif(CASE WHEN page_id % 3 = 0 THEN '' ELSE CAST(page_id AS VARCHAR) END, '')) AS message FROM pages")
def coalesce_text(spark, sf_dir):
    maybe = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", filters.join_text([F.col("url"), maybe]).alias("message"))


@QUERIES.add("SELECT source, avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) AS share, count(*) AS n_posts FROM documents GROUP BY source HAVING avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) >= 0.5")
def majority_language_sources(spark, sf_dir):
    return filters.majority(table(spark, sf_dir, "documents"), "source", F.col("lang") == "en", CONFIG.majority)


@QUERIES.add("SELECT doc_id, lang AS classification, CASE WHEN lang <> 'en' THEN '1' END AS classified FROM documents")
def conditional_flag(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("classification"))
    return filters.flag_classified(rows, none="en")


@QUERIES.add("SELECT conv_id, turn, role FROM conversations WHERE role <> 'user'")
def not_user_hosts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("role <> 'user'").select("conv_id", "turn", "role")


@QUERIES.add("SELECT doc_id, source FROM documents WHERE contains(lower(text), 'license') ORDER BY doc_id LIMIT 5000")
def keyword_search(spark, sf_dir):
    return filters.search(table(spark, sf_dir, "documents"), "text", "license", CONFIG.search_limit, ["doc_id"]).select("doc_id", "source")


@QUERIES.add("SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-09 12:00:00'")
def time_range_feed(spark, sf_dir):
    day = lambda s: F.to_timestamp(F.lit(s))
    return filters.feed(table(spark, sf_dir, "events"), "ts", day("2024-01-05 00:00:00"), day("2024-01-09 12:00:00")).select("event_id", "user_id", "event_type")


@QUERIES.add("SELECT doc_id, length(text) AS n FROM documents WHERE coalesce(length(text), 0) > 0")
def non_empty_text(spark, sf_dir):
    return filters.non_empty(table(spark, sf_dir, "documents"), "text").select("doc_id", F.length("text").cast("bigint").alias("n"))


_GRAMS = r"regexp_extract_all('_' || regexp_replace(lower(text), '[^\p{L}]+', '_', 'g') || '_', '(?s).')"
#: Profiles of all languages, ranks of every text, and the nearest language.
_DETECT = f"""lc AS (SELECT doc_id, lang, {_GRAMS} AS c FROM documents WHERE text IS NOT NULL),
lg AS (SELECT doc_id, lang, unnest(list_transform(list_filter(range(1, len(c) - 1), lambda i: c[i + 1] <> '_'), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM lc),
lk AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS known_rank FROM lg WHERE lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY lang, gram QUALIFY known_rank <= {language.RANKS}),
lr AS (SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, gram) AS place FROM lg GROUP BY doc_id, gram QUALIFY place <= {language.RANKS}),
ls AS (SELECT doc_id, lk.lang, sum({language.RANKS} - abs(place - known_rank)) AS agreed FROM lr JOIN lk USING (gram) GROUP BY doc_id, lk.lang),
ln AS (SELECT doc_id, max(place) AS n FROM lr GROUP BY doc_id),
lb AS (SELECT doc_id, lang, agreed FROM ls QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY agreed DESC, lang) = 1),
ld AS (SELECT d.doc_id, CASE WHEN agreed >= {language.LEAST * language.RANKS!r} * n THEN lb.lang END AS detected FROM documents d LEFT JOIN lb ON d.doc_id = lb.doc_id LEFT JOIN ln ON d.doc_id = ln.doc_id)"""


def known_languages(spark, sf_dir) -> DataFrame:
    """Profiles of the languages of the documents that are labelled as good."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    return language.train(table(spark, sf_dir, "documents").join(good, "doc_id", "left_semi").select("lang", "text"))


@QUERIES.add(f"WITH {_DETECT} SELECT doc_id, detected FROM ld")
def detect_language(spark, sf_dir):
    return language.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text", known_languages(spark, sf_dir))


@QUERIES.add(f"WITH lc AS (SELECT lang, {_GRAMS} AS c FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL), lg AS (SELECT lang, unnest(list_transform(list_filter(range(1, len(c) - 1), lambda i: c[i + 1] <> '_'), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM lc) SELECT lang, gram, CAST(row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS INTEGER) AS rank FROM lg GROUP BY lang, gram QUALIFY rank <= {language.RANKS}")
def language_profiles(spark, sf_dir):
    return language.profiles(table(spark, sf_dir, "documents"))


@QUERIES.add(f"WITH {_DETECT} SELECT doc_id FROM ld WHERE detected = 'en'")
def language_filter(spark, sf_dir):
    return language.of_language(table(spark, sf_dir, "documents"), ["doc_id"], "text", known_languages(spark, sf_dir), "en").select("doc_id")


@QUERIES.add("SELECT c_mktsegment AS privacy, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1")
def open_groups(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").groupBy(F.col("c_mktsegment").alias("privacy")).agg(F.count("*").alias("n"))


@QUERIES.add(_CRAWL + "SELECT count(text) AS n_crawling, count(lang) AS n_cleaning, count(quality) AS n_classification, count(CASE WHEN toxic = 1 THEN 1 END) AS n_analysis FROM c")
def monitoring_counts(spark, sf_dir):
    rows = crawl(spark, sf_dir).select("text", "lang", "quality", F.when(F.col("toxic") == 1, 1).alias("analysed"))
    return counts.monitoring(rows, {"n_crawling": "text", "n_cleaning": "lang", "n_classification": "quality", "n_analysis": "analysed"})


_LABELS = "SELECT d.source, concat_ws(',', d.lang, CASE WHEN l.toxic = 1 THEN 'toxic' END, CASE WHEN l.quality = 1 THEN 'good' END) AS labels FROM documents d JOIN labels l USING (doc_id)"
_COUNTS = f"WITH x AS ({_LABELS}), c AS (SELECT source AS host, unnest(string_split(labels, ',')) AS label FROM x), n AS (SELECT host, label, count(*) AS n FROM c GROUP BY 1, 2) "


def labelled(spark, sf_dir) -> DataFrame:
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return both.select("source", F.concat_ws(",", "lang", F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 1, "good")).alias("labels"))


@QUERIES.add(_COUNTS + "SELECT * FROM n")
def host_label_counts(spark, sf_dir):
    return counts.label_counts(labelled(spark, sf_dir), "source", "labels")


_PIVOT = ["en", "fr", "de", "es", "toxic", "good"]


@QUERIES.add(_COUNTS + "SELECT host, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (label = '{x}'), 0) AS BIGINT) AS {x}" for x in _PIVOT) + " FROM n GROUP BY host")
def host_label_pivot(spark, sf_dir):
    return counts.label_pivot(counts.label_counts(labelled(spark, sf_dir), "source", "labels"), _PIVOT)


@QUERIES.add("WITH r AS (SELECT source AS host, lang || ',all' AS labels, CASE WHEN quality > toxic THEN 'positif' WHEN quality < toxic THEN 'negatif' ELSE 'netral' END AS s FROM documents JOIN labels USING (doc_id)), e AS (SELECT host, unnest(string_split(labels, ',')) AS label, s FROM r) SELECT host, label, count(*) FILTER (s = 'positif') AS positif, count(*) FILTER (s = 'negatif') AS negatif, count(*) FILTER (s = 'netral') AS netral FROM e GROUP BY host, label")
def label_sentiment_counts(spark, sf_dir):
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    mood = F.when(F.col("quality") > F.col("toxic"), "positif").when(F.col("quality") < F.col("toxic"), "negatif").otherwise("netral")
    return counts.sentiment_counts(both.select("source", F.concat("lang", F.lit(",all")).alias("labels"), mood.alias("s")), "source", "labels", "s", ["positif", "negatif", "netral"])


#: Search keywords written for this engine.
KEYWORDS = ("source_1", "e_0", "7")
_SEARCH = f"""WITH hosts AS (SELECT source AS id, CASE min(doc_id) % 3 WHEN 0 THEN 'group' WHEN 1 THEN 'page' ELSE 'user' END AS type, source AS name, CASE min(doc_id) % 2 WHEN 0 THEN 'OPEN' ELSE 'CLOSED' END AS privacy FROM documents GROUP BY source),
posts AS (SELECT doc_id, source AS host_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS place FROM documents),
{_DETECT},
m AS (SELECT host_id FROM posts JOIN ld USING (doc_id) WHERE place <= 10 GROUP BY host_id HAVING avg(CASE WHEN detected = 'en' THEN 1.0 ELSE 0.0 END) >= 0.5),
k(keyword) AS (VALUES {", ".join(f"('{k}')" for k in KEYWORDS)}),
f AS (SELECT keyword, hosts.*, row_number() OVER (PARTITION BY keyword, type ORDER BY id) AS place FROM k JOIN hosts ON contains(lower(name), keyword))
SELECT DISTINCT id, type, name, {NOW_MS} AS crawltime FROM f JOIN m ON host_id = id WHERE place <= 5000 AND (type <> 'group' OR privacy = 'OPEN')"""


@QUERIES.add(_SEARCH)
def host_search(spark, sf_dir):
    """Keyword search over hosts, open groups only, with most of the last ten posts in the target language."""
    docs = table(spark, sf_dir, "documents")
    first = F.min("doc_id")
    kind = F.when(first % 3 == 0, "group").when(first % 3 == 1, "page").otherwise("user")
    hosts = docs.groupBy(F.col("source").alias("id")).agg(kind.alias("type"), F.when(first % 2 == 0, "OPEN").otherwise("CLOSED").alias("privacy")).withColumn("name", F.col("id"))
    posts = docs.select(F.col("source").alias("host_id"), F.col("doc_id").alias("time"), F.col("text").alias("message"), *[F.lit(None).cast("string").alias(c) for c in ("caption", "description", "name", "story")])
    return filters.search_hosts(hosts, posts, list(KEYWORDS), known_languages(spark, sf_dir), "en", CONFIG.search_limit, NOW_MS)


@QUERIES.add("SELECT source AS host, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS place FROM documents) WHERE place <= 10")
def latest_per_host(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("host"), "doc_id")
    return filters.latest(rows, ["host"], "doc_id", 10)
