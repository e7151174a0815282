"""Upserts, surrogate keys, incremental state, streams and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.functions import text
from sparkloom.functions.text import epoch_ms
from sparkloom.operators import classify, features, graph, sentiment
from sparkloom.plans import jobs
from sparkloom.plans.cleaning import ORACLES as ORACLES_OF_CLEANING
from sparkloom.plans.common import Registry, table
from sparkloom.plans.features import ORACLES as ORACLES_OF_SENTIMENT
from sparkloom.plans.relations import _POSTS as POSTS_OF_EVENTS
from sparkloom.plans.relations import network
from sparkloom.plans.rows import ORACLES as ORACLES_OF_ROWS
from sparkloom.plans.rows import known_languages
from sparkloom.sources import sinks, tables
from sparkloom.sources.keyed import KeyedTable
from sparkloom.sources.workspace import folder, written
from sparkloom.streaming import ingest

QUERIES = Registry()
ORACLES = QUERIES.sql


@QUERIES.add("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer UNION ALL SELECT -s_suppkey - 1, 'supplier', s_nationkey FROM supplier")
def upsert_rows(spark, sf_dir):
    """Every third customer gets a cell, the others' null keeps the old one; suppliers are new rows."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    some = old.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "new").alias("c_mktsegment"), F.lit(None).cast("int").alias("c_nationkey"))
    fresh = table(spark, sf_dir, "supplier").select((-F.col("s_suppkey") - 1).alias("c_custkey"), F.lit("supplier").alias("c_mktsegment"), F.col("s_nationkey").alias("c_nationkey"))
    return sinks.upsert(old, some.unionByName(fresh), ["c_custkey"])


@QUERIES.add("""WITH e AS (SELECT user_id, event_type, value, epoch_us(ts) // 1000 AS t FROM events)
SELECT user_id, max(event_type) FILTER (t = lt) AS last_type, max(value) FILTER (event_type = 'purchase' AND t = lp) AS last_purchase, max(event_type) FILTER (t = lt) IS NOT NULL AS seen, lt AS last_type_at FROM
(SELECT *, max(t) OVER (PARTITION BY user_id) AS lt, max(CASE WHEN event_type = 'purchase' AND value IS NOT NULL THEN t END) OVER (PARTITION BY user_id) AS lp FROM e) GROUP BY user_id, lt""")
def table_upserts(spark, sf_dir):
    """What each user did last, kept as a keyed table by three upserts whose order is not that of the events, one of them repeated."""
    path = folder(spark, "keyed")
    users = KeyedTable.create(spark, path, "user_id bigint, last_type string, last_purchase double, seen boolean", "user_id", 16)
    events = table(spark, sf_dir, "events").withColumn("t", text.epoch_ms(F.col("ts")))
    rows = events.select("user_id", "t", F.col("event_type").alias("last_type"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"), F.lit(True).alias("seen"))
    for k in (2, 0, 1, 0):
        users.upsert(rows.where(F.pmod(F.col("t"), F.lit(3)) == k), F.col("t"), f"part{k}")
    users.vacuum()
    return users.read(times=True).select("user_id", "last_type", "last_purchase", "seen", "last_type_at")


@QUERIES.add("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation UNION ALL SELECT (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY r_name), r_name FROM region")
def dimension_surrogate_keys(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    new = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return sinks.with_keys(dim, new.unionByName(dim.select("name")), ["name"])


@QUERIES.add("SELECT n_name AS domain, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name")
def update_or_insert(spark, sf_dir):
    """Counts per nation over a table of zeros."""
    zeros = table(spark, sf_dir, "nation").select(F.col("n_name").alias("domain"), F.lit(0).cast("bigint").alias("n"))
    both = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return sinks.upsert(zeros, both.groupBy(F.col("n_name").alias("domain")).agg(F.count("*").alias("n")), ["domain"])


@QUERIES.add(f"WITH n AS ({POSTS_OF_EVENTS}) SELECT title, node, count(*) AS size FROM (SELECT title, unnest([u, r]) AS node FROM n) WHERE node IS NOT NULL GROUP BY 1, 2")
def incremental_equals_full(spark, sf_dir):
    """Node sizes by two runs over saved state: each reads the last version and writes the next."""
    path = f"{folder(spark, "tables")}/nodes"
    net = network(spark, sf_dir)
    for k in (0, 1):
        old = tables.state(spark, path, "title string, node string, size bigint")
        sinks.save_state(graph.merge_nodes(old, graph.nodes(net.where(F.col("event_id") % 2 == k), "title", "u", "r")), path)
    return tables.state(spark, path, "title string, node string, size bigint")


@QUERIES.add("SELECT event_id, user_id, event_type AS title, epoch_us(ts) // 1000 AS time_ms FROM events WHERE event_type <> 'view'")
def stream_ingest(spark, sf_dir):
    """events as a file stream, filtered, mapped and upserted by id in micro-batches."""
    path = folder(spark, "stream")
    events = table(spark, sf_dir, "events")
    events.repartition(3, "event_id").write.parquet(f"{path}/in")
    stream = ingest.source(spark, f"{path}/in", events.schema)
    columns = {"event_id": F.col("event_id"), "user_id": F.col("user_id"), "title": F.col("event_type"), "time_ms": epoch_ms(F.col("ts"))}
    ingest.upsert_stream(stream, columns, "event_id", f"{path}/out", f"{path}/checkpoint", F.col("event_type") != "view", order="time_ms").awaitTermination()
    return ingest.current(spark, f"{path}/out", StructType.fromDDL("event_id bigint, user_id bigint, title string, time_ms bigint"), "event_id").drop("_batch")


@QUERIES.add("SELECT label, count(*) AS n FROM (SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'junk' END AS label FROM labels) GROUP BY label")
def training_file_round_trip(spark, sf_dir):
    """Labels written as one tab-separated training file and read back."""
    path = f"{folder(spark, "tables")}/training"
    rows = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "good").otherwise("junk").alias("label"), F.col("doc_id").cast("string").alias("url"), F.lit("a,b").alias("terms"))
    sinks.single_file(rows, path)
    return tables.training_file(spark, path).groupBy("label").agg(F.count("*").alias("n"))


@QUERIES.add("SELECT lang AS title, count(*) AS n FROM documents GROUP BY lang")
def title_files_round_trip(spark, sf_dir):
    """A folder of files per title, read back."""
    path = f"{folder(spark, "tables")}/titles"
    sinks.files_by(table(spark, sf_dir, "documents").select(F.col("lang").alias("title"), "doc_id"), "title", path)
    return spark.read.option("sep", "\t").option("header", True).csv(path).groupBy("title").agg(F.count("*").alias("n"))


_WEIGHTS = "k(label, term, weight) AS (VALUES " + ", ".join(f"('{a}', '{b}', CAST({c} AS DOUBLE))" for a, b, c in jobs.EXAMPLE_WEIGHTS) + ")"
_LABELS = list(dict.fromkeys(w[0] for w in jobs.EXAMPLE_WEIGHTS))


@QUERIES.add(f"""WITH c AS ({ORACLES_OF_CLEANING["clean_text"]}), x AS (SELECT doc_id, unnest(string_split(terms, ',')) AS term FROM c), f AS (SELECT doc_id, term, count(*) AS tf FROM x WHERE term <> '' GROUP BY 1, 2),
idf AS (SELECT term, ln(((SELECT count(DISTINCT doc_id) FROM f) + 1.0) / (count(*) + 1.0)) AS idf FROM f GROUP BY term HAVING count(*) >= {jobs.CONFIG.min_doc_freq}), {_WEIGHTS},
m AS (SELECT doc_id, label, sum(tf * idf * weight) AS margin FROM f JOIN idf USING (term) JOIN k USING (term) GROUP BY 1, 2),
h AS (SELECT doc_id, string_agg(label, ',' ORDER BY list_position({_LABELS}, label)) AS l FROM m WHERE margin >= {jobs.CONFIG.margin} GROUP BY 1)
SELECT doc_id AS row_key, coalesce(l, 'none') AS classification, CASE WHEN l IS NOT NULL THEN '1' END AS classified, terms AS cleaned FROM documents JOIN c USING (doc_id) LEFT JOIN h USING (doc_id) WHERE text <> ''""")
def job_clean_and_classify(spark, sf_dir):
    """The cleaner and then the classifier job over one crawl table, which is written in between without the texts, as nothing reads them again."""
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    crawl = docs.select(F.col("doc_id").alias("row_key"), "text", F.lit(None).cast("string").alias("cleaned"), F.lit(None).cast("string").alias("classification"))
    clean, _ = written(jobs.cleaner(crawl).drop("text"), "crawl")
    weights = spark.createDataFrame(jobs.EXAMPLE_WEIGHTS, "label string, term string, weight double")
    idf = features.inverse_frequency(clean.where("cleaned is not null"), F.split("cleaned", ","), jobs.CONFIG.min_doc_freq)
    return jobs.classifier(clean, lambda rows: classify.by_weights(rows, "row_key", F.split("cleaned", ","), weights, idf, _LABELS, jobs.CONFIG.margin))


@QUERIES.add(ORACLES_OF_SENTIMENT["doc_sentiment"].replace("SELECT doc_id, round(pos, 6) AS pos, round(neg, 6) AS neg, CASE", "SELECT doc_id AS row_key, CASE"))
def job_sentiment(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_key"), "text", F.lit(None).cast("string").alias("sentiment"))
    lexicon = sentiment.prior(spark.createDataFrame(sentiment.LEXICON, "pos string, id string, pos_score double, neg_score double, terms string"))
    return jobs.sentiment_analyzer(rows, lexicon).drop("text")


@QUERIES.add("SELECT page_id, domain, n FROM (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS domain, CAST(length(html) AS BIGINT) AS n FROM pages WHERE html <> '')")
def job_html_content(spark, sf_dir):
    """Pages of a list of addresses, those with content."""
    pages = table(spark, sf_dir, "pages")
    out = jobs.html_content(pages.select("url"), pages)
    return out.select("page_id", text.domain(F.col("url")).alias("domain"), F.length("html").cast("bigint").alias("n"))


@QUERIES.add("WITH l AS (SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'junk' END AS label, doc_id FROM labels), d AS (SELECT label, detected, d.doc_id FROM l JOIN documents d USING (doc_id) JOIN (" + ORACLES_OF_ROWS["detect_language"] + ") USING (doc_id)) SELECT label, CAST(doc_id AS VARCHAR) AS url, terms FROM d JOIN (" + ORACLES_OF_CLEANING["clean_text"] + ") USING (doc_id) WHERE detected = 'en' AND terms <> ''")
def job_training_data(spark, sf_dir):
    """Training rows of labelled pages in the target language, cleaned, written as a training file and read back."""
    lines = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "good").otherwise("junk").alias("label"), F.col("doc_id").cast("string").alias("url"))
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), "text")
    path = folder(spark, "training")
    sinks.single_file(jobs.training_data(lines, pages, known_languages(spark, sf_dir), "en"), path)
    return tables.training_file(spark, path)


@QUERIES.add("SELECT page_id AS row_key, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS host FROM pages")
def job_set_domain(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("row_key"), "url", F.lit(None).cast("string").alias("host"))
    return jobs.set_domain(rows).select("row_key", "host")
