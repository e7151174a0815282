"""Whole jobs over the tables: state, streams and stored models included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.functions import text as T
from sparkloom.operators import counts, graph, replies
from sparkloom.plans import jobs
from sparkloom.plans.cleaning import sql_bucket
from sparkloom.plans.common import Registry, sql_terms, table
from sparkloom.plans.features import _TF, LEAST_ROWS, STEPS, _sql_train
from sparkloom.plans.relations import _POSTS, _TREE, network
from sparkloom.plans.rows import _DETECT, known_languages
from sparkloom.schema import Role
from sparkloom.session import EngineConfig
from sparkloom.sources import feed, sinks, tables
from sparkloom.sources.keyed import KeyedTable
from sparkloom.sources.workspace import folder, written
from sparkloom.streaming import ingest, stateful

QUERIES = Registry()
ORACLES = QUERIES.sql
CONFIG = jobs.CONFIG
NOW_MS = 1_800_000_000_000

#: Files of a batch where a run takes all that are there.
ALL_FILES = 1 << 30


def _cleaned(spark, sf_dir) -> DataFrame:
    """documents as a crawl table whose texts are cleaned; written, as the jobs read it several times."""
    return written(table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "lang", F.array_join(T.simple_terms(F.col("text")), ",").alias("cleaned")), "crawl")[0]


@QUERIES.add(_TF + f" SELECT {sql_bucket('term')} AS bucket, term FROM idf")
def job_feature_indices(spark, sf_dir):
    """Buckets of the terms that enough training rows have."""
    training = _cleaned(spark, sf_dir).select(F.col("lang").alias("label"), F.col("doc_id").cast("string").alias("url"), F.col("cleaned").alias("terms"))
    return jobs.feature_indices(training)


@QUERIES.add(_TF + " SELECT lang AS title, term, round(count(*) * any_value(idf), 6) AS value FROM x JOIN idf USING (term) WHERE lang IS NOT NULL GROUP BY 1, 2")
def job_term_cloud(spark, sf_dir):
    """The state after a run over all rows: title values of every known term."""
    rows = _cleaned(spark, sf_dir)
    path = folder(spark, "termcloud")
    crawl = rows.select(F.col("doc_id").cast("string").alias("row_key"), "cleaned", F.col("lang").alias("classification"), F.lit(None).cast("string").alias("termcloud_status"))
    training = rows.select(F.col("lang").alias("label"), F.col("doc_id").cast("string").alias("url"), F.col("cleaned").alias("terms"))
    jobs.term_cloud_builder(crawl, training, "classification", path)
    return tables.state(spark, f"{path}/state_classification", "title string, term string, value double").withColumn("value", F.round("value", 6))


@QUERIES.add(f"WITH n AS ({_POSTS}) SELECT title, node, count(*) AS size FROM (SELECT title, unnest([u, r]) AS node FROM n WHERE u IS NOT NULL) WHERE node IS NOT NULL GROUP BY 1, 2")
def job_network(spark, sf_dir):
    """Node sizes after a run, one that is repeated before its status is written, and one over the rows that came since."""
    path = folder(spark, "network")
    posts = network(spark, sf_dir).select(F.col("event_id").cast("string").alias("row_key"), "title", F.col("u").alias("user"), F.col("r").alias("reply_to"))
    late = F.pmod(F.xxhash64("row_key"), F.lit(2)) == 1
    for todo in (posts.where(~late), posts.where(~late), posts.where(late)):
        jobs.network_analyzer(todo.withColumn("network_status", F.lit(None).cast("string")), path)
    return tables.state(spark, f"{path}/nodes", "title string, node string, size bigint")


@QUERIES.add("WITH h AS (SELECT source, row_number() OVER (ORDER BY source) AS id FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)) SELECT CAST(id AS BIGINT) AS id, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in ("de", "en", "es", "fr")) + " FROM h JOIN documents USING (source) WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY id")
def job_counter(spark, sf_dir):
    """Counts per host and label for a dimension of hosts that gets its keys first."""
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL AND lang IN ('de', 'en', 'es', 'fr')")
    hosts = table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("domain"))
    dimension = sinks.with_keys(spark.createDataFrame([], "id bigint, domain string"), hosts, ["domain"])
    crawl = docs.select(F.col("source").alias("host"), F.col("lang").alias("classification"))
    return jobs.counter(crawl, dimension, "host", ["de", "en", "es", "fr"])


@QUERIES.add(f"""WITH h AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment <> 'BUILDING' AND (c_custkey % 3) * 1800000 >= {CONFIG.host_interval_ms})
SELECT o_orderkey AS row_key, o_custkey AS host_id, concat_ws('. ', o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) AS text, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END + epoch_us(o_orderdate) // 1000 AS time_ms FROM orders JOIN h ON id = o_custkey""")
def job_host_crawl(spark, sf_dir):
    """Posts of the hosts that are due and no users: orders of customers."""
    hosts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "user").otherwise("page").alias("type"), (F.lit(NOW_MS) - (F.col("c_custkey") % 3) * 1_800_000).alias("last_crawl_ms"))
    key, made = F.col("o_orderkey"), T.epoch_ms(F.col("o_orderdate"))
    none = F.lit(None).cast("string")
    posts = table(spark, sf_dir, "orders").select(key.alias("row_key"), F.col("o_custkey").alias("host_id"), F.col("o_orderpriority").alias("message"), F.when(key % 2 == 0, F.col("o_orderstatus")).otherwise("").alias("description"), none.alias("caption"), none.alias("story"), F.when(key % 4 != 0, made).alias("created_ms"), (made + 1).alias("updated_ms"))
    return jobs.host_crawl(hosts, posts, NOW_MS)


@QUERIES.add(_TREE + ", q AS (SELECT t.*, conv_id FROM t JOIN conversations c ON c.conv_id * 1000 + c.turn = t.base) SELECT child AS id, parent AS replyto_id, base AS base_id, depth, c.role AS user_id, r.role AS replyto_user_id, b.role AS base_user_id FROM q JOIN p c ON c.id = child JOIN p r ON r.id = parent JOIN p b ON b.id = base WHERE conv_id % 3 <> 0 AND (conv_id % 5 <> 0)")
def job_comment_threads(spark, sf_dir):
    """All replies below the first turns that are classified and due for a visit."""
    conv, turn = F.col("conv_id"), F.col("turn")
    rows = table(spark, sf_dir, "conversations")
    seen = F.when(conv % 5 == 0, F.lit(NOW_MS - 1))
    posts = rows.select((conv * 1000 + turn).alias("id"), F.when(turn > 0, conv * 1000 + turn - 1).alias("reply_to"), F.when(conv % 3 != 0, "x").alias("classified"), seen.cast("bigint").alias("comment_ms"), F.col("role").alias("user_id"))
    return jobs.comment_threads(posts, NOW_MS, attributes=("user_id",))[0]


@QUERIES.add(f"WITH {_DETECT} SELECT CAST(doc_id AS VARCHAR) AS row_key, CAST(n_chars AS BIGINT) AS time_ms, source AS user_id FROM ld JOIN documents USING (doc_id) WHERE detected = 'en' AND length(text) > 0")
def job_tweets(spark, sf_dir):
    """Documents as posts that arrive in files, those in one language kept by id."""
    path = folder(spark, "tweets")
    docs = table(spark, sf_dir, "documents")
    posts = docs.select(F.col("doc_id").cast("string").alias("row_key"), "text", F.col("n_chars").cast("long").alias("time_ms"), F.col("source").alias("user_id"), F.col("lang").alias("user_name"))
    files = posts.rdd.getNumPartitions()
    (posts if files > 1 else posts.repartition(2)).write.parquet(f"{path}/in")  # files grow in number, not in size
    jobs.tweets(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", known_languages(spark, sf_dir), "en", files_per_batch=(files + 1) // 2).awaitTermination()
    schema = StructType.fromDDL("row_key string, text string, time_ms bigint, user_id string, user_name string")
    return ingest.current(spark, f"{path}/out", schema, "row_key").select("row_key", "time_ms", "user_id")


@QUERIES.add(_sql_train() + f""", fa AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({sql_terms()}) AS term FROM documents) GROUP BY 1, 2),
s AS (SELECT doc_id, label, sum(tf * idf * weight) AS margin FROM fa JOIN idf USING (term) JOIN w{STEPS} USING (term) GROUP BY 1, 2), h AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM s WHERE margin >= 0 GROUP BY 1)
SELECT doc_id AS row_key, coalesce(l, 'none') AS classification, CASE WHEN l IS NOT NULL THEN '1' END AS classified FROM documents LEFT JOIN h USING (doc_id) WHERE text IS NOT NULL""")
def job_classifier(spark, sf_dir):
    """A model built from a training table and saved, then all documents classified by it."""
    rows = _cleaned(spark, sf_dir)
    path = folder(spark, "model")
    config = EngineConfig(min_doc_freq=LEAST_ROWS, svm_iterations=STEPS, margin=0.0)
    training = rows.join(table(spark, sf_dir, "labels"), "doc_id").select(F.when(F.col("quality") == 1, "Good").otherwise("Junk").alias("label"), F.col("doc_id").cast("string").alias("url"), F.col("cleaned").alias("terms"))
    names = jobs.classifier_builder(training, path, None, config)
    crawl = rows.select(F.col("doc_id").alias("row_key"), "cleaned", F.lit(None).cast("string").alias("classification"))
    return jobs.classifier_cells(crawl, jobs.by_models(spark, path, names, config), config)


@QUERIES.add(f"WITH n AS ({_POSTS}) SELECT e.event_id, n.u, n.r FROM n JOIN events e ON e.event_id = n.event_id JOIN events a ON a.event_id = e.event_id - CAST(e.props->>'$.k' AS BIGINT) WHERE a.event_type = 'click' AND a.event_id <> e.event_id AND e.ts >= TIMESTAMP '2024-01-05 00:00:00' AND n.u <> n.r")
def replies_since(spark, sf_dir):
    """Answers to clicks since a time, by others than those they answer."""
    events = table(spark, sf_dir, "events")
    back = F.get_json_object("props", "$.k").cast("bigint")
    posts = network(spark, sf_dir).join(events.select("event_id", "ts", F.when(back != 0, F.col("event_id") - back).alias("answers")), "event_id")
    return replies.replies(posts, "answers", events.where("event_type = 'click'"), "event_id", F.col("ts") >= F.to_timestamp(F.lit("2024-01-05 00:00:00")), F.col("u") != F.col("r")).select("event_id", "u", "r")


@QUERIES.add("SELECT source AS task, count(text) AS n_crawling, count(lang) AS n_cleaning, count(quality) AS n_classification FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def monitoring_upserts(spark, sf_dir):
    """Counts per user as rows of a keyed table: set to zero for all, then upserted as they are counted."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    board = KeyedTable.create(spark, folder(spark, "board"), "task string, n_crawling bigint, n_cleaning bigint, n_classification bigint", "task", 8)
    names = {"n_crawling": "text", "n_cleaning": "lang", "n_classification": "quality"}
    board.upsert(rows.select(F.col("source").alias("task"), *[F.lit(0).cast("bigint").alias(n) for n in names]), 1)
    board.upsert(counts.monitoring(rows, names, F.col("source").alias("task")), 2)
    board.vacuum()
    return board.read()


@QUERIES.add("SELECT source AS line, count(*) AS n FROM documents WHERE source <> '' GROUP BY source")
def text_lines_round_trip(spark, sf_dir):
    """Sources written as lines of text and read back."""
    path = folder(spark, "lines")
    table(spark, sf_dir, "documents").where("source <> ''").select("source").write.text(path)
    return tables.text_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@QUERIES.add("SELECT n_name AS word, count(s_suppkey) AS n FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def keyword_file(spark, sf_dir):
    """Words of a file of keywords, with the suppliers of the nations that they name."""
    path = folder(spark, "keywords")
    nations = table(spark, sf_dir, "nation")
    nations.select(F.concat_ws(",", "n_name", "n_name")).write.text(path)
    words = tables.word_table(spark, path).distinct()
    both = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return both.join(words, F.col("n_name") == F.col("word")).groupBy("word").agg(F.count("*").alias("n"))


@QUERIES.add("SELECT page_id AS row_key, url AS address, length(html) AS size FROM pages")
def role_columns(spark, sf_dir):
    """Physical columns of a source type under a job's logical names."""
    pages = table(spark, sf_dir, "pages").withColumn("size:n", F.length("html").cast("bigint"))
    return Role("website", {"row_key": "page_id", "address": "url", "size": "size:n"}).rename(pages)


@QUERIES.add(f"WITH n AS ({_POSTS}) SELECT title, node, count(*) AS size FROM (SELECT title, unnest([u, r]) AS node FROM n) WHERE node IS NOT NULL GROUP BY 1, 2")
def stream_node_sizes(spark, sf_dir):
    """Node sizes that a stream of posts keeps itself, stopped and started again on its checkpoint."""
    path = folder(spark, "nodes")
    posts = network(spark, sf_dir)
    table_of = KeyedTable.create(spark, f"{path}/table", "id struct<title:string,node:string>, size bigint", "id", 8)
    late = F.pmod(F.col("event_id"), F.lit(3)) == 0
    for part in (posts.where(~late), posts.where(late)):  # a run takes all files of its part at once
        part.write.mode("append").parquet(f"{path}/in")
        sizes = graph.nodes(ingest.source(spark, f"{path}/in", posts.schema, ALL_FILES), "title", "u", "r").select(F.struct("title", "node").alias("id"), "size")
        stateful.keep_aggregate(sizes, table_of, f"{path}/checkpoint").awaitTermination()
    table_of.vacuum()
    return table_of.read().select("id.title", "id.node", "size")


@QUERIES.add(f"WITH t AS (SELECT CAST(user_id AS VARCHAR) AS key, max(epoch_us(ts) // 1000) AS last_ms FROM events GROUP BY user_id) SELECT key, last_ms, last_ms + {CONFIG.host_interval_ms} AS due_ms FROM t WHERE last_ms + {CONFIG.host_interval_ms} <= (SELECT max(last_ms) FROM t)")
def stream_due_users(spark, sf_dir):
    """Users that a stream of events finds due for a visit: those who rest since their last event when it ends."""
    path = folder(spark, "due")
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    low, high = events.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    third = F.floor((F.unix_millis("ts") - low) * 3 / (high - low + 1))
    for k in range(3):  # in the order of their time, as a feed brings them
        events.where(third == k).write.mode("append").parquet(f"{path}/in")
        stateful.start_due(ingest.source(spark, f"{path}/in", events.schema, ALL_FILES), "user_id", "ts", CONFIG.host_interval_ms, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    last = events.groupBy(F.col("user_id").cast("string").alias("key")).agg(F.max(F.unix_millis("ts")).alias("last_ms"))
    return spark.read.schema(stateful.DUE).parquet(f"{path}/out").join(last, ["key", "last_ms"], "left_semi")


@QUERIES.add("SELECT event_id, user_id, event_type, value FROM events")
def feed_ingest(spark, sf_dir):
    """events as a paged feed that is followed in two runs, into a keyed table."""
    path = folder(spark, "feed")
    feed.register(spark)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    target = KeyedTable.create(spark, f"{path}/table", events.schema, "event_id", 8)
    late = F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0
    for k, part in enumerate((events.where(~late), events.where(late))):
        sinks.named_files(part, f"{path}/in", f"run{k}")
        rows = spark.readStream.format(feed.NAME).schema(events.schema).option("path", f"{path}/in").option("page", "500").load()
        stateful.keep_rows(rows, target, f"{path}/checkpoint").awaitTermination()
    target.vacuum()
    return target.read()


@QUERIES.add("SELECT CAST(least(count(*), (5000 + 499) // 500 * 500) AS BIGINT) AS n FROM events")
def feed_search(spark, sf_dir):
    """Rows of a paged search: whole pages of 500 until 5000 are there."""
    path = folder(spark, "search")
    feed.register(spark)
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    sinks.named_files(events.coalesce(1), path, "all")
    found = spark.read.format(feed.NAME).schema(events.schema).option("path", path).option("page", "500").option("limit", "5000").load()
    return found.agg(F.count("*").alias("n"))
