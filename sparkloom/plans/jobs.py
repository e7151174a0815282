"""The engine's jobs: each reads unprocessed rows, derives cells and upserts them."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkloom.functions import language, text
from sparkloom.operators import classify, counts, dictionary, features, filters, graph, html_comments, replies, sentiment, tagger
from sparkloom.session import EngineConfig, session
from sparkloom.sources import sinks, tables
from sparkloom.sources.keyed import KeyedTable
from sparkloom.sources.workspace import written
from sparkloom.streaming import ingest

CONFIG = EngineConfig()
EXAMPLE_WEIGHTS = (("function", "the", 0.4), ("function", "of", 0.4), ("function", "and", 0.4), ("romance", "de", 0.6), ("romance", "que", 0.6), ("german", "und", 1.1))


def cleaner_cells(crawl: DataFrame, lists: dictionary.Lists | None = None) -> DataFrame:
    """(row_key, cleaned) of rows that have a text and no terms yet, by the engine's word lists or the given ones."""
    todo = filters.non_empty(tables.unprocessed(crawl, "row_key", "text", "cleaned"), "text")
    return dictionary.clean_terms(todo, ["row_key"], "text", lists).withColumnRenamed("terms", "cleaned")


def cleaner(crawl: DataFrame, lists: dictionary.Lists | None = None) -> DataFrame:
    """Cleaned terms for rows that have a text and none yet."""
    return sinks.upsert(crawl, cleaner_cells(crawl, lists), ["row_key"])


def classifier_cells(crawl: DataFrame, classify_rows: Callable[[DataFrame], DataFrame], config: EngineConfig = CONFIG) -> DataFrame:
    """(row_key, classification, classified) of cleaned rows without a label; ``none`` gets no flag.

    ``classify_rows`` gives (row_key, classification) for rows with ``cleaned``:
    by term weights (``classify.by_weights``) or stored models (``by_models``).
    """
    todo = tables.unprocessed(crawl, "row_key", "cleaned", "classification")
    return filters.flag_classified(classify_rows(todo).select("row_key", "classification"), none=config.none_label)


def classifier(crawl: DataFrame, classify_rows: Callable[[DataFrame], DataFrame], config: EngineConfig = CONFIG) -> DataFrame:
    """Labels for cleaned rows without one."""
    return sinks.upsert(crawl, classifier_cells(crawl, classify_rows, config), ["row_key"])


def by_models(spark: SparkSession, path: str, labels: list[str], config: EngineConfig = CONFIG) -> Callable[[DataFrame], DataFrame]:
    """Classify by the model that ``classifier_builder`` saved."""
    model = classify.Model.load(spark, path, labels)
    terms = F.filter(F.split("cleaned", ","), lambda w: w != "")
    return lambda rows: classify.by_weights(rows, "row_key", terms, model.weights, model.idf, labels, config.margin, config.none_label)


def classifier_builder(training: DataFrame, path: str, labels: list[str] | None = None, config: EngineConfig = CONFIG) -> list[str]:
    """Train all labels of (label, url, terms) rows at once and save the model; the labels.

    Rows are written once with a number each, as their urls may repeat.
    """
    named = training.where("terms is not null AND label is not null").select(F.monotonically_increasing_id().alias("key"), F.lower("label").alias("label"), F.filter(F.split("terms", ","), lambda w: w != "").alias("terms"))
    rows, _ = written(named, "training")
    names = labels or [r.label for r in rows.select("label").distinct().orderBy("label").collect()]
    classify.build(rows, "key", F.col("terms"), "label", names, config.min_doc_freq, config.svm_iterations).save(path)
    return names


def feature_indices(training: DataFrame, config: EngineConfig = CONFIG) -> DataFrame:
    """(bucket, term) of the terms in enough training rows."""
    return features.document_frequency(training, F.split("terms", ","), config.min_doc_freq).select(text.java_bucket(F.col("term")).alias("bucket"), "term")


def sentiment_cells(rows: DataFrame, lexicon: DataFrame, negation: str | None = None, model: tagger.Tagger | None = None) -> DataFrame:
    """(row_key, sentiment) of rows that have a text and none yet, by a lexicon of (term, pos, score); tags are the model's, else the dictionary's."""
    todo = tables.unprocessed(rows, "row_key", "text", "sentiment")
    if model is None:
        done = sentiment.detect_text(todo, "row_key", "text", dictionary.tag_table(rows.sparkSession), lexicon, negation)
    else:
        tagged = todo.join(tagger.tag_texts(todo, "row_key", "text", model), "row_key", "left")
        done = sentiment.detect(tagged, "row_key", F.col("tagged"), lexicon, negation)
    return done.select("row_key", "sentiment")


def sentiment_analyzer(rows: DataFrame, lexicon: DataFrame, negation: str | None = None, model: tagger.Tagger | None = None) -> DataFrame:
    """Sentiment of rows that have a text and none yet."""
    return sinks.upsert(rows, sentiment_cells(rows, lexicon, negation, model), ["row_key"])


def domain_cells(rows: DataFrame) -> DataFrame:
    """(row_key, host) of rows with a URL and no host yet."""
    todo = tables.unprocessed(rows, "row_key", "url", "host")
    return todo.select("row_key", text.domain(F.col("url")).alias("host")).where("host is not null")


def set_domain(rows: DataFrame) -> DataFrame:
    return sinks.upsert(rows, domain_cells(rows), ["row_key"])


def term_cloud_builder(crawl: DataFrame, training: DataFrame, title: str, folder: str, config: EngineConfig = CONFIG) -> DataFrame:
    """Term cloud per title over unprocessed rows added to the saved state; writes state and files."""
    spark = crawl.sparkSession
    old = tables.state(spark, f"{folder}/state_{title}", "title string, term string, value double")
    todo = tables.scan(crawl, ["cleaned", title], ["termcloud_status"])
    idf = features.inverse_frequency(training, F.split("terms", ","), config.min_doc_freq)
    rows = todo.select(F.explode(F.split(title, ",")).alias("title"), "cleaned")
    total = features.term_cloud(features.term_frequency(features.term_rows(rows, "title", F.split("cleaned", ",")), "title"), "title", idf, config.top_terms, old)[1]
    path = sinks.save_state(total, f"{folder}/state_{title}")
    cloud = features.top(spark.read.schema(total.schema).parquet(path), "title", config.top_terms)
    sinks.files_by(cloud.select("title", "term", "value"), "title", f"{folder}/cloud_{title}")
    return sinks.mark(todo, "row_key", "termcloud_status")


def network_analyzer(comments: DataFrame, folder: str) -> DataFrame:
    """Nodes and edges of unprocessed comments added to the saved state; writes state and files.

    The state is written under a run, named by the rows it takes: a run that is
    repeated before the status is written starts from the state before it.
    """
    spark = comments.sparkSession
    todo = tables.scan(comments, ["user"], ["network_status"])
    seen = todo.agg(F.count("*").alias("n"), F.sum(F.xxhash64("row_key").cast("decimal(38,0)")).alias("h")).first()
    run = f"{seen.n:x}-{int(seen.h or 0) & (2**64 - 1):016x}"
    old = lambda name, schema: tables.state(spark, f"{folder}/{name}", schema, run)
    nodes = graph.merge_nodes(old("nodes", "title string, node string, size bigint"), graph.nodes(todo, "title", "user", "reply_to"))
    edges = graph.merge_edges(old("edges", "title string, node1 string, node2 string"), graph.edges(todo, "title", "user", "reply_to"))
    for name, df, order in (("nodes", nodes, ["node"]), ("edges", edges, ["node1", "node2"])):
        path = sinks.save_state(df, f"{folder}/{name}", run)
        sinks.files_by(graph.numbered(spark.read.parquet(path), order), "title", f"{folder}/{name}_files")
    return sinks.mark(todo, "row_key", "network_status")


def counter(crawl: DataFrame, host_dim: DataFrame, host: str, labels: list[str]) -> DataFrame:
    """A row per known host with a count per label; replaces earlier counts when upserted by id."""
    table = counts.label_pivot(counts.label_counts(crawl.where("classification is not null"), host, "classification"), labels)
    return host_dim.join(table, host_dim.domain == table.host).drop("host", "domain")


def comment_wrapper(pages: DataFrame, comments: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(comment table, page status): comments of classified pages not looked at yet, with the page's url, domain and classification."""
    todo = tables.scan(pages, ["classified", "html", "url", "host", "classification"], ["comment_status"])
    found = html_comments.extract(todo, "row_key", "html")
    context = todo.select(F.col("row_key").cast("string").alias("page"), "url", F.col("host").alias("domain"), "classification")
    new = found.join(context, "page").drop("page")
    return (new if comments is None else sinks.upsert(comments, new, ["row_key"])), sinks.mark(todo, "row_key", "comment_status")


def comment_threads(posts: DataFrame, now_ms: int, comments: DataFrame | None = None, config: EngineConfig = CONFIG, attributes: tuple[str, ...] = ("user_id", "user_name", "text", "time_ms")) -> tuple[DataFrame, DataFrame]:
    """(comment table, post status): all replies below the classified posts due for a visit, with depth and the users of parent and root.

    ``posts`` has id, reply_to (an id, null for a post), classified, comment_ms
    (time of the last visit, null for none) and ``attributes``.
    """
    roots = posts.where("reply_to is null and classified is not null")
    due = filters.due(roots.withColumn("_last", F.coalesce("comment_ms", F.lit(0).cast("bigint"))), "_last", now_ms, config.post_interval_ms).select(F.col("id").alias("base"))
    rows = replies.tree(posts, "id", "reply_to").join(due, "base", "left_semi")
    full = replies.with_base(rows, posts.select("id", *attributes), "id", list(attributes))
    named = {"child": "", "parent": "replyto_", "base": "base_"}
    cells = [F.col(f"{side}_{a}").alias(f"{prefix}{a}") for side, prefix in named.items() for a in attributes if side == "child" or a.startswith("user")]
    new = full.select(F.col("child").alias("id"), F.col("parent").alias("replyto_id"), F.col("base").alias("base_id"), "depth", *cells)
    return (new if comments is None else sinks.upsert(comments, new, ["id"])), due.select(F.col("base").alias("id"), F.lit(now_ms).cast("bigint").alias("comment_ms"))


def html_content(addresses: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages of a list of addresses that have content; each once."""
    wanted = addresses.where("url <> ''").select("url").distinct()
    return pages.where("html <> ''").join(wanted, "url", "left_semi")


def host_crawl(hosts: DataFrame, posts: DataFrame, now_ms: int, config: EngineConfig = CONFIG) -> DataFrame:
    """Posts of due hosts that are no users."""
    todo = filters.due(hosts.where("type <> 'user'"), "last_crawl_ms", now_ms, config.host_interval_ms)
    body = filters.join_text([F.col(c) for c in ("message", "description", "caption", "story")])
    return posts.join(todo.select(F.col("id").alias("host_id")), "host_id").select("row_key", "host_id", body.alias("text"), F.coalesce("created_ms", "updated_ms").alias("time_ms"))


def training_data(lines: DataFrame, pages: DataFrame, known: DataFrame, target: str, lists: dictionary.Lists | None = None) -> DataFrame:
    """label, url, terms of training urls whose page is in the target language by the ``known`` profiles; a url has one page."""
    wanted = pages.where(F.length("text") > 0).join(lines.select("url").distinct(), "url", "left_semi")
    terms = dictionary.clean_terms(language.of_language(wanted, ["url"], "text", known, target), ["url"], "text", lists)
    return lines.join(terms, "url").select("label", "url", "terms")


def upload(spark: SparkSession, resource: str) -> DataFrame:
    """(label, url, terms) of an uploaded training list; lines with fewer than three fields are dropped."""
    return tables.split_lines(tables.text_lines(spark, resource), "value", "\t", ["label", "url", "terms"]).select("label", "url", "terms")


def tweets(spark: SparkSession, source: str, target: str, checkpoint: str, known: DataFrame, language_: str = "id", interval: str | None = None, files_per_batch: int = 1) -> StreamingQuery:
    """Posts of a folder in the target language by the ``known`` profiles, upserted by id as they arrive, ``files_per_batch`` files at once."""
    schema = "row_key string, text string, time_ms long, user_id string, user_name string"
    stream = ingest.source(spark, source, schema, files_per_batch)
    names = ("row_key", "text", "time_ms", "user_id", "user_name")
    keep = lambda batch: language.of_language(batch.where("row_key IS NOT NULL"), ["row_key", "time_ms"], "text", known, language_)
    return ingest.upsert_stream(stream, {n: F.col(n) for n in names}, "row_key", target, checkpoint, F.length("text") > 0, interval, "time_ms", keep=keep)


def _now() -> int:
    return int(time.time() * 1000)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return KeyedTable.open(spark, path).read() if KeyedTable.exists(spark, path) else spark.read.parquet(path)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _cells(spark: SparkSession, a, derive: Callable[[DataFrame], DataFrame]) -> None:
    """Derived cells into the keyed table that is the output, else the whole table with them to another folder."""
    rows = _read(spark, a.input)
    if KeyedTable.exists(spark, a.output):
        KeyedTable.open(spark, a.output).upsert(derive(rows), _now())
    else:
        _write(sinks.upsert(rows, derive(rows), ["row_key"]), a.output)


def _upsert_file(spark: SparkSession, result: tuple[DataFrame, DataFrame], output: str, status: str) -> None:
    _write(result[0], output)
    _write(result[1], status)


#: Options of the commands that clean words: files of word lists, of any size.
LISTS: dict[str, str | None] = {"acronyms": None, "slang": None, "stop": None, "keep": None, "roots": None, "formal": None}


def _lists(spark: SparkSession, a) -> dictionary.Lists:
    read = {"acronyms": tables.map_table, "slang": tables.map_table, "stop": tables.word_table, "keep": tables.word_table, "roots": tables.word_table, "formal": lambda s, path: tables.map_table(s, path).select("word", F.col("to").try_cast("bigint").alias("n")).where("n IS NOT NULL")}
    return dictionary.Lists.own(spark, **{k: f(spark, getattr(a, k)) for k, f in read.items() if getattr(a, k)})


def _facebook(spark, a) -> None:
    if a.keywords:
        found = filters.search_hosts(_read(spark, a.hosts), _read(spark, a.posts), tables.word_list(spark, a.keywords), _read(spark, a.profiles), a.language, CONFIG.search_limit, _now())
        _write(found, a.output)
    else:
        _write(host_crawl(_read(spark, a.hosts), _read(spark, a.posts), _now()), a.output)


def _training(spark, a) -> None:
    if a.mode == "upload":
        sinks.single_file(upload(spark, a.source), a.output)
    else:
        lines = tables.split_lines(tables.text_lines(spark, a.source), "value", "\t", ["label", "url"]).select("label", "url")
        sinks.single_file(training_data(lines, _read(spark, a.pages), _read(spark, a.profiles), a.language, _lists(spark, a)), a.output)


def _lexicon(spark, a) -> DataFrame:
    return sentiment.prior(tables.lexicon_file(spark, a.lexicon))


#: Command -> (arguments, options with defaults, what it does).
COMMANDS: dict[str, tuple[tuple[str, ...], dict[str, str | None], Callable]] = {
    "languageprofiles": (("input", "output"), {}, lambda s, a: _write(language.profiles(_read(s, a.input)), a.output)),
    "cleaner": (("input", "output"), LISTS, lambda s, a: _cells(s, a, lambda rows: cleaner_cells(rows, _lists(s, a)))),
    "trainingdatabuilder": (("mode", "source", "output"), {"pages": None, "profiles": None, "language": "id"} | LISTS, _training),
    "classifierbuilder": (("training", "model"), {"labels": None}, lambda s, a: print(",".join(classifier_builder(tables.training_file(s, a.training), a.model, a.labels and a.labels.split(","))))),
    "classifier": (("input", "model", "labels", "output"), {}, lambda s, a: _cells(s, a, lambda rows: classifier_cells(rows, by_models(s, a.model, a.labels.split(","))))),
    "featureindicescreator": (("training", "output"), {}, lambda s, a: _write(feature_indices(tables.training_file(s, a.training)), a.output)),
    "twittercrawler": (("source", "target", "checkpoint", "profiles"), {"language": "id", "interval": None}, lambda s, a: tweets(s, a.source, a.target, a.checkpoint, _read(s, a.profiles), a.language, a.interval).awaitTermination()),
    "facebookcrawler": (("hosts", "posts", "output"), {"keywords": None, "profiles": None, "language": "id"}, _facebook),
    "taggerbuilder": (("tagged", "model"), {}, lambda s, a: tagger.train(_read(s, a.tagged), ["sentence"]).save(a.model)),
    "sentimentanalyzer": (("input", "lexicon", "output"), {"negation": None, "tagger": None}, lambda s, a: _cells(s, a, lambda rows: sentiment_cells(rows, _lexicon(s, a), a.negation, tagger.Tagger.load(s, a.tagger) if a.tagger else None))),
    "setdomain": (("input", "output"), {}, lambda s, a: _cells(s, a, domain_cells)),
    "htmlcontent": (("addresses", "pages", "output"), {}, lambda s, a: _write(html_content(tables.text_lines(s, a.addresses).withColumnRenamed("value", "url"), _read(s, a.pages)), a.output)),
    "termcloud": (("input", "training", "folder", "status"), {"title": "classification"}, lambda s, a: _write(term_cloud_builder(_read(s, a.input), tables.training_file(s, a.training), a.title, a.folder), a.status)),
    "networkanalyzer": (("input", "folder", "status"), {}, lambda s, a: _write(network_analyzer(_read(s, a.input), a.folder), a.status)),
    "websitecomment": (("pages", "output", "status"), {}, lambda s, a: _upsert_file(s, comment_wrapper(_read(s, a.pages)), a.output, a.status)),
    "postcomment": (("posts", "output", "status"), {}, lambda s, a: _upsert_file(s, comment_threads(_read(s, a.posts), _now()), a.output, a.status)),
    "counter": (("input", "hosts", "labels", "output"), {"host": "host"}, lambda s, a: _write(counter(_read(s, a.input), _read(s, a.hosts), a.host, a.labels.split(",")), a.output)),
}


def main(argv: list[str] | None = None) -> None:
    """python -m sparkloom.plans.jobs COMMAND ...: run one job; ``websitecrawler`` has nothing to run."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    each = parser.add_subparsers(dest="command", required=True)
    for name, (arguments, options, _) in COMMANDS.items():
        sub = each.add_parser(name)
        for x in arguments:
            sub.add_argument(x, choices=("upload", "download") if x == "mode" else None)
        for x, default in options.items():
            sub.add_argument(f"--{x}", default=default)
    args = parser.parse_args(argv)
    COMMANDS[args.command][2](session(args.command), args)


if __name__ == "__main__":
    main()
