"""Networks, reply trees and page comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import graph, html_comments, replies
from sparkloom.plans.common import Registry, table

QUERIES = Registry()
ORACLES = QUERIES.sql

_POSTS = "SELECT e.event_id, e.event_type AS title, CAST(e.user_id AS VARCHAR) AS u, CAST(a.user_id AS VARCHAR) AS r FROM events e LEFT JOIN events a ON a.event_id = e.event_id - CAST(e.props->>'$.k' AS BIGINT) AND a.event_id <> e.event_id"
_NET = f"WITH n AS ({_POSTS}), "
_NODES = "nd AS (SELECT title, node, count(*) AS size FROM (SELECT title, unnest([u, r]) AS node FROM n) WHERE node IS NOT NULL GROUP BY 1, 2), "
_EDGES = "ed AS (SELECT DISTINCT title, u AS node1, r AS node2 FROM n WHERE u IS NOT NULL AND r IS NOT NULL) "


def network(spark, sf_dir) -> DataFrame:
    """events as posts: each answers the event that is ``k`` (in its props) before it, itself not."""
    events = table(spark, sf_dir, "events")
    answered = events.select(F.col("event_id").alias("answers"), F.col("user_id").cast("string").alias("r"))
    back = F.get_json_object("props", "$.k").cast("bigint")
    posts = events.select("event_id", F.col("event_type").alias("title"), F.col("user_id").cast("string").alias("u"), F.when(back != 0, F.col("event_id") - back).alias("answers"))
    return posts.join(answered, "answers", "left").drop("answers")


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT title, node, size FROM nd")
def network_nodes(spark, sf_dir):
    return graph.nodes(network(spark, sf_dir), "title", "u", "r")


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT * FROM ed")
def network_edges(spark, sf_dir):
    return graph.edges(network(spark, sf_dir), "title", "u", "r")


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT title, node, size FROM nd")
def network_merge_nodes(spark, sf_dir):
    """State of the even events and new rows of the odd ones: as all at once."""
    net = network(spark, sf_dir)
    return graph.merge_nodes(*[graph.nodes(net.where(F.col("event_id") % 2 == k), "title", "u", "r") for k in (0, 1)])


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT * FROM ed")
def network_merge_edges(spark, sf_dir):
    net = network(spark, sf_dir)
    return graph.merge_edges(*[graph.edges(net.where(F.col("event_id") % 2 == k), "title", "u", "r") for k in (0, 1)])


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT CAST(row_number() OVER (PARTITION BY title ORDER BY node) - 1 AS BIGINT) AS id, title, node, size FROM nd")
def network_export_nodes(spark, sf_dir):
    return graph.numbered(network_nodes(spark, sf_dir), ["node"])


@QUERIES.add(_NET + _NODES + _EDGES + "SELECT CAST(row_number() OVER (PARTITION BY title ORDER BY node1, node2) - 1 AS BIGINT) AS id, * FROM ed")
def network_export_edges(spark, sf_dir):
    return graph.numbered(network_edges(spark, sf_dir), ["node1", "node2"])


@QUERIES.add("WITH n AS (SELECT CAST(user_id AS VARCHAR) AS u FROM events) SELECT 'all' AS title, u AS node, count(*) AS size FROM n GROUP BY u")
def network_untitled(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.lit(None).cast("string").alias("title"), F.col("user_id").cast("string").alias("u"), F.lit(None).cast("string").alias("r"))
    return graph.nodes(rows, "title", "u", "r")


_TURNS = "p AS (SELECT conv_id * 1000 + turn AS id, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS up, role FROM conversations)"
_TREE = f"WITH RECURSIVE {_TURNS}, t AS (SELECT r.id AS child, r.up AS parent, r.up AS base, 1 AS depth FROM p r JOIN p b ON r.up = b.id WHERE b.up IS NULL UNION ALL SELECT r.id, r.up, t.base, t.depth + 1 FROM t JOIN p r ON r.up = t.child) "


def turns(spark, sf_dir) -> DataFrame:
    """Turns by (conv_id, turn): one number for both would merge conversations from turn 1000 on."""
    conv, turn = F.col("conv_id"), F.col("turn")
    key = lambda t: F.struct(conv.alias("conv_id"), t.cast("bigint").alias("turn"))
    named = conv.isNotNull() & turn.isNotNull()
    return table(spark, sf_dir, "conversations").select(F.when(named, key(turn)).alias("id"), F.when(named & (turn > 0), key(turn - 1)).alias("up"), "role")


def _numbers(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys of turns as the numbers that the SQL shows; nothing is joined by these."""
    return rows.withColumns({k: F.col(k)["conv_id"] * 1000 + F.col(k)["turn"] for k in keys})


def _tree(spark, sf_dir) -> DataFrame:
    return replies.tree(turns(spark, sf_dir), "id", "up")


@QUERIES.add(_TREE + "SELECT * FROM t")
def reply_tree(spark, sf_dir):
    return _numbers(_tree(spark, sf_dir), "child", "parent", "base")


@QUERIES.add(_TREE + "SELECT depth, count(*) AS n FROM t GROUP BY depth")
def reply_depth_stats(spark, sf_dir):
    return _tree(spark, sf_dir).groupBy("depth").agg(F.count("*").alias("n"))


@QUERIES.add(_TREE + "SELECT child, parent, base, depth, c.role AS child_role, p1.role AS parent_role, b.role AS base_role FROM t JOIN p c ON c.id = child JOIN p p1 ON p1.id = parent JOIN p b ON b.id = base")
def reply_tree_with_base(spark, sf_dir):
    return _numbers(replies.with_base(_tree(spark, sf_dir), turns(spark, sf_dir), "id", ["role"]), "child", "parent", "base")


@QUERIES.add(f"WITH {_TURNS} SELECT up, id, role FROM p WHERE up IN (SELECT id FROM p WHERE role = 'user')")
def replies_to(spark, sf_dir):
    rows = turns(spark, sf_dir)
    return _numbers(replies.replies(rows, "up", rows.where("role = 'user'"), "id").select("up", "id", "role"), "up", "id")


@QUERIES.add()
def html_visible_text(spark, sf_dir):
    return html_comments.extract_text(table(spark, sf_dir, "pages"), "page_id", "html")


_THREADS = """WITH c AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations
  WHERE role <> '' AND trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '')
SELECT sha256(conv_id || '|' || CAST(i % 2 AS VARCHAR) || '/' || CAST(i // 2 AS VARCHAR)) AS row_key, CAST(conv_id AS VARCHAR) AS page, role AS "user",
  trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, CAST(1 AS INTEGER) AS depth, '' AS reply_to FROM c"""


def threads(spark, sf_dir) -> DataFrame:
    """A page for every conversation: its turns, dealt out over two comment sectors, as comments."""
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    turns = table(spark, sf_dir, "conversations").where("role <> ''").withColumn("text", plain).where("text <> ''")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.format_string('<li class="c"><cite>%s</cite><p>%s</p></li>', F.col("role"), escaped)
    pages = turns.withColumn("i", place).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", item.alias("item")))).alias("items"))
    side = lambda k: F.concat(F.lit('<div class="comments"><ul>'), F.array_join(F.transform(F.filter("items", lambda x: x["i"] % 2 == k), lambda x: x["item"]), ""), F.lit("</ul></div>"))
    return pages.select("conv_id", F.concat(F.lit("<html><body>"), side(0), side(1), F.lit("</body></html>")).alias("html"))


@QUERIES.add(_THREADS)
def html_comment_rows(spark, sf_dir):
    return html_comments.extract(threads(spark, sf_dir), "conv_id", "html")


@QUERIES.add()
def html_page_comments(spark, sf_dir):
    """Comments of the crawled pages themselves."""
    return html_comments.extract(table(spark, sf_dir, "pages"), "page_id", "html")


@QUERIES.add("SELECT l.doc_id, p.page_id, length(p.html) AS n FROM labels l JOIN pages p ON l.doc_id = p.page_id WHERE length(p.html) > 0")
def training_download(spark, sf_dir):
    """Training rows with the text of their page."""
    pages = table(spark, sf_dir, "pages").where(F.length("html") > 0)
    return table(spark, sf_dir, "labels").join(pages, F.col("doc_id") == F.col("page_id")).select("doc_id", "page_id", F.length("html").cast("bigint").alias("n"))
