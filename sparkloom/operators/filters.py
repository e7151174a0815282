"""Row predicates and projections of the crawl jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import language


def due(df: DataFrame, time_ms: str, now_ms: int, interval_ms: int) -> DataFrame:
    """Rows last visited ``interval_ms`` ago or earlier."""
    return df.where(F.lit(now_ms).cast("bigint") - F.col(time_ms) >= interval_ms)


def non_empty(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.coalesce(F.length(text), F.lit(0)) > 0)


def majority(df: DataFrame, key: str, is_target: Column, share: float = 0.5) -> DataFrame:
    """Keys of which at least ``share`` of the rows are of the target."""
    return df.groupBy(key).agg(F.avg(is_target.cast("double")).alias("share"), F.count("*").alias("n_posts")).where(F.col("share") >= share)


def join_text(fields: list[Column]) -> Column:
    """Non-empty fields joined by a full stop."""
    return F.concat_ws(". ", *[F.nullif(f.cast("string"), F.lit("")) for f in fields])


def flag_classified(df: DataFrame, column: str = "classification", none: str = "none", flag: str = "classified") -> DataFrame:
    return df.withColumn(flag, F.when(F.col(column) != none, F.lit("1")))


def search(df: DataFrame, text: str, keyword: str, limit: int, order: list[str]) -> DataFrame:
    """Up to ``limit`` rows whose text has the keyword, whatever its case, in a fixed order."""
    return df.where(F.contains(F.lower(text), F.lit(keyword.lower()))).orderBy(*order).limit(limit)


def feed(df: DataFrame, time: str, since: Column, until: Column) -> DataFrame:
    return df.where((F.col(time) >= since) & (F.col(time) <= until))


def latest(df: DataFrame, keys: list[str], time: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key by time; each task keeps no more than that of a key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time)))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def search_hosts(hosts: DataFrame, posts: DataFrame, keywords: list[str], known: DataFrame, target: str, limit: int, now_ms: int, n_posts: int = 10, share: float = 0.5) -> DataFrame:
    """(id, type, name, crawltime) of hosts found by a keyword, whatever its case, up to ``limit`` of each type for each.

    Groups must be open.  Of the host's last ``n_posts`` posts at least
    ``share`` must have a text in the ``target`` language by the ``known``
    profiles; a host without posts is left out.
    """
    name = F.lower("name")
    found = hosts.withColumn("keyword", F.explode(F.array_compact(F.array(*[F.when(F.contains(name, F.lit(k.lower())), F.lit(k)) for k in keywords]))))
    place = F.row_number().over(Window.partitionBy("keyword", "type").orderBy("id"))
    found = found.withColumn("_place", place).where(F.col("_place") <= limit)
    found = found.where((F.col("type") != "group") | (F.col("privacy") == "OPEN")).select("id", "type", "name").distinct()
    fields = ["caption", "description", "message", "name", "story"]
    mine = posts.join(found.select(F.col("id").alias("host_id")), "host_id", "left_semi")
    mine = mine.withColumn("post", F.row_number().over(Window.partitionBy("host_id").orderBy(F.desc("time")))).where(F.col("post") <= n_posts)
    texts = mine.select("host_id", "post", F.posexplode(F.array(*fields)).alias("field", "text"))
    each = language.detect(texts, ["host_id", "post", "field"], "text", known)
    judged = each.groupBy("host_id", "post").agg(F.bool_or(F.col("detected") == target).alias("is_target"))
    kept = majority(judged, "host_id", F.coalesce("is_target", F.lit(False)), share).select(F.col("host_id").alias("id"))
    return found.join(kept, "id", "left_semi").select("id", "type", "name", F.lit(now_ms).cast("bigint").alias("crawltime"))
