"""Operators of a crawl: lookups, seeds, frontiers, envelopes, windows and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.functions.text import page_base64
from presswork.sources.control import Counter

# Lookups


def last_write(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """(key, value): each key's value with the highest seq."""
    return df.groupBy(key).agg(F.max_by(value, seq).alias(value))


def lookup(df: DataFrame, pairs: DataFrame, key: str, value: str, seq: str, default: str) -> DataFrame:
    """df with the last value written for its key, or the default."""
    found = last_write(pairs, key, value, seq).withColumnRenamed(value, "_v")
    return df.join(found, key, "left").withColumn(value, F.coalesce("_v", F.lit(default))).drop("_v")


# Seeds


def keyword_urls(keywords: DataFrame, template: str, first: int, stop: int) -> DataFrame:
    """(url, topic_id, keyword, page) of every keyword line and page; a line may start with a topic id and a tab.

    Pages are an array that is exploded, not a join: the plan has no exchange.
    """
    parts = F.split("line", "\t")
    split = keywords.select(F.when(F.size(parts) > 1, parts[0]).otherwise("").alias("topic_id"), F.element_at(parts, -1).alias("keyword"))
    paged = split.withColumn("page", F.explode(F.sequence(F.lit(first), F.lit(stop - 1)))) if stop > first else split.withColumn("page", F.lit(0)).limit(0)
    return paged.select(F.format_string(template, F.url_encode("keyword"), "page").alias("url"), "topic_id", "keyword", "page")


def id_batch(spark: SparkSession, retry: DataFrame, highest: int, limits: int, least_new: int, template: str) -> tuple[DataFrame, int]:
    """(id, url, is_retry) of up to limits - least_new ids to try again and new ones below the raised counter, and the counter."""
    again = retry.select(F.col("id").cast("long").alias("id")).orderBy("id").limit(max(0, limits - least_new))
    fresh = limits - again.count()
    new = spark.range(highest + 1, highest + fresh + 1).select("id")
    both = again.withColumn("is_retry", F.lit(True)).unionAll(new.withColumn("is_retry", F.lit(False)))
    return both.withColumn("url", F.format_string(template, "id")), highest + fresh


def fresh_ids(spark: SparkSession, counter: Counter, n: int, template: str) -> DataFrame:
    """(id, url) of the next n ids of a counter that other drivers raise, too; no two get the same."""
    ids = counter.take(n)
    return spark.range(ids.start, ids.stop).select("id", F.format_string(template, "id").alias("url"))


def counted_batch(spark: SparkSession, retry: DataFrame, counter: Counter, limits: int, least_new: int, template: str) -> DataFrame:
    """id_batch() whose new ids come from a shared counter."""
    again = retry.select(F.col("id").cast("long").alias("id")).orderBy("id").limit(max(0, limits - least_new))
    new = fresh_ids(spark, counter, limits - again.count(), template)
    old = again.select("id", F.format_string(template, "id").alias("url"), F.lit(True).alias("is_retry"))
    return old.unionByName(new.withColumn("is_retry", F.lit(False)))


def reconcile(missing: DataFrame, last_success: Column, margin: int = 500) -> DataFrame:
    """missing(id) with `fate`: an id close below or above the last success may still come, and is tried again."""
    return missing.withColumn("fate", F.when(F.col("id") > last_success - margin, "retry").otherwise("gone"))


def high_water(old: Column, ids: DataFrame) -> DataFrame:
    """The highest id so far, never lower than before."""
    return ids.agg(F.greatest(F.max("id"), old).alias("largest_success"))


# Windows


def keep_latest(df: DataFrame, key: str, time: str, n: int = 1000, *ties: str) -> DataFrame:
    """Each key's latest n rows; the group limit cuts before the exchange."""
    w = W.partitionBy(key).orderBy(F.desc(time), *[F.desc(t) for t in ties])
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def first_per_user(df: DataFrame, user: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(each user's first row and all without a user, the others for the queue); rows without a user aren't ranked."""
    named = df.where(F.col(user).isNotNull()).withColumn("_r", F.row_number().over(W.partitionBy(user).orderBy(seq)))
    return named.where("_r = 1").drop("_r").unionByName(df.where(F.col(user).isNull())), named.where("_r > 1").drop("_r")


def previous_link(df: DataFrame, order: str, link: str, doc: str) -> DataFrame:
    """df with the last link before each node of a document."""
    w = W.partitionBy(doc).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("previous_link", F.last(link, ignorenulls=True).over(w))


# Filters and envelopes


def with_title(posts: DataFrame) -> DataFrame:
    return posts.where(F.length("title") > 0)


def links_on(links: DataFrame, domains: list[str], url: str = "url") -> DataFrame:
    """Links to these hosts, each once."""
    from presswork.functions.urls import host

    return links.where(host(F.col(url)).isin(domains)).distinct()


def enveloped(posts: DataFrame, **defaults: str) -> DataFrame:
    """posts with these columns; a value that a post has stays."""
    return posts.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in posts.columns else F.lit(v) for c, v in defaults.items()})


def with_config(posts: DataFrame, config: dict[str, str]) -> DataFrame:
    """posts with config_info; entries that a post has win."""
    own = F.coalesce(F.col("config_info"), F.create_map().cast("map<string,string>")) if "config_info" in posts.columns else None
    base = F.create_map(*[F.lit(x) for kv in sorted(config.items()) for x in kv]) if config else F.create_map().cast("map<string,string>")
    if own is None:
        return posts.withColumn("config_info", base)
    return posts.withColumn("config_info", F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(own, k)), own))


def packed_page(posts: DataFrame, skip_flag: int = 401) -> DataFrame:
    """posts with the page compressed in html_base64 and html blank, but for posts of the skipped kind."""
    skip = F.coalesce(F.col("info_flag").try_cast("int") == skip_flag, F.lit(False))
    return posts.withColumn("html_base64", F.when(~skip, page_base64(F.col("html")))).withColumn("html", F.when(skip, F.col("html")).otherwise(F.lit("")))


def item_size(*columns: str) -> Column:
    return sum((F.coalesce(F.length(c), F.lit(0)) for c in columns), F.lit(0))


def without_rows(df: DataFrame, column: str, values: list) -> DataFrame:
    """A queue without the named entries; entries that are null stay."""
    return df.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))


# Rollups


def ingest_counts(posts: DataFrame, config: str = "config_id", time: str = "ts") -> DataFrame:
    """(config_id, day, n): posts per config and day, and per config with a null day."""
    daily = posts.groupBy(F.col(config).alias("config_id"), F.to_date(time).alias("day")).agg(F.count("*").alias("n"))
    # totals come from the daily counts: the rows are read and shuffled once
    return daily.unionByName(daily.groupBy("config_id").agg(F.sum("n").alias("n")).withColumn("day", F.lit(None).cast("date")))


def last_ingest(posts: DataFrame, url: str = "url", time: str = "ts") -> DataFrame:
    return posts.groupBy(url).agg(F.max(time).alias("last_seen"))
