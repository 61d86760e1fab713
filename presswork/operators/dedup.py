"""Seen-address elimination, first-seen stores, routing and purging."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.urls import canonical, dedup_key


def with_key(df: DataFrame, url: str = "url", salt: str = "") -> DataFrame:
    return df.withColumn("dedup_key", dedup_key(canonical(F.col(url)), salt))


def unseen(df: DataFrame, seen: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows whose key isn't in seen(key); a null key was never seen."""
    return df.join(seen.select(F.col("key").alias(key)), key, "left_anti")


def first_seen(df: DataFrame, key: str, time: str, *ties: str) -> DataFrame:
    """One row per key: the earliest, ties by the given columns; a row without a time comes last.

    One partial aggregate of whole rows instead of a window: a key that many
    rows share costs one row a task. Columns may have any type, maps included;
    only time and ties are compared.
    """
    order = F.struct(F.col(time).isNull(), time, *ties)
    out = df.groupBy(key).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in df.columns)), order).alias("_x"))
    return out.select("_x.*")


def add_seen(seen: DataFrame, new: DataFrame) -> DataFrame:
    """The store (key, first_seen) with new rows; a key that is seen again keeps its first time."""
    return seen.unionByName(new.select("key", "first_seen")).groupBy("key").agg(F.min("first_seen").alias("first_seen"))


@dataclass(frozen=True)
class Route:
    """Addresses that match the pattern go to the store, under its groups joined, or all of the address if it has none."""

    pattern: str
    store: str


def routed(df: DataFrame, routes: list[Route], default: str, url: str = "url") -> DataFrame:
    """df with `store` and `route_key` by the first route that matches, all in one projection."""
    u = F.col(url)
    store: Column | None = None
    key: Column | None = None
    for r in routes:
        hit, n = u.rlike(r.pattern), re.compile(r.pattern).groups
        own = F.concat(*[F.regexp_extract(u, r.pattern, i + 1) for i in range(n)]) if n else u
        store = F.when(hit, r.store) if store is None else store.when(hit, r.store)
        key = F.when(hit, own) if key is None else key.when(hit, own)
    return df.withColumn("store", store.otherwise(default) if store is not None else F.lit(default)).withColumn("route_key", key.otherwise(u) if key is not None else u)


def unseen_by_route(df: DataFrame, seen: DataFrame, routes: list[Route], default: str, url: str = "url") -> DataFrame:
    """Rows that their route's store seen(store, key) doesn't hold."""
    return routed(df, routes, default, url).join(seen.select("store", F.col("key").alias("route_key")), ["store", "route_key"], "left_anti")


#: How long stores keep an address, in seconds.
DAY = 86_400
TTL = {"offline": 10 * DAY, "news": 3 * DAY, "forum": 5 * DAY, "micro": 3 * 3600}


def is_expired(first_seen_at: Column, now: Column, ttl_seconds: Column) -> Column:
    """Seen at least ttl ago; both ends count, and nothing from before 1970 is purged."""
    age = F.unix_micros(now) - F.unix_micros(first_seen_at)
    return (F.unix_micros(first_seen_at) >= 0) & (age >= ttl_seconds * 1_000_000)


def purge(seen: DataFrame, rules: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(what stays, purged counts by store) of seen(store, key, first_seen) under rules(store, ttl_seconds); a store without a rule keeps all."""
    joined = seen.join(rules, "store", "left").withColumn("_gone", F.coalesce(is_expired(F.col("first_seen"), now, F.col("ttl_seconds")), F.lit(False)))
    return joined.where("not _gone").select(seen.columns), joined.groupBy("store").agg(F.count_if("_gone").alias("purged"))


def days_to_purge(seen: DataFrame, now: Column, most: int) -> DataFrame:
    """Keys per whole day of age up to `most`, oldest first: where a purge that searches backward would stop."""
    age = F.floor((F.unix_seconds(now) - F.unix_seconds("first_seen")) / DAY)
    return seen.select(F.least(age, F.lit(most)).alias("age_days")).groupBy("age_days").agg(F.count("*").alias("n")).orderBy(F.desc("age_days"))


def purge_backward(seen: DataFrame, now: Column, ttl_days: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(what stays, one row with the day that was purged and its count) of a purge that looks back day by day.

    It begins at keys of ttl_days, goes on to older ones up to `most` days, and
    ends at the first day that has any; all keys of that age or older go. If no
    day has any, nothing goes, and the day is null.
    """
    age = F.floor((F.unix_seconds(now) - F.unix_seconds("first_seen")) / DAY)
    hit = seen.where(age.between(ttl_days, most)).agg(F.min(age).alias("day"))
    marked = seen.withColumn("_age", age).join(F.broadcast(hit), how="left").withColumn("_gone", F.coalesce(F.col("_age") >= F.col("day"), F.lit(False)))
    return marked.where("not _gone").select(seen.columns), marked.agg(F.first("day").alias("day"), F.count_if("_gone").alias("purged"))
