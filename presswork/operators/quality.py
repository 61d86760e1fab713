"""Checks of posts, and statistics of runs over a crawl log.

A crawl log has a row per detail page: config_id, url, seq, status (ok,
parse_failed or download_failed), exc_name, exc_detail, empty_fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

OK, PARSE_FAILED, DOWNLOAD_FAILED = "ok", "parse_failed", "download_failed"
CAP = 100

#: Declared types of a post's fields.
FIELD_TYPES = {
    "url": "string", "title": "string", "content": "string", "author": "string", "source": "string", "siteName": "string", "channel": "string",
    "html": "string", "summary": "string", "ctime": "timestamp", "gtime": "timestamp", "video_urls": "array", "pic_urls": "array", "visitCount": "int", "replyCount": "int",
}


def type_errors(types: dict[str, Column]) -> Column:
    """A map of the fields whose JSON type isn't the declared one to the type they have.

    types: for each field its type as schema_of_json or typeof names it; times
    may be numbers, counts may be lists. Fields that aren't declared pass.
    """
    allowed = {"string": ["string"], "timestamp": ["timestamp", "timestamp_ntz", "bigint", "int", "double"], "array": ["array"], "int": ["int", "bigint", "array"]}
    entries = []
    for f, t in types.items():
        if f in FIELD_TYPES:
            kind = F.regexp_extract(F.lower(t), "^([a-z_]+)", 1)
            entries.append(F.struct(F.lit(f if f != "url" else "url_type").alias("key"), F.when(~kind.isin(allowed[FIELD_TYPES[f]]), kind).alias("value")))
    return F.map_filter(F.map_from_entries(F.array(*entries)), lambda _, v: v.isNotNull())


def count_of(value: Column, listed: Column | None = None) -> Column:
    """A count that may come as a number or as the first of a list of structs with `count`."""
    return value if listed is None else F.coalesce(value, F.get(listed, F.lit(0)).getField("count"))


def empty_fields(df: DataFrame, texts: list[str], counts: list[str] = (), time: str | None = None) -> Column:
    """Names of the fields of a row that are empty: blank texts, counts below 0, a time that is missing or has
    fractions of a second (it was filled in with now)."""
    flags = [F.when(F.coalesce(F.length(c), F.lit(0)) == 0, F.lit(c)) for c in texts]
    flags += [F.when(F.coalesce(F.col(c), F.lit(-1)) < 0, F.lit(c)) for c in counts]
    if time:
        t = F.col(time)
        flags.append(F.when(t.isNull() | (F.date_format(t, "SSSSSS") != "000000"), F.lit(time)))
    return F.array_compact(F.array(*flags))


def page_status(body: Column, gone_pattern: str, post_id: Column, *fields: Column) -> Column:
    """What came of a page: gone, no_id, download_failed (all fields empty) or ok."""
    empty = F.lit(True)
    for f in fields:
        empty = empty & (F.coalesce(F.length(f), F.lit(0)) == 0)
    return F.when(F.coalesce(body.rlike(gone_pattern), F.lit(False)), "gone").when(post_id.isNull(), "no_id").when(empty, DOWNLOAD_FAILED).otherwise(OK)


def _counters() -> list[Column]:
    return [
        F.count("*").alias("new_count"),
        F.count_if(F.col("status") == OK).alias("parse_success_num"),
        F.count_if(F.col("status") == PARSE_FAILED).alias("parse_failed_num"),
        F.count_if(F.col("status") == DOWNLOAD_FAILED).alias("download_failed_num"),
    ]


def run_counters(log: DataFrame) -> DataFrame:
    """(config_id, new_count, parse_success_num, parse_failed_num, download_failed_num)."""
    return log.groupBy("config_id").agg(*_counters())


def run_summary(log: DataFrame, time: str = "ts") -> DataFrame:
    """run_counters with start and end in seconds, and whether the run is complete, from one aggregate."""
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    done = F.col("new_count") == F.col("parse_success_num") + F.col("parse_failed_num") + F.col("download_failed_num")
    return log.groupBy("config_id").agg(*_counters(), F.min(second).alias("start_time"), F.max(second).alias("end_time")).withColumn("finished", done)


def field_failures(log: DataFrame) -> DataFrame:
    """(field, ratio): failures of each field, "fails/new/total".

    Totals are counted as two more fields in the same aggregate; the window
    above it sees a row a field.
    """
    from pyspark.sql import Window as W

    none = F.array().cast("array<string>")
    marks = F.concat(F.array(F.lit("*new")), F.when(F.col("status") == OK, F.array(F.lit("*total"))).otherwise(none), F.coalesce("empty_fields", none))
    counts = log.select(F.explode(marks).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    of = lambda name: F.coalesce(F.max(F.when(F.col("field") == name, F.col("n"))).over(W.partitionBy(F.lit(1))), F.lit(0))
    out = counts.withColumns({"new": of("*new"), "total": of("*total")}).where(~F.startswith("field", F.lit("*")))
    return out.select("field", F.format_string("%d/%d/%d", "n", "new", "total").alias("ratio"))


def never_parsed(log: DataFrame, fields: list[str]) -> DataFrame:
    """(field, never): whether no page ever had the field."""
    long = log.select(F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"), "empty_fields")
    return long.groupBy("field").agg(F.bool_and(F.array_contains("empty_fields", F.col("field"))).alias("never"))


def error_samples(log: DataFrame, cap: int = CAP) -> DataFrame:
    """(exc_name, n, urls, detail): the first `cap` pages and the last detail of each kind of exception.

    Only the capped rows are collected: a kind that a third of all rows has is
    cut to its first rows by the group limit, before and after the exchange.
    """
    from pyspark.sql import Window as W

    bad = log.where(F.col("exc_name").isNotNull())
    ranked = bad.withColumn("_r", F.row_number().over(W.partitionBy("exc_name").orderBy("seq"))).where(F.col("_r") <= cap)
    urls = ranked.groupBy("exc_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "url"))), lambda x: x["url"]).alias("urls"))
    return bad.groupBy("exc_name").agg(F.count("*").alias("n"), F.max_by("exc_detail", "seq").alias("detail")).join(urls, "exc_name")


def failures_by_field(log: DataFrame, cap: int = CAP) -> DataFrame:
    """(field, urls): the first pages on which each field was empty."""
    from pyspark.sql import Window as W

    long = log.select("url", "seq", F.explode("empty_fields").alias("field"))
    ranked = long.withColumn("_r", F.row_number().over(W.partitionBy("field").orderBy("seq"))).where(F.col("_r") <= cap)
    return ranked.groupBy("field").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "url"))), lambda x: x["url"]).alias("urls"))


def capped_samples(df: DataFrame, kind: str, value: str, order: str, cap: int = 100) -> DataFrame:
    """(kind, n, samples): of each kind how many there are and its first `cap` values in this order, cut before and after the exchange."""
    w = W.partitionBy(kind).orderBy(order)
    first = df.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap)
    listed = first.groupBy(kind).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value]).alias("samples"))
    return df.where(F.col(value).isNotNull()).groupBy(kind).agg(F.count("*").alias("n")).join(listed, kind)
