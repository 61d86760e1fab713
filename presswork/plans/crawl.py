"""The crawl as one plan: pages become posts, links become work, a log becomes statistics."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import article, dates, text, urls
from presswork.operators import crawl, dedup, quality

#: Statuses of a fetched page that count as an answer.
ANSWERS = (200, 404, 410)


def fetched(pages: DataFrame, keep_status_code: bool = False) -> DataFrame:
    """Pages with a fetchable address and, if the table has a status, one that is an answer."""
    ok = urls.is_fetchable(F.col("url"))
    if "status" in pages.columns and not keep_status_code:
        ok = ok & F.coalesce(F.col("status").isin(*ANSWERS), F.lit(False))
    return pages.where(ok)


def rejected_addresses(pages: DataFrame, caller: str, cap: int = 100) -> DataFrame:
    """A report of up to `cap` addresses that can't be fetched."""
    return pages.where(~urls.is_fetchable(F.col("url"))).select(F.lit(caller).alias("caller"), "url").orderBy("url").limit(cap)


HREF = r"""(?i)<(?:a|iframe)\s[^>]*?(?:href|src)=["']?([^"'\s>]+)"""
BASE = r"""(?i)<base\s[^>]*?href=["']?([^"'\s>]+)"""


def links(pages: DataFrame, pattern: str | None = None, domains: list[str] | None = None) -> DataFrame:
    """(page_id, channel_url, detail_url) of all links, each once a page, all in Catalyst.

    With a pattern, its first match in an address (or that match's first group)
    replaces the address; an address without a match stays. Relative addresses
    are resolved against the page's base element, or else its own address. With
    domains, absolute links to other hosts are left out.
    """
    found = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    raw = pages.select("page_id", "url", F.regexp_extract("html", BASE, 1).alias("_base"), F.explode(F.array_distinct(found)).alias("href"))
    href = F.col("href")
    if pattern is not None:
        group = 1 if re.compile(pattern).groups else 0
        href = F.when(href.rlike(pattern), F.regexp_extract(href, pattern, group)).otherwise(href)
    raw = raw.select("page_id", "url", F.when(F.col("_base") != "", urls.joined(F.col("url"), F.col("_base"))).otherwise(F.col("url")).alias("_base"), href.alias("href"))
    relative = ~F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    out = raw.select("page_id", F.col("url").alias("channel_url"), urls.joined(F.col("_base"), F.col("href")).alias("detail_url"), relative.alias("_relative"))
    if domains is not None:
        out = out.where(F.col("_relative") | urls.host(F.col("detail_url")).isin(domains))
    return out.drop("_relative").distinct()


def new_work(found: DataFrame, seen: DataFrame, salt: str = "") -> DataFrame:
    """Links whose address wasn't seen; the key is computed before the join, which is the only exchange."""
    return dedup.unseen(dedup.with_key(found, "detail_url", salt), seen)


def page_facts(pages: DataFrame) -> DataFrame:
    """The Catalyst-only part of a post: key, title, link figures, charset and flags of quality."""
    title, h1 = text.tag_text(F.col("html"), "title"), text.tag_text(F.col("html"), "h1")
    facts = fetched(pages).select(
        "page_id",
        "url",
        urls.canonical(F.col("url"), keep_fragment=False).alias("canonical_url"),
        title.alias("_t"),
        h1.alias("_h"),
        F.size(text.link_texts(F.col("html"))).alias("n_links"),
        F.round(text.link_density(F.col("html")), 6).alias("link_density"),
        text.charset(F.col("html")).alias("charset"),
    )
    facts = facts.withColumn("title", text.page_title(F.col("_t"), F.col("_h"))).drop("_t", "_h")
    return facts.withColumn("has_title", F.length("title") > 0)


def posts(pages: DataFrame, gtime: Column, config: dict[str, str] | None = None, max_days: int | None = None, **envelope: str) -> DataFrame:
    """Posts of pages(page_id, url, html): extracted, repaired, checked and in their envelope.

    The extraction is one Python stage; plain filters come before it, and what
    depends on it after. Pages without a title are dropped.
    """
    x = fetched(pages).withColumn("_x", article.extract(F.col("html"), F.col("url")))
    out = x.select(
        "page_id", "url", "html", F.col("_x.title").alias("title"), F.col("_x.content").alias("content"), F.col("_x.source").alias("source"), F.col("_x.author").alias("author"),
        F.col("_x.channel").alias("channel"), F.col("_x.breadcrumb").alias("breadcrumb"), gtime.alias("gtime"),
        dates.page_ctime(F.col("_x.published").cast("timestamp_ntz").cast("timestamp"), F.col("html"), gtime).alias("ctime"),
    )
    return finished_posts(out, config, max_days, **envelope)


def finished_posts(out: DataFrame, config: dict[str, str] | None = None, max_days: int | None = None, **envelope: str) -> DataFrame:
    """Extracted posts, whose times are repaired, checked for age and empty fields, and put in their envelope."""
    out = crawl.with_title(out).withColumn("ctime", dates.repaired_ctime(F.col("ctime"), F.col("gtime")))
    out = out.where(dates.within(F.col("ctime"), F.col("gtime"), max_days))
    out = crawl.with_config(crawl.enveloped(out, **envelope), config or {})
    out = out.withColumn("empty_fields", quality.empty_fields(out, ["title", "content", "author", "source"]))
    return out.withColumn("item_size", crawl.item_size("html", "content"))


def frontier(seeds: DataFrame, expand: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame], rounds: int) -> DataFrame:
    """All addresses reachable in `rounds` from seeds(url), by expand(urls) -> urls.

    A round is an anti-join against what is known; `cut` writes each round, so
    that the plan doesn't grow and a lost executor costs a task.
    """
    known = cut(seeds.select("url").distinct())
    edge = known
    for _ in range(rounds):
        edge = cut(expand(edge).select("url").distinct().join(known, "url", "left_anti"))
        if edge.isEmpty():
            break
        known = cut(known.unionByName(edge))
    return known


#: What a page came to: no page, a page without a record, or one with.
DOWNLOAD_FAILED, PARSE_FAILED, PARSED = "download_failed", "parse_failed", "ok"


@dataclass(frozen=True)
class Site:
    """A site's callbacks, which the plan runs.

    find_links gives (page_id, channel_url, detail_url) of list pages. read_page
    is a column of the page's records, an array of structs, from its columns: a
    null page isn't asked; null or an empty array means that parsing failed. A
    field next_urls of a record has further pages of its thread.
    """

    find_links: Callable[[DataFrame], DataFrame]
    read_page: Callable[[], Column]


def default_record() -> Column:
    """One record a page, from the article's extraction; none if it has no title."""
    x = article.extract(F.col("html"), F.col("url"))
    return F.transform(F.array(x), lambda r: F.when(F.length(r["title"]) > 0, F.struct(r["title"].alias("title"), r["content"].alias("content"), r["source"].alias("source"), r["author"].alias("author"))))


#: Sites by name; a name that isn't there is the default one.
SITES: dict[str, Site] = {"default": Site(links, default_record)}


def listed(pages: DataFrame, site: str = "default") -> DataFrame:
    """The list stage: detail links of list pages(page_id, url, html) by the site's callback; failed downloads give none."""
    return SITES.get(site, SITES["default"]).find_links(fetched(pages).where("html is not null"))


def detailed(pages: DataFrame, site: str = "default") -> DataFrame:
    """The detail stage: detail pages(url, html) with `status` and `records`, by the site's callback, asked once a page.

    A page that is null wasn't downloaded; one without a record wasn't parsed.
    """
    asked = pages.withColumn("records", F.when(F.col("html").isNotNull(), F.filter(SITES.get(site, SITES["default"]).read_page(), lambda r: r.isNotNull())))
    status = F.when(F.col("html").isNull(), DOWNLOAD_FAILED).when(F.coalesce(F.size("records"), F.lit(0)) <= 0, PARSE_FAILED).otherwise(PARSED)
    return asked.withColumn("status", status)


def next_pages(details: DataFrame) -> DataFrame:
    """(channel_url, detail_url) of the next pages that records name; without such a field there are none."""
    fields = details.schema["records"].dataType.elementType.fieldNames()
    if "next_urls" not in fields:
        return details.sparkSession.createDataFrame([], "channel_url string, detail_url string")
    return details.select(F.col("url").alias("channel_url"), F.explode(F.flatten(F.col("records.next_urls"))).alias("detail_url")).distinct()


def data_rows(details: DataFrame) -> DataFrame:
    """The data stage: a row for each record, without next_urls; a record without an address has its page's."""
    rows = details.where(F.col("status") == PARSED).select(F.col("url").alias("_url"), F.explode("records").alias("_r"))
    fields = [f for f in rows.schema["_r"].dataType.fieldNames() if f not in ("next_urls", "url")]
    own = F.coalesce(F.col("_r.url"), F.col("_url")) if "url" in rows.schema["_r"].dataType.fieldNames() else F.col("_url")
    return rows.select(own.alias("url"), *(F.col(f"_r.{f}").alias(f) for f in fields))


@dataclass(frozen=True)
class Run:
    """What a run of the stages came to: details with their status, data rows, how many addresses were new, and new ones that weren't fetched."""

    details: DataFrame
    data: DataFrame
    new_total: int
    left: DataFrame


#: Rounds whose tables are read one by one; so many are written together.
TOGETHER = 16


def crawled(lists: DataFrame, fetch: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame], site: str = "default", seen: DataFrame | None = None, rounds: int | None = None) -> Run:
    """List pages to detail pages to data, as chained stages.

    fetch(urls) gives (url, html) of addresses, html null where the download
    failed. Next pages that records name are fetched in further rounds, each
    once, and count as new, until none is left; `cut` writes each round.
    Addresses in seen(key) are not fetched. With `rounds` a run ends after so
    many, and what it didn't fetch is left, and not counted as new.
    """
    found = listed(lists, site).select(F.col("detail_url").alias("url")).distinct()
    if seen is not None:
        found = dedup.unseen(dedup.with_key(found), seen).select("url")

    def together(parts: list[DataFrame]) -> list[DataFrame]:
        return [cut(reduce(DataFrame.unionByName, parts))] if len(parts) == TOGETHER else parts

    edge = cut(found)
    known, details, total, done = [edge], [], 0, 0
    waiting = edge.count()
    while waiting and done != rounds:
        total, done = total + waiting, done + 1
        part = cut(detailed(fetch(edge), site))
        details = together([*details, part])
        named = next_pages(part).select(F.col("detail_url").alias("url")).distinct()
        edge = cut(named.join(reduce(DataFrame.unionByName, known), "url", "left_anti"))
        known = together([*known, edge])
        waiting = edge.count()
    every = reduce(DataFrame.unionByName, details) if details else cut(detailed(fetch(edge), site))
    return Run(every, data_rows(every), total, edge)


#: Hooks on the way out: before posts are saved, and at a run's end.
BEFORE_SAVE: list[Callable[[DataFrame], DataFrame]] = []
BEFORE_STOP: list[Callable[[DataFrame], None]] = []


def saved(df: DataFrame) -> DataFrame:
    for hook in BEFORE_SAVE:
        df = df.transform(hook)
    return df


def finished(log: DataFrame) -> DataFrame:
    """The run's summary, shown to every hook."""
    summary = quality.run_summary(log)
    for hook in BEFORE_STOP:
        hook(summary)
    return summary
