"""Dates in free text, and times of publication and collection.

Source text is taken to be in a fixed zone, eight hours ahead of UTC. `now` is
always an argument: a query gives the same rows whenever it runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def offset() -> Column:
    """How far local time is ahead of UTC."""
    return F.expr("INTERVAL 8 HOURS")


#: What is looked for, in this order, and the format of what is found. A format without a year is of now's year.
FORMATS = (
    (r"(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})", "yyyy-M-d H:m:s"),
    (r"(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2})", "yyyy-M-d H:m"),
    (r"(\d{4}-\d{1,2}-\d{1,2})", "yyyy-M-d"),
    (r"(\d{4}-\d{1,2})", "yyyy-M"),
    (r"(\d{2}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})", "yy-M-d H:m:s"),
    (r"(\d{2}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2})", "yy-M-d H:m"),
    (r"(\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})", "M-d H:m:s"),
    (r"(\d{1,2}-\d{1,2} \d{1,2}:\d{1,2})", "M-d H:m"),
    (r"(\d{1,2}-\d{1,2})", "M-d"),
    (r"(\d+)\s*秒前", "1 second ago"),
    (r"(\d+)\s*分钟前", "60 seconds ago"),
    (r"(\d+)\s*小时前", "3600 seconds ago"),
    (r"(\d+)\s*天前", "86400 seconds ago"),
    (r"今天\s*(\d{1,2}:\d{1,2}:\d{1,2})", "0 days ago at H:m:s"),
    (r"昨天\s*(\d{1,2}:\d{1,2}:\d{1,2})", "1 day ago at H:m:s"),
    (r"前天\s*(\d{1,2}:\d{1,2}:\d{1,2})", "2 days ago at H:m:s"),
    (r"今天\s*(\d{1,2}:\d{1,2})", "0 days ago at H:m"),
    (r"昨天\s*(\d{1,2}:\d{1,2})", "1 day ago at H:m"),
    (r"前天\s*(\d{1,2}:\d{1,2})", "2 days ago at H:m"),
)


def normalized(text: Column) -> Column:
    """Year and month signs and slashes as dashes, the day sign as a space, blanks collapsed."""
    x = F.regexp_replace(F.trim(F.regexp_replace(text, r"(?:&nbsp;|&#160;| )+", " ")), "[年月/]", "-")
    return F.regexp_replace(F.replace(x, F.lit("日"), F.lit(" ")), r"\s+", " ")


def _built(value: Column, form: str, now: Column) -> Column:
    number = int(form.split(" ")[0]) if " ago" in form else 0
    if form.endswith(" ago"):
        return F.timestamp_seconds(F.unix_seconds(now.cast("timestamp")) - value.cast("long") * number)
    if " ago at " in form:
        day = F.date_format(F.date_sub(now.cast("date"), number), "yyyy-M-d")
        return F.try_to_timestamp(F.concat(day, F.lit(" "), value), F.lit(f"yyyy-M-d {form.split(' at ')[1]}"))
    if form.startswith("yy-"):  # 69 and later are of the last century
        century = F.when(F.substring(value, 1, 2).cast("int") < 69, "20").otherwise("19")
        return F.try_to_timestamp(F.concat(century, value), F.lit("yy" + form))
    if form.startswith("M"):
        return F.try_to_timestamp(F.concat(F.year(now).cast("string"), F.lit("-"), value), F.lit("yyyy-" + form))
    return F.try_to_timestamp(value, F.lit(form))


def local_datetime(text: Column, now: Column) -> Column:
    """The local time that the text names, by the first format that is found.

    Blank text, and text without a date, give now. A hit that isn't in the
    calendar gives null, where a caller may fall back.
    """

    def by_format(x: Column) -> Column:
        # each pattern is matched once: what it finds is kept, and the first that found anything is built
        found = F.array(*(F.regexp_extract(x, pattern, 1) for pattern, _ in FORMATS))
        return _bound(found, first_built)

    def first_built(found: Column) -> Column:
        out = None
        for i, (_, form) in enumerate(FORMATS):
            hit = F.get(found, F.lit(i))
            built = _built(hit, form, now)
            out = F.when(hit != "", built) if out is None else out.when(hit != "", built)
        return out.otherwise(now)

    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", now).otherwise(_bound(normalized(text), by_format))


def _bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def utc_datetime(text: Column, now_utc: Column) -> Column:
    """local_datetime in UTC; a date that can't be gives now."""
    return F.coalesce(local_datetime(text, now_utc + offset()) - offset(), now_utc)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def repaired_ctime(ctime: Column, gtime: Column) -> Column:
    """A time of publication at local midnight is a date without a time.

    It becomes the last second of its day if the page was collected on a later
    one, and else the time of collection less a minute on its own date. A page
    collected at local midnight leaves it as it is. Times are UTC.
    """
    c, g = ctime + offset(), gtime + offset()
    midnight = lambda t: F.pmod(F.unix_seconds(t.cast("timestamp")), F.lit(86_400)) == 0
    later = F.floor((F.unix_seconds(g.cast("timestamp")) - F.unix_seconds(c.cast("timestamp"))) / 86400) > 0
    before = g - F.expr("INTERVAL 1 MINUTE")
    day = F.date_trunc("day", c)
    end = day + F.expr("INTERVAL 86399 SECONDS")
    same = day + F.make_dt_interval(F.lit(0), F.hour(before), F.minute(before), F.second(before))
    return F.when(midnight(c) & ~midnight(g), F.when(later, end).otherwise(same) - offset()).otherwise(ctime)


def plus_years(ts: Column, years: int) -> Column:
    """The same day and time some years on; 29 February becomes the 28th."""
    return ts + F.make_ym_interval(F.lit(years))


def within(ctime: Column, gtime: Column, days: int | None, strict: bool = False) -> Column:
    """Whether a post isn't older than `days` when collected; None lets all pass."""
    if days is None:
        return F.lit(True)
    edge = gtime - F.make_dt_interval(F.lit(days))
    return ctime > edge if strict else ctime >= edge


#: What a page's time of publication looks like if no dated text weighs enough, in this order.
PAGE_DATES = (
    r"(\d{1,4}\W\d{1,2}\W\d{1,2}\W?[  ]+?\d{1,2}:\d{1,2})",
    r"(\d{1,4}.\d{1,2}.\d{1,2}.\s*\d{1,2}:\d{1,2}(:\d{1,2}){0,1})",
    r"(\d{1,4}年\d{1,2}月\d{1,2})",
)


def page_ctime(published: Column, page: Column, gtime: Column) -> Column:
    """The time of publication in UTC: the local one that was found, else the first of PAGE_DATES in the page's body, else the time of collection.

    The first pattern that finds anything decides; a find that isn't a date with
    or without hour and minute gives the time of collection.
    """
    body = F.regexp_replace(page, r"(?is)^.*?(?=<body\b)", "")

    def told(text: Column) -> Column:
        plain = F.trim(F.regexp_replace(text, r"\D+", " "))
        return F.coalesce(F.try_to_timestamp(plain, F.lit("yyyy M d H m")), F.try_to_timestamp(plain, F.lit("yyyy M d")))

    def first(found: Column) -> Column:
        hits = F.filter(found, lambda t: t != "")
        return F.when(F.size(hits) > 0, F.coalesce(told(F.get(hits, F.lit(0))) - offset(), gtime))

    found = F.array(*(F.regexp_extract(body, f"(?is){p}", 1) for p in PAGE_DATES))
    return F.coalesce(published - offset(), _bound(found, first), gtime)
