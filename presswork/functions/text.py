"""Text, cast, array, map and JSON functions, as Catalyst expressions where they can be."""

from __future__ import annotations

import html as _html
import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.arrow import arrow_function
from presswork.functions.charsets import ALIASES



def first_match(text: Column, pattern: str, default: str = "") -> Column:
    """The first match: its first group if the pattern has one, or all of it."""
    group = 1 if re.compile(pattern).groups else 0
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group)).otherwise(F.lit(default))


def all_matches(text: Column, pattern: str) -> Column:
    group = 1 if re.compile(pattern).groups else 0
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def replaced(text: Column, pattern: str, by: str, count: int = 0) -> Column:
    """All matches replaced, or the first `count`; the rest is split off once, not scanned again."""
    if count <= 0:
        return F.regexp_replace(text, pattern, by)
    ahead = f"^((?s:.*?))(?:{pattern})"
    out, done = text, F.lit("")
    for _ in range(count):
        hit = out.rlike(pattern)
        done = F.when(hit, F.concat(done, F.regexp_extract(out, ahead, 1), F.lit(by))).otherwise(done)
        out = F.when(hit, F.regexp_replace(out, f"^(?s:.*?)(?:{pattern})((?s:.*))$", f"${re.compile(pattern).groups + 1}")).otherwise(out)
    return F.concat(done, out)


def deleted(text: Column, pattern: str, count: int = 0) -> Column:
    return replaced(text, pattern, "", count)


def matches(text: Column, pattern: str) -> Column:
    """Whether the pattern matches from the start on."""
    return F.coalesce(text.rlike(f"^(?:{pattern})"), F.lit(False))


def stripped(text: Column) -> Column:
    """Without white space of any alphabet around it, and without trailing non-breaking spaces."""
    return F.regexp_replace(F.regexp_replace(text, r"(?:&#160;)+\s*$", ""), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def as_int(text: Column, default: int = -1) -> Column:
    return F.coalesce(F.expr(f"try_cast({_sql(text)} as int)") if isinstance(text, str) else text.try_cast("int"), F.lit(default))


def as_float(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(default))


def _sql(name: str) -> str:
    return f"`{name}`"


def similarity(a: Column, b: Column) -> Column:
    """Share of places, of the longer text's, where both have the same character; null for two empty texts."""
    n = F.least(F.length(a), F.length(b))
    same = F.aggregate(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        F.lit(0),
        lambda acc, i: acc + F.when(F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)), 1).otherwise(0),
    )
    return F.try_divide(same.cast("double"), F.greatest(F.length(a), F.length(b)))


def alternation(words) -> str | None:
    """A pattern that finds any of the words, given as a list or separated by commas."""
    if not words:
        return None
    words = words.split(",") if isinstance(words, str) else words
    return "|".join(re.escape(w.lower()) for w in words)


def short_trace(text: Column) -> Column:
    """A traceback of over nine lines as its first six and last three."""
    lines = F.split(text, "\n")
    return F.when(F.size(lines) <= 9, text).otherwise(F.array_join(F.concat(F.slice(lines, 1, 6), F.slice(lines, -3, 3)), "\n"))


def charset(page: Column) -> Column:
    """The declared charset of a page: a meta element's, else an XML declaration's, else utf-8; aliases resolved."""
    meta = F.regexp_extract(page, r"""(?i)<meta[^>]*?charset=["']*([^"'>\s/;]+)""", 1)
    xml = F.regexp_extract(page, r"""^<\?xml.*?encoding=["']*([^"'>\s]+)""", 1)
    name = F.lower(F.when(meta != "", meta).when(xml != "", xml).otherwise(F.lit("utf-8")))
    table = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(table, name), name)


@arrow_function("string")
def unescaped(text: pd.Series) -> pd.Series:
    return text.map(_html.unescape, na_action="ignore")


@arrow_function("binary")
def deflated(text: pd.Series) -> pd.Series:
    return text.map(lambda t: zlib.compress(t.encode()), na_action="ignore")


@arrow_function("string")
def inflated(data: pd.Series) -> pd.Series:
    return data.map(lambda d: zlib.decompress(d).decode(), na_action="ignore")


def page_base64(page: Column) -> Column:
    """A page compressed and in base 64, without line ends."""
    return F.regexp_replace(F.base64(deflated(page)), r"[\r\n]", "")


def page_from_base64(text: Column) -> Column:
    return inflated(F.unbase64(text))


def tag_text(page: Column, tag: str) -> Column:
    """Text of the first element of this name, without markup."""
    inner = F.regexp_extract(page, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(inner, r"<[^>]*>", ""), r"\s+", " "))


#: What separates a title from the site's name, and how site names end.
TITLE_SEPARATORS, SITE_ENDS = r"—|_|-|\|", r"(?:网|日报)$"


def page_title(title: Column, h1: Column) -> Column:
    """The title's first part, or its second if the first is a shorter site name; the heading if it is like it."""
    parts = F.split(title, TITLE_SEPARATORS)
    first, second = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    own = F.when(F.trim(first).rlike(SITE_ENDS) & (F.length(first) < F.length(second)), second).otherwise(first)
    return F.trim(F.when((h1 != "") & (F.coalesce(similarity(own, h1), F.lit(0.0)) > 0.6), h1).otherwise(own))


def link_texts(page: Column) -> Column:
    """Texts of the links of a page."""
    found = F.regexp_extract_all(page, F.lit(r"(?is)<a\s[^>]*>(.*?)</a>"), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"<[^>]*>", ""))


def body_text(page: Column) -> Column:
    body = F.regexp_replace(page, r"(?is)<(head|script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    return F.regexp_replace(body, r"<[^>]*>", "")


def link_share(page: Column) -> Column:
    """Bytes of link texts, of the bytes of the page's text without white space."""
    linked = F.octet_length(F.array_join(link_texts(page), ""))
    return F.try_divide(linked.cast("double"), F.octet_length(F.regexp_replace(body_text(page), r"\s+", "")))


def is_list_page(page: Column, share: float = 0.6) -> Column:
    return F.coalesce(link_share(page) > share, F.lit(False))


def link_density(page: Column) -> Column:
    """Characters in links, of all characters of the page's text."""
    linked = F.aggregate(link_texts(page), F.lit(0), lambda n, x: n + F.length(x))
    return linked.cast("double") / F.greatest(F.length(body_text(page)), F.lit(1))


def boosted(tokens: Column, hit, factor: float = 5.0) -> Column:
    """Weights of tokens: 1, times `factor` for each neighbour for which hit(token) holds."""
    n = F.size(tokens)

    def weight(_, i: Column) -> Column:
        near = lambda j: F.when((j >= 0) & (j < n) & hit(F.get(tokens, j)), F.lit(factor)).otherwise(F.lit(1.0))
        return near(i - 1) * near(i + 1)

    return F.transform(tokens, weight)


def after_label(tokens: Column, label: str) -> Column:
    """The token behind the first one that matches the label; '' if there is none."""
    at = F.array_position(F.transform(tokens, lambda t: t.rlike(label)), True)
    return F.when(at > 0, F.coalesce(F.get(tokens, at.cast("int")), F.lit(""))).otherwise(F.lit(""))


def context(text: Column, at: Column, before: int = 50, after: int = 66) -> Column:
    """Text around a place: from its start if that is near, to the end if that is."""
    start = F.when(at < 70, F.lit(0)).otherwise(at - before)
    end = F.when(at > F.length(text) - 87, F.length(text) - 1).otherwise(at + after)
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))
