"""URL functions: canonical forms, keys, resolution, ids and short keys.

Whatever Catalyst can express is a column expression; paths that are quoted anew
and links that are resolved against a page go through Arrow-batched functions.
"""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, quote, unquote_to_bytes, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.arrow import arrow_function

#: Fixed value: the digits of base 62, in order.
DIGITS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def is_fetchable(url: Column) -> Column:
    """Only http, https and ftp addresses are fetched; blanks around and case don't matter."""
    return F.coalesce(F.lower(F.trim(url)).rlike("^(https?|ftp)://"), F.lit(False))


def _split(url: Column) -> tuple[Column, Column, Column, Column]:
    """What stands before the query, whether there is one, the query, and the fragment with its #."""
    head, frag = F.regexp_extract(url, r"^([^#]*)", 1), F.regexp_extract(url, r"(#.*)$", 1)
    return F.regexp_extract(head, r"^([^?]*)", 1), F.instr(head, "?") > 0, F.regexp_extract(head, r"\?(.*)$", 1), frag


def _enc(x: Column) -> Column:
    """Form encoding with * and ~ escaped, which java.net leaves or escapes differently."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("~"), F.lit("%7E"))


def canonical_query(query: Column) -> Column:
    """Arguments in the order of (name, value), encoded anew; blank values stay, both & and ; separate."""
    parts = F.filter(F.split(F.replace(query, F.lit(";"), F.lit("&")), "&"), lambda p: p != "")

    def pair(p: Column) -> Column:
        at = F.instr(p, "=")
        name = F.when(at > 0, F.substring(p, F.lit(1), at - 1)).otherwise(p)
        value = F.when(at > 0, F.substring(p, at + 1, F.length(p))).otherwise(F.lit(""))
        return F.struct(F.try_url_decode(name).alias("k"), F.try_url_decode(value).alias("v"))

    pairs = F.array_sort(F.transform(parts, pair))
    return F.array_join(F.transform(pairs, lambda kv: F.concat(_enc(kv["k"]), F.lit("="), _enc(kv["v"]))), "&")


def canonical(url: Column, keep_fragment: bool = True) -> Column:
    """The address with its query in canonical order; all in Catalyst.

    Case of the host and the path are left alone. An empty fragment goes away, a
    missing one isn't added.
    """
    head, asked, query, frag = _split(url)
    q = canonical_query(query)
    tail = F.when(F.length(frag) > 1, frag).otherwise(F.lit("")) if keep_fragment else F.lit("")
    return F.concat(head, F.when(asked & (q != ""), F.concat(F.lit("?"), q)).otherwise(F.lit("")), tail)


def canonical_for_dedup(url: str | None) -> str | None:
    """The form that identifies a page: host in lower case, path quoted in one
    way, an empty path is /, arguments sorted, the fragment and a last # kept."""
    if url is None:
        return None
    parts = urlsplit(url)
    path = _requote(parts.path) or "/"
    query = urlencode(sorted(parse_qsl(parts.query.replace(";", "&"), keep_blank_values=True)))
    out = urlunsplit((parts.scheme, parts.netloc.lower(), path, query, parts.fragment))
    return out + "#" if url.endswith("#") and not out.endswith("#") else out


def _requote(path: str) -> str:
    """Quotes a path anew; an escaped / or ? stays escaped, for it isn't one."""
    parts = re.split("(%2[fF]|%3[fF])", path)
    return "".join(p.upper() if k % 2 else quote(unquote_to_bytes(p), safe="/:;=@&+$,!*'()~.-_") for k, p in enumerate(parts))


@arrow_function("string")
def dedup_url(url: pd.Series) -> pd.Series:
    return url.map(canonical_for_dedup, na_action="ignore")


def dedup_key(url: Column, salt: str = "") -> Column:
    return F.concat(F.lit(salt), url)


def url_hash(url: Column) -> Column:
    """Hex SHA-1 of a canonical address."""
    return F.sha1(url)


@arrow_function("string")
def resolve(url: pd.Series, page: pd.Series) -> pd.Series:
    """The address with sorted arguments, joined to the page's if it has no host."""

    def one(u: str | None, base: str | None) -> str | None:
        if u is None:
            return None
        parts = urlsplit(u)
        u = urlunsplit(parts._replace(query=urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))))
        return u if parts.netloc else urljoin(base or "", u)

    return pd.Series([one(u, b) for u, b in zip(url, page)], dtype="object")


def without_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^([^?#]*)", 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def joined(base: Column, address: Column) -> Column:
    """The address as it reads on a page at base, all in Catalyst.

    An address with a scheme stays; //host takes the page's scheme, /path its
    host, ?query its path and #part its address; any other stands in the page's
    folder. Steps . and .. are taken.
    """
    scheme, site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    own = F.regexp_extract(address, r"^([^?#]*)", 1)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_extract(path, r"^(.*/)", 1), own))
    full = F.when(full.startswith("/"), full).otherwise(F.concat(F.lit("/"), full))

    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    def plain(p: Column) -> Column:
        steps = F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), step)
        return F.concat(F.array_join(steps, "/"), F.when(p.rlike(r"(^|/)\.\.?$"), "/").otherwise(F.lit("")))

    full = F.when(full.rlike(r"(^|/)\.\.?(/|$)"), plain(full)).otherwise(full)
    rest = F.regexp_extract(address, r"([?#].*)$", 1)
    return (
        F.when(address.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), address)
        .when(address.startswith("//"), F.concat(scheme, address))
        .when(address == "", base)
        .when(address.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), address))
        .when(address.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), address))
        .otherwise(F.concat(site, full, rest))
    )


def post_id(url: Column, pattern: str) -> Column:
    """The number in a pattern's first group; null without one."""
    return F.expr("null").cast("long") if not pattern else F.nullif(F.regexp_extract(url, pattern, 1), F.lit("")).cast("long")


def base62(n: Column, width: int) -> Column:
    """n in base 62, padded with zeros to `width` digits, for n below 62 ** width."""
    digit = lambda k: F.substring(F.lit(DIGITS), (F.floor(n / (62**k)) % 62 + 1).cast("int"), F.lit(1))
    return F.concat(*[digit(k) for k in reversed(range(width))])


def _bare(text: Column, width: int) -> Column:
    """Without leading zeros, but for the last digit."""
    return F.regexp_replace(text, f"^0{{1,{width - 1}}}(?=.)", "") if width > 1 else text


def short_key(mid: Column) -> Column:
    """A numeric id in blocks of seven decimal digits from the right, each as
    four digits of base 62; the leading block isn't padded."""
    s = mid.cast("string")
    blocks = F.ceil(F.length(s) / 7).cast("int")
    lead = F.length(s) - (blocks - 1) * 7
    head = _bare(base62(F.substring(s, F.lit(1), lead).cast("long"), 5), 5)
    rest = F.when(
        blocks > 1,
        F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(blocks - 2, F.lit(0))), lambda i: base62(F.substring(s, lead + 1 + i * 7, F.lit(7)).cast("long"), 4)), ""),
    ).otherwise(F.lit(""))
    return F.concat(head, rest)


def _value62(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda acc, c: F.when(c == "", acc).otherwise(acc * 62 + F.instr(F.lit(DIGITS), c) - 1))


def from_short_key(key: Column) -> Column:
    """The id of a short key."""
    blocks = F.ceil(F.length(key) / 4).cast("int")
    lead = F.length(key) - (blocks - 1) * 4
    head = _value62(F.substring(key, F.lit(1), lead)).cast("string")
    rest = F.when(
        blocks > 1,
        F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(blocks - 2, F.lit(0))), lambda i: F.lpad(_value62(F.substring(key, lead + 1 + i * 4, F.lit(4))).cast("string"), 7, "0")), ""),
    ).otherwise(F.lit(""))
    return F.concat(head, rest).cast("long")
