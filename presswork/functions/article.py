"""Extraction of articles from pages: body, publish time, source, author and channel.

One Arrow-batched function parses a page once and returns a struct of all
fields. It is pure: no field's extraction changes what another sees.
"""

from __future__ import annotations

import datetime as dt
import html
import math
import re
from dataclasses import dataclass
from itertools import islice
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.arrow import arrow_function
from presswork.functions.dom import Element, parse

# Names of classes and ids, and how they count.
UNLIKELY = re.compile(r"combx|comment|community|disqus|extra|foot|header|menu|remark|rss|shoutbox|sidebar|sponsor|ad-break|agegate|pagination|pager|popup|tweet|twitter|copyright", re.I)
MAYBE = re.compile(r"and|article|body|column|main|shadow", re.I)
POSITIVE = re.compile(r"article|body|content|entry|hentry|main|page|pagination|post|text|blog|story", re.I)
NEGATIVE = re.compile(
    r"combx|comment|com-|contact|foot|footer|footnote|masthead|media|meta|outbrain|promo|related|scroll|shoutbox|sidebar|sponsor|shopping|tags|tool|widget|bdshare|bshare|jiathis|copyright|author|banquan|mzsm",
    re.I,
)
PRIOR = {"div": 5, "pre": 3, "td": 3, "blockquote": 3} | dict.fromkeys("address ol ul dl dd dt li form".split(), -3) | dict.fromkeys("h1 h2 h3 h4 h5 h6 th select".split(), -5)
MIN_TEXT, RETRY = 25, 25
HOLDS_BLOCK = frozenset("a blockquote dl div img ol p pre table ul".split())


def squeeze(s: str) -> str:
    return " ".join(s.split())


@dataclass(slots=True)
class Measure:
    """What is in an element: characters of its text with white space squeezed and trimmed, whether white space
    stands before and behind it, characters of its links' texts, commas of both kinds, and elements of some names."""

    text: int = 0
    before: bool = False
    behind: bool = False
    links: int = 0
    commas: int = 0
    wide: int = 0
    p: int = 0
    img: int = 0
    li: int = 0
    input: int = 0
    hidden: int = 0
    embed: int = 0

    @property
    def density(self) -> float:
        return self.links / max(self.text, 1)

    def append(self, text: int, before: bool, behind: bool) -> None:
        if not text:
            self.before, self.behind = self.before or (not self.text and before), self.behind or before
        elif not self.text:
            self.text, self.before, self.behind = text, self.before or before, behind
        else:
            self.text, self.behind = self.text + (self.behind or before) + text, behind


class Measures:
    """Measures of the elements of a tree that stays as it is: each is put together once, from those of its children."""

    def __init__(self) -> None:
        self.known: dict[Element, Measure] = {}

    def __call__(self, e: Element) -> Measure:
        if (m := self.known.get(e)) is None:
            m = self.known[e] = Measure()
            for c in e.children:
                if isinstance(c, str):
                    m.append(len(squeeze(c)), c[:1].isspace(), c[-1:].isspace())
                    m.commas += c.count(",")
                    m.wide += c.count("，")
                else:
                    x = self(c)
                    m.append(x.text, x.before, x.behind)
                    m.links += x.links + (x.text if c.tag == "a" else 0)
                    m.commas += x.commas
                    m.wide += x.wide
                    m.p += x.p + (c.tag == "p")
                    m.img += x.img + (c.tag == "img")
                    m.li += x.li + (c.tag == "li")
                    m.input += x.input + (c.tag == "input")
                    m.hidden += x.hidden + (c.tag == "input" and c.get("type") == "hidden")
                    m.embed += x.embed + (c.tag == "embed")
        return m


class Scorer:
    """Which element holds the article, by scores that paragraphs give to the elements around them."""

    def __init__(self, positive: str | None = None, negative: str | None = None, min_text: int = MIN_TEXT):
        self.liked, self.disliked = (re.compile(x, re.I) if x else None for x in (positive, negative))
        self.min_text = min_text

    def class_weight(self, e: Element) -> int:
        w = 0
        for name in filter(None, (e.get("class"), e.get("id"))):
            w += 25 * bool(POSITIVE.search(name)) - 25 * bool(NEGATIVE.search(name))
            w += 25 * bool(self.liked and self.liked.search(name)) - 25 * bool(self.disliked and self.disliked.search(name))
        return w

    def scores(self, root: Element, measures: Measures) -> dict[Element, float]:
        """Every paragraph's points go to its parent, and half of them to the
        grandparent; links take their share away."""
        out: dict[Element, float] = {}
        for e in root.find_all("p", "pre", "td"):
            m = measures(e)
            if m.text < self.min_text or e.parent is None:
                continue
            points = 2 + m.commas + m.wide + m.text // 25
            for holder, share in ((e.parent, 1), (e.parent.parent, 2)):
                if holder is not None:
                    out[holder] = out.get(holder, self.class_weight(holder) + PRIOR.get(holder.tag, 0)) + points / share
        return {e: s * (1 - measures(e).density) for e, s in out.items()}

    def article(self, root: Element) -> tuple[list[Element], dict]:
        """The best element and its siblings that go with it."""
        measures = Measures()
        scores = self.scores(root, measures)
        if not scores:
            return [], scores
        best = max(scores, key=scores.__getitem__)
        if best.parent is None:
            return [best], scores
        floor = max(10, 0.2 * scores[best])
        out = []
        for x in best.parent.elements():
            own = next((c for c in x.children if isinstance(c, str)), "") if x.children and isinstance(x.children[0], str) else ""
            density = measures(x).density if x.tag == "p" else 1.0
            if x is best or scores.get(x, -math.inf) >= floor or (len(own) > 80 and density < 0.25) or (len(own) <= 80 and density == 0 and re.search(r"\.( |$)", own)):
                out.append(x)
        return out, scores

    def unwanted(self, e: Element, scores: dict, m: Measure) -> bool:
        """Whether a table, list or division in the article isn't part of it."""
        weight = self.class_weight(e)
        if weight + scores.get(e, 0) < 0:
            return True
        if m.commas >= 10:
            return False
        return bool(
            (m.p and m.img > m.p)
            or (m.li - 100 > m.p and e.tag not in ("ul", "ol"))
            or m.input - m.hidden > m.p // 3
            or (m.text < self.min_text and (m.img == 0 or m.img > 2))
            or (weight < 25 and m.density > 0.2)
            or (weight >= 25 and m.density > 0.5)
            or (m.embed == 1 and m.text < 75)
            or m.embed > 1
        )


def _prepare(root: Element, ruthless: bool) -> None:
    for e in root.find_all("footer", "select", "script", "style", "noscript"):
        e.drop()
    for e in list(root.walk()):
        name = f"{e.get('class')} {e.get('id')}".strip()
        hidden = re.search(r"display\s*:\s*none", e.get("style"), re.I)
        if hidden or (ruthless and name and e.tag not in ("html", "body") and UNLIKELY.search(name) and not MAYBE.search(name)):
            e.drop()
    for e in root.find_all("div"):
        # text that stands loose in a division becomes a paragraph
        kids: list = []
        for c in e.children:
            if isinstance(c, str) and c.strip():
                kids.append(p := Element("p", parent=e))
                p.children.append(c)
            elif not (isinstance(c, Element) and c.tag == "br"):
                kids.append(c)
        if any(isinstance(c, Element) and c.tag in HOLDS_BLOCK for c in kids) or not any(isinstance(c, Element) and c.tag not in HOLDS_BLOCK for c in kids):
            e.children = kids


def _sanitized(parts: list[Element], scores: dict, scorer: Scorer) -> str:
    node = Element("#")
    for p in parts:
        if p.parent is not None:
            p.parent.children.remove(p)
        p.parent = node
        node.children.append(p)
    measures = Measures()
    for e in node.find_all("h1", "h2", "h3", "h4", "h5", "h6"):
        if scorer.class_weight(e) <= 0 or measures(e).density > 0.33:
            e.drop()
    for e in node.find_all("form", "iframe", "textarea"):
        e.drop()
    for tag in ("table", "ul", "div"):
        # from the end on, so that all in an element is decided before it is measured
        measures = Measures()
        for e in reversed(node.find_all(tag)):
            if e.parent is not None and scorer.unwanted(e, scores, measures(e)):
                e.drop()
    ended = False
    for e in node.find_all("p"):
        text = e.text().strip()
        head = text[:12]
        ended = ended or bool(re.search("版权说明|版权声明|免责声明", head)) or bool(re.search("说明|声明|注明", head) and re.search("转载|版权", text) and re.search("传播|授权|不代表", text))
        if ended:
            e.drop()
    return lines(node)


BREAKS = frozenset("p div br li tr h1 h2 h3 h4 h5 h6 blockquote pre table ul ol section article td".split())


def lines(node: Element) -> str:
    """Text with a line for each block."""
    out: list[str] = []

    def walk(e: Element) -> None:
        for c in e.children:
            if isinstance(c, str):
                out.append(re.sub(r"\s+", " ", c))
            else:
                if c.tag in BREAKS:
                    out.append("\n")
                walk(c)
                if c.tag in BREAKS:
                    out.append("\n")

    walk(node)
    return "\n".join(s for s in (x.strip() for x in "".join(out).split("\n")) if s)


def article_text(page: str | Element | None, retry_length: int = RETRY, **options) -> str:
    """The article as plain text; a text that is too short is looked for again with less thrown away.

    A page that was parsed, clean, stays as it is.
    """
    scorer = Scorer(**options)
    text = ""
    whole = page if isinstance(page, Element) else parse(page, clean=True)
    for ruthless in (True, False):
        root = whole.copy()
        _prepare(root, ruthless)
        parts, scores = scorer.article(root)
        if not parts:
            if ruthless:
                continue
            parts = [root.first("body") or root]
        text = _sanitized(parts, scores, scorer)
        if len(text.encode()) >= retry_length:
            break
    return text


# Publish time

_YEAR = r"(?:20\d\d|19[7-9]\d|[0-3]\d|9\d)"
DATE = re.compile(rf"({_YEAR})[-\s/.,、年]([01]?\d)[-\s/.,、月]([0-3]?\d)日?(?!\d)[\sT\xa0]{{0,3}}(?:([0-2]?\d):([0-5]?\d)(?::([0-5]?\d))?)?")
#: Words near a date, and how they weigh.
NEAR = (
    ("来源", 2.5), ("author", 2.2), ("post", 2.0), ("artical", 2.0), ("发布", 1.5), ("阅读", 1.5), ("发表", 1.5), ("date", 1.5), ("pub", 1.5), ("分享", 1.5),
    ("日期", 1.2), ("时间", 1.2), ("count", 1.2), ("Count", 1.2), ("星期", 1.2), ("time", 1.2), ("网", 1.2), ("评论", 1.2),
)
EARLY = (2, 2.5, 3, 3.5, 4, 4.5)


def dated(text: str, weight: float) -> list[tuple[float, int, dt.datetime]]:
    """(weight, place, time) of all dates in a text."""
    out = []
    for m in DATE.finditer(text):
        year = int(m[1]) + (0 if len(m[1]) == 4 else 1900 if m[1] > "69" else 2000)
        try:
            when = dt.datetime(year, int(m[2]), int(m[3]), *(int(x or 0) for x in m.groups()[3:]))
        except ValueError:
            continue
        at, w = m.start(), weight
        if at == 0:
            continue
        w *= 1.5 if re.match(r"\d{4}-\d{1,2}-", m[0]) else 1
        w *= 1.5 if "年" in m[0] else 1
        w *= 2.5 if (when.hour, when.minute, when.second) != (0, 0, 0) else 1
        w *= 1.2 ** sum(at < len(text) / d for d in EARLY)
        near = text[0 if at < 70 else at - 50 : len(text) - 1 if at > len(text) - 87 else at + 66]
        for word, factor in NEAR:
            w *= factor if word in near else 1
        out.append((w, at, when))
    return out


def publish_time(page: str | None, url: str | None = None) -> dt.datetime | None:
    """The local time of publication: the date that weighs most, page before address, earlier before later."""
    text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "", page or "")
    text = re.sub(r"\s{5}", " ", html.unescape(text).replace("\n\r", ""))
    found = dated(text, 10) + [(w, 1 << 40, t) for w, _, t in dated(f"-{url or ''}", 15)]
    return max(found, key=lambda x: (x[0], -x[1]))[2] if found else None


# Source and author

_TIMES = (
    re.compile(r"\d{1,4}\W\d{1,2}\W\d{1,2}\W?\s+\d{1,2}:\d{1,2}"),
    re.compile(r"\d{1,4}年\d{1,2}月\d{1,2}|\d{1,2}月\d{1,2}日?"),
    re.compile(r"\d{1,4}[-./]\d{1,2}[-./]\d{1,2}"),
)
#: How strings of a page begin, and then tokens around a headline, that say nothing about source or author.
NOISE_STRINGS = re.compile(r"\d+$|阅读$|分享|点击|发现$|扫一扫$|即可将网页分享至朋友圈|字号$|评论|·|摘要|正文$|关闭$|网友评论$|^条$")
NOISE_TOKENS = re.compile(r"^\d+$|阅读$|分享|点击|发现$|扫一扫$|即可将网页分享至朋友圈|字号$|评论|·|^中$|^小$|^大$|\||^次$|^收藏$")
SOURCE, AUTHOR, EDITOR, ENDS = re.compile("来源|来自|发布者"), re.compile("作者"), re.compile("编辑"), re.compile("(?:报|网)$")


def is_time(token: str) -> bool:
    return any(r.search(token) for r in _TIMES)


def credits(tokens: list[str]) -> tuple[str, str]:
    """(source, author) from the tokens around a headline.

    What follows a source or author label is it. Without a source label the token
    that weighs most is: neighbours of a date count five times, addresses ten,
    short names that end like a paper's or a site's twenty.
    """
    tokens = [t for t in tokens if t and not NOISE_TOKENS.match(t)]
    if not tokens:
        return "", ""
    kind = ["source" if SOURCE.search(t) and len(t) < 4 else "author" if AUTHOR.search(t) else "editor" if EDITOR.search(t) else "" for t in tokens]
    weight = [1.0] * len(tokens)
    for i, t in enumerate(tokens):
        if is_time(t):
            for j in (i - 1, i + 1):
                if 0 <= j < len(tokens):
                    weight[j] *= 5
        if kind[i] == "source" and i + 1 < len(tokens):
            weight[i + 1] *= 10
        weight[i] *= 10 if t.startswith(("http", "www.")) else 1
        weight[i] *= 20 if ENDS.search(t) and len(t) < 10 else 1

    def follows(label: str) -> str | None:
        if label not in kind:
            return None
        i = len(kind) - 1 - kind[::-1].index(label)
        return tokens[i + 1] if i + 1 < len(tokens) and not kind[i + 1] else ""

    author, source = follows("author") or "", follows("source")
    if source is None:
        best = max(range(len(tokens)), key=lambda i: (weight[i], -i))
        source = tokens[best] if weight[best] > 1 and not kind[best] and not is_time(tokens[best]) else ""
    if not author and len(tokens) == 3 and any(map(is_time, tokens)) and source and not kind[0] and tokens[0] != source and not is_time(tokens[0]):
        author = tokens[0]
    return source if len(source) <= 20 else "", author if len(author) <= 20 else ""


def source_author(root: Element, title: str, body: str) -> tuple[str, str]:
    """Looks between headline and text, else near a source label and a date, else after the headline, else around the date."""
    page = root.first("body") or root
    texts = [s for s in (squeeze(x) for x in page.strings()) if s and not NOISE_STRINGS.match(s)]
    at = lambda ok: next((i for i, t in enumerate(texts) if ok(t)), 0)
    head, label, date = at(lambda t: t == title), at(SOURCE.search), at(is_time)
    content = at(lambda t: len(t) > 5 and body.startswith(t) and t != title)
    if head and content:
        span = texts[head : max(content, label + 2)]
    elif label and date and abs(label - date) <= 3:
        span = texts[min(label, date) : max(label, date) + 2]
    elif head and date > head:
        span = texts[head : date + 3]
    elif date or label:
        span = texts[max(date or label, 2) - 2 : (date or label) + 3]
    else:
        return "", ""
    joined = " ".join(span).replace(title, " ") if title else " ".join(span)
    return credits(re.sub(r"[:：()（）]", " ", joined.replace("http:", "http@")).replace("http@", "http:").split())


# Breadcrumbs

#: What stands between levels, and labels that aren't levels.
BETWEEN = re.compile(r"(?:->|→|[>»›＞|—-])+")
NOT_LEVEL = re.compile("正文|文章内容|位置|more", re.I)
MOST_STRINGS, LONGEST = 8, 11


def _strings(e: Element, most: int = 2 * MOST_STRINGS) -> list[str]:
    """The first strings in an element that aren't blank."""
    return list(islice((x for s in e.strings() if (x := s.strip())), most))


def _trail(root: Element, url: str) -> Element | None:
    """The element with the breadcrumb: by separators, by the words for text, home and place, then the link before the date."""
    body = root.first("body") or root
    all_ = [body, *body.walk()]
    small = lambda e: 0 < len(_strings(e)) < MOST_STRINGS
    for e in all_:
        own = [c.strip() for c in e.children if isinstance(c, str) and c.strip()]
        if len(_strings(e)) < 2 * MOST_STRINGS and any(BETWEEN.fullmatch(s) or (BETWEEN.search(s) and len(s) < 25 and not re.search(r"\d-\d*", s)) for s in own) and e.find_all("a"):
            return e
    for word, most in (("正文", 4), ("首页", 4), ("位置", 8)):
        fits = []
        for e in all_:
            for s in (c.strip() for c in e.children if isinstance(c, str)):
                if word in s and len(s) < most:
                    holder = e if len(_strings(e)) > 1 else e.parent
                    if holder is not None and small(holder) and not re.search("顶部|字号", holder.text()):
                        fits.append(holder)
        if fits:
            return min(fits, key=lambda e: len(_strings(e)))
    last = None
    for e in all_:
        if e.tag == "a" and e.text().strip() and e.get("href"):
            last = e
        elif last is not None and len(_strings(e)) == 1 and len(_strings(e)[0]) < 25 and is_time(_strings(e)[0]):
            same = urlsplit(urljoin(url, last.get("href"))).netloc == urlsplit(url).netloc
            if same and len(squeeze(last.text())) < 15:
                holder = Element("div")
                holder.children.append(last)
                return holder
            return None
    return None


def breadcrumb(root: Element, url: str = "") -> list[dict]:
    """[{level, name, href}] from the outside in; links first, then what else stands in the trail."""
    trail = _trail(root, url)
    if trail is None:
        return []
    parts: list[tuple[str, str]] = []
    for a in trail.find_all("a"):
        if "href" in a.attrs:
            script = "javascript" in a.get("href")
            parts.append((squeeze(a.text()), "none" if script else urljoin(url, a.get("href").strip())))
    rest = "\n".join(s for s in _loose(trail) if s)
    parts += [(squeeze(x), "none") for piece in rest.split("\n") for x in BETWEEN.split(piece) if x.strip()]
    out = [{"level": i + 1, "name": n, "href": h} for i, (n, h) in enumerate(parts) if n and len(n) <= LONGEST and not NOT_LEVEL.search(n)]
    return [] if len(out) == 1 and re.fullmatch("评论|我的评论|收藏", out[0]["name"]) else out


def _loose(e: Element) -> list[str]:
    out = []
    for c in e.children:
        if isinstance(c, str):
            out.append(c.strip())
        elif not (c.tag == "a" and "href" in c.attrs):
            out += _loose(c)
    return out


def title_of(root: Element) -> str:
    t, h = (squeeze(e.text()) if (e := root.first(tag)) is not None else "" for tag in ("title", "h1"))
    parts = re.split(r"—|_|-|\|", t)
    own = parts[1] if len(parts) > 1 and re.search("(?:网|日报)$", parts[0].strip()) and len(parts[0]) < len(parts[1]) else parts[0]
    same = sum(a == b for a, b in zip(own, h))
    return (h if h and same / max(len(own), len(h)) > 0.6 else own).strip()


FIELDS = "title string, content string, source string, author string, published timestamp, channel string, breadcrumb array<struct<level:int,name:string,href:string>>"


@arrow_function(FIELDS, once=True)
def _extracted(page: pd.Series, url: pd.Series) -> pd.DataFrame:
    rows = []
    for p, u in zip(page, url):
        if p is None:
            rows.append((None, None, None, None, None, None, None))
            continue
        root = parse(p, clean=True)
        title, body = title_of(root), article_text(root)
        source, author = source_author(root, title, body)
        trail = breadcrumb(root, u or "")
        rows.append((title, body, source, author, publish_time(p, u), trail[-1]["name"] if trail else "", trail))
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in FIELDS.replace("array<struct<level:int,name:string,href:string>>", "x").split(", ")])
    out["published"] = pd.to_datetime(out["published"])
    return out


def extract(page: Column, url: Column) -> Column:
    """All fields of a page in one struct, from one parse; published is local time. A null page gives nulls."""
    return _extracted(page, url)
