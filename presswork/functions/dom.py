"""A small tree for lenient HTML, with a subset of XPath and CSS.

It lives inside Arrow-batched functions: Spark's xpath functions stop the job on
pages that aren't XML. Built on the standard library's tokenizer; ends that are
left out are implied, script and style hold raw text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F

from presswork.functions.arrow import arrow_function

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
P_ENDS_AT = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li td th tr".split())
SIBLINGS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
DEPTH = 250
#: Attributes that a cleaned page doesn't keep.
PRESENTATION = re.compile(r"(?:width|height|style|[-a-z]*color|background[-a-z]*|on\w*)$", re.I)


class Element:
    """An element; children are elements and strings."""

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Element | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Element | str] = []

    def get(self, name: str, default: str = "") -> str:
        return self.attrs.get(name, default)

    def elements(self) -> Iterator[Element]:
        return (c for c in self.children if isinstance(c, Element))

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def find_all(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags]

    def first(self, tag: str) -> Element | None:
        return next((e for e in self.walk() if e.tag == tag), None)

    def strings(self) -> Iterator[str]:
        todo = [iter(self.children)]
        while todo:
            for c in todo[-1]:
                if isinstance(c, str):
                    yield c
                else:
                    todo.append(iter(c.children))
                    break
            else:
                todo.pop()

    def text(self) -> str:
        return "".join(self.strings())

    def copy(self, parent: Element | None = None) -> Element:
        """The element and all below it, apart from the tree it stands in."""
        out = Element(self.tag, dict(self.attrs), parent)
        out.children = [c if isinstance(c, str) else c.copy(out) for c in self.children]
        return out

    def drop(self, with_tail: bool = False) -> None:
        """Takes the element out; the text behind it stays unless with_tail."""
        if self.parent is None:
            return
        at = self.parent.children.index(self)
        del self.parent.children[at]
        if with_tail and at < len(self.parent.children) and isinstance(self.parent.children[at], str):
            del self.parent.children[at]
        self.parent = None

    def html(self) -> str:
        attrs = "".join(f' {k}="{_escape(v, True)}"' for k, v in self.attrs.items())
        inner = "".join(c.html() if isinstance(c, Element) else c if self.tag in ("script", "style") else _escape(c) for c in self.children)
        return inner if self.tag == "#" else f"<{self.tag}{attrs}>" if self.tag in VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


def _escape(s: str, quotes: bool = False) -> str:
    s = s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return s.replace('"', "&quot;") if quotes else s


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.top = Element("#")
        self.depth = 0

    def _close_to(self, e: Element) -> None:
        self.top = e.parent or self.root
        self.depth = 0
        x = self.top
        while x is not self.root:
            self.depth, x = self.depth + 1, x.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in P_ENDS_AT:
            x = self.top
            while x is not self.root and x.tag not in P_ENDS_AT:
                x = x.parent
            if x.tag == "p":
                self._close_to(x)
        if tag in SIBLINGS:
            x = self.top
            same = {tag, "th" if tag == "td" else "td" if tag == "th" else "dd" if tag == "dt" else "dt" if tag == "dd" else tag}
            while x is not self.root and x.tag not in SIBLINGS[tag] and x.tag not in same:
                x = x.parent
            if x.tag in same:
                self._close_to(x)
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.top)
        self.top.children.append(e)
        if tag not in VOID and self.depth < DEPTH:
            self.top = e
            self.depth += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.top.tag == tag:
            self._close_to(self.top)

    def handle_endtag(self, tag: str) -> None:
        x = self.top
        while x is not self.root and x.tag != tag:
            x = x.parent
        if x is not self.root:
            self._close_to(x)

    def handle_data(self, data: str) -> None:
        if data:
            self.top.children.append(data)


def parse(page: str | None, clean: bool = False, base: str = "") -> Element:
    """The tree of a page, under an element named #; `clean` leaves scripts and styles out, `base` makes links absolute."""
    b = _Builder()
    b.feed(re.sub(r"^\s*<\?xml[^>]*\?>", "", page or ""))
    b.close()
    if clean:
        for e in b.root.find_all("script", "style", "noscript"):
            e.drop()
    if base:
        link = b.root.first("base")
        base = urljoin(base, link.get("href")) if link is not None and link.get("href") else base
        for e in b.root.walk():
            for k in ("href", "src"):
                if k in e.attrs:
                    e.attrs[k] = urljoin(base, e.attrs[k].strip())
    return b.root


def plain_attributes(root: Element) -> Element:
    """The tree without sizes, colours, styles and handlers."""
    for e in root.walk():
        e.attrs = {k: v for k, v in e.attrs.items() if not PRESENTATION.match(k)}
    return root


# XPath: steps by / and //, names and *, [n], [@a], [@a="v"], [contains(@a, "v")], [contains(text(), "v")], then text(), //text() or @a; | joins.

_STEP = re.compile(r"(//?|^)(text\(\)|[\w*-]+|\.|@[\w-]+)((?:\[[^\]]*\])*)")
_TEST = re.compile(r"""^(?:(\d+)|@([\w-]+)|@([\w-]+)\s*=\s*["'](.*)["']|contains\(\s*(@[\w-]+|text\(\)|\.)\s*,\s*["'](.*)["']\s*\)|text\(\)\s*=\s*["'](.*)["'])$""")


def relative(path: str) -> str:
    """An absolute path as one from the current element, in every part of a union."""
    return "|".join("." + p if p.startswith("/") else p for p in (x.strip() for x in path.split("|")))


def _passes(e: Element, at: int, test: str) -> bool:
    m = _TEST.match(test.strip())
    if not m:
        raise ValueError(f"not understood: [{test}]")
    if m[1]:
        return at == int(m[1])
    if m[2]:
        return m[2] in e.attrs
    if m[3]:
        return e.attrs.get(m[3]) == m[4]
    if m[5]:
        own = e.get(m[5][1:]) if m[5][0] == "@" else e.text() if m[5] == "." else "".join(c for c in e.children if isinstance(c, str))
        return m[6] in own
    return m[7] in [c for c in e.children if isinstance(c, str)]


def _one_path(root: Element, path: str) -> list:
    here: list = [root]
    at = 0
    path = path.removeprefix("./").join(("/", "")) if path.startswith("./") and not path.startswith(".//") else path.removeprefix(".")
    path = path if path.startswith("/") else "/" + path
    while at < len(path):
        m = _STEP.match(path, at)
        if not m or m.end() == at:
            raise ValueError(f"not understood: {path[at:]}")
        axis, name, tests = m[1], m[2], re.findall(r"\[([^\]]*)\]", m[3])
        out: list = []
        for e in (x for x in here if isinstance(x, Element)):
            if name == "text()":
                out += list(e.strings()) if axis == "//" else [c for c in e.children if isinstance(c, str)]
            elif name[0] == "@":
                out += [x.attrs[name[1:]] for x in ([e, *e.walk()] if axis == "//" else [e]) if name[1:] in x.attrs]
            elif name == ".":
                out.append(e)
            else:
                places: dict[int, int] = {}
                for x in e.walk() if axis == "//" else e.elements():
                    if name in ("*", x.tag):
                        places[id(x.parent)] = n = places.get(id(x.parent), 0) + 1
                        if all(_passes(x, n, t) for t in tests):
                            out.append(x)
        seen: set = set()
        here = [x for x in out if isinstance(x, str) or not (id(x) in seen or seen.add(id(x)))]
        at = m.end()
    return here


def xpath(root: Element, path: str) -> list:
    """Elements and strings that the path finds, in order; a path that isn't understood finds none."""
    try:
        return [x for p in relative(path).split("|") for x in _one_path(root, p)]
    except ValueError:
        return []


def css_to_xpath(selector: str) -> str:
    """Names, .class, #id, [a], [a=v], descendants and > children; commas join."""
    out = []
    for part in selector.split(","):
        path, axis = "", "//"
        for token in re.findall(r">|[^\s>]+", part):
            if token == ">":
                axis = "/"
                continue
            name = re.match(r"[\w*-]*", token)[0] or "*"
            tests = "".join(
                f'[contains(@class, "{c}")]' if c else f'[@id="{i}"]' if i else f'[@{a}="{v}"]' if v is not None and v != "" else f"[@{a}]"
                for c, i, a, v in re.findall(r"""\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:=["']?([^\]"']*)["']?)?\]""", token)
            )
            path += axis + name + tests
            axis = "//"
        out.append(path)
    return "|".join(out)


def css(root: Element, selector: str) -> list:
    return xpath(root, css_to_xpath(selector))


def as_text(x) -> str:
    return x if isinstance(x, str) else x.text()


def xpath_all(path: str):
    """A column function: texts of all that the path finds in a page."""

    @arrow_function("array<string>")
    def run(page: pd.Series) -> pd.Series:
        return page.map(lambda p: None if p is None else [as_text(x) for x in xpath(parse(p), path)])

    return run


def css_all(selector: str):
    return xpath_all(css_to_xpath(selector))


def xpath_first(path: str, default: str = ""):
    """A column function: text of the first that the path finds, or the default."""

    @arrow_function("string")
    def run(page: pd.Series) -> pd.Series:
        return page.map(lambda p: None if p is None else next((as_text(x) for x in xpath(parse(p), path)), default))

    return run


def css_first(selector: str, default: str = ""):
    return xpath_first(css_to_xpath(selector), default)


def without(path: str, with_tail: bool = False):
    """A column function: the page's HTML without what the path finds."""

    @arrow_function("string")
    def run(page: pd.Series) -> pd.Series:
        def one(p: str | None) -> str | None:
            if p is None:
                return None
            root = parse(p)
            for e in xpath(root, path):
                if isinstance(e, Element):
                    e.drop(with_tail)
            return root.html()

        return page.map(one)

    return run


@arrow_function("string")
def cleaned_html(page: pd.Series) -> pd.Series:
    """The page without scripts, styles and presentational attributes."""
    return page.map(lambda p: None if p is None else plain_attributes(parse(p, clean=True)).html())


@arrow_function("array<string>")
def absolute_links(page: pd.Series, url: pd.Series) -> pd.Series:
    """Addresses of links and frames that are or become absolute, each once."""

    def one(p: str | None, u: str | None) -> list[str] | None:
        if p is None:
            return None
        root = parse(p, base=u or "")
        found = [e.get("href") if e.tag == "a" else e.get("src") for e in root.find_all("a", "iframe")]
        return list(dict.fromkeys(x for x in found if "http" in x))

    return pd.Series([one(p, u) for p, u in zip(page, url)], dtype="object")
