"""Main text of pages by wrapper induction.

Pages of one host are made from a few templates. Their trees are aligned by
simple tree matching: the roots must agree, and children are matched in order so
that most nodes agree, those that are equal before those of one shape, and these
before those of one name. Aligned text that stays the same from page to page
belongs to the template; text that varies fills a slot. A host's template is
folded page by page: each task folds the pages it reads, the partial templates
of a host are folded again, first in salted groups and then in one, so that a
host with a third of all pages needs no more than its share. All pages and all
their nodes count, and nothing that decides is left out: a node's texts are
counted in a sketch that knows how far it may be short, and children that few
pages have stay, unless a template gets too large for them. Where either could
change a decision, all pages of the host are aligned with its template once more
and counted exactly, outside of it: by the template's node, or, for what has
none there, by the labels that lead to it.

A page's content is the smallest element that holds nearly all text of slots
that isn't links, without what the template holds. Where a host has too few
pages for a template, elements that are named article or main come first.

Slots alone can't tell an article from a comment or an advert, since both vary;
so names of elements, roles and classes mark menus, adverts, forms, notices and
comments, which are left out.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import Scratch, sliced

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end may be left out, and what closes them.
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
#: How far up an unclosed element is looked for.
FENCE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
CLOSES_P = BLOCK - {"body", "html", "title", "legend", "option", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes"}
DROP = {"head", "script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "nav", "menu", "footer", "aside", "form", "button", "select", "option", "input", "object", "embed", "canvas", "audio", "video", "noembed", "noframes"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "tablist", "status"}


def _words(names: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{names})(?:$|[\s_-])", re.I)


#: Words of classes and ids that mark what is not the article, wherever it stands.
NOISE = _words(
    r"ads?|advert\w*|adsense|adslot|adbox|banner|sponsor\w*|promo\w*|promoted|nav|navbar|navigation|menu\w*|breadcrumbs?|crumbs?|masthead|topbar|sidebar\w*|"
    r"comments?|commentlist|comment-?\w*|disqus\w*|replies|reply|discussion|respond|cookies?|consent|gdpr|notices?|notification\w*|alert\w*|popup|modal|overlay|newsletter|subscribe|subscription|signup|sign-up|"
    r"login|share|sharing|social\w*|related\w*|recommend\w*|pagination|pager|paging|toolbar|skip\w*|tagcloud"
)
#: Words that mark parts of a page's frame; inside an article they may be its own, and then slots decide.
FRAME = _words(r"header|footer|foot|side|rail|widget\w*|aside|search\w*|copyright|legal|disclaimer|tags?")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>|</[^a-zA-Z][^>]*+>", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/>"']+)""")
#: Words that, as parts of a longer name inside an article, leave it noise; with any other word beside it (related-work) the element's
#: own links decide, and so they do for a word that an article has, too.
BESIDE = re.compile(r"(?:box|slot|wrap|wrapper|container|list|items?|section|block|area|inner|outer|content|bar|links?|buttons?|btn|icons?|posts?|articles?|stories|top|bottom|left|right|unit|widget\w*|form|text|title|\d+)$", re.I)
SHARED = re.compile(r"discussion$|related$|social$|alert\w*$|notices?$", re.I)
#: Elements that are nested deeper are laid flat, but for one around what names call noise, which keeps it together.
DEPTH = 300
#: A template node that holds the counts of twice so many texts goes back to so many; a text's count is then short by at most
#: what is counted as SHORT, a part of TEXTS + 1 of the node's pages or less.
TEXTS, SHORT = 256, ""
#: A template of more than twice so many nodes leaves children to a count of their own that fewer than this share of a node's pages have, of LEAST_PAGES or more.
HOLD, RARE, LEAST_PAGES = 2048, 0.02, 100
#: A task gives its partial templates away after so many nodes of pages, or so many hosts.
LOAD, HOSTS = 300_000, 2000
#: A text is template if it is the same in this share of at least LEAST aligned pages.
CONSTANT, LEAST = 0.8, 4
#: If what the template holds of a page's content is so many times what its slots hold, the host's pages are copies, and it is content.
COPIES = 3
#: The content is the smallest element with this share of the text that may be content.
NEARLY = 0.8
SALTS = 64
#: Hosts with this part of all pages or more are large; so are at most as many hosts, with templates of at most LARGE_BYTES each.
LARGE, LARGE_BYTES = 1000, 1 << 16


class Node:
    """An element: children are elements and strings. `blocks` says whether a line's element holds a block, `drop` and
    `same` what is left out: all of it, or its own lines."""

    __slots__ = ("tag", "attrs", "children", "parent", "blocks", "drop", "same", "form", "mass")

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent
        self.blocks = self.drop = self.same = False

    def elements(self) -> list[Node]:
        """The elements that are aligned: all but those of a line and those without text."""
        return [c for c in self.children if isinstance(c, Node) and c.tag not in RAW and c.tag != "head" and (c.blocks or c.tag not in INLINE)]


def parse(page: str) -> Node:
    """A tree of the page: elements, and strings for text. Ends that are left out
    are implied, ends without a start are ignored, everything still open at the
    end is closed."""
    root = Node("#")
    top, at, size, deep, flat = root, 0, len(page), 0, 0
    held: tuple[Node, int] | None = None  # an element of noise below DEPTH, and what was laid flat around it

    def text(s: str) -> None:
        if s:
            top.children.append(html.unescape(s))

    ends = page.rfind(">")  # no tag ends behind it
    while at < size:
        m = _TOKEN.search(page, at) if at <= ends or page.find("<!", at) >= 0 else None
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            top.children.append(m[0][9:].removesuffix("]]>"))
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1] and flat:
            flat -= 1
            continue
        if m[1]:
            x = top
            while x is not root and x.tag != tag and not (tag not in BLOCK and x.tag in ("td", "th", "article", "main", "section", "body")):
                x = x.parent
            if x is not root and x.tag == tag:
                top = x.parent
                if held and x is held[0]:
                    flat, held = held[1], None
            continue
        if tag in CLOSES_P:
            x = top
            while x is not root and x.tag != "p" and x.tag not in BLOCK:
                x = x.parent
            if x.tag == "p":
                top = x.parent
        if tag in CLOSES:
            x, last = top, None
            while x is not root and x.tag not in FENCE[tag]:
                if x.tag in CLOSES[tag]:
                    last = x
                    if tag not in ("tbody", "tfoot", "tr"):
                        break
                x = x.parent
            if last is not None:
                top = last.parent
        attrs = {}
        for a in _ATTR.finditer(m[3]):
            attrs.setdefault((a[1] or a[5]).lower(), html.unescape(a[2] or a[3] or a[4] or ""))
        node = Node(tag, attrs, top)
        top.children.append(node)
        if tag not in INLINE:
            x = top
            while x.tag in INLINE and not x.blocks:
                x.blocks, x = True, x.parent
        if tag in VOID or (m[3].endswith("/") and tag not in BLOCK and tag not in RAW):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|$(?![\s\S])", re.I).search(page, at)
            inner = page[at : end.start()] if end else page[at:]
            if inner and tag in ("title", "textarea"):
                node.children.append(html.unescape(inner))
            at = end.end() if end else size
            continue
        deep, x = 0, node
        while x is not root:
            deep, x = deep + 1, x.parent
        if deep < DEPTH:
            top, held = node, None
        elif held is None and tag not in INLINE and noisy(node, True):
            top, held, flat = node, (node, flat), 0
        else:  # the element stays empty, and what it holds stands behind it
            flat += 1
    return root


def squeeze(s: str) -> str:
    return " ".join(s.split())


def label(node: Node) -> str:
    """What must agree for two nodes to be aligned: element, role and classes."""
    a = node.attrs
    return node.tag if not ("class" in a or "role" in a) else f"{node.tag}.{a.get('class', '')}.{a.get('role', '')}"


def line(node: Node) -> Iterator[str]:
    """The node's own text, with that of elements in the line."""
    for c in node.children:
        if isinstance(c, str):
            yield c
        elif c.tag in INLINE and not c.blocks:
            yield from line(c)


def _digest(s: str) -> str:
    return blake2b(s.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


def shape(node: Node) -> list:
    """[label, pages, texts, children, wholes] of a page. texts counts digests of the node's own text, wholes those of all
    that is in it; the nodes get their shapes as `form`."""
    own = squeeze("".join(line(node)))
    kids = [shape(c) for c in node.elements()]
    texts = {_digest(own): 1} if own else {}
    inner = [x for k in kids for x in (k[4] or k[2])]
    wholes = {_digest(" ".join([*texts, *inner])): 1} if inner else {}
    node.form = [label(node), 1, texts, kids, wholes]
    return node.form


#: Bits that the programme for a common subsequence holds at once, 16 MB; longer lists are halved.
TABLE_BITS = 1 << 27


def _lengths(x: list, y: list) -> np.ndarray:
    """Lengths of the longest common subsequences of y with the first 0, 1, ... of x."""
    at: dict = {}
    for i, k in enumerate(x):
        at[k] = at.get(k, 0) | 1 << i
    full = v = (1 << len(x)) - 1
    for k in y:
        u = v & at.get(k, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(x) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(x)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common(x: list, y: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence; None equals nothing.

    Equal ends are taken first. What is between goes through a programme over
    bits of a number, whose rows are kept; lists too long for that are cut where
    the lengths of both halves add up to the most, which takes the memory of a row.
    """
    head = 0
    while head < len(x) and head < len(y) and x[head] == y[head] and x[head] is not None:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail] and x[-1 - tail] is not None:
        tail += 1
    ends = [(i, i) for i in range(head)], [(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]
    x, y = x[head : len(x) - tail], y[head : len(y) - tail]
    both = set(x) & set(y) - {None}
    if not both:
        return ends[0] + ends[1]
    p, q = ([i for i, k in enumerate(z) if k in both] for z in (x, y))  # what has no equal is left out
    x, y = [x[i] for i in p], [y[j] for j in q]
    if (len(x) + 64) * len(y) <= TABLE_BITS or len(y) < 2:
        found = _programme(x, y)
    else:
        half = len(y) // 2
        cut = int(np.argmax(_lengths(x, y[:half]) + _lengths(x[::-1], y[half:][::-1])[::-1]))
        found = common(x[:cut], y[:half]) + [(i + cut, j + half) for i, j in common(x[cut:], y[half:])]
    return ends[0] + [(p[i] + head, q[j] + head) for i, j in found] + ends[1]


def _programme(x: list, y: list) -> list[tuple[int, int]]:
    n = len(x)
    at: dict = {}
    for i, k in enumerate(x):
        at[k] = at.get(k, 0) | 1 << i
    full = (1 << n) - 1
    v, rows = full, []
    for k in y:
        u = v & at.get(k, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    i, j, out = n, len(y), []
    while i and j:
        bit = 1 << (i - 1)
        if rows[j - 1] & bit:
            i -= 1
        else:
            j -= 1
            if not (j and not rows[j - 1] & bit):
                i -= 1
                out.append((i, j))
    return out[::-1]


class Counts(dict):
    """Counts of digests that only grow, and their largest, (count, digest), as `top`."""

    __slots__ = ("top",)

    def __init__(self, counts: dict):
        super().__init__(counts)
        self.top = max(((v, k) for k, v in counts.items() if k), default=None)

    def add(self, counts: dict, texts: int = TEXTS) -> Counts:
        """Beyond twice `texts` digests, all lose the largest count that is left out."""
        for k, v in counts.items():
            self[k] = v = self.get(k, 0) + v
            if k and (self.top is None or (v, k) > self.top):
                self.top = (v, k)
        if len(self) > 2 * texts + 1:
            short = self.pop(SHORT, 0)
            floor = sorted(self.values(), reverse=True)[texts]
            left = {k: v - floor for k, v in self.items() if v > floor} | {SHORT: short + floor}
            self.clear()
            self.update(left)
            self.top = max(((v, k) for k, v in left.items() if k), default=None)
        return self


def _most(counts: dict, pages: int) -> str | None:
    """The digest that half of the pages have, if one has."""
    if pages == 1 or not counts:
        return next(iter(counts), None)
    top = counts.top if type(counts) is Counts else max(((v, k) for k, v in counts.items() if k), default=None)
    return top[1] if top and 2 * top[0] >= pages else None


def _whole(t: list):
    return _most(t[4] or t[2], t[1])


def _build(t: list) -> tuple:
    """The label, and those of the children that half of the pages have."""
    return t[0], frozenset([k[0] for k in t[3] if 2 * k[1] >= t[1]] if t[3] else ())


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of children of two nodes, in order, matched by simple tree matching.

    A pairing counts the nodes that agree, in three grades: first children that
    are equal with all they hold, then between these such as are built alike,
    then such as have one label. Each grade is a longest common subsequence.
    """
    out: list[tuple[int, int]] = []

    def between(i: int, i2: int, j: int, j2: int, grade: int) -> None:
        if i == i2 or j == j2:
            return
        if grade == 3:
            return
        key = (_whole, _build, lambda t: t[0])[grade]
        pairs = [(i + p, j + q) for p, q in common([key(t) for t in a[i:i2]], [key(t) for t in b[j:j2]])]
        if grade == 0:
            pairs = [(p, q) for p, q in pairs if a[p][0] == b[q][0]]
        for p, q in [*pairs, (i2, j2)]:
            between(i, p, j, q, grade + 1)
            if p < i2 or q < j2:
                out.append((p, q))
            i, j = p + 1, q + 1

    between(0, len(a), 0, len(b), 0)
    return out


def counted(x: dict, y: dict) -> dict:
    """The sum of two counts."""
    return Counts(x).add(y)


def merge(a: list, b: list, texts: int = TEXTS) -> list:
    """fold() in place: a becomes the template, and parts of b are in it."""
    a[1] += b[1]
    for n in (2, 4):
        if b[n]:
            if type(a[n]) is not Counts:
                a[n] = Counts(a[n])
            a[n].add(b[n], texts)
    x, y = a[3], b[3]
    if not x or not y:
        a[3] = x or y
        return a
    pairs = align(x, y)
    for i, j in pairs:
        merge(x[i], y[j], texts)
    if len(pairs) < len(y):
        kids, i2, j2 = [], 0, 0
        for i, j in [*pairs, (len(x), len(y))]:
            kids += x[i2:i]
            kids += y[j2:j]
            kids += x[i : i + 1]
            i2, j2 = i + 1, j + 1
        a[3] = kids
    return a


def fold(a: list, b: list) -> list:
    """The template of two templates with equal roots; counts add up, children of either alone stay."""

    def copy(t: list) -> list:
        return [t[0], t[1], dict(t[2]), [copy(k) for k in t[3]], dict(t[4])]

    return merge(copy(a), copy(b))


def _size(t: list) -> int:
    return 1 + sum(map(_size, t[3]))


def _path(path: str, kid: list) -> str:
    """Names a child by the labels that lead to it."""
    return _digest(f"{path}/{kid[0]}")


def shed(t: list) -> bool:
    """Takes out the children that a rare part of their node's pages have, and says whether there were such."""
    kids = [k for k in t[3] if t[1] < LEAST_PAGES or k[1] >= RARE * t[1]]
    some, t[3] = len(kids) < len(t[3]), kids
    return any([some, *map(shed, kids)])


def _varies(t: list) -> bool:
    return bool(t[2]) and not any(k and v >= CONSTANT * t[1] for k, v in t[2].items())


def settled(t: list, unsure: list | None = None, most: int = 0) -> list:
    """The template with what decides alone: texts that are constant, for alignment the digest that half of the pages have,
    children that LEAST pages have or half of them, and whether the text varies.

    most is the largest count of pages of a sibling with the same label and a text that varies: these were told apart by their
    texts, so that a paragraph which some articles share is no template for being the same where it is the same. unsure gets
    the nodes of which the sketch can't say whether their text is constant.
    """
    least, short = max(LEAST, CONSTANT * max(t[1], most)), t[2].get(SHORT, 0)
    if unsure is not None and short and any(k and v < least <= v + short for k, v in t[2].items()):
        unsure.append(t)
    digest, labels = _whole(t), {}
    for k in t[3]:
        if _varies(k):
            labels[k[0]] = max(labels.get(k[0], 0), k[1])
    kids = [settled(k, unsure, labels.get(k[0], 0)) for k in t[3] if k[1] >= LEAST or 2 * k[1] >= t[1]]
    return [t[0], t[1], {k: v for k, v in t[2].items() if k and v >= least}, kids, {digest: t[1]} if digest else {SHORT: 0}, int(_varies(t))]


def complete(tree: list, apart: dict[str, list]) -> list:
    """A settled template with what is counted apart, by its path, as its last part; there, too, a text isn't constant for
    being told apart from such as vary."""
    pages: dict[str, int] = {}

    def walk(t: list, path: str) -> None:
        if t[5]:
            pages[path] = max(pages.get(path, 0), t[1])
        for k in t[3]:
            walk(k, _path(path, k))

    if apart:
        walk(tree, "")
    for path, t in apart.items():
        t[2] = {k: v for k, v in t[2].items() if v >= CONSTANT * pages.get(path, 0)}
    return [*tree, {path: t for path, t in apart.items() if t[2]}]


def numbered(t: list) -> list:
    """The nodes of a settled template, each with its place among them as its last part."""
    nodes = [t]
    for n, x in enumerate(nodes):
        x.append(n)
        nodes += x[3]
    return nodes


def exact(tree: list, counts: dict[str, tuple[int, dict]]) -> list:
    """A complete template of a settled one and exact counts: pages, and constant texts, of its nodes and of paths that have none there."""
    nodes = numbered(tree)
    for x in nodes:
        n, texts = counts.pop(f"#{x.pop()}", (0, {}))
        x[1], x[2], x[5] = n or x[1], texts, int(n > 0 and not texts)
    for x in nodes:
        most: dict = {}
        for k in x[3]:
            if k[5]:
                most[k[0]] = max(most.get(k[0], 0), k[1])
        for k in x[3]:
            k[2] = {d: v for d, v in k[2].items() if v >= CONSTANT * most.get(k[0], 0)}
    return complete(tree, {path: ["", n, texts, [], {}, 0] for path, (n, texts) in counts.items()})


def packed(template: list) -> bytes:
    return zlib.compress(json.dumps(template, separators=(",", ":")).encode(), 6)


def unpacked(raw: bytes) -> list:
    return json.loads(zlib.decompress(raw))


def _host(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]*)", url or "")
    return m[1].rpartition("@")[2].lower() if m else ""


KIND = "host string, template binary, pages long, open boolean"


def _rows(held: dict[str, list], open_: set | frozenset = frozenset()) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array([packed(t) for t in held.values()], pa.binary()), pa.array([t[1] for t in held.values()], pa.int64()), pa.array([h in open_ for h in held], pa.bool_())],
        ["host", "template", "pages", "open"],
    )


def _inducing(texts: int, hold: int):
    """Partial templates of a task's pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        open_, load = set(), 0
        for batch in batches:
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t, h = shape(parse(page or "")), _host(url)
                load += _size(t)
                held[h] = t = merge(held[h], t, texts) if h in held else t
                if not t[1] % LEAST_PAGES and _size(t) > 2 * hold and shed(t):
                    open_.add(h)
                if load > LOAD or len(held) > HOSTS:
                    yield _rows(held, open_)
                    held, open_, load = {}, set(), 0
        if held:
            yield _rows(held, open_)

    return run


def _folding(texts: int, hold: int, last: bool):
    """Partial templates that arrive host by host become one a host; the last fold keeps what decides."""

    def row(host: str, t: list, open_: bool) -> pa.RecordBatch:
        if last:
            unsure: list = []
            t = settled(t, unsure)
            open_ = open_ or bool(unsure)
            t = t if open_ else complete(t, {})
        elif _size(t) > 2 * hold:
            open_ = shed(t) or open_
        return _rows({host: t}, {host} if open_ else set())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, t, open_ = None, None, False
        for batch in batches:
            for h, raw, o in zip(*(batch.column(n).to_pylist() for n in range(3))):
                if t is not None and h == host:
                    t, open_ = merge(t, unpacked(raw), texts), open_ or o
                else:
                    if t is not None:
                        yield row(host, t, open_)
                    host, t, open_ = h, unpacked(raw), o
        if t is not None:
            yield row(host, t, open_)

    return run


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, node, digest, n): pages that have the text at a template's node, or at a path that has none; without a digest, that have the node."""
    counts: dict[tuple, int] = {}
    seen: dict[bytes, list] = {}

    def rows() -> pa.RecordBatch:
        columns = list(zip(*counts)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(list(counts.values()), pa.int64())], ["host", "node", "digest", "n"])

    for batch in sliced(batches, 100):
        for url, page, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if raw not in seen:
                if len(seen) > 200:
                    seen.clear()
                seen[raw] = unpacked(raw)
                numbered(seen[raw])
            root, h = parse(page or ""), _host(url)
            shape(root)
            found: set[tuple[str, str]] = set()
            mark(root, seen[raw], found=found)
            for at, digest in found:
                counts[h, at, digest] = counts.get((h, at, digest), 0) + 1
        if len(counts) > LOAD:
            yield rows()
            counts.clear()
    yield rows()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 10):
        for host, raw, pages, nodes in zip(*(batch.column(n).to_pylist() for n in range(4))):
            t = unpacked(raw)
            t = exact(t, {x["node"]: (x["pages"], {y["digest"]: y["n"] for y in x["texts"]}) for x in nodes or ()})
            t[1] = pages
            yield _rows({host: t})


def templates(scratch: Scratch, pages: DataFrame, texts: int = TEXTS, hold: int = HOLD) -> DataFrame:
    """(host, template, pages) of all hosts of pages(page_id, url, html). Pages are only moved where hosts are too small or
    templates too large to go to all tasks, and counts are open."""

    def folded(df: DataFrame, *by: str, last: bool) -> DataFrame:
        return df.repartition(*by).sortWithinPartitions(*by, "template").select("host", "template", "open").mapInArrow(_folding(texts, hold, last), KIND)

    part = scratch.cut(pages.select("url", "html").mapInArrow(_inducing(texts, hold), KIND), "partial")
    part = part.withColumn("salt", F.pmod(F.xxhash64("template"), F.lit(SALTS)))
    part = scratch.cut(folded(part, "host", "salt", last=False), "salted")
    made = scratch.cut(folded(part, "host", last=True), "templates")
    sure, open_ = made.where("not open"), made.where("open")
    if open_.isEmpty():
        return sure.drop("open")
    counts = _with_templates(pages, open_, "inner").mapInArrow(_counting, "host string, node string, digest string, n long")
    counts = scratch.cut(counts.groupBy("host", "node", "digest").agg(F.sum("n").alias("n")), "counts")
    of = counts.where("digest = ''").select("host", "node", F.col("n").alias("pages"))
    constant_ = F.when(F.col("n") >= F.greatest(F.lit(float(LEAST)), CONSTANT * F.col("pages")), F.struct("digest", "n"))
    nodes = counts.where("digest <> ''").join(of, ["host", "node"]).groupBy("host", "node", "pages").agg(F.collect_list(constant_).alias("texts"))
    nodes = nodes.where("node like '#%' or size(texts) > 0").groupBy("host").agg(F.collect_list(F.struct("node", "pages", "texts")).alias("nodes"))
    done = open_.join(nodes, "host", "left").select("host", "template", "pages", "nodes").mapInArrow(_counted, KIND)
    return sure.unionByName(scratch.cut(done, "counted")).drop("open")


def _with_templates(pages: DataFrame, made: DataFrame, far: str) -> DataFrame:
    """(page_id, url, html, template) of pages that have a template; of all pages, if far is left and not inner."""
    made = made.withColumnRenamed("host", "_host")
    host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]*)", 1), "^.*@", ""))
    total = made.agg(F.sum("pages")).first()[0] or 0
    # At most LARGE hosts have so many pages each; their templates go to all tasks, and their pages stay where they are.
    large = (F.col("pages") * LARGE >= total) & (F.octet_length("template") <= LARGE_BYTES)
    all_, hot = pages.select("page_id", "url", "html", host.alias("_h")), F.broadcast(made.where(large))
    near = all_.join(hot, F.col("_h") == F.col("_host"))
    rest = all_.join(hot, F.col("_h") == F.col("_host"), "left_anti").join(made.where(~large), F.col("_h") == F.col("_host"), far)
    return near.unionByName(rest).select("page_id", "url", "html", "template")


def _holds(node: Node, tags: tuple) -> bool:
    return any(isinstance(c, Node) and (c.tag in tags or _holds(c, tags)) for c in node.children)


def noisy(node: Node, inside: bool) -> bool:
    """Whether an element's name, role or classes say that it isn't the article; what holds an article or its heading is
    spared for its classes. inside: in an element that is named article or main."""
    a = node.attrs
    if node.tag in DROP or "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or (node.tag == "dialog" and "open" not in a):
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if node.tag == "header" and not (inside and _holds(node, ("h1", "h2"))):
        return True
    if node.tag in ("html", "body", "main") or not ("class" in a or "id" in a):
        return False
    names = re.sub(r"(?:^|(?<=\s))(?:no|has|with|without)[-_]\S+", "", f"{a.get('class', '')} {a.get('id', '')}", flags=re.I)
    if inside:
        told = any(_plainly(x) for x in names.split()) or (bool(NOISE.search(names)) and _linked(node))
    else:
        told = bool(NOISE.search(names) or FRAME.search(names))
    return told and not _holds(node, ("article", "main", "h1"))


def _plainly(name: str) -> bool:
    """Whether a class or id says noise by itself: all its parts do, or are such as stand beside such a part."""
    parts = re.split(r"[-_]", name)
    noise = [p for p in parts if NOISE.fullmatch(p) and not SHARED.match(p)]
    return bool(NOISE.fullmatch(name) and not SHARED.match(name)) or (bool(noise) and all(p in noise or not p or BESIDE.match(p) or NOISE.fullmatch(p) for p in parts))


def _linked(node: Node) -> bool:
    """Whether half of an element's letters, or more, are in links, buttons and fields."""
    inside = every = 0
    todo: list[tuple[Node | str, bool]] = [(node, False)]
    while todo:
        x, link = todo.pop()
        if isinstance(x, str):
            n = len(x) - x.count(" ")
            every, inside = every + n, inside + n * link
        else:
            todo.extend((c, link or x.tag in ("a", "button", "form", "option")) for c in x.children)
    return 2 * inside >= every


def constant(template: list | None, texts: dict) -> bool:
    """Whether aligned pages have the same text there, up to what counts may be short."""
    if template is None or template[1] < LEAST:
        return False
    short = template[2].get(SHORT, 0)
    return any(template[2].get(d, 0) + short >= max(LEAST, CONSTANT * template[1]) for d in texts)


def mark(node: Node, template: list | None, inside: bool = False, apart: dict | None = None, path: str = "", found: set | None = None) -> None:
    """Sets `drop` on what names call noise, and `same` on nodes whose own text the host repeats. apart has the templates of
    what is counted by its path; found gets the page's nodes and texts, by a numbered template's nodes and by paths."""
    kids = node.elements()
    place = {id(kids[j]): i for i, j in align(template[3], node.form[3])} if template and kids and template[3] else {}
    for c in node.children:
        if isinstance(c, Node):
            c.drop = noisy(c, inside)
            if not c.drop and c.tag not in RAW and c.tag != "head" and (c.blocks or c.tag not in INLINE):
                t, at = template[3][place[id(c)]] if id(c) in place else None, ""
                if apart or found is not None:
                    at = _path(path, c.form)
                if apart and t is None:
                    t = apart.get(at)
                if found is not None:
                    found.update((f"#{t[-1]}" if t else at, d) for d in ("", *c.form[2]))
                c.same = constant(t, c.form[2])
                mark(c, t, inside or c.tag in ("article", "main"), apart, at, found)
            elif not c.drop:
                mark(c, None, inside, apart, path, found)


INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "picture", "source", "ruby", "rt", "rp", "data", "nobr"}


def blocks(node: Node, repeated: bool = False) -> list[str]:
    """Texts of the blocks below node, in page order, white space squeezed, without empty ones; what the host repeats only if asked for."""
    out, run = [], []

    def close() -> None:
        if s := squeeze("".join(run)):
            out.append(s)
        run.clear()

    def walk(x: Node, own: bool) -> None:
        for c in x.children:
            if isinstance(c, str):
                if own:
                    run.append(c)
            elif not c.drop:
                if c.tag == "br":
                    run.append(" ")
                elif c.tag in BLOCK:
                    close()
                    walk(c, repeated or not c.same)
                    close()
                else:
                    walk(c, own if c.tag in INLINE and not c.blocks else repeated or not c.same)
            elif c.tag in BLOCK:
                close()  # what stands before and behind it aren't one block

    walk(node, repeated or not node.same)
    close()
    return out


def weigh(node: Node, link: bool = False, own: bool = True) -> tuple[int, int, int]:
    """Sets `mass`: letters of slots, of these in links, and letters that the host repeats, of all that isn't dropped."""
    slots = links = same = 0
    link, own = link or node.tag == "a", own and not node.same if node.tag in INLINE and not node.blocks else not node.same
    for c in node.children:
        if isinstance(c, str):
            n = len(c) - c.count(" ")
            if own:
                slots, links = slots + n, links + n * link
            else:
                same += n
        elif not c.drop:
            x, y, z = weigh(c, link, own)
            slots, links, same = slots + x, links + y, same + z
    node.mass = (slots, links, same)
    return node.mass


HEADINGS = ("h1", "h2", "h3")
#: Elements that are parts of a text and not the whole of it.
PARTS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "table", "ul", "ol", "dl", "figure", "tr", "td", "th", "dt", "dd"}


def densest(root: Node) -> Node:
    """The smallest element that holds nearly all letters of slots that aren't links, and no heading less."""
    node = root
    while True:
        kids = [c for c in node.children if isinstance(c, Node) and not c.drop and c.tag not in INLINE]
        gain = [max(c.mass[0] - 2 * c.mass[1], 0) for c in kids]
        top = max(range(len(kids)), key=gain.__getitem__, default=None)
        if top is None or not gain[top] or gain[top] < NEARLY * sum(gain) or kids[top].tag in PARTS:
            return node
        if any(k != top and c.mass[0] > 0 and (c.tag in HEADINGS or _holds(c, HEADINGS)) for k, c in enumerate(kids)):
            return node
        node = kids[top]


def named(root: Node) -> list[list[Node]]:
    """The outermost elements that are named article, those that are named main, and bodies of articles; such as have text."""

    def outermost(x: Node, want) -> list[Node]:
        return [y for c in x.children if isinstance(c, Node) and not c.drop for y in ([c] if want(c) else outermost(c, want))]

    wants = (lambda c: c.tag == "article", lambda c: c.tag == "main" or c.attrs.get("role") == "main", lambda c: c.attrs.get("itemprop") == "articleBody")
    return [[x for x in outermost(root, want) if x.mass[0] + x.mass[2]] for want in wants]


def chosen(root: Node) -> list[Node]:
    """The densest element; where there are articles and these hold it, or nearly all that it holds, all of these."""
    node, articles = densest(root), named(root)[0]
    inner = sum(x.mass[0] - x.mass[1] for x in articles)
    return articles if articles and inner >= NEARLY * (node.mass[0] - node.mass[1]) else [node]


def main_text(page: str | None, template: list | None = None) -> str:
    """The page's main text; without a template, or if the host has too few pages for one, by names and then by mass alone."""
    root = parse(page or "")
    shape(root)
    known = template is not None and template[1] >= LEAST
    if known and len(template) == 5:
        template = complete(settled(template), {})
    mark(root, template if known else None, apart=template[-1] if known else None)
    weigh(root)
    if known:
        tops = chosen(root)
        slots, same = sum(x.mass[0] for x in tops), sum(x.mass[2] for x in tops)
        if slots and same <= COPIES * slots:
            return "\n".join(t for x in tops for t in blocks(x))
        # a host whose pages are copies of one: nearly all of it is constant, and no slot
        return main_text(page)
    tops = next((x for x in named(root) if x), None) or [densest(root)]
    return "\n".join(t for x in tops for t in blocks(x, True))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, list] = {}
    for batch in sliced(batches, 100):
        texts = []
        for raw, page in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist()):
            if raw is not None and raw not in seen:
                if len(seen) > 200:
                    seen.clear()
                seen[raw] = unpacked(raw)
            texts.append(main_text(page, seen.get(raw) if raw is not None else None))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(spark: SparkSession, pages: DataFrame, texts: int = TEXTS, hold: int = HOLD) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages(page_id, url, html).

    A null or empty html gives an empty text. Pages without a host, or without
    url, share one template. Rows that repeat give equal rows; they count as
    pages of their own for the template. A page of any length and any number of
    elements is read whole. Line breaks in a block are white space. Other
    columns, whatever their names, are not read. An empty table gives no row.
    texts and hold say what a template holds at once, not what counts.
    """
    scratch = Scratch(spark, "wrapper")
    joined = _with_templates(pages, templates(scratch, pages, texts, hold), "left")
    return joined.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
