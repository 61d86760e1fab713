"""Secret scan: fixed patterns, and a guess-cost estimate for values in credential context.

The patterns' matches (kinds assign, access, hex) always stay. To these the
method adds spans of kind guess: the values that follow a credential word, when
guessing them is dear. The cost of a value is that of its cheapest split into
spans of five sorts, each with its number of guesses: dictionary words by their
rank among frequent ones, dates, repeats, keyboard walks and brute force. A
dynamic programme over the value's positions finds the split, as the least sum
of logarithms; a split's number of spans adds the logarithm of its orderings.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from presswork.llm.common import sliced, tidy

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
#: Words that an ASSIGN match starts with; a text without any of them has none.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

#: A credential word: it begins a word, or a part of one (DB_PASS, dbPassword), and may have more parts behind it.
WORD = (
    r"(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|auth|credentials?|login|"
    r"(?:api|access|private|client|secret|shared|session|signing|account|service|master|encryption)[_-]?(?:access[_-]?)?(?:key|secret|token))"
    r"(?:[_-]?(?:access[_-]?)?(?:key|value|token))?[0-9]*"
)
#: A credential word, a sign or `is`, and its value: up to the closing quote of its line, or else up to white space, a tag,
#: or a quote that no letter or digit follows; and user:value@ in an address. Neither a value nor a user has a longest length.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z0-9])|(?<=[a-z0-9])(?=[A-Z]))(?i:"""
    + WORD
    + r""")["']?\x20*(?:=>|:=|[:=]|\b(?i:is)\b)\x20*(?:"((?:[^"\\\n]|\\[^\n])+)"|'((?:[^'\\\n]|\\[^\n])+)'|["']?((?:[^\s"'<]|["'](?=[A-Za-z0-9])|<(?!/?[A-Za-z!][^<>\n]*>))+))"""
    + r"""|://[^\s/:@"'<>]*:([^\s/"'<>]+)@""",
    re.A,
)
CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "token", "auth", "credential", "login", "key", "://")
#: One of these at the end of a value without quotes is the sentence's.
SENTENCE = ".,;)"
#: From ten to this power guesses on, a value counts as a secret and not as a word of the language or a weak example.
GUESSES = 10.0
#: The scan doesn't tell costs from this on apart: guess_cost() leaves a value there.
ENOUGH = 100.0

#: Common passwords and words in credentials, the most frequent first.
FIRST = (
    "password pass word admin root user test guest login welcome letmein secret master default changeme example sample demo dummy "
    "hello dragon monkey shadow sunshine princess football baseball superman batman trustno qwerty abc love summer winter spring autumn "
    "the and your here token key value string null none true false api access private public client server database prod dev stage local "
    "my new old temp please enter insert redacted xxx placeholder"
).split()
#: The tokenizer whose whole words follow, by id; its merges, and so its ids, were learned the most frequent first.
TOKENIZER = "word_bpe_49k.json"


@functools.cache
def ranks() -> tuple[dict[str, int], int]:
    """The rank of each word in lower case, and the length of the longest."""
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = (w.removesuffix("</w>") for w in sorted(vocab, key=vocab.get) if w.endswith("</w>"))
    rank = {w: i + 1 for i, w in enumerate(dict.fromkeys([*FIRST, *(w for w in words if len(w) > 1 and w.isascii() and w.isalpha())]))}
    return rank, max(map(len, rank))


LEET = str.maketrans("@4831!0$57", "aabeiiosst")
#: Rows of a keyboard, for walks along them.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEXT = {a + b for row in ROWS for a, b in zip(row, row[1:])}
NEXT |= {b + a for a, b in [tuple(p) for p in NEXT]} | {a + b for x, y in zip(ROWS, ROWS[1:]) for a, b in zip(x, y)}
DATES = (
    re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)
ORDERINGS = [math.log10(math.factorial(k)) for k in range(21)]
DATE_COST = (math.log10(365 * 100 * 5), math.log10(365 * 100 * 5), math.log10(150))


def _classes(s: str) -> int:
    n = 10 * any("0" <= c <= "9" for c in s) + 26 * any("a" <= c <= "z" for c in s) + 26 * any("A" <= c <= "Z" for c in s)
    return max(n + 33 * any(not c.isalnum() and c < "\x80" for c in s) + 100 * any(c >= "\x80" for c in s), 10)


class _Spans:
    """Spans of a value that aren't brute force, by their start; starts are asked in ascending order, so that a run is read once."""

    def __init__(self, value: str):
        self.value, self.low = value, value.lower()
        if len(self.low) != len(value):  # a letter that becomes two in lower case stays, so that places agree
            self.low = "".join(x if len(x := c.lower()) == 1 else c for c in value)
        self.plain = self.low.translate(LEET)
        self.ends: dict[str, int] = {}  # of the walk last read, by kind
        self.repeats: dict[int, tuple[int, float]] = {}  # end of the run last read and cost of its unit, by the unit's size

    def walks(self, i: int) -> list[tuple[str, int, int]]:
        """(kind, end, base) of the walks from i; each j from i + 3 to end closes a span of base * (j - i) guesses."""
        value, low, n = self.value, self.low, len(self.value)
        out = []
        k = self.ends.get("keys", 0)
        if k <= i:
            k = i + 1
            while k < n and low[k - 1 : k + 1] in NEXT:
                k += 1
            self.ends["keys"] = k
        if k - i >= 3:
            out.append(("keys", k, len(NEXT)))
        k = self.ends.get("abc", 0)
        if k <= i + 1:
            k = i + 1
            while k < n and ord(value[k]) - ord(value[k - 1]) in (1, -1) and value[k].isalnum() and ord(value[k]) - ord(value[k - 1]) == ord(value[i + 1]) - ord(value[i]):
                k += 1
            self.ends["abc"] = k
        if k - i >= 3:  # abc, 321: a walk along the alphabet
            out.append(("abc", k, 26 * 2))
        return out

    def others(self, i: int, room: float = math.inf) -> list[tuple[int, float]]:
        """(end, log10 of guesses) of the words, repeats and dates from i; a repeat that costs more than room may be left out."""
        value, low, plain, n = self.value, self.low, self.plain, len(self.value)
        out = []
        words, longest = ranks()
        for j in range(i + 2, min(n, i + longest) + 1):
            if rank := words.get(low[i:j]) or words.get(plain[i:j]):
                part = value[i:j]
                turns = (2 if part != low[i:j] else 1) * (2 if low[i:j] != plain[i:j] else 1)
                out.append((j, math.log10(rank * turns + 1)))
        for size in range(1, int(min((n - i) // 2, room)) + 1):  # repeats of a unit; a unit costs a power of ten a character at least
            k, unit = self.repeats.get(size, (0, 0.0))
            if k <= i + size:
                k = i + size
                while k < n and value[k] == value[k - size]:
                    k += 1
                # all units of a run have the same characters
                unit = math.log10(_classes(value[i : i + size])) * size if k >= i + 2 * size else 0.0
                self.repeats[size] = (k, unit)
            times = (k - i) // size
            if times >= 2 and (times * size >= 3):
                out.append((i + times * size, unit + math.log10(times)))
        for rx, cost in zip(DATES, DATE_COST):
            if m := rx.match(value, i):
                out.append((m.end(), cost))
        return out


def spans_of(value: str) -> list[tuple[int, int, float]]:
    """(start, end, log10 of guesses) of all spans that aren't brute force."""
    spans = _Spans(value)
    out = []
    for i in range(len(value)):
        out.extend((i, j, math.log10(base * (j - i))) for _, end, base in spans.walks(i) for j in range(i + 3, end + 1))
        out.extend((i, j, cost) for j, cost in spans.others(i))
    return out


def guess_cost(value: str, enough: float = math.inf) -> float:
    """log10 of the guesses for the cheapest split of value, or enough, if every split costs that or more; 0 for an empty value.

    Costs only grow along a split, so a split that has reached enough is left,
    and the programme ends when none is below; the rest of the value isn't read.
    """
    if not value:
        return 0.0
    n, spans, letter = len(value), _Spans(value), math.log10(_classes(value))
    # after each position: least cost with k spans that aren't single letters of brute force
    best: dict[int, dict[int, float]] = {0: {0: 0.0}}
    walked: dict = {}  # the end of each kind's last walk, and the states that took it

    def reach(j: int, k: int, cost: float) -> None:
        nonlocal enough
        k = min(k, 20)
        if cost + ORDERINGS[k] >= enough:
            return
        if j == n:
            enough = cost + ORDERINGS[k]  # from now on only cheaper splits count
        elif cost < best.setdefault(j, {}).get(k, math.inf):
            best[j][k] = cost

    for i in range(n):
        if not best:
            return enough
        if not (states := best.pop(i, None)):
            continue
        here: list[tuple[int, float]] = []
        for k, c in sorted(states.items()):  # more spans must cost less
            if not here or c < here[-1][1]:
                here.append((k, c))
        for k, c in here:
            reach(i + 1, k, c + letter)
        for j, cost in spans.others(i, enough - here[-1][1]):
            for k, c in here:
                reach(j, k + 1, c + cost)
        for kind, end, base in spans.walks(i):
            if walked.get(kind, (0,))[0] != end:
                walked[kind] = (end, [])
            took = walked[kind][1]
            # a walk that began earlier, with no more spans, and is cheaper three steps on stays cheaper
            fresh = [(k, c) for k, c in here if not any(p <= k and d + math.log10((3 + i - at) / 3) <= c for at, p, d in took)]
            took.extend((i, k, c) for k, c in fresh)
            for j in range(i + 3, end + 1) if fresh else ():
                cost = math.log10(base * (j - i))
                for k, c in fresh:
                    reach(j, k + 1, c + cost)
    return enough


def scan(text: str, guesses: float = GUESSES) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, cost) of all spans, by start and kind; cost is 0 but for guess."""
    out = []
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), 0.0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), 0.0) for m in HEX.finditer(text)]
    if any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            at = m.start(m.lastindex)
            value = m[m.lastindex]
            if m.lastindex == 3 and value[-1] in SENTENCE:
                value = value[:-1]
            if (cost := guess_cost(value, max(guesses, ENOUGH))) >= guesses:
                out.append((at, 3, at + len(value), cost))
    return sorted(out)


_LOWER = {c: c + 32 for c in range(65, 91)}


def listed(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        cols: list[list] = [[] for _ in range(6)]
        for text in batch.column(1).fill_null("").to_pylist():
            spans = scan(text)
            base = [s for s in spans if s[1] < 3]
            for c, x in zip(cols, (*(sum(s[1] == k for s in base) for k in range(3)), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), max((s[3] for s in spans), default=0.0))):
                c.append(x)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "guess_cost"])


def find_secrets(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, guess_cost) for every row.

    Positions are code points. A null or empty text has no span, and the hash of
    the empty string. guess_cost is the highest among the row's guess spans,
    and ENOUGH stands for all costs from there on; spans have their whole length.
    Rows that repeat are each scanned; other columns are not read.
    """
    return documents.select("doc_id", "text").mapInArrow(_report, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, guess_cost double")


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with each span, or run of spans that overlap, replaced by the mark."""
    out, at = [], 0
    for a, _, b, _ in scan(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        i, j = (batch.schema.get_field_index(c) for c in ("text", "n_chars"))
        texts = [None if t is None else redact(t) for t in batch.column(i).to_pylist()]
        cols = batch.columns
        cols[i] = pa.array(texts, batch.schema.field(i).type)
        if j >= 0:
            cols[j] = pa.array([n if t is None else len(t) for t, n in zip(texts, batch.column(j).to_pylist())], batch.schema.field(j).type)
        yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def without_secrets(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """All documents with all their columns, their secrets replaced by a mark and n_chars, if there is one, counted anew.

    A null text stays null and keeps its n_chars; an empty one stays empty. Texts
    of any length are scanned whole; rows that repeat give equal rows; an empty
    table gives no row.
    """
    return documents.mapInArrow(tidy(_redacted), documents.schema)
