"""Statistical charset detection for bytes that declare none.

Each candidate's coding-state machine, its decoder, walks from character to
character and marks what it can't be; a page in which it marks too much is not
in that charset. What it reads is held against
the characters that running text of its languages mostly consists of, and
against how such text is built: letters of one alphabet, in lower case after
lower case. The candidate with the highest score is the charset.

A page with fewer than ten characters besides markup, or of ASCII alone, is
utf-8. Where no candidate reaches LEAST it is, too, unless a few bytes only are
outside ASCII: such is taken for windows-1252, as a reader must take something.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd

from presswork.functions.arrow import arrow_function

#: Charset names that stand for a larger one.
ALIASES = {"big5": "big5hkscs", "gb2312": "gbk", "gbk2312": "gbk", "ascii": "utf-8"}
#: Characters besides markup below which nothing is guessed, the share of bytes outside ASCII that may not fit, the least score.
SHORT, MISFIT, LEAST = 10, 0.03, 0.15
#: The share of bytes outside ASCII up to which bytes that no candidate explains are Western.
FEW = 0.05

#: The most frequent characters of running text, by language: lists of this library's own, of fewer than 200 each.
HANS = "的一是不了在人有我他这个们中来上大为和国地到以说时要就出会可也你对生能而子那得于着下自之年过发后作里用道行所然家种事成方多经么去法学如都同现当没动面起看定天分还进好小部其些主样理心她本前开但因只从想实日军者意无力它与长把机十民第公此已工使情明性知全三又关点正业外将两高间由问很最重并物手应战向头文体政美相见被利什二等产或新己制身果加西斯月话合回特代内信表化老给"
HANT = "的一是不了在人有我他這個們中來上大為和國地到以說時要就出會可也你對生能而子那得於著下自之年過發後作裡用道行所然家種事成方多經麼去法學如都同現當沒動面起看定天分還進好小部其些主樣理心她本前開但因只從想實"
HANGUL = "이다는의에을가고하지한도로사리기은인시대자들어해그있수나것일정만아부서라게보주전제여과장원상구성스생동우공연소신세모무조선유교경중안문화용물건국실관발민방외당학"
KANA = "のにはをたがでてとしれさいるなあもかこらりまっよくすきうけおせえそやみんだどばつげじちめわほへねべごびアイウエオカキクケコサシスセタチテトナニノハフマムメモラリルレロンーッュジデドバパプ"
MARKS = "、。，．「」『』（）！？：；・“”‘’《》〈〉【】—…　％０１２３４５６７８９～￥"


ASCII_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_LETTERS = bytes(b for b in range(256) if b not in ASCII_LETTERS)
_IS_ASCII_LETTER = np.array([b in ASCII_LETTERS for b in range(129)])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Wide:
    """A charset of several bytes a character; `usual` is how much of running text its frequent ones are."""

    name: str
    codec: str
    frequent: str
    usual: float
    #: Bounds of the code points that its languages write in; all else is rare.
    script: tuple[tuple[int, int], ...]


HAN, KANA_RANGE, HANGUL_RANGE, WIDE_MARKS = (0x4E00, 0x9FFF), (0x3041, 0x30FF), (0xAC00, 0xD7A3), (0x3000, 0x303F)
FULL_WIDTH, QUOTES = (0xFF00, 0xFF5E), (0x2010, 0x2026)
WIDES = (
    Wide("gbk", "gb18030", HANS + MARKS, 0.45, (HAN, WIDE_MARKS, FULL_WIDTH, QUOTES)),
    Wide("big5hkscs", "big5hkscs", HANT + MARKS, 0.35, (HAN, WIDE_MARKS, FULL_WIDTH, QUOTES)),
    Wide("euc-kr", "cp949", HANGUL + MARKS, 0.5, (HANGUL_RANGE, WIDE_MARKS, QUOTES)),
    Wide("shift_jis", "cp932", KANA + MARKS, 0.45, (KANA_RANGE, HAN, WIDE_MARKS, FULL_WIDTH, QUOTES)),
    Wide("euc-jp", "euc_jp", KANA + MARKS, 0.45, (KANA_RANGE, HAN, WIDE_MARKS, FULL_WIDTH, QUOTES)),
)


@dataclass(frozen=True)
class Narrow:
    """A charset of a byte a character, for the letters of one alphabet."""

    name: str
    codec: str
    alphabet: tuple[tuple[int, int], ...]
    #: How much the score counts against others of the same bytes.
    weight: float
    #: Small letters that make up `usual` of running text; none for letters that stand among those of ASCII.
    frequent: str = ""
    usual: float = 0.6


NARROWS = (
    Narrow("windows-1252", "cp1252", ((0xC0, 0x17F),), 0.73),
    Narrow("windows-1251", "cp1251", ((0x400, 0x45F),), 0.95, "оеаинтсрвлкмдп", 0.75),
    Narrow("koi8-r", "koi8_r", ((0x400, 0x45F),), 0.95, "оеаинтсрвлкмдп", 0.75),
    Narrow("windows-1253", "cp1253", ((0x370, 0x3FF),), 0.95, "αοιετσνηυρπκμλςάίόέή", 0.75),
    Narrow("windows-1255", "cp1255", ((0x590, 0x5FF),), 0.95, "יוהלאמרתבשנכד", 0.75),
    Narrow("windows-1256", "cp1256", ((0x600, 0x6FF),), 0.95, "اليمنتورهبدعسةأ", 0.75),
    Narrow("tis-620", "cp874", ((0xE00, 0xE5B),), 0.95, "านรอกเงมยลวดทสต่้ัิี", 0.7),
)


@cache
def _table(text: str, bounds: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane, whether it is in text, and whether within the bounds; all others count as the last."""
    own, inside = np.zeros(0x10000, bool), np.zeros(0x10000, bool)
    own[_codes(text)] = True
    for low, high in bounds:
        inside[low : high + 1] = True
    return own, inside


def wide_score(raw: bytes, high: int, c: Wide) -> float:
    """How well running text in this charset explains `raw`, which has so many bytes outside ASCII; from 0 to about 1."""
    codes = _codes(raw.decode(c.codec, "replace"))
    at = np.flatnonzero(codes >= 128)
    # letters of ASCII are beside the words of such text, not in them
    ascii_letter = _IS_ASCII_LETTER[np.minimum(codes, 128)]
    inside = ascii_letter[np.maximum(at - 1, 0)] | ascii_letter[np.minimum(at + 1, len(codes) - 1)]
    codes = codes[at]
    unknown = int((codes == 0xFFFD).sum())
    if unknown > MISFIT * high + 1 or unknown == len(codes):  # the last character may be cut
        return 0.0
    codes = codes[codes != 0xFFFD]
    frequent, script = (t[np.minimum(codes, 0xFFFF)].mean() for t in _table(c.frequent, c.script))
    # half-width katakana and rare signs speak against a charset, since they take any byte
    return float(min(1.0, frequent / c.usual) * script**2 * (1 - inside.mean()))


@cache
def _letters(c: Narrow) -> tuple[np.ndarray, ...]:
    """For each byte, whether it is unknown, a letter, an upper-case one, one of the alphabet, a frequent one."""
    points = [bytes([b]).decode(c.codec, "replace") for b in range(256)]
    kinds = [unicodedata.category(p) for p in points]
    alphabet = _table("", c.alphabet)[1]
    return tuple(np.array(x, bool) for x in ([p == "\ufffd" for p in points], [k[0] in "LM" for k in kinds], [k == "Lu" for k in kinds], [bool(alphabet[ord(p)]) for p in points], [p in c.frequent for p in points]))


def _triples(raw: bytes) -> tuple[np.ndarray, ...]:
    """(byte before, byte, byte after, how often) of the different places of bytes outside ASCII."""
    data = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.int32)
    at = np.flatnonzero(data >= 128)
    key, n = np.unique(data[at - 1] << 16 | data[at] << 8 | data[at + 1], return_counts=True)
    return key >> 16, key >> 8 & 255, key & 255, n


#: Words of Latin text without a letter of ASCII (à) have no more bytes than this, and half of other alphabets' letters are in longer ones.
SHORT_WORD = 4


def _words(raw: bytes) -> tuple[np.ndarray, int]:
    """How often each byte begins or ends a short word of bytes outside ASCII alone, and how many bytes are in longer runs of such."""
    data = np.frombuffer(b" " + raw + b" ", np.uint8)
    edge = np.flatnonzero(np.diff((data >= 128).astype(np.int8)))
    start, end = edge[::2] + 1, edge[1::2] + 1  # the run's first byte, and that after its last
    size = end - start
    lone = (size <= SHORT_WORD) & ~_IS_ASCII_LETTER[np.minimum(data[start - 1], 128)] & ~_IS_ASCII_LETTER[np.minimum(data[end], 128)]
    first, last = data[start[lone]], data[end[lone & (size > 1)] - 1]
    return np.bincount(first, minlength=256) + np.bincount(last, minlength=256), int(size[size > SHORT_WORD].sum())


def narrow_score(triples: tuple[np.ndarray, ...], words: tuple[np.ndarray, int], letters: int, c: Narrow) -> float:
    """As wide_score: the share of high bytes that are letters of the alphabet where such letters stand, or signs beside a space.

    `letters` is the number of letters of ASCII.
    """
    before, byte, after, n = triples
    unknown, letter, upper, alphabet, frequent = _letters(c)
    high = n.sum()
    if n[unknown[byte]].sum() > MISFIT * high:
        return 0.0
    latin = not c.frequent
    own = letter[byte] & alphabet[byte]
    side = lambda x: letter[x] & ((x < 128) if latin else (x >= 128))
    # a capital inside a word of small letters isn't how text is written
    odd = upper[byte] & letter[before] & ~upper[before]
    placed = own & ~odd & (side(before) | side(after) | (latin & letter[before] & letter[after]))
    if not latin:  # words of another alphabet have no letters of ASCII in them
        placed &= ~(letter[before] & (before < 128)) & ~(letter[after] & (after < 128))
    sign = ~letter[byte] & ~unknown[byte] & ~(letter[before] & letter[after] & (before >= 128) & (after >= 128))
    share = (n[placed].sum() + 0.6 * n[sign].sum()) / high
    if latin:
        share += words[0][letter & alphabet].sum() / high
        # letters outside ASCII are few in Latin text
        share *= min(1.0, 1.4 * (1 - high / max(1, letters + high)) ** 0.5)
    elif not own.any():
        return 0.0
    else:
        # and most letters of such text are of it, in words of more than a few
        share *= min(1.0, n[own & frequent[byte]].sum() / n[own].sum() / c.usual) * min(1.0, 3 * high / (letters + high)) * min(1.0, 2 * words[1] / high)
    return float(c.weight * share**2)


ESCAPES = ((b"\x1b$B", "iso-2022-jp"), (b"\x1b$@", "iso-2022-jp"), (b"\x1b$)C", "iso-2022-kr"))
MARKED = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))




def scores(raw: bytes) -> dict[str, float]:
    """The score of every candidate that could be meant; none for ASCII."""
    high = len(raw.translate(None, bytes(range(128))))
    if not high:
        return {}
    out = {c.name: wide_score(raw, high, c) for c in WIDES}
    if max(out.values()) < max(c.weight for c in NARROWS):  # else none of these can win
        triples, words, letters = _triples(raw), _words(raw), len(raw.translate(None, NO_LETTERS))
        out |= {c.name: narrow_score(triples, words, letters, c) for c in NARROWS}
    return {k: v for k, v in out.items() if v}


def is_utf8(raw: bytes) -> bool:
    """Whether all of it is, but for a character that its end may have cut."""
    try:
        codecs.getincrementaldecoder("utf-8")().decode(raw)
    except UnicodeDecodeError:
        return False
    return True


def detected(raw: bytes) -> str:
    """The charset of text bytes that declare none."""
    for mark, name in MARKED:
        if raw.startswith(mark):
            return name
    text = re.sub(rb"</?[^>]*>\s*", b" ", raw)
    if len(text.strip()) < SHORT:
        return "utf-8"
    if is_utf8(text):
        for mark, name in ESCAPES:
            if mark in text:
                return name
        return "utf-8"
    best = max(scores(text).items(), key=lambda kv: kv[1], default=("utf-8", 0.0))
    if best[1] >= LEAST:
        return best[0]
    return "windows-1252" if len(text.translate(None, bytes(range(128)))) <= FEW * len(text) else "utf-8"


DECLARED = (re.compile(r"""(?i)<meta[^>]*?charset=["']*([^"'>\s/;]+)"""), re.compile(r"""^<\?xml.*?encoding=["']*([^"'>\s]+)"""))


def charset(raw: bytes) -> str:
    """The charset that a page's bytes declare, not verified, aliases resolved; or else the one detected."""
    head = raw.decode("latin-1")
    for pattern in DECLARED:
        if m := pattern.search(head):
            return ALIASES.get(m[1].lower(), m[1].lower())
    return detected(raw)


@arrow_function("string")
def charset_of_bytes(page: pd.Series) -> pd.Series:
    """The charset of each page's bytes; null for null."""
    return page.map(charset, na_action="ignore")


def _read(raw: bytes) -> str:
    try:
        return raw.decode(charset(raw), "replace")
    except LookupError:  # a name that no decoder has
        return raw.decode(detected(raw), "replace")


@arrow_function("string")
def text_of_bytes(page: pd.Series) -> pd.Series:
    """Each page's bytes as text, by its charset; bytes that don't fit are U+FFFD. A declared charset that isn't known is detected."""
    return page.map(_read, na_action="ignore")


@arrow_function("binary")
def bytes_of_text(text: pd.Series, name: pd.Series) -> pd.Series:
    """text in the named charset, '?' for what it hasn't; null if either is."""
    return pd.Series([None if t is None or n is None else t.encode(n, "replace") for t, n in zip(text, name)], dtype=object)
