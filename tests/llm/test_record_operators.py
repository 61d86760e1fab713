"""WARC salvage, exact top-k, mixing, suffix dedup and HTML extraction against plain Python."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import mixing, suffix_dedup, topk, warc, wrapper
from presswork.llm.common import Scratch
from presswork.llm.queries import op3_warc_salvage, op4_exact_topk, op7_suffix_dedup, op9_source_mixing, op10_html_extraction

# WARC


def warc_by_hand(rows):
    first = {}
    for i, _, page in rows:
        if i is not None:
            first[page or ""] = min(first.get(page or "", i), i)
    out = []
    for i, _, page in rows:
        raw, f = (page or "").encode(), first.get(page or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, *(("response", None) if f is None or f == i else ("revisit", f))))
    return sorted(out, key=repr)


def test_warc_over_the_whole_table(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, op3_warc_salvage(spark, sf).collect()), key=repr) == warc_by_hand(rows)


def test_warc_edge_cases(spark):
    rows = [(5, "http://a/\r\nX: y", "é" * 10), (3, None, "é" * 10), (4, "u", None), (6, "u", ""), (9, "u", "<p>WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (None, "u", "alone"), (8, "u", "\x1f\x8b\x08 fake"), (10, "u", "y" * 6_000_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    assert sorted(map(tuple, warc.round_trip(spark, df).collect()), key=repr) == warc_by_hand(rows)
    assert warc.round_trip(spark, df.limit(0)).collect() == []


def member(i, page):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(warc.record(i, f"http://h/{i}", page.encode())) + z.flush()


def salvaged(data):
    got = list(warc.salvage(data))
    ids = [warc._number(h["warc-record-id"]) for _, _, h, _, _ in got if h is not None]
    gaps = [(o, n) for o, n, h, _, _ in got if h is None]
    covered = sorted({(o, n) for o, n, _, _, _ in got})
    assert sum(n for _, n in covered) == len(data)  # every byte is in a record or in a gap
    return ids, gaps


def test_salvage_of_members():
    parts = [member(i, f"page {i} " * 50) for i in range(6)]
    whole = b"".join(parts)
    assert salvaged(whole) == (list(range(6)), [])
    at = sum(map(len, parts[:2]))
    broken = bytearray(whole)
    broken[at + len(parts[2]) // 2] ^= 0xFF
    assert salvaged(bytes(broken)) == ([0, 1, 3, 4, 5], [(at, len(parts[2]))])
    assert salvaged(whole[:at] + b"junk\x1f\x8b\x08junk" + whole[at:]) == (list(range(6)), [(at, 11)])
    assert salvaged(whole[: at + 20]) == ([0, 1], [(at, 20)])
    assert salvaged(whole[:at] + whole[at + 5 :])[0] == [0, 1, 3, 4, 5]
    assert salvaged(b"") == ([], []) and salvaged(b"no archive") == ([], [(0, 10)])


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_inside_a_member(level):
    rng = random.Random(7)
    parts = [warc.record(i, f"http://h/{i}", rng.randbytes(3000).hex().encode()) for i in range(8)]

    def packed(raw):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        return z.compress(raw) + z.flush()

    raw, last = b"".join(parts), member(9, "last")
    whole = packed(raw)
    assert salvaged(whole + last) == ([*range(8), 9], [])
    bad = bytearray(raw)
    bad[len(parts[0]) * 3 - 100] ^= 1  # one record fails, the member doesn't
    data = packed(bytes(bad))
    assert salvaged(data + last) == ([0, 1, 3, 4, 5, 6, 7, 9], [(0, len(data))])
    assert salvaged(packed(b"junk" + raw) + last)[0] == [*range(8), 9]
    hurt = bytearray(whole)
    hurt[len(whole) // 2] ^= 0x55  # the member fails its check
    ids, gaps = salvaged(bytes(hurt) + last)
    assert ids[:3] == [0, 1, 2] and ids[-1] == 9 and len(set(ids)) == len(ids) and gaps == [(0, len(whole))] * len(gaps) != []
    crc = bytearray(whole)
    crc[-6] ^= 1
    assert salvaged(bytes(crc) + last) == ([*range(8), 9], [(0, len(whole))])
    for cut in (len(whole) // 2, len(whole) - 4):
        ids, gaps = salvaged(whole[:cut])
        assert ids == list(range(len(ids))) and len(ids) >= 3 and sum(n for _, n in gaps) == cut
        ids, gaps = salvaged(whole[:cut] + last)
        assert ids == [*range(len(ids) - 1), 9] and len(ids) >= 4 and sum(n for _, n in gaps) == cut
    bare = b"".join(b"WARC/1.1\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: 900\r\n\r\n%s\r\n\r\n" % (i, rng.randbytes(450).hex().encode()) for i in range(4))
    whole = packed(bare)
    assert salvaged(whole) == ([0, 1, 2, 3], [])
    assert salvaged(whole[:-1]) == ([0, 1, 2, 3], [(0, len(whole) - 1)])
    if level:  # nothing proves these records
        assert salvaged(whole[:-6] + b"\0" + whole[-5:]) == ([], [(0, len(whole))])


def test_salvage_of_plain_records():
    parts = [warc.record(i, "http://h/", f"text {i}".encode()) for i in range(4)]
    whole = b"".join(parts)
    assert salvaged(whole) == ([0, 1, 2, 3], [])
    at = len(parts[0])
    broken = bytearray(whole)
    broken[at + len(parts[1]) - 6] ^= 1  # in the payload: its digest fails
    assert salvaged(bytes(broken)) == ([0, 2, 3], [(at, len(parts[1]))])
    lied = whole.replace(b"Content-Length: 93\r\n\r\nHTTP", b"Content-Length: 99\r\n\r\nHTTP", 1)
    assert salvaged(lied)[0] in ([1, 2, 3], [0, 1, 2, 3])


def test_read_logs_gaps(spark):
    parts = [member(i, f"page {i}") for i in range(3)]
    data = parts[0] + parts[1][:30] + parts[2]
    got = warc.read_archives(spark, spark.createDataFrame([("a", bytearray(data)), ("b", None)], "archive string, data binary"))
    assert sorted(r.page_id for r in got.where("reason is null").collect()) == [0, 2]
    assert [(r.archive, r.offset, r.length) for r in warc.quarantine(got).collect()] == [("a", len(parts[0]), 30)]


def test_what_was_written_must_be_read(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 40) for i in range(30)], "page_id long, url string, html string")
    scratch = Scratch(spark, "t")
    archives = scratch.cut(warc.write_archives(spark, pages), "archives")
    assert warc.verified(scratch, archives).count() == 30
    rows = [(r.archive, r.records, bytearray(r.data[:100] + b"#" + r.data[101:])) for r in archives.collect()]
    with pytest.raises(warc.Incomplete, match="30 records written"):
        warc.verified(scratch, spark.createDataFrame(rows, archives.schema))


@pytest.mark.parametrize("junk", [b"WARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 7\r\n\r\n", b"\x1f\x8b\x08", b"\x1f\x8b\x08\x00WARC/1.0\n"])
def test_damaged_files_are_searched_once(junk):
    import time

    good = warc.record(1, "http://h/", b"kept")
    data = good + junk * (1_000_000 // len(junk)) + member(2, "kept too")
    began = time.perf_counter()
    ids, gaps = salvaged(data)
    assert ids == [1, 2] and gaps == [(len(good), len(junk) * (1_000_000 // len(junk)))]
    assert time.perf_counter() - began < 20


# top-k


def topk_by_hand(rows, every=50, k=5):
    vs = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vs:
        if q % every == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vs if i != q and len(a) == len(b)))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_topk_over_the_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op4_exact_topk(spark, sf).collect())) == topk_by_hand(rows)


def test_topk_edge_cases(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(1, 120)] + [(200 + i, [0.5] * 8) for i in range(20)]
    rows += [(300, None), (301, [None] * 8), (350, [float("nan")] * 8), (351, [float("inf")] * 8), (400, [1.0, 2.0]), (401, [3.0, 1.0]), (450, []), (500, [1e12] * 8), (None, [1.0] * 8), (1000, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, topk.search(spark, df).collect())) == topk_by_hand(rows)
    assert topk.search(spark, df.limit(0)).collect() == []


def test_topk_of_huge_components(spark):
    rows = [(50, [1e16, 1e16]), (1, [3e16, 3e16]), (2, [3e16, 3e16 + 4]), (3, [1.0, 2.0]), (100, [-1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.vec_id) for r in sorted(topk.search(spark, df, k=3).collect())]
    assert got == [(50, 2), (50, 1), (50, 3), (100, 3), (100, 50), (100, 1)]


@pytest.mark.parametrize("kind", [np.float32, np.float64])
@pytest.mark.parametrize("resolve", [1, 64])
def test_bounds_hold_and_reading_stops_early(kind, resolve, monkeypatch):
    monkeypatch.setattr(topk, "RESOLVE", resolve)
    rng = np.random.default_rng(2)
    for n in (3, 300, 70_000):
        x = np.floor(rng.normal(0, 20, (n, 6))).astype(kind)
        x[: n // 3] = x[0]  # ties
        lists, none = topk.Lists(x), np.zeros(n, bool)
        read = 0
        for q in np.floor(rng.normal(0, 20, (20, 6))).astype(kind):
            for depth in (np.zeros(6, int), np.full(6, n), rng.integers(0, n + 1, 6), np.full(6, n // 2)):
                for rows in (np.arange(n), np.arange(0, n, 3)):
                    lower, upper = lists.bounds(q, depth, rows)
                    assert (lower <= x[rows] @ q).all() and (x[rows] @ q <= upper).all()
                    if depth.min() == n:
                        assert (lower == upper).all()
            rows, scores, entries = lists.best(q, none, 5)
            assert sorted(scores)[-5:] == sorted(x @ q)[-5:] and entries <= x.size
            assert set(np.flatnonzero(x @ q >= sorted(x @ q)[-min(5, n)])) <= set(rows)
            read += entries
        if n > 300 and resolve > 1:
            assert read < 0.9 * 20 * x.size  # few dimensions: most lists needn't be read to their ends


def test_shares_read(spark, sf):
    got = topk.shares_read(spark, spark.read.parquet(f"{sf}/embeddings.parquet")).collect()
    print("entries read", sum(r.read for r in got) / sum(r.entries for r in got))
    assert len(got) == 10 and all(0 <= r.read <= r.entries == 500 * 64 for r in got)


# mixing


def mix_by_hand(rows):
    """Targets by rational numbers, the selection by a plain loop over the seeded order."""
    import re

    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sums = defaultdict(int)
    for n, (_, _, s) in zip(size, rows):
        sums[s] += n
    names = sorted(s for s in sums if s is not None) + [None] * (None in sums)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = Fraction(3, 2) * sum(size), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sums[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = Fraction(2 * sums[s])
            left -= 2 * sums[s]
            open_.discard(s)
    out = []
    for s in names:
        q = round(target[s])
        whole = min(q // sums[s], 2) if sums[s] else 0
        rest, upto = q - whole * sums[s], 0
        mine = sorted((hashlib.md5(f"{'-' if i is None else i}:{mixing.SEED}".encode()).hexdigest(), -1 if i is None else i, n, i) for n, (i, _, x) in zip(size, rows) if x == s)
        for _, _, n, i in mine:
            upto += n
            out.append((i, n, sums[s], float(target[s]), n * (whole + (rest > 0 and upto - n / 2 <= rest))))
    return sorted(out, key=repr)


def test_mixing_over_the_whole_table(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, op9_source_mixing(spark, sf).collect()), key=repr)
    assert got == mix_by_hand(rows)
    taken, target = defaultdict(int), {}
    source = {i: s for i, _, s in rows}
    for i, _, _, t, n in got:
        taken[source[i]] += n
        target[source[i]] = t
    longest = max(n for _, n, _, _, _ in got)
    assert all(abs(taken[s] - target[s]) <= longest / 2 + 1 for s in target)


def test_mixing_edge_cases(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "q " * 500, None), (5, "a b c", "y"), (5, "a b c", "y"), (None, "one two", "y"), (6, None, "empty"), (7, "w " * 40, "Z"), (8, "\t\n", "Z")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, target double")
    assert sorted(map(tuple, mixing.mix(spark, df).collect()), key=repr) == mix_by_hand(rows)
    assert mixing.mix(spark, df.limit(0)).collect() == []
    mixed = mixing.mixture(spark, df)
    assert mixed.columns == df.columns


def test_flow_over_overlapping_sources():
    tokens = {("a",): 100, ("a", "b"): 50, ("b",): 10}
    flow = mixing.min_cost_flow(tokens, {"a": 100, "b": 60})
    assert sum(flow[p].get("a", 0) for p in tokens) == 100 and sum(flow[p].get("b", 0) for p in tokens) == 60
    assert all(sum(f.values()) <= tokens[p] for p, f in flow.items())  # no repetition is needed
    flow = mixing.min_cost_flow(tokens, {"a": 100, "b": 110})
    assert sum(flow[("a", "b")].values()) + sum(flow[("b",)].values()) == 110
    assert mixing.min_cost_flow({("a",): 3}, {"a": 50})[("a",)]["a"] == 6


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 30 else ["b", "a", "a"] if i < 50 else ["b"] if i < 60 else [None, "z"] if i < 65 else None) for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = {r.doc_id: r for r in mixing.mix_overlapping(spark, df, {"a": 300, "b": 250}).collect()}
    words = lambda lo, hi: sum(got[i].size * got[i].copies for i in range(lo, hi))
    assert words(0, 60) == 550 and words(60, 70) == 0 and all(r.copies <= 1 for r in got.values())
    got = {r.doc_id: r for r in mixing.mix_overlapping(spark, df, {"a": 900, "b": 300}).collect()}
    assert words(0, 60) == 1100 or words(0, 60) == 1200  # all there is, or both quotas
    assert words(0, 30) == 600 and max(r.copies for r in got.values()) == 2
    assert mixing.mix_overlapping(spark, df.limit(0), {"a": 5}).collect() == []


# suffix dedup


def suffix_by_hand(rows, span=200):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = defaultdict(int)
    for _, r in raws:
        for p in range(len(r) - span + 1):
            seen[r[p : p + span]] += 1
    out = []
    for i, r in raws:
        gone = np.zeros(len(r) + 1, np.int32)
        for p in range(len(r) - span + 1):
            if seen[r[p : p + span]] > 1:
                gone[p] += 1
                gone[p + span] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int)])) == 1)
        out.append((i, len(r), int(mask.sum()), len(edges), hashlib.sha256(np.frombuffer(r, np.uint8)[~mask].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_over_the_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op7_suffix_dedup(spark, sf).collect()), key=repr) == suffix_by_hand(rows)


def suffix_cases():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghij klm") for _ in range(n))
    a, b, exact, less = text(1500), text(900), text(200), text(199)
    rows = [(1, a), (2, a[:700] + "#" + a[701:]), (3, text(50) + exact + text(60)), (4, text(80) + exact), (5, text(100) + less + text(70)), (6, less), (7, None), (8, ""), (9, "z" * 2000), (10, "z" * 150), (11, "z" * 199), (12, b + text(30) + b), (13, "é" * 150 + text(20)), (14, text(33) + "é" * 150), (15, text(5000)), (16, text(5000)), (17, "ab" * 400), (18, exact + exact)]
    return rows


@pytest.mark.parametrize(("bucket", "block"), [(256, 1 << 13), (2, 1 << 13), (2, 1), (2, 0)])
def test_suffix_edge_cases(spark, bucket, block, monkeypatch):
    """With buckets sorted, counted by wide blocks, by narrow ones, and window by window."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rows = suffix_cases() + [(15, suffix_cases()[14][1]), (None, "y" * 250)]
    rng = random.Random(4)
    common = "".join(rng.choice("xyzw") for _ in range(230))
    rows += [(100 + k, "".join(rng.choice("abcd") for _ in range(rng.randint(0, 120))) + common[rng.randint(0, 25) :] + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 120)))) for k in range(40)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_bytes int")
    assert sorted(map(tuple, suffix_dedup.remove_repeats(spark, df).collect()), key=repr) == suffix_by_hand(rows)


def test_suffix_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_mergesort_orders_suffixes():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    group = np.sort(np.array([rng.randint(0, 12) for _ in strings]))
    data = np.frombuffer(b"".join(strings), np.uint8)
    end = np.cumsum([len(s) for s in strings])
    begin = end - np.array([len(s) for s in strings])
    order = suffix_dedup.Suffixes(data, begin, end).mergesort(begin, end, group)
    got = [(int(group[i]), strings[i], int(i)) for i in order]
    assert got == sorted((int(g), s, i) for i, (g, s) in enumerate(zip(group, strings)))


# HTML


def article_by_hand(page):
    """The supplied pages have one article of h1 and p, with b and br inside."""
    import html
    import re

    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inner)
    texts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_extraction_over_the_whole_table(spark, sf):
    sf = sf.replace("0.001", "0.01")
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op10_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == article_by_hand(pages[r.page_id].html)


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body><!-- c -->
<div id="header"><a href="/">Home</a></div><ul class="main-menu"><li><a>One</a><li><a>Two</a></ul>
<div class="wrap"><div class="cookie-notice">We use cookies, don't we</div><div class="story"><h2>Head {n}</h2>
<p>First   para {n} &amp; more &eacute; text that goes on for a while so that it counts<br>after a break
<p>Second para {n} with <b>bold</b> and <a href="x">a link</a> inside, and some more words
<ul><li>item {n}<li>item b{n}</ul><table><tr><td>cell {n}<td>two{n}</table><blockquote>quoted {n}</blockquote></div>
<div class="promo-line">Buy now {n}</div><p>Follow us on every channel</p>
<div id="comments"><div class="comment"><p>Nice one {n}</p></div></div></div>
<form><label>Mail</label><input name=m><button>Go</button></form><footer>F {n}</footer>
<script>var t = "</p><p>no</p>"; if (a < b) x();</script></body></html>"""


def test_wrapper_induction(spark):
    rows = [(n, f"http://Host.example/{n}", PAGE.format(n=n)) for n in range(12)]
    rows += [(50, "http://other.example/", None), (51, None, ""), (52, "x", "plain words, no markup at all"), (53, "http://u@other.example/", "<p>un<p>closed <div>deep" + "<div>" * 3000 + "end"), (54, "http://z/", "<<<>>> a < b <3 &amp;lt; &#x41;&nbsp;B"), (0, "http://Host.example/0", PAGE.format(n=0))]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, host string")
    got = defaultdict(list)
    for r in wrapper.extract(spark, df).collect():
        got[r.page_id].append(r.text)
    for n in range(12):
        want = f"Head {n}\nFirst para {n} & more é text that goes on for a while so that it counts after a break\nSecond para {n} with bold and a link inside, and some more words\nitem {n}\nitem b{n}\ncell {n}\ntwo{n}\nquoted {n}"
        assert set(got[n]) == {want}
    assert len(got[0]) == 2
    assert got[50] == [""] and got[51] == [""] and got[52] == ["plain words, no markup at all"]
    assert got[53] == ["un\nclosed\ndeep\nend"]
    assert wrapper.extract(spark, df.limit(0)).collect() == []


def neutral_page(n, rng, extra=""):
    """A page without semantic tags or telling classes; its frame is longer than its story."""
    words = lambda k: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(k))
    story = [f"Story {n}: {words(12)}."] + [f"{words(rng.randint(10, 30))} {n}." for _ in range(rng.randint(2, 6))]
    frame = "This long text of the house stands on every page, says who prints it, for whom, and under which rules. " * 12
    links = "".join(f"<div><a href=/{rng.randrange(999)}>{words(4)}</a></div>" for _ in range(rng.randint(0, 8)))
    body = "".join(f"<div>{t}</div>" for t in story[1:])
    html = f"<html><body><div>{frame}</div>{extra}<div><div>{links}</div><div><h2>{story[0]}</h2><div>Share this with your friends</div>{body}</div></div><div><div>{frame}</div></div></body></html>"
    return html, "\n".join(story)


def induced(pages):
    t = None
    for p in pages:
        x = wrapper.shape(wrapper.parse(p))
        t = wrapper.fold(t, x) if t else x
    return t


def test_slots_choose_the_content(spark):
    rng = random.Random(3)
    made = [neutral_page(n, rng, "<div>Today: all trains are late</div>" if n % 5 == 2 else "") for n in range(40)]
    got = {r.page_id: r.text for r in wrapper.extract(spark, spark.createDataFrame([(n, "http://h/", p) for n, (p, _) in enumerate(made)], "page_id long, url string, html string")).collect()}
    assert all(got[n] == want for n, (_, want) in enumerate(made))
    alone = [wrapper.main_text(p) for p, _ in made]
    assert not any(a == want for a, (_, want) in zip(alone, made))  # without the template the frame wins


def test_no_limit_of_children_or_texts():
    rng = random.Random(4)
    pages = []
    for n in range(30):
        rows = "".join(f"<div>row {rng.randrange(10**9)}</div>{'<p>Follow us on every channel</p>' if k == 699 else ''}" for k in range(700 + rng.randrange(3)))
        pages.append(f"<body><section><h2>Head {n}</h2>{rows}</section></body>")
    t = induced(pages)
    for p in pages:
        text = wrapper.main_text(p, t)
        assert text.count("\n") >= 700 and "Follow us" not in text and text.startswith("Head ")
    # a text that four fifths of the pages have is found among any number of others, whatever the order
    counts = {}
    for n in rng.sample(range(500), 500):
        counts = wrapper.counted(counts, {"same" if n % 10 < 8 else f"x{n}": 1})
    assert wrapper.constant(["p", 500, counts, [], {}], {"same": 1}) and not wrapper.constant(["p", 500, counts, [], {}], {"x9": 1})


def counted_page(n):
    """A line that 77 of 100 pages share, one that 83 share, a correction on one of 100, and an element whose class no other page has."""
    staff = "Reported by our own staff." if n % 100 < 77 else f"Reported by writer {n}."
    house = "Printed in our own house." if n % 100 >= 17 else f"Printed in house {n}."
    note = "<blockquote>Corrected after it went out.</blockquote>" if n % 100 == 42 else ""
    html = f"<body><div><h2>Head {n}</h2><div>The story of {n} in its own words.</div><section>{staff}</section><pre>{house}</pre>{note}<ul class='u{n}'>Tail {n}</ul></div></body>"
    return html, "\n".join([f"Head {n}", f"The story of {n} in its own words.", staff, *([house] if n % 100 < 17 else []), f"Tail {n}"])


def test_no_child_is_too_rare_and_no_count_too_short():
    made = [counted_page(n) for n in range(600)]
    t = induced([p for p, _ in made])
    assert all(wrapper.main_text(p, t) == want for p, want in made)


@pytest.mark.parametrize("bounds", [{}, {"texts": 2}, {"texts": 2, "hold": 8}])
def test_what_a_template_cannot_hold_is_counted_exactly(spark, bounds):
    made = [counted_page(n) for n in range(1200)]
    df = spark.createDataFrame([(n, "http://h/", p) for n, (p, _) in enumerate(made)], "page_id long, url string, html string").repartition(6, "page_id")
    got = {r.page_id: r.text for r in wrapper.extract(spark, df, **bounds).collect()}
    assert all(got[n] == want for n, (_, want) in enumerate(made))
    rows = wrapper.templates(wrapper.Scratch(spark, "test"), df, **bounds).collect()
    assert [(r.host, r.pages) for r in rows] == [("h", 1200)]
    # a small template: the correction is counted apart, by its path, on all 12 pages that have it
    assert [t[1] for t in wrapper.unpacked(rows[0].template)[-1].values()] == ([12] if "hold" in bounds else [])


def test_what_one_page_repeats_is_no_template(spark):
    made = [(f"<body><div><h1>Head {n}</h1>" + "".join(f"<p>Part {k} of {n}.</p>" for k in range(3)) + "<p>Again.</p>" * (90 if n == 50 else 0) + "</div></body>") for n in range(300)]
    df = spark.createDataFrame([(n, "http://h/", p) for n, p in enumerate(made)], "page_id long, url string, html string").repartition(2, "page_id")
    for bounds in ({}, {"texts": 2, "hold": 8}):
        got = {r.page_id: r.text for r in wrapper.extract(spark, df, **bounds).collect()}
        assert all(t.count("Part ") == 3 and t.count("Again.") == (90 if n == 50 else 0) for n, t in got.items())


def test_paragraphs_that_articles_share_stay():
    rng = random.Random(8)
    made = []
    for n in range(40):
        story = [f"Paragraph {k} of story {n}." for k in range(rng.randint(1, 6))]
        if n % 2 == 1:
            story.insert(rng.randint(0, len(story)), "Said in several stories, at any place.")
        made.append((f"<body><div><h1>Head {n}</h1>{''.join(f'<p>{p}</p>' for p in story)}<p>Follow us on every channel</p></div></body>", "\n".join([f"Head {n}", *story])))
    t = induced([p for p, _ in made])
    assert all(wrapper.main_text(p, t) == want for p, want in made)


@pytest.mark.parametrize("seed", range(5))
def test_counts_know_how_far_they_are_short(seed):
    rng = random.Random(seed)
    whole, parts = defaultdict(int), []
    for _ in range(20):
        part = wrapper.Counts({})
        for _ in range(rng.randrange(300)):
            k = f"d{int(rng.paretovariate(0.6)) % 500}"
            whole[k] += 1
            part.add({k: 1}, 4)
        parts.append(part)
    total = wrapper.Counts({})
    for part in parts:
        total.add(part, 4)
    short = total.get(wrapper.SHORT, 0)
    assert 0 < short <= sum(whole.values()) / 5 and len(total) <= 10
    assert all(total.get(k, 0) <= v <= total.get(k, 0) + short for k, v in whole.items())
    assert total.top == max((v, k) for k, v in total.items() if k)


def test_near_copies_keep_their_text():
    story = "".join(f"<p>Paragraph {k} of the story that all pages tell in the same words.</p>" for k in range(20))
    pages = [f"<body><div><h1>Headline {n}</h1>{story}<p>Only here: {n}</p></div></body>" for n in range(9)]
    text = wrapper.main_text(pages[3], induced(pages))
    assert text.count("\n") == 21 and "Paragraph 7" in text and "Only here: 3" in text


def test_all_articles_and_blocks_stay():
    page = """<body><article><h1>One</h1><p>First text.</p><div class="legal side">A legal side of the matter.</div><div class="tags">Tagged text</div><fieldset>Set</fieldset><label>Labelled</label>
    <math><mi>x</mi></math></article><article><h1>Two</h1><p>Second.</p></article><dialog>Hidden</dialog></body>"""
    assert wrapper.main_text(page) == "One\nFirst text.\nA legal side of the matter.\nTagged text\nSet\nLabelled x\nTwo\nSecond."


@pytest.mark.parametrize("unit", ['<a b="c', "<a b='c>", "<a ", "<", "<div>", "<p>x", "</p", '<a b="', "<!-", "<li><td>"])
def test_parsing_is_linear(unit):
    import time

    began = time.perf_counter()
    wrapper.main_text(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 15


@pytest.mark.parametrize("seed", range(5))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    for _ in range(60):
        x, y = ([rng.choice([*"abcd", None]) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = wrapper.common(x, y)
        assert all(x[i] == y[j] is not None for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b is not None else max(best[i][j + 1], best[i + 1][j])
        assert len(pairs) == best[-1][-1]


def test_names_that_mark_noise():
    page = """<body class="page has-sidebar"><header><h1>Site</h1></header><div class="layout no-sidebar"><main><article class="post comments-open"><header class="entry-header"><h1>Title</h1></header>
    <p>Body text.</p><section class="user-comments"><article class="comment"><p>A reader's long comment, longer than the body.</p></article></section><div class="ad-slot">Buy</div>
    <p hidden>x</p><div role="alert">Notice</div><figure><img src=a><figcaption>Caption</figcaption></figure></article></main></div>
    <article class="comment"><p>Another comment that is a good deal longer than the article itself is.</p></article></body>"""
    assert wrapper.main_text(page) == "Title\nBody text.\nCaption"
    assert wrapper.main_text("<div class='menu'>m</div><div><p>One</p>\n<p>Two &lt;b&gt;</p></div>") == "One\nTwo <b>"


def test_fold_is_the_same_in_any_grouping(spark):
    shapes = [wrapper.shape(wrapper.parse(PAGE.format(n=n))) for n in range(9)]
    one = shapes[0]
    for s in shapes[1:]:
        one = wrapper.fold(one, s)
    a, b = shapes[0], shapes[4]
    for s in shapes[1:4]:
        a = wrapper.fold(a, s)
    for s in shapes[5:]:
        b = wrapper.fold(b, s)
    two = wrapper.fold(a, b)
    assert one[1] == two[1] == 9 and wrapper.unpacked(wrapper.packed(one)) == one
    counts = lambda t: (t[0], t[1], [counts(c) for c in t[3]])
    assert counts(one) == counts(two)


def test_components_of_a_long_chain(spark):
    from presswork.llm.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(Scratch(spark, "t"), edges).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {1000: 1000, 1001: 1000}
    assert components(Scratch(spark, "t"), edges.limit(0)).collect() == []


def test_a_record_quoted_in_a_damaged_one_stays_in_the_gap(spark):
    quoted = warc.record(7, "http://q/7", b"<p>seven</p>")
    first, second = warc.record(1, "http://p/1", b"<pre>" + quoted + b"</pre> tail"), warc.record(2, "http://p/2", b"two")
    spoilt = first.replace(b"</pre> tail", b"</pre> tall")
    assert len(spoilt) == len(first)
    plain = spoilt + second
    rows = list(warc.salvage(plain))
    assert [(r[0], r[1], r[2] and r[2]["warc-record-id"]) for r in rows] == [(0, len(first), None), (len(first), len(second), warc.urn(2))]
    assert "digest" in rows[0][4]
    # the last record, and one before something that is no record
    assert [r[2] for r in warc.salvage(second + spoilt)][1:] == [None] and len(list(warc.salvage(second + spoilt))) == 2
    pack = lambda *parts: gzip.compress(b"".join(parts), mtime=0)
    for data in (pack(spoilt) + pack(second), pack(spoilt, second)):
        ids = [r[2]["warc-record-id"] for r in warc.salvage(data) if r[2]]
        assert ids == [warc.urn(2)], data[:20]
    # a length that was damaged doesn't hide the records behind it
    cut = first.replace(b"Content-Length: %d\r\n\r\nHTTP" % 0, b"")
    size = re.search(rb"Content-Length: (\d+)\r\n\r\nHTTP", cut)
    broken = cut[: size.start(1)] + b"9" * len(size[1]) + cut[size.end(1) :]
    assert warc.urn(2) in [r[2]["warc-record-id"] for r in warc.salvage(broken + second) if r[2]]


def test_archives_that_are_null_empty_repeated_or_wide(spark):
    good = gzip.compress(warc.record(1, "u", b"x"), mtime=0)
    rows = [("a", good, 1), ("a", good, 1), ("b", None, 2), ("c", b"", 3), (None, good, 4)]
    read = warc.read_archives(spark, spark.createDataFrame([(n, None if d is None else bytearray(d), k) for n, d, k in rows], "archive string, data binary, page_id long"))
    # each row that has a record gives it, named or not
    assert sorted((r.archive or "", r.record_type) for r in read.collect()) == [("", "response"), ("a", "response"), ("a", "response")]


def test_rows_without_an_id_are_taken_as_the_mix_wants(spark):
    ten = " ".join(["w"] * 100)
    rows = [(None, ten, "a")] * 40 + [(None, ten, "b")] * 400 + [(k, ten, "c") for k in range(50)] + [(7, ten + " x", "c"), (7, None, "c"), (None, "two words", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(r.source_size, r.target) for r in mixing.mix(spark, docs).select("source_size", "target").distinct().collect()}
    got = {r.source: r.n for r in mixing.mixture(spark, docs).groupBy("source").agg(F.sum(F.coalesce(F.size(F.split("text", " ")), F.lit(0))).alias("n")).collect()}
    sizes = {"a": 4000, "b": 40_002, "c": 5101}
    targets = {size: target for size, target in want}
    for source, size in sizes.items():
        assert abs(got[source] - targets[size]) <= 101, (source, got, targets)


def test_mixes_of_odd_tables(spark):
    kind = "doc_id long, text string, source string, sources array<string>, size long, copies int, target string"
    long = "word " * 60_000
    rows = [(1, long, "a", ["a", "b"], 5, 1, "t"), (2, None, "a", None, 5, 1, "t"), (3, "x y", None, [], 5, 1, "t"), (4, "x", "b", ["b", None, "q"], 5, 1, "t")]
    docs = spark.createDataFrame(rows, kind)
    assert {r.doc_id: r.size for r in mixing.mix(spark, docs).collect()} == {1: 60_000, 2: 0, 3: 2, 4: 1}
    assert mixing.mix(spark, docs.limit(0)).collect() == []
    over = {r.doc_id: (r["size"], r.copies) for r in mixing.mix_overlapping(spark, docs, {"a": 60_000, "b": 1}).collect()}
    assert over[1] == (60_000, 1) and over[2] == (0, 0) or over[2][0] == 0
    assert over[4] == (1, 1) and over[3][1] == 0
    assert mixing.mix_overlapping(spark, docs.limit(0), {"a": 5}).collect() == []
