"""Lexical search, collocations and decontamination against plain Python, on small odd tables."""

import hashlib
import heapq
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import collocations, decontaminate, lexical
from presswork.llm.common import Scratch, unvarints, varints

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}

DOCS = "doc_id long, text string, lang string, n long, term string, found string, score long"
ODD = ["", None, " \t\n", "...", "É é A a", "日本語 テキスト x1", "a" * 5000, "\x00\x7f", "word " * 9000, "it's 10.5% of_it", "\x85 \xa0 ß ẞ İ"]


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def docs_of(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang), with columns whose names the operators use for their own."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", 7, "x", "y", 3) for r in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "item_id long, text string, weight long, words string")


def made_up(seed, rows, vocabulary=30, longest=60):
    rng = random.Random(seed)
    words = ["the", "of", "Aé", "ba", "x9", *(f"w{k}" for k in range(vocabulary))]
    texts = [rng.choice([" ", ". ", "\n", "-"]).join(rng.choices(words, weights=[1 / (1 + k) for k in range(len(words))], k=rng.randint(0, longest))) for _ in range(rows)]
    return [(k, t) for k, t in enumerate(texts)]


# postings


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)))
def test_numbers_come_back_from_seven_bit_bytes(values):
    raw, ends = varints(np.array(values, np.uint64))
    assert unvarints(raw.tobytes()).tolist() == values
    assert len(ends) == len(values)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 60), st.integers(0, 4), max_size=20), max_size=5), st.integers(1, 5), st.integers(1, 9))
def test_merge_of_lists_keeps_the_best(lists, k, window):
    sums = Counter()
    for own in lists:
        sums.update(own)
    want = heapq.nlargest(k, ((s, -d) for d, s in sums.items() if s > 0))
    arrays = [(np.array(sorted(own), np.int64), np.array([own[d] for d in sorted(own)], np.int64)) for own in lists]
    assert lexical.best(arrays, k, window) == [(s, -d) for s, d in want]


def ranking_by_hand(docs, items, k):
    tf = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    known, total = sum(1 for x in n if x), sum(n)
    df = Counter(w for c in tf for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, own in asked.items():
        scored = []
        for (d, _), c, size in zip(docs, tf, n):
            score = 0
            for w, reps in own.items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * known + 2) / (2 * df[w] + 1)))
                    m = 25 + 75 * size * known // total
                    score += reps * weight * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("shard_bytes, items", [(1 << 24, 256), (300, 2)])
def test_search_against_plain_python(spark, shard_bytes, items):
    docs = [*made_up(1, 70), *((100 + k, t) for k, t in enumerate(ODD)), (None, "the w3 w4"), (None, "the w3 w4"), (5, "w5 w6 the"), (5, "w5 w6 the"), (-7, "w5 w6 the"), (-(2**63), "w29"), (2**63 - 1, "w29")]
    asked = [*made_up(2, 9, longest=12), (3, "w9 w9"), (None, "w3 w28"), (50, None), (51, ""), (52, "nowhere"), (53, "the THE The"), (54, "w29")]
    got = lexical.ranked(spark, docs_of(spark, docs).repartition(3), items_of(spark, asked), 4, shard_bytes, items).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=key) == sorted(ranking_by_hand(docs, asked, 4), key=key)


def test_search_of_nothing(spark):
    none, some = docs_of(spark, []), docs_of(spark, [(1, None), (2, "..")])
    item = items_of(spark, [(1, "a b")])
    assert lexical.ranked(spark, none, item).collect() == []
    assert lexical.ranked(spark, some, item).collect() == []
    assert lexical.ranked(spark, docs_of(spark, [(1, "a")]), items_of(spark, [])).collect() == []


def test_norms_are_exact_beyond_64_bits():
    n = np.array([1, 10**9], np.int64)
    assert lexical.lengths_norm(n, 10**11, 10**13).tolist() == [25 + 75 * x * 10**11 // 10**13 for x in (1, 10**9)]


# collocations


def phrases_by_hand(docs, least, longest, top, share):
    f, n = {}, Counter()
    for _, text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for s in range(len(words) - k + 1):
                    g = (lang, *words[s : s + k])
                    f[g] = f.get(g, 0) + 1
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    rows = []
    for (lang, *g), a in found.items():
        if any(len(h) - 1 > len(g) and h[0] == lang and 100 * b >= share * a and any(list(h[s : s + len(g)]) == g for s in range(1, len(h) - len(g) + 1)) for h, b in found.items()):
            continue
        cuts = [(2_000_000 * a // (f[(lang, *g[:k])] + f[(lang, *g[k:])]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        rows.append((lang, -score, -a, " ".join(g).encode(), f[(lang, *g[:k])], f[(lang, *g[k:])]))
    out, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        seen[lang] += 1
        if seen[lang] <= top:
            out.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("chunk_bytes, top, longest", [(1 << 24, 2000, 4), (400, 5, 4), (400, 2000, 2), (400, 2000, 5)])
def test_collocations_against_plain_python(spark, chunk_bytes, top, longest):
    rng = random.Random(3)
    docs = [(i, t, rng.choice(["en", "de", None])) for i, t in made_up(4, 120, vocabulary=12)]
    docs += [(200 + k, t, "en") for k, t in enumerate(ODD)] + [(None, "the of ba", "en")] * 9 + [(300, "a b c d e f " * 40, "und"), (301, "x" * 3000 + " y " + "x" * 3000 + " y", "de")]
    got = collocations.collocations(spark, docs_of(spark, docs).repartition(3), 5, longest, top, 80, chunk_bytes).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == sorted(phrases_by_hand(docs, 5, longest, top, 80))


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark, docs_of(spark, [])).collect() == []
    assert collocations.collocations(spark, docs_of(spark, [(1, None), (2, ". , "), (3, "a b")])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 4_000_000_000_000_123_457, 4_000_000_000_000_123_458, 4_000_000_000_000_123_999
    got = spark.range(1).select(collocations._score(F.lit(a), F.lit(left), F.lit(right)).alias("x")).first().x
    assert got == 2_000_000 * a // (left + right)


# decontamination


def hits_by_hand(docs, items, window):
    wanted = [(i, terms(t)) for i, t in items if i is not None]
    out = []
    for d, text in docs:
        words = terms(text)
        hit, found = set(), set()
        for i, own in wanted:
            k = min(window, len(own))
            gone = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} if k else set()
            for s in range(len(words) - k + 1):
                if k and tuple(words[s : s + k]) in gone:
                    hit.update(range(s, s + k))
                    found.add(str(i))
        ids = ",".join(sorted(found))
        out.append((d, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("window, seed", [(10, 5), (3, 6), (1, 7)])
def test_hits_against_plain_python(spark, window, seed):
    items = [*made_up(seed, 30, vocabulary=6, longest=25), (3, "the of"), (3, "w1 w1 w1 w1"), (None, "the"), (60, None), (61, "..."), (62, "w5 w5"), (63, " ".join(["w2"] * 14))]
    docs = [*made_up(seed + 10, 60, vocabulary=6), *((100 + k, t) for k, t in enumerate(ODD)), (None, "the of w1"), (7, "w5 w5"), (7, "w5 w5"), (8, items[0][1] * 2), (9, "w2 " * 400)]
    docs += [(200 + k, f"q {t} q") for k, t in enumerate(t for _, t in items if t)]
    for block, at_once in ((1 << 17, 8), (40, 2)):
        found = decontaminate.counted(decontaminate.matched(spark, docs_of(spark, docs).repartition(3), items_of(spark, items), window, block_words=block, at_once=at_once))
        ids = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(sorted(r.found["items"])).encode()).hexdigest(), r.n_hit > 0) for r in found.collect()]
        assert sorted(ids, key=repr) == sorted(hits_by_hand(docs, items, window), key=repr)
    got = decontaminate.contamination(spark, docs_of(spark, docs), items_of(spark, items), window).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(hits_by_hand(docs, items, window), key=repr)


def test_an_item_of_many_blocks_loses_no_window(spark):
    words = [f"u{k % 97}x{k % 89}" for k in range(700)]
    docs = [(k, " ".join(words[k : k + 10])) for k in range(0, 690, 7)]
    got = decontaminate.matched(spark, docs_of(spark, docs), items_of(spark, [(1, " ".join(words))]), block_words=160, at_once=2).collect()
    assert len(got) == len(docs) and all(r.found["items"] == ["1"] and r.found["spans"][0]["stop"] == 10 for r in got)


def test_spans_and_covered_documents_go(spark):
    ten = " ".join(f"k{x}" for x in range(10))
    docs = [(1, f"É {ten.upper()} tail, " + "own " * 20), (2, f"a {ten}, b"), (3, None), (4, ""), (5, f"{'own ' * 30}{ten}; x; {ten}."), (6, "s1 s2 " + "own " * 9)]
    items = [(1, ten), (2, "s1 s2")]
    got = {r.doc_id: r.text for r in decontaminate.decontaminated(spark, docs_of(spark, docs), items_of(spark, items)).collect()}
    # a short item's span is shorter than what is cut
    assert got == {1: "É  tail, " + "own " * 20, 2: "", 3: None, 4: "", 5: "own " * 30 + "; x; .", 6: docs[5][1]}
    all_spans = decontaminate.decontaminated(spark, docs_of(spark, docs), items_of(spark, items), least=1, coverage=1.0)
    assert {r.doc_id: r.text for r in all_spans.collect()}[6] == " " + "own " * 9


def test_decontamination_of_and_by_nothing(spark):
    assert decontaminate.contamination(spark, docs_of(spark, []), items_of(spark, [(1, "a")])).collect() == []
    rows = decontaminate.contamination(spark, docs_of(spark, [(1, "a b"), (2, None)]), items_of(spark, [])).collect()
    assert sorted((r.doc_id, r.n_words, r.contaminated, r.items_sha256) for r in rows) == [(k, n, False, hashlib.sha256(b"").hexdigest()) for k, n in ((1, 2), (2, 0))]


def test_index_has_every_posting(spark):
    docs = made_up(8, 40)
    index = lexical.indexed(spark, docs_of(spark, docs), Scratch(spark, "t"), 200)
    df = Counter(w for _, t in docs for w in set(terms(t)))
    got = Counter()
    for r in index.shards.where("term is not null").collect():
        got[r.term] += r.df
    assert got == df and index.terms == sum(len(terms(t)) for _, t in docs)
