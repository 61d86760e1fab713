"""Many paths on one parse, and many routes by an automaton: rows are those of single functions and of the chain."""

import random
import re

import pytest
from pyspark.sql import functions as F

from presswork.functions import dom, paths
from presswork.operators import dedup, routes

PAGE = """<html><head><title>T &amp; t</title></head><body><nav><a href="/a">A</a><a href="http://o/b">B</a></nav>
<div class="ad big">buy</div>tail<article><h1>H</h1><p style="x" class="k">one</p><p>two <b>three</b></p></article></body></html>"""


def test_paths_are_those_of_single_functions(spark):
    df = spark.createDataFrame([(1, PAGE, "http://h/x/"), (2, None, "u"), (3, "", None), (4, "<p>only", None)], "id int, html string, url string")
    wanted = paths.wanted(title="//title", link="//nav/a/@href", p="css:article > p", text="//p/text()", bad="//p][", empty="")
    got = df.lateralJoin(paths.html_paths(F.col("html").outer(), F.col("url").outer(), wanted)).collect()
    rows = {(r.id, r.name, r.place): r.value for r in got}
    assert rows == {(1, "title", 1): "T & t", (1, "link", 1): "http://h/a", (1, "link", 2): "http://o/b", (1, "p", 1): "one", (1, "p", 2): "two three", (1, "text", 1): "one", (1, "text", 2): "two ", (4, "text", 1): "only"}
    html = {(r.name, r.place): r.markup for r in got if r.id == 1}
    assert html["p", 2] == "<p>two <b>three</b></p>" and html["link", 1] is None
    for name, path in (("title", "//title"), ("p", "//article/p")):
        single = df.where("id = 1").select(dom.xpath_all(path)(F.col("html"))).first()[0]
        assert single == [rows[1, name, k + 1] for k in range(len(single))]


def test_paths_in_sql_and_from_a_table(spark):
    paths.register(spark)
    spark.createDataFrame([(1, PAGE, "//h1"), (2, PAGE, "css:div.ad")], "id int, html string, path string").createOrReplaceTempView("asked")
    got = spark.sql("SELECT id, value FROM asked, LATERAL html_paths(html, NULL, map('x', path))").collect()
    assert {(r.id, r.value) for r in got} == {(1, "H"), (2, "buy")}


def test_changes_share_a_parse(spark):
    df = spark.createDataFrame([(PAGE,), (None,), ("",)], "html string")
    clean = paths.rewritten(paths.dropping("css:.ad", with_tail=True), paths.dropping("//nav"), dom.plain_attributes)
    first, none, empty = (r[0] for r in df.select(clean(F.col("html"))).collect())
    assert none is None and empty == "" and "tail" not in first and "<nav" not in first and "style" not in first and 'class="k"' in first
    kept = df.select(paths.rewritten(paths.dropping("css:.ad"))(F.col("html"))).first()[0]
    assert "tail" in kept and "buy" not in kept


@pytest.mark.parametrize(
    ("pattern", "runs"),
    [
        (r"ab\.com/(\d+)x", ["ab.com/", "x"]),
        (r"abc?d", ["ab", "d"]),
        (r"abc+d", ["abc", "d"]),
        (r"ab{0,2}c", ["a", "c"]),
        (r"a|b", []),
        (r"(?i)abc", []),
        (r"x[^\]a]y\dz", ["x", "y", "z"]),
        (r"(abc|d)ef(?:g)", ["ef"]),
        (r"\Qa.b\E", []),
        (r"\x41b", []),
        (r"[[a-c]&&[b]]d", []),
        (r"^http://h/$", ["http://h/"]),
    ],
)
def test_runs_that_every_match_has(pattern, runs):
    assert routes.required(pattern) == runs


def test_a_match_has_all_runs():
    rng = random.Random(2)
    pieces = ["a", "b", "\\.", "c?", "d*", "e+", "[xy]", "(f|g)", "(?:h)", "\\d", "i{2}", "j{0,1}", "."]
    for _ in range(400):
        pattern = "".join(rng.choices(pieces, k=rng.randint(1, 6)))
        for _ in range(20):
            text = "".join(rng.choices("abcdefghij.xy12", k=12))
            if m := re.search(pattern, text):
                assert all(r in m[0] for r in routes.required(pattern)), (pattern, m[0])


def test_many_routes_equal_the_chain(spark):
    rng = random.Random(3)
    table = [dedup.Route(rng.choice([r"//{0}\.com/(\d+)", r"{0}/(a)(\w)?", r"^http://{0}", r"[0-9]{{2}}|{0}", r"(?i){0}X", r"{0}.*end$"]).format(rng.choice(["ab", "cd", "abc", "e"])), f"s{k % 5}") for k in range(60)]
    urls = [None, "", *(f"http://{rng.choice(['ab', 'cd', 'abc', 'zz'])}.com/{rng.choice(['12', 'ab/ax', 'e/ab', 'cdx', 'q', 'abend'])}" for _ in range(150))]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "k int, url string")
    got, want = (sorted(map(tuple, f(df, table, "rest").select("k", "store", "route_key").collect())) for f in (routes.routed_by_many, dedup.routed))
    assert got == want and len({g[1] for g in got}) > 4
    assert routes.routed_by_many(df, [], "rest").where("store = 'rest'").count() == len(urls) and routes.routed_by_many(df.limit(0), table, "rest").count() == 0
    assert all(len(r[0] or ()) < len(table) for r in df.select(routes.candidates(table)(F.col("url"))).collect())
