"""Invariants over generated inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.functions import article, dom, urls

TEXT = st.text(alphabet="abcXYZ019 %/?#&=;:+~*é中.-_", max_size=40)


@given(TEXT, TEXT, TEXT)
@settings(max_examples=300, deadline=None)
def test_a_dedup_address_is_its_own(path, query, fragment):
    once = urls.canonical_for_dedup(f"http://Host.Example/{path}?{query}#{fragment}")
    assert urls.canonical_for_dedup(once) == once


@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["", "1", "2"])), max_size=5), st.randoms())
def test_order_of_arguments_does_not_matter(args, rng):
    form = lambda xs: urls.canonical_for_dedup("http://h/p?" + "&".join(f"{k}={v}" for k, v in xs))
    other = list(args)
    rng.shuffle(other)
    assert form(args) == form(other)


@given(st.text(alphabet="<>/=\"' abdivplt!-&;#x1\n", max_size=300))
@settings(max_examples=300, deadline=None)
def test_any_text_is_a_page(page):
    root = dom.parse(page, clean=True, base="http://h/")
    assert isinstance(root.text(), str) and isinstance(root.html(), str)
    assert dom.parse(root.html()).text() == dom.parse(dom.parse(root.html()).html()).text()
    assert isinstance(article.article_text(page), str)
    assert isinstance(article.breadcrumb(root, "http://h/"), list)


@given(st.datetimes(dt.datetime(1971, 1, 1), dt.datetime(2039, 12, 31)))
def test_a_lone_date_is_found(when):
    when = when.replace(microsecond=0)
    assert article.publish_time(f"<p>on {when:%Y-%m-%d %H:%M:%S} it was</p>") == when
