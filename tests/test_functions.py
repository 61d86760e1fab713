"""Literal vectors for scalar functions and page extraction."""

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from presswork.functions import article, dates, dom, text, urls
from presswork.functions.arrow import SLICE_BYTES, arrow_function


def one(spark, col, *values):
    """The column over one row with columns a, b, ..."""
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {'timestamp_ntz' if isinstance(v, dt.datetime) else 'bigint' if isinstance(v, int) else 'string'}" for n, v in zip("abcd", values)))
    return df.select(col.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("url", "v1", "v2"),
    [
        ("http://xxx.com/123.html?b=1&a=3", "http://xxx.com/123.html?a=3&b=1", "http://xxx.com/123.html?a=3&b=1"),
        ("http://www.sina.com/1.html?b=3&a=1##", None, "http://www.sina.com/1.html?a=1&b=3##"),
        ("http://WWW.A.com", "http://WWW.A.com", "http://www.a.com/"),
        ("http://a.com/x#", "http://a.com/x", "http://a.com/x#"),
        ("http://a.com/x?b=&a=1", "http://a.com/x?a=1&b=", "http://a.com/x?a=1&b="),
        ("http://a.com/x?k=%E4%B8%AD+z*~&a=1&a=0", "http://a.com/x?a=0&a=1&k=%E4%B8%AD+z%2A%7E", None),
        ("http://a.com/a b/%2f?c;b=2", "http://a.com/a b/%2f?b=2&c=", "http://a.com/a%20b/%2F?b=2&c="),
    ],
)
def test_canonical_urls(spark, url, v1, v2):
    got = one(spark, F.struct(urls.canonical(F.col("a")), urls.dedup_url(F.col("a"))), url)
    if v1:
        assert got[0] == v1
    if v2:
        assert got[1] == v2
    # a canonical address is its own canonical form
    assert one(spark, urls.canonical(F.col("a")), got[0]) == got[0]
    assert urls.canonical_for_dedup(got[1]) == got[1]


def test_null_urls(spark):
    assert one(spark, F.struct(urls.canonical(F.col("a")), urls.dedup_url(F.col("a"))), None) == (None, None)
    assert one(spark, urls.is_fetchable(F.col("a")), None) is False
    assert one(spark, urls.is_fetchable(F.col("a")), "  FTP://x") is True


def test_resolve(spark):
    assert one(spark, urls.resolve(F.col("a"), F.col("b")), "/p?b=1&a=2", "http://h/x/") == "http://h/p?a=2&b=1"
    assert one(spark, urls.resolve(F.col("a"), F.col("b")), "http://o/q", "http://h/x/") == "http://o/q"


@pytest.mark.parametrize(("mid", "key"), [(3743906829572599, "BiqdsEagL"), (12345678901234, "5banBlCi"), (10000000, "10000"), (9999999, "FXsj"), (0, "0")])
def test_short_keys(spark, mid, key):
    assert one(spark, urls.short_key(F.col("a")), mid) == key
    assert one(spark, urls.from_short_key(F.col("a")), key) == mid


def test_short_key_of_another_id(spark):
    assert one(spark, urls.from_short_key(F.col("a")), "F4nV0euD8") == 4110452583454338


NOW = dt.datetime(2024, 1, 31, 12, 0, 0)


@pytest.mark.parametrize(
    ("written", "local"),
    [
        ("2013年8月15日 22:46:21", "2013-08-15 22:46:21"),
        ("2013/11/11 13:52", "2013-11-11 13:52:00"),
        ("2014年5月11日", "2014-05-11 00:00:00"),
        ("2014年5月", "2014-05-01 00:00:00"),
        ("13年8月15日 22:46", "2013-08-15 22:46:00"),
        ("13年8月15日 22:46:21", "2013-08-15 22:46:21"),
        ("8月15日 22:46:21", "2024-08-15 22:46:21"),
        ("7/3", "2024-07-03 00:00:00"),
        ("3 秒前", "2024-01-31 11:59:57"),
        ("29 分钟前", "2024-01-31 11:31:00"),
        ("2 小时前", "2024-01-31 10:00:00"),
        ("2天前", "2024-01-29 12:00:00"),
        ("今天 15:42:21", "2024-01-31 15:42:21"),
        ("昨天 15:42", "2024-01-30 15:42:00"),
        ("前天 10:41", "2024-01-29 10:41:00"),
        ("发稿时间：2020-03-18 20:48:14 作者：…", "2020-03-18 20:48:14"),
        ("", "2024-01-31 12:00:00"),
        ("nothing", "2024-01-31 12:00:00"),
        ("13-8-15", None),
    ],
)
def test_local_dates(spark, written, local):
    got = one(spark, F.date_format(dates.local_datetime(F.col("a"), F.col("b")), "yyyy-MM-dd HH:mm:ss"), written, NOW)
    assert got == local


def test_utc_dates(spark):
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert one(spark, fmt(dates.utc_datetime(F.col("a"), F.col("b"))), "2013/11/11 13:52", NOW) == "2013-11-11 05:52:00"
    assert one(spark, fmt(dates.utc_datetime(F.col("a"), F.col("b"))), "13-8-15", NOW) == "2024-01-31 12:00:00"
    assert one(spark, fmt(dates.plus_years(F.col("a"), 1)), dt.datetime(2024, 2, 29, 3)) == "2025-02-28 03:00:00"


@pytest.mark.parametrize(
    ("ctime", "gtime", "repaired"),
    [
        ("2024-01-10 00:00:00", "2024-01-10 09:30:15", "2024-01-10 09:29:15"),
        ("2024-01-10 00:00:00", "2024-01-12 09:30:15", "2024-01-10 23:59:59"),
        ("2024-01-10 00:00:00", "2024-01-11 00:00:00", "2024-01-10 00:00:00"),
        ("2024-01-10 00:00:00", "2024-01-10 00:00:30", "2024-01-10 23:59:30"),
        ("2024-01-10 08:00:00", "2024-01-12 09:30:15", "2024-01-10 08:00:00"),
    ],
)
def test_midnight_repair(spark, ctime, gtime, repaired):
    c, g = (dt.datetime.fromisoformat(x) for x in (ctime, gtime))
    got = one(spark, F.date_format(dates.repaired_ctime(F.col("a") - dates.offset(), F.col("b") - dates.offset()) + dates.offset(), "yyyy-MM-dd HH:mm:ss"), c, g)
    assert got == repaired


def test_text_functions(spark):
    a = F.col("a")
    assert one(spark, text.similarity(a, F.col("b")), "hello", "helo") == pytest.approx(0.6)
    assert one(spark, text.similarity(a, F.col("b")), "", "") is None
    assert one(spark, text.page_title(a, F.lit("")), "大事件_新华网") == "大事件"
    assert one(spark, text.page_title(a, F.lit("")), "新华网_某某重大新闻标题") == "某某重大新闻标题"
    assert one(spark, text.page_title(a, F.col("b")), "hello", "helo") == "hello"
    assert one(spark, text.charset(a), '<meta http-equiv="x" content="text/html; charset=GB2312">') == "gbk"
    assert one(spark, text.charset(a), '<meta charset="big5">') == "big5hkscs"
    assert one(spark, text.charset(a), '<?xml version="1.0" encoding="ascii"?><x/>') == "utf-8"
    assert one(spark, text.charset(a), "<p>") == "utf-8"
    assert one(spark, text.stripped(a), " 　 x y  \n") == "x y"
    assert one(spark, text.replaced(a, "a(b)", "-", 2), "abxabyab") == "-x-yab"
    assert one(spark, text.first_match(a, r"k=(\d+)", "none"), "k=7 k=8") == "7"
    assert one(spark, text.first_match(a, r"k=(\d+)", "none"), "x") == "none"
    assert one(spark, text.as_int(a), "x") == -1 and one(spark, text.as_float(a), "1.5") == 1.5
    assert one(spark, text.unescaped(a), "a&amp;b&#160;") == "a&b "
    assert one(spark, text.page_from_base64(text.page_base64(a)), "<p>é" * 500) == "<p>é" * 500
    assert text.alternation("a.b,C") == r"a\.b|c" and text.alternation([]) is None
    lines = "\n".join(map(str, range(12)))
    assert one(spark, text.short_trace(a), lines) == "0\n1\n2\n3\n4\n5\n9\n10\n11"
    assert one(spark, text.is_list_page(a), "<body><a href=x>12345678</a>9</body>") is True
    assert one(spark, text.boosted(F.split(a, " "), lambda t: t.rlike(r"^\d")), "x 1 y z") == [5.0, 1.0, 5.0, 1.0]


PAGE = """<html><head><title>某地举行大型活动_新华网</title><script>var x = "</p>";</script></head><body>
<div class="crumb"><a href="/">首页</a> &gt; <a href="/news/">新闻</a> &gt; <a href="/news/local/">本地</a> &gt; 正文</div>
<div style="display:none">hidden words that nobody should ever read in the article</div>
<div id="sidebar">link link link <a href="/a">one</a><a href="/b">two</a></div>
<h1>某地举行大型活动</h1><div class="info"><span>2024-01-10 09:00:01</span> <span>来源：</span><span>人民日报</span> <span>作者：</span><span>张三</span></div>
<div class="article-content"><p>第一段，这里有很多文字，讲述了活动的经过，参加的人很多，天气也很好，大家都很高兴。</p>
<p>第二段，继续讲述活动的细节，包括时间、地点，以及主办方的介绍，还有许多嘉宾的发言内容。</p>
<p>版权声明：本文不得转载</p><p>后面的文字也不要，因为在版权声明之后，不属于正文部分的内容。</p></div>
<div id="footer">footer text copyright 2020</div></body></html>"""


def test_article_of_a_news_page(spark):
    got = one(spark, article.extract(F.col("a"), F.col("b")), PAGE, "http://news.example/news/local/1.html")
    assert got.title == "某地举行大型活动"
    assert got.content.startswith("第一段") and "第二段" in got.content
    for gone in ("版权声明", "后面的文字", "hidden", "footer", "首页"):
        assert gone not in got.content
    assert (got.source, got.author) == ("人民日报", "张三")
    assert got.published == dt.datetime(2024, 1, 10, 9, 0, 1)
    assert [(b.level, b.name, b.href) for b in got.breadcrumb] == [(1, "首页", "http://news.example/"), (2, "新闻", "http://news.example/news/"), (3, "本地", "http://news.example/news/local/")]
    assert got.channel == "本地"


def test_extraction_of_odd_pages(spark):
    assert one(spark, article.extract(F.col("a"), F.col("b")), None, None).title is None
    for page in ("", "plain", "<<>>", "<p>" * 2000 + "deep", "<html><body></body></html>"):
        got = one(spark, article.extract(F.col("a"), F.col("b")), page, "x")
        assert got.channel == "" and got.breadcrumb == []
    assert article.article_text("<body><span>short</span></body>") == "short"
    liked = "<body><div class='hot'><p>" + "good words, more of them. " * 3 + "</p></div><div class='other'><p>" + "other words, more of them. " * 4 + "</p></div></body>"
    assert "good" in article.article_text(liked, positive="hot", negative="other")


def test_publish_time_weighs_context():
    assert article.publish_time("<p>built 2001-01-01</p><p>发布时间 2023年05月06日 10:11</p>" + "<p>rest</p>" * 80) == dt.datetime(2023, 5, 6, 10, 11)
    assert article.publish_time("<p>nothing</p>", "http://a/2022-03-04/x.html") == dt.datetime(2022, 3, 4)
    assert article.publish_time("<p>none</p>", "http://a/") is None
    assert article.publish_time("<p>on 2024-13-40 or 2024-02-30</p>") is None


def test_breadcrumb_by_words():
    root = dom.parse("<body><div><span>您的位置：</span><a href='/s'>体育</a><a href='javascript:x()'>足球</a></div><p>text</p></body>")
    assert [(b["name"], b["href"]) for b in article.breadcrumb(root, "http://h/x")] == [("体育", "http://h/s"), ("足球", "none")]
    assert article.breadcrumb(dom.parse("<body><p>no trail at all</p></body>"), "http://h/") == []


def test_measures_are_those_of_the_text():
    page = """<div> a, b <p>c，d <a href="x"> link <a>in</a></a> </p>\n<input type="hidden"><input><img> <ul><li>x<li> y </ul><embed></div><div>  </div>"""
    root, measures = dom.parse(page), article.Measures()
    for e in [*root.walk(), root]:
        m, own = measures(e), e.text()
        assert m.text == len(article.squeeze(own))
        assert m.links == sum(len(article.squeeze(a.text())) for a in e.find_all("a"))
        assert (m.commas, m.wide) == (own.count(","), own.count("，"))
        assert [m.p, m.img, m.li, m.input, m.embed] == [len(e.find_all(t)) for t in ("p", "img", "li", "input", "embed")]
        assert m.hidden == sum(x.get("type") == "hidden" for x in e.find_all("input"))


def test_extraction_leaves_the_tree_as_it_is():
    root = dom.parse("<title>t</title><body><div class='footer'>gone</div><div>loose text, that is long enough to be an article<p>more of it, and more</p></div>", clean=True)
    before = root.html()
    assert "loose text" in article.article_text(root) and root.html() == before


def test_deep_and_wide_pages_are_walked_once():
    page = "<div>" * 200 + "<p>some text here, that is long enough to count</p>" * 5000 + "</div>" * 200
    began = time.process_time()
    root = dom.parse(page, clean=True)
    assert article.article_text(root).count("\n") == 4999
    assert article.breadcrumb(root) == []
    assert time.process_time() - began < 10


def test_strings_and_tokens_that_say_nothing():
    assert all(article.NOISE_STRINGS.match(x) for x in ("123", "阅读", "分享到", "摘要：", "正文", "条"))
    assert not any(article.NOISE_STRINGS.match(x) for x in ("头条", "大", "|", "收藏"))
    assert all(article.NOISE_TOKENS.match(x) for x in ("123", "中", "大", "|", "次", "收藏"))
    assert not any(article.NOISE_TOKENS.match(x) for x in ("摘要", "正文", "条", "大象"))


def test_credits():
    assert article.credits(["2024-01-10", "新华网", "x"])[0] == "新华网"
    assert article.credits([]) == ("", "")
    assert article.credits(["作者", "李四", "来源", "某报"]) == ("某报", "李四")


def test_dom_paths(spark):
    page = "<?xml version='1.0'?><html><base href='http://b/d/'><body><ul id=u><li class='a x'>1<li class=b>2</ul><p>t<b>bold</b>tail<br>end<a href='../q'>l</a><script>a<b</script></body></html>"
    root = dom.parse(page, clean=True, base="http://b/")
    texts = lambda p: [dom.as_text(x).strip() for x in dom.xpath(root, p)]
    assert texts("//li") == ["1", "2"] and texts("//ul/li[2]") == ["2"]
    assert texts('//li[contains(@class, "x")]/text()') == ["1"] and texts('//*[@id="u"]/li[@class="b"]') == ["2"]
    assert texts("//a/@href | //li[1]") == ["http://b/q", "1"]
    assert texts("/html/body/p/b") == ["bold"] and texts("//p[count(x)]") == []
    assert [x.text() for x in dom.css(root, "ul > li.b, p b")] == ["2", "bold"]
    for e in dom.xpath(root, "//b"):
        e.drop()
    assert dom.xpath(root, "//p")[0].text() == "ttailendl"
    assert dom.plain_attributes(dom.parse('<p style="x" bgcolor=red onclick=y class=k>t</p>')).html() == '<p class="k">t</p>'
    assert one(spark, dom.xpath_all("//li")(F.col("a")), page) == ["1", "2"]
    assert one(spark, dom.css_first("li.b", "none")(F.col("a")), page) == "2" and one(spark, dom.xpath_first("//h9", "none")(F.col("a")), page) == "none"
    assert "bold" not in one(spark, dom.without("//b")(F.col("a")), page)
    assert one(spark, dom.absolute_links(F.col("a"), F.col("b")), "<a href='/x'>1</a><a href='/x'>2</a><iframe src='http://o/'></iframe>", "http://h/p") == ["http://h/x", "http://o/"]
    assert "<script" not in one(spark, dom.cleaned_html(F.col("a")), page)


def test_batches_are_handled_in_pieces(spark):
    """A batch of pages isn't Python objects all at once; rows, nulls and local times are those of the whole."""

    @arrow_function("n int, at timestamp")
    def seen(page: pd.Series) -> pd.DataFrame:
        at = [None if p is None else pd.Timestamp("2024-07-01 12:00") for p in page]
        return pd.DataFrame({"n": [len(page)] * len(page), "at": pd.to_datetime(pd.Series(at, dtype="datetime64[ns]"))})

    pages = spark.range(3000).repartition(1).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("p"), 4000)).alias("page"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        rows = pages.select("id", seen("page").alias("x")).select("id", "x.n", F.col("x.at").cast("timestamp_ntz").cast("string").alias("at")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(r.id for r in rows) == list(range(3000))
    assert max(r.n for r in rows) * 4000 < 2 * SLICE_BYTES
    assert {r.at for r in rows if r.id != 7} == {"2024-07-01 12:00:00"} and [r.at for r in rows if r.id == 7] == [None]
    assert spark.range(0).select(seen(F.lit("p"))).count() == 0
