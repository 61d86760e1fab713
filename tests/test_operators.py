"""Operators, the builder, sources, sinks and streams on small literal tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presswork.functions import dates, text, urls
from presswork.operators import crawl, dedup, quality
from presswork.plans import crawl as plan
from presswork.plans.builder import Query
from presswork.sources import queues, readers, sinks
from presswork.streaming import streams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n, h=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)


def test_reconcile_and_ids(spark):
    df = spark.createDataFrame([(9501,), (9500,), (20000,)], "id long")
    assert rows(crawl.reconcile(df, F.lit(10000))) == [(20000, "retry"), (9500, "gone"), (9501, "retry")]
    got, top = crawl.id_batch(spark, df, 100, 5, 2, "u/%d")
    assert [r.id for r in got.collect() if r.is_retry] == [9500, 9501, 20000] and sorted(r.id for r in got.collect() if not r.is_retry) == [101, 102] and top == 102
    assert crawl.high_water(F.lit(7).cast("long"), df).first()[0] == 20000
    assert crawl.high_water(F.lit(7).cast("long"), df.limit(0)).first()[0] == 7


def test_dedup_and_ttl(spark):
    now = day(20)
    seen = spark.createDataFrame([("s", "a", day(8)), ("s", "b", day(9)), ("s", "c", day(11)), ("s", "d", day(19)), ("s", "e", day(10)), ("t", "f", day(0))], "store string, key string, first_seen timestamp")
    rules = spark.createDataFrame([("s", 10 * dedup.DAY)], "store string, ttl_seconds long")
    stays, counts = dedup.purge(seen, rules, F.lit(now).cast("timestamp"))
    assert sorted(r.key for r in stays.collect()) == ["c", "d", "f"]
    assert rows(counts) == [("s", 3), ("t", 0)]
    kept = dedup.add_seen(seen.select("key", "first_seen"), spark.createDataFrame([("a", day(19)), ("n", day(1))], "key string, first_seen timestamp"))
    assert {r.key: r.first_seen for r in kept.collect()}["a"] == day(8) and kept.count() == 7
    df = spark.createDataFrame([("http://x?b=1&a=2", 2), ("http://x?a=2&b=1", 1), ("http://y", 3), (None, 4)], "url string, n int")
    keyed = dedup.with_key(df, salt="k:")
    assert rows(dedup.first_seen(keyed.where("url is not null"), "dedup_key", "n").select("n")) == [(1,), (3,)]
    left = dedup.unseen(keyed, spark.createDataFrame([("k:http://y",)], "key string"))
    assert sorted(r.n for r in left.collect()) == [1, 2, 4]


def test_routes(spark):
    df = spark.createDataFrame([("http://n/2020/55",), ("http://w/u?id=9",), ("http://z",)], "url string")
    routes = [dedup.Route(r"//n/(\d+)/(\d+)", "news"), dedup.Route(r"//w/", "micro")]
    assert rows(dedup.routed(df, routes, "rest")) == [("http://n/2020/55", "news", "202055"), ("http://w/u?id=9", "micro", "http://w/u?id=9"), ("http://z", "rest", "http://z")]
    seen = spark.createDataFrame([("news", "202055"), ("micro", "202055")], "store string, key string")
    assert dedup.unseen_by_route(df, seen, routes, "rest").count() == 2


def test_lookup_and_windows(spark):
    pairs = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "url string, channel string, seq int")
    assert rows(crawl.lookup(spark.createDataFrame([("a",), ("b",)], "url string"), pairs, "url", "channel", "seq", " ")) == [("a", "new"), ("b", " ")]
    q = spark.createDataFrame([(1, "u"), (2, "u"), (3, None), (4, None)], "seq int, username string")
    first, rest = crawl.first_per_user(q, "username", "seq")
    assert sorted(r.seq for r in first.collect()) == [1, 3, 4] and [r.seq for r in rest.collect()] == [2]
    assert rows(crawl.keyword_urls(spark.createDataFrame([("7\tx y",), ("z",)], "line string"), "q=%s&p=%d", 0, 2).select("url", "topic_id")) == [("q=x+y&p=0", "7"), ("q=x+y&p=1", "7"), ("q=z&p=0", ""), ("q=z&p=1", "")]


def test_envelope(spark):
    p = spark.createDataFrame([("t", None, "0401", "<p>"), ("", "own", "01", "<b>")], "title string, site string, info_flag string, html string")
    out = crawl.with_config(crawl.enveloped(p, site="s", worker_id="9"), {"a": "1"})
    assert [(r.site, r.worker_id, r.config_info) for r in out.collect()] == [("s", "9", {"a": "1"}), ("own", "9", {"a": "1"})]
    assert crawl.with_title(p).count() == 1
    packed = crawl.packed_page(p).collect()
    assert packed[0].html == "<p>" and packed[0].html_base64 is None and packed[1].html == "" and packed[1].html_base64


def log_of(spark):
    data = [(1, "c", "u1", day(0), "ok", None, None, ["author"]), (2, "c", "u2", day(0, 1), "parse_failed", "E", "first", ["author", "title"]), (3, "c", "u3", day(0, 2), "download_failed", "E", "last", [])]
    return spark.createDataFrame(data, "seq long, config_id string, url string, ts timestamp, status string, exc_name string, exc_detail string, empty_fields array<string>")


def test_run_statistics(spark):
    log = log_of(spark)
    s = quality.run_summary(log).first()
    assert (s.new_count, s.parse_success_num, s.parse_failed_num, s.download_failed_num, s.finished, s.end_time - s.start_time) == (3, 1, 1, 1, True, 7200)
    assert rows(quality.field_failures(log)) == [("author", "2/3/1"), ("title", "1/3/1")]
    assert rows(quality.never_parsed(log, ["author", "title"])) == [("author", False), ("title", False)]
    assert rows(quality.never_parsed(log.where("seq < 3"), ["author", "title"])) == [("author", True), ("title", False)]
    e = quality.error_samples(log).first()
    assert (e.exc_name, e.n, e.detail, e.urls) == ("E", 2, "last", ["u2", "u3"])
    assert quality.error_samples(log, cap=1).first().urls == ["u2"]
    seen = []
    plan.BEFORE_STOP.append(lambda df: seen.append(df.count()))
    plan.finished(log)
    plan.BEFORE_STOP.clear()
    assert seen == [1]


def test_quality_checks(spark):
    df = spark.createDataFrame([("", 3, day(0)), ("x", -1, dt.datetime(2024, 1, 1, 0, 0, 0, 5)), ("x", None, None)], "title string, visitCount int, ctime timestamp")
    assert [r[0] for r in df.select(quality.empty_fields(df, ["title"], ["visitCount"], "ctime")).collect()] == [["title"], ["visitCount", "ctime"], ["visitCount", "ctime"]]
    counts = spark.createDataFrame([(None, [(5,)]), (3, None)], "n int, l array<struct<count:int>>")
    assert [r[0] for r in counts.select(quality.count_of(F.col("n"), F.col("l"))).collect()] == [5, 3]


def test_builder_is_immutable(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, username string")
    q = Query(spark).table(t)
    assert [r.id for r in q.where("id > 1").order({"id": -1}).find().collect()] == [3, 2]
    assert q.find().count() == 3 and q.limit(0).find().count() == 3 and q.limit(-1, 2).find().count() == 3
    assert [r.id for r in q.order({"id": 1}).limit(1, 1).find().collect()] == [2]
    assert q.where("id > 5").where("id = 1").count().first().n == 1
    assert rows(q.where("username = 'a'").update({"username": "it's"}).select("username")) == [("it's",), ("b",), (None,)]
    assert q.where("username = 'a'").delete().count() == 2 and q.delete().count() == 0
    assert rows(q.add([{"username": "z", "id": 9}, {"id": 8}]).where("id > 3")) == [(8, None), (9, "z")]
    with pytest.raises(ValueError):
        Query(spark).find()


def test_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert readers.connect(spark, f"parquet://{tmp_path}/t").count() == 3
    assert readers.connect(spark, "main", {"main": f"parquet://{tmp_path}/t"}).count() == 3
    with pytest.raises(ValueError):
        readers.connect(spark, "nope://x")
    q = spark.createDataFrame([(1, '{"a":"x","ctime":86400}'), (2, "broken")], "seq int, value string")
    got = readers.decoded_queue(readers.popped(q, 5), "a string, ctime long").collect()
    assert [(r.seq, r.a, r.ctime) for r in got] == [(2, None, None), (1, "x", dt.datetime(1970, 1, 2))]
    host = lambda shape, doc: rows(readers.listed_hosts(spark.createDataFrame([(doc,)], "value string"), shape))
    want = [("http", "1.1.1.1", "80")]
    assert host("nested", '{"data":{"proxy_list":["1.1.1.1:80"]}}') == want
    assert host("lines", "1.1.1.1:80\r\n1.1.1.1:80") == want
    assert host("data", '{"data":[{"ip":"1.1.1.1","port":80}]}') == want == host("result", '{"RESULT":[{"ip":"1.1.1.1","port":"80"}]}') == host("array", '[{"ip":"1.1.1.1","port":"80"}]')
    s = readers.Settings("# top\n[a]\nx = 1\n; note\ny = %(x)s2\n")
    s.set("a", "x", "5")
    s.set("a", "z", "7")
    s.set("b", "k", "v")
    assert str(s) == "# top\n[a]\nx = 5\n; note\ny = %(x)s2\nz = 7\n\n[b]\nk = v\n" and s.get("a", "y") == "52" and s.get("q", "y", "d") == "d"
    assert readers.arguments(["--config", "c", "--debug"]).debug and readers.seeds(spark, None).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "id int, t string")
    assert sinks.send(df, f"parquet://{tmp_path}/p") and spark.read.parquet(f"{tmp_path}/p").count() == 2
    assert sinks.send(df, f"redis://h{tmp_path}/q") and sorted(r.value for r in queues.messages(spark, f"{tmp_path}/q").collect()) == ['{"id":1,"t":"é"}', '{"id":2}']
    assert sinks.send(df, "zmq://x") is False and sinks.sink_for("rocket_mq://x")[0] == "rocketmq"
    with pytest.raises(ValueError):
        sinks.sink_for("smtp://x")
    log = spark.createDataFrame([("c", i) for i in range(5)], "config_id string, end_time int")
    assert sorted(r.end_time for r in sinks.run_log(log, log.limit(0), 2).collect()) == [3, 4]
    m = spark.createDataFrame([(i,) for i in range(4)], "seq int")
    assert sinks.monitor_log(m, m.limit(1), 3).count() == 1 and sinks.monitor_log(m, m.limit(1), 4).count() == 5 and sinks.monitor_log(m, m.limit(1), 3, keep=True).count() == 4
    assert "_message" in sinks.log_rows(spark.createDataFrame([("m",)], "message string"), worker_id="3").first().value


def test_pages_to_posts(spark):
    page = "<html><title>A title here</title><body><h1>A title here</h1><p>" + "Some words, many of them, in a paragraph. " * 5 + "</p></body></html>"
    p = spark.createDataFrame([(1, "http://a/1", page, 200), (2, "javascript:x", page, 200), (3, "http://a/3", page, 500), (4, "http://a/4", "", 404)], "page_id long, url string, html string, status int")
    out = plan.posts(p, F.lit(day(3)).cast("timestamp"), {"k": "v"}, info_flag="01").collect()
    assert [(r.page_id, r.title, r.info_flag, r.config_info) for r in out] == [(1, "A title here", "01", {"k": "v"})]
    assert out[0].content.startswith("Some words") and plan.rejected_addresses(p, "f").count() == 1
    linked = spark.createDataFrame([(1, "http://a/x", '<a href="/1">1</a><a href="/1">1</a><a href="http://b/?z=1&y=2">2</a>')], "page_id long, url string, html string")
    assert sorted(r.detail_url for r in plan.links(linked).collect()) == ["http://a/1", "http://b/?z=1&y=2"]
    seen = spark.createDataFrame([("http://b/?y=2&z=1",)], "key string")
    assert [r.detail_url for r in plan.new_work(plan.links(linked), seen).collect()] == ["http://a/1"]


def test_pages_are_parsed_once(spark, sf, capsys):
    """The filters after the extraction take what it gave; they don't run it again in Python workers of their own."""
    plan.posts(spark.read.parquet(f"{sf}/pages.parquet"), F.lit(day(3)).cast("timestamp"), {"k": "v"}, max_days=20, info_flag="01").explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_frontier(spark):
    graph = {"a": ["b", "c"], "b": ["c", "d"], "d": ["a", "e"]}
    edges = spark.createDataFrame([(x, y) for x, ys in graph.items() for y in ys], "url string, nxt string")
    grow = lambda df: df.join(edges, "url").select(F.col("nxt").alias("url"))
    found = plan.frontier(readers.seeds(spark, ["a"]), grow, lambda df: spark.createDataFrame(df.collect(), df.schema), 2)
    assert sorted(r.url for r in found.collect()) == ["a", "b", "c", "d"]


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_stream_is_batch(spark, tmp_path):
    rng = random.Random(2)
    data = [(i, f"http://h/{rng.randint(0, 20)}", day(0, rng.randint(0, 40))) for i in range(100)]
    df = spark.createDataFrame(data, "id int, url string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    out = []
    streams.run_available(streams.first_seen(stream_of(spark, str(tmp_path / "in"), df.schema)), lambda b, _: out.extend(b.collect()), str(tmp_path / "c1"))
    assert sorted(r.url for r in out) == sorted({u for _, u, _ in data})
    counts = []
    daily = streams.daily_counts(stream_of(spark, str(tmp_path / "in"), df.schema).withColumn("config_id", F.lit("c")))
    streams.run_available(daily, lambda b, _: counts.extend(b.collect()), str(tmp_path / "c2"), "update")
    assert sum(r.n for r in counts) == 100
    streams.run_available(stream_of(spark, str(tmp_path / "in"), df.schema), sinks.to_batches(f"parquet://{tmp_path}/sunk"), str(tmp_path / "c3"))
    assert spark.read.parquet(str(tmp_path / "sunk")).count() == 100


def test_stream_ttl(spark, tmp_path):
    df = spark.createDataFrame([("k", day(0)), ("k", day(1)), ("k", day(3)), ("k", day(4)), ("j", day(1))], "dedup_key string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
    out = []
    try:
        streams.run_available(streams.first_seen_ttl(stream_of(spark, str(tmp_path / "in"), df.schema), 3 * dedup.DAY), lambda b, _: out.extend(b.collect()), str(tmp_path / "c"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert sorted((r.dedup_key, r.ts) for r in out) == [("j", day(1)), ("k", day(0)), ("k", day(3))]


def test_joined_addresses(spark):
    from urllib.parse import urljoin

    bases = ["http://a.com/x/y.html?q=1#f", "https://a.com", "http://a.com/", "http://a.com/d/"]
    hrefs = ["b.html", "/r", "//h.com/z", "?p=2", "#top", "", "../up", "./here?x=1", "../../../far#f", "http://o.com/q", "d/../e/", "..", "mailto:x@y", "a/b/c"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for b, h, got in df.select("b", "h", urls.joined(F.col("b"), F.col("h"))).collect():
        assert got == urljoin(b, h), (b, h)


def test_link_patterns_bases_and_domains(spark):
    html = '<base href="/deep/"><a href="go?to=http://x.com/1&n">1</a><a href="http://x.com/2">2</a><a href="http://y.com/3">3</a><iframe src="frame.html"></iframe><a href="?p=2">n</a>'
    p = spark.createDataFrame([(1, "http://a.com/x/", html)], "page_id long, url string, html string")
    found = lambda **k: sorted(r.detail_url for r in plan.links(p, **k).collect())
    assert found() == ["http://a.com/deep/?p=2", "http://a.com/deep/frame.html", "http://a.com/deep/go?to=http://x.com/1&n", "http://x.com/2", "http://y.com/3"]
    assert found(pattern=r"http://[^&]*")[2] == "http://x.com/1" and found(pattern=r"to=(http://[^&]*)")[2] == "http://x.com/1"
    assert found(domains=["x.com"]) == ["http://a.com/deep/?p=2", "http://a.com/deep/frame.html", "http://a.com/deep/go?to=http://x.com/1&n", "http://x.com/2"]


def test_page_ctime_chain(spark):
    g = dt.datetime(2024, 3, 1, 10)
    cases = [
        (dt.datetime(2024, 1, 2, 12), "<body>2015-02-11 18:07</body>", dt.datetime(2024, 1, 2, 4)),
        (None, "<head>2011-01-01 01:01</head><body>on 2015-02-11 18:07:00</body>", dt.datetime(2015, 2, 11, 10, 7)),
        (None, "<body>2015年02月12日 06:48</body>", dt.datetime(2015, 2, 11, 22, 48)),
        (None, "<body>2015年2月12</body>", dt.datetime(2015, 2, 11, 16)),
        (None, "<body>2015年13月12</body>", g),
        (None, "<body>nothing</body>", g),
        (None, None, g),
    ]
    df = spark.createDataFrame([(i, p, h) for i, (p, h, _) in enumerate(cases)], "i int, p timestamp, h string")
    got = dict(df.select("i", dates.page_ctime(F.col("p"), F.col("h"), F.lit(g).cast("timestamp"))).collect())
    assert [got[i] for i in range(len(cases))] == [w for _, _, w in cases]


def test_sites_and_stages(spark):
    """List to detail to data by a site's callbacks, next pages included."""
    web = {f"http://s/{i}": f"<b>t{i}</b>" + (f"<i>http://s/{i}b</i>" if i == 1 else "") for i in range(3)} | {"http://s/1b": "<b>t1b</b>", "http://s/9": None, "http://s/8": "no record"}
    table = spark.createDataFrame(list(web.items()), "url string, html string")

    def records():
        t = F.regexp_extract("html", "<b>(.*?)</b>", 1)
        more = F.filter(F.array(F.regexp_extract("html", "<i>(.*?)</i>", 1)), lambda u: u != "")
        return F.when(t != "", F.array(F.struct(t.alias("title"), more.alias("next_urls"))))

    plan.SITES["s"] = plan.Site(lambda p: plan.links(p, domains=["s"]), records)
    try:
        lists = spark.createDataFrame([(1, "http://s/", "".join(f'<a href="http://s/{i}">x</a>' for i in (0, 1, 2, 8, 9)) + '<a href="http://other/1">y</a>')], "page_id long, url string, html string")
        keep = lambda df: spark.createDataFrame(df.collect(), df.schema)
        run = plan.crawled(lists, lambda u: u.join(table, "url", "left"), keep, "s", seen=spark.createDataFrame([("http://s/2",)], "key string"))
        assert {r.url[9:]: r.status for r in run.details.collect()} == {"0": "ok", "1": "ok", "8": plan.PARSE_FAILED, "9": plan.DOWNLOAD_FAILED, "1b": "ok"}
        assert sorted((r.url[9:], r.title) for r in run.data.collect()) == [("0", "t0"), ("1", "t1"), ("1b", "t1b")]
        assert run.new_total == 5 and "next_urls" not in run.data.columns
    finally:
        del plan.SITES["s"]
    chain = spark.createDataFrame([(f"http://c/{n}", f"<h1>{n}</h1>") for n in range(30)], "url string, html string")

    def linked():
        following = F.concat(F.lit("http://c/"), (F.substring_index("url", "/", -1).cast("int") + 1).cast("string"))
        return F.array(F.struct(F.col("html").alias("title"), F.array_compact(F.array(F.when(~F.col("url").endswith("/29"), following))).alias("next_urls")))

    plan.SITES["c"] = plan.Site(lambda p: p.select(F.col("url").alias("channel_url"), F.lit("http://c/0").alias("detail_url")), linked)
    try:
        start = spark.createDataFrame([("http://c/list", "<a>")], "url string, html string")
        run = plan.crawled(start, lambda u: u.join(chain, "url", "left"), keep, "c")
        assert run.data.count() == 30 and run.new_total == 30 and run.left.count() == 0
        run = plan.crawled(start, lambda u: u.join(chain, "url", "left"), keep, "c", rounds=3)
        assert run.data.count() == 3 and run.new_total == 3 and [r.url for r in run.left.collect()] == ["http://c/3"]
    finally:
        del plan.SITES["c"]
    page = "<title>A title</title><body><p>" + "Some words, many of them. " * 9 + "</p></body>"
    got = plan.detailed(spark.createDataFrame([("u1", page), ("u2", None), ("u3", "")], "url string, html string")).collect()
    assert {r.url: r.status for r in got} == {"u1": plan.PARSED, "u2": plan.DOWNLOAD_FAILED, "u3": plan.PARSE_FAILED}


def test_first_seen_of_posts_with_maps(spark):
    df = spark.createDataFrame([("k", None, {"a": "1"}), ("k", day(2), {"b": "2"}), ("k", day(1), {"c": "3"}), ("n", None, None)], "key string, t timestamp, m map<string,string>")
    assert sorted((r.key, r.t, r.m) for r in dedup.first_seen(df, "key", "t").collect() if r.key == "k") == [("k", day(1), {"c": "3"})]
    assert dedup.first_seen(df, "key", "t").where("key = 'n'").count() == 1


def test_backward_purge(spark):
    now = F.lit(day(30)).cast("timestamp")
    seen = spark.createDataFrame([(f"k{n}", day(n)) for n in (5, 11, 12, 29)], "key string, first_seen timestamp")
    stay, gone = dedup.purge_backward(seen, now, 10, 60)
    assert sorted(r.key for r in stay.collect()) == ["k29"] and gone.first().asDict() == {"day": 18, "purged": 3}
    stay, gone = dedup.purge_backward(seen, now, 26, 60)
    assert stay.count() == 4 and gone.first().asDict() == {"day": None, "purged": 0}
