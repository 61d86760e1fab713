"""Counters that several writers raise, and the first-seen store: what it reads, keeps and drops."""

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.operators import crawl, dedup, seen
from presswork.sources import control


def test_writers_get_disjoint_ranges(spark, tmp_path):
    counters = [control.Counter(spark, f"{tmp_path}/ids") for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = [r for rs in pool.map(lambda c: [c.take(n, start=100) for n in (3, 1, 5)], counters) for r in rs]
    assert sorted(x for r in got for x in r) == list(range(101, 137))
    assert counters[0].read() == (12, 136)


def test_a_lost_race_is_retried_and_a_value_never_falls(spark, tmp_path):
    a, b = (control.Counter(spark, f"{tmp_path}/c") for _ in range(2))
    asked = []

    def slow(old):
        asked.append(old)
        if len(asked) == 1:
            b.raise_to(50)  # the other writer is first
        return (old or 0) + 1

    assert a.change(slow) == (50, 51) and asked == [None, 50]
    assert b.raise_to(40) == 51 and b.raise_to(60) == 60 and a.read()[1] == 60
    always = control.Counter(spark, f"{tmp_path}/d", tries=2)
    with pytest.raises(control.LostRaceError):
        always.change(lambda old: [b.__class__(spark, f"{tmp_path}/d").take(1), (old or 0) + 1][1])


def test_batches_of_ids_share_a_counter(spark, tmp_path):
    counter = control.Counter(spark, f"{tmp_path}/ids")
    counter.raise_to(100)
    retry = spark.createDataFrame([(9,), (7,), (8,)], "id long")
    first, second = (crawl.counted_batch(spark, retry, counter, 5, 3, "u/%d").collect() for _ in range(2))
    assert [(r.id, r.is_retry) for r in sorted(first)] == [(7, True), (8, True), (101, False), (102, False), (103, False)]
    assert sorted(r.id for r in second if not r.is_retry) == [104, 105, 106] and {r.url for r in first if r.is_retry} == {"u/7", "u/8"}


def test_old_versions_go(spark, tmp_path):
    c = control.Counter(spark, f"{tmp_path}/c")
    for _ in range(control.KEPT + 5):
        c.take(1)
    assert c.read() == (control.KEPT + 5, control.KEPT + 5) and len(c._versions()) <= control.KEPT + 1
    assert not list(tmp_path.glob("c/_draft*"))


def test_filters_have_all_their_keys_and_few_others():
    rng = np.random.default_rng(1)
    own, other = (rng.integers(-(2**63), 2**63, (n, 2), np.int64) for n in (5000, 20_000))
    bits = seen.filter_of(own[:, 0], own[:, 1])
    assert seen.may_hold(bits, own[:, 0], own[:, 1]).all()
    assert seen.may_hold(bits, other[:, 0], other[:, 1]).mean() < 0.02
    assert not seen.may_hold(seen.filter_of(own[:0, 0], own[:0, 1]), own[:, 0], own[:, 1]).any()


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour, tzinfo=dt.timezone.utc)


def store_of(spark, folder, **options):
    return seen.SeenStore(spark, str(folder), **options)


def frame(spark, rows):
    return spark.createDataFrame(rows, "dedup_key string, first_seen timestamp, extra int")


def test_a_batch_reads_its_own_partitions_only(spark, tmp_path):
    store = store_of(spark, tmp_path / "s", buckets=16)
    store.add(frame(spark, [(f"k{n}", at(1 + n % 3), 0) for n in range(300)]))
    every = len(list((tmp_path / "s/keys").glob("*/*/*.parquet")))
    one = store.met(frame(spark, [("k7", at(9), 0), (None, at(9), 0)]))
    assert every > 40 and len(one.inputFiles()) <= 2 and one.where("key = 'k7'").count() == 1
    assert store.met(frame(spark, [("nobody", at(9), 0)])) is None or len(store.met(frame(spark, [("nobody", at(9), 0)])).inputFiles()) <= 2
    files = set((tmp_path / "s").rglob("*.parquet"))
    store.add(frame(spark, [("new", at(2), 0), ("k7", at(9), 0)]))
    more = set((tmp_path / "s").rglob("*.parquet"))
    assert files < more and len(more - files) == 2, "one file of keys and one of filters is added, none is rewritten"


def test_store_equals_the_one_that_is_rewritten(spark, tmp_path):
    rng = random.Random(3)
    store, whole = store_of(spark, tmp_path / "s", buckets=4), spark.createDataFrame([], "key string, first_seen timestamp")
    for day in range(1, 5):
        rows = [(rng.choice([None, *(f"k{n}" for n in range(40))]), at(day, rng.randrange(24)), k) for k in range(30)]
        df = frame(spark, rows)
        left = {r.extra for r in store.unseen(df).collect()}
        assert left == {r.extra for r in dedup.unseen(df, whole).collect()}
        new = {r.key for r in store.add(df).collect()}
        assert new == {r.dedup_key for r in df.collect() if r.extra in left and r.dedup_key}
        whole = spark.createDataFrame(dedup.add_seen(whole, df.where("dedup_key is not null").select(F.col("dedup_key").alias("key"), "first_seen")).collect(), whole.schema)
    assert sorted(map(tuple, store.rows().collect())) == sorted(map(tuple, whole.collect()))


def test_days_are_dropped_and_hours_told(spark, tmp_path):
    store = store_of(spark, tmp_path / "s", buckets=2, ttl_seconds=2 * 86_400)
    store.add(frame(spark, [("a", at(1, 5), 0), ("b", at(3, 5), 0), ("c", at(3, 7), 0), ("d", at(4), 0)]))
    now = at(5, 6)
    keys = spark.createDataFrame([(k,) for k in "abcde"], "dedup_key string")
    assert {r.dedup_key for r in store.unseen(keys, now=now).collect()} == {"a", "b", "e"}
    assert {r.dedup_key for r in store.unseen(keys).collect()} == {"e"}
    assert store.purge(now) == [at(1).date()] and store.days() == [at(3).date(), at(4).date()]
    rules = spark.createDataFrame([("s", 2 * 86_400)], "store string, ttl_seconds long")
    table = spark.createDataFrame([("s", "a", at(1, 5)), ("s", "b", at(3, 5)), ("s", "c", at(3, 7)), ("s", "d", at(4))], "store string, key string, first_seen timestamp")
    assert {r.key for r in store.rows(now).collect()} == {r.key for r in dedup.purge(table, rules, F.lit(now))[0].collect()} == {"c", "d"}
    store.add(frame(spark, [("b", now, 0)]), now=now)
    assert {(r.key, r.first_seen.astimezone(dt.timezone.utc)) for r in store.rows(now).collect() if r.key == "b"} == {("b", now)}, "an address that was forgotten is new again"


def test_an_empty_store(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    assert store.rows().count() == 0 and store.purge(at(5)) == [] and store.unseen(frame(spark, [("a", at(1), 0)])).count() == 1
    assert store.add(frame(spark, [])).count() == 0 and store.add(frame(spark, [("a", None, 0), (None, at(1), 0)])).count() == 0
