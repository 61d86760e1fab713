"""Numbers over a whole list, whatever adaptive execution does to its ranges."""

import random

import pytest
from pyspark.sql import functions as F

from presswork.operators import numbering


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(("start", "limits", "idx", "after"), [(3, 4, [3, 4, 0, 1], 2), (5, 4, [0, 1, 2, 3], 4), (0, 5, [0, 1, 2, 3, 4], 0), (0, 12, [0, 1, 2, 3, 4], 0), (2, 7, [2, 3, 4, 0, 1, 2, 3], 4), (4, 6, [4, 0, 1, 2, 3, 4], 0), (1, 0, [], 1)])
def test_circular_batch(spark, start, limits, idx, after):
    words = spark.createDataFrame([(i, f"w{i}", -1) for i in range(5)], "n int, w string, idx int")
    got, nxt = numbering.circular_batch(words, "n", start, limits)
    read = got.orderBy("place").collect()
    assert [r.idx for r in read] == idx and nxt == after and [r.place for r in read] == list(range(len(idx)))
    assert all(r.w == f"w{r.idx}" for r in read)
    assert numbering.circular_batch(words.limit(0), "n", start, limits)[0].count() == 0


def test_wide_rows_keep_their_numbers_under_adaptive_execution(spark, small_ranges):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 6).alias("wide"))
    got, after = numbering.circular_batch(rows, "k", 0, n)
    seen = got.agg(F.count("*"), F.count_distinct("idx"), F.min("idx"), F.max("idx"), F.count_if(F.col("idx") != F.col("k")), F.sum(F.length("wide"))).first()
    assert tuple(seen) == (n, n, 0, n - 1, 0, n * 192) and after == 0
    part, _ = numbering.circular_batch(rows, "k", 100_000, 1000)
    assert part.count() == 1000 and sorted(r.k for r in part.select("k").collect()) == list(range(100_000, 101_000))


def test_only_the_ranges_of_a_batch_are_read(spark, small_ranges):
    own = numbering.numbered(spark.range(100_000).withColumn("wide", F.repeat(F.md5(F.col("id").cast("string")), 6)), "id")
    assert own.ranges.count() > 2
    plan = own.between(50_000, 50_010)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(range), GreaterThanOrEqual(range" in plan
    assert own.between(50_000, 50_010).count() == 10 and own.between(99_999, 200_000).count() == 1 and own.between(100_000, 100_001).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_running_values_against_a_loop(spark, small_ranges, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(6)]), k, rng.choice([None, rng.randint(-9, 9)]), {"m": "x"}) for k in range(rng.choice([1, 400]))]
    df = spark.createDataFrame(rows, "a int, b int, v long, extra map<string,string>").repartition(7)
    got = numbering.running(df, F.col("v"), "total", "a", "b").collect()
    so_far, want = 0, []
    for a, b, v, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        so_far += v or 0
        want.append((a, b, v, so_far))
    assert sorted(((r.a, r.b, r.v, r.total) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1])) == want
    assert numbering.running(df.limit(0), F.col("v"), "total", "a").count() == 0


def test_equal_rows_all_get_a_number(spark):
    df = spark.createDataFrame([(1, "x")] * 40 + [(2, "y")] * 3 + [(None, None)] * 2, "k int, v string").repartition(5)
    got = numbering.numbered(df, "k").all().collect()
    assert sorted(r.idx for r in got) == list(range(45)) and {r.idx for r in got if r.k is None} == {0, 1} and {r.idx for r in got if r.k == 2} == {42, 43, 44}
