"""Database tables against the Derby that Spark ships."""

import uuid

import pytest
from pyspark.sql import functions as F

from presswork.sources.tables import Table


@pytest.fixture
def url(spark):
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def table(spark, url, name):
    return Table(spark, url, name, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})


def test_parts_of_a_skewed_key_are_alike(spark, url):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, F.col("id") % 3000).otherwise(F.col("id") * 1_000_003).alias("ID"), F.col("id").alias("V"))
    own = table(spark, url, "SKEWED")
    own.write(df)
    own.run("INSERT INTO SKEWED VALUES (NULL, -1)", "INSERT INTO SKEWED VALUES (-77, -2)")
    read = own.read("ID", 8)
    sizes = [r.n for r in read.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and sum(sizes) == 20_002 and min(sizes) > 0.8 * max(sizes), sizes
    assert sorted(r.V for r in read.collect()) == sorted([*range(20_000), -1, -2])
    even = [r.n for r in spark.read.jdbc(url, "SKEWED", "ID", 0, 20_000_000_000, 8).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(even) > 5 * min(even), "equal steps of the key are what this is better than"


def test_hot_keys_and_small_tables(spark, url):
    own = table(spark, url, "HOT")
    own.write(spark.range(300).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).cast("long").alias("ID")))
    parts = own.predicates("ID", 6)
    assert 2 <= len(parts) <= 6 and own.read("ID", 6).count() == 300
    empty = table(spark, url, "VOID_T")
    empty.write(spark.range(0).select(F.col("id").alias("ID")))
    assert empty.predicates("ID", 4) == ["1 = 1"] and empty.read("ID", 4).count() == 0
    one = table(spark, url, "ONE_T")
    one.write(spark.range(1).select(F.col("id").alias("ID")))
    assert one.read("ID", 4).count() == 1 and one.read().count() == 1


def test_upserts_replace_and_add(spark, url):
    own = table(spark, url, "POSTS")
    own.write(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "K long, T string"))
    new = spark.createDataFrame([(2, "B"), (3, "C"), (3, "C")], "K long, T string").repartition(3)
    assert own.upsert(new, ["K"], "POSTS_NEW") == (1, 2)
    want = [(None, "n"), (1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, own.read().collect()), key=repr) == sorted(want, key=repr)
    assert own.upsert(new, ["K"], "POSTS_NEW") == (2, 2) and own.read().count() == 4, "done again, it changes nothing"


def test_a_failed_statement_takes_the_others_back(spark, url):
    own = table(spark, url, "T")
    own.write(spark.createDataFrame([(1,)], "K long"))
    with pytest.raises(Exception, match="NOWHERE"):
        own.run("DELETE FROM T", "DELETE FROM NOWHERE")
    assert own.read().count() == 1
