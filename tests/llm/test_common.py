"""What all operators leave as it was: the session's settings, and columns of any name."""

from collections import Counter

from presswork.llm import mixing, queries
from presswork.llm.common import Scratch, sliced

import pyarrow as pa


def settings_of(spark):
    return {r.key: r.value for r in spark.sql("SET").collect()}


def test_no_setting_is_left_changed(spark, sf):
    before = settings_of(spark)
    for name in ("op2_quality_classifier", "op3_warc_salvage", "op6_secret_scan", "op9_source_mixing"):
        assert queries.queries()[name](spark, sf).count() > 0
        assert settings_of(spark) == before, name


def test_scratch_reads_back(spark):
    scratch = Scratch(spark, "t")
    assert sorted(r.id for r in scratch.cut(spark.range(5)).collect()) == [0, 1, 2, 3, 4]


def test_sliced():
    batch = pa.RecordBatch.from_pydict({"a": list(range(10))})
    assert [b.num_rows for b in sliced(iter([batch, batch.slice(0, 0)]), 4)] == [4, 4, 2]


def test_mixture_keeps_columns_of_any_name(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 3}", 77, 5, "x", 1) for i in range(60)] + [(None, "a b", None, 1, 1, "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int, copies int, row string, `a.b` int")
    got = mixing.mixture(spark, df)
    assert got.dtypes == df.dtypes
    assert all(tuple(r) in rows for r in got.collect())
    taken = Counter(r.doc_id for r in got.collect())
    want = {r.doc_id: r.taken // r.size for r in mixing.mix(spark, df).collect()}
    assert {i: taken[i] for i in want} == want
    assert mixing.mixture(spark, df.limit(0)).collect() == []


def test_mix_of_one_document_many_times(spark):
    from tests.llm.test_record_operators import mix_by_hand

    rows = [(1, "a b c", "x")] * 10_000 + [(2, "a b", "y"), (3, None, "x"), (None, "q", "y"), (None, "q", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, mixing.mix(spark, df).collect()), key=repr) == mix_by_hand(rows)
