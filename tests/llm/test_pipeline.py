"""Every stage of the pipeline against plain Python, on what its predecessor kept."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from presswork.llm import quality, secrets
from tests.llm.test_minhash_join import brute
from tests.llm.test_record_operators import mix_by_hand
from tests.llm.test_text_operators import base_spans, check_places, tokenizer


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "minhash near-dedup", "secret scans", "source mixing", "best-fit packing"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_rejected_documents_go(spark, sf, stages):
    model = quality.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    bad = {r.doc_id for r in quality.scored(stages[0], model).where("score < 0.5").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert kept == {r.doc_id for r in stages[0].collect()} - bad
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, (_, _, kept) in brute(rows, width=5).items() if kept}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_secrets_are_replaced(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        if secrets.scan(before[i].text or ""):
            assert not base_spans(r.text) and "[SECRET]" in r.text and r.n_chars == len(r.text)
        else:
            assert r == before[i]


def test_mix_repeats_documents(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    got = Counter(r.doc_id for r in stages[4].collect())
    for i, size, _, _, taken in mix_by_hand(rows):
        if size:
            assert got[i] == taken // size
    text = {i: t for i, t, _ in rows}
    assert all(text[r.doc_id] == r.text for r in stages[4].collect())


def test_all_copies_are_packed(stages):
    tok = tokenizer()
    want = defaultdict(int)
    for r in stages[4].collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1
        for k, s in enumerate(range(0, n, 4096)):
            want[r.doc_id, k, s, min(4096, n - s)] += 1
    rows = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in rows) == want
    check_places(rows, 4096)


def test_run_gives_the_last_stage(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == stages[5].columns and got.count() == stages[5].count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_and_odd_tables(spark, sf):
    text = "one two three four five six seven eight nine ten " * 4
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)]
    rows += [(i, t, "en", s, len(t)) for i, t, s in ((2, text + "pwd: Xq7!vR2#kLp9zW", "s"), (3, text, "s"), (4, "zero " + text, "t"))]
    clash = "key long, lot int, _n int, copies int, row string, bytes binary, a long, score double"
    odd = spark.createDataFrame([(*r, 7, 7, 7, 7, "x", b"x", 7, 7.0) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {clash}")
    given = Counter(map(tuple, odd.collect()))
    stage = dict(corpus_pipeline.STAGES)
    for name in stage:
        assert stage[name](spark, odd.limit(0), sf).count() == 0, name
    out = {name: stage[name](spark, odd, sf) for name in stage}
    got = {name: df.collect() for name, df in out.items()}
    for name in list(stage)[:-1]:
        assert out[name].columns == odd.columns, name

    # a text without a word has the model's prior; rows that repeat stay or go together
    model = quality.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = Counter(map(tuple, got["quality classifier"]))
    assert all(given[r] == n for r, n in kept.items())
    assert all((r in kept) == (model.offset >= 0) for r in given if not r[1])
    # without words nothing is linked; a doc_id that repeats stands once; of near copies the smallest doc_id stays
    assert sorted((r.doc_id or 0) for r in got["minhash near-dedup"]) == [0, 1, 2]
    # what isn't a secret is unchanged, n_chars too
    secret = Counter(map(tuple, got["secret scans"]))
    changed = list((secret - given).elements())
    assert sum(secret.values()) == len(rows) and len(changed) == 1
    assert changed[0][:2] == (2, text + "pwd: [SECRET]") and changed[0][4] == len(changed[0][1])
    # copies are whole rows, as often as the mix takes them
    assert set(map(tuple, got["source mixing"])) <= set(given)
    # each row is packed, null and empty texts as their end alone
    pieces = got["best-fit packing"]
    assert sorted((r.doc_id or 0) for r in pieces) == [0, 1, 1, 2, 3, 4]
    assert all(r.length == 1 for r in pieces if r.doc_id in (None, 1))
