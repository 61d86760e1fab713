import random
import re

from presswork.llm.minhash_join import near_duplicates, one_of_each


def brute(rows, width=4, percent=80):
    """component of every doc_id, by comparing all pairs of full sets."""
    sets = {}
    for i, text in rows:
        t = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark, df, **kw).collect()}


def test_whole_table_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_edge_cases(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words[:40] + ["x"] + words[41:])
    rows = [(1, " ".join(words)), (2, near), (3, None), (4, ""), (5, " \t\n"), (6, "A b"), (7, "a  B\n"), (8, "b a"), (9, " ".join(words).upper()), (10, "é É"), (11, "é é"), (12, "z" * 300_000), (13, "one two three four"), (14, "one two three")]
    got = found(spark, rows)
    assert got == brute(rows)
    assert got[3] == (0, 3, True) and got[7] == (1, 6, False)
    assert found(spark, []) == {}


def test_copies_edited_in_different_places(spark):
    base = [f"t{i}" for i in range(200)]
    rows = [(100 + k, " ".join(base[:k] + ["edit", str(k)] + base[k + 2 :])) for k in range(0, 150, 3)] + [(5, " ".join(base[:90]))]
    assert found(spark, rows) == brute(rows)


def test_a_group_of_half_similar_texts(spark):
    """Most pairs lie between 0.5 and 0.8: the rarest shingles choose what is compared, and no link is lost."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(150)] = f"e{rng.randrange(40)}"
        if rng.random() < 0.3 and rows:  # copies of copies
            words = rng.choice(rows)[1].split()
            words[rng.randrange(150)] = "again"
        rows.append((k, " ".join(words)))
    got = found(spark, rows)
    assert got == brute(rows)
    assert len({c for _, c, _ in got.values()}) > 3


def test_null_ids_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(None, "a b c d e", 1, "s"), (1, "a b c d e", 2, "s"), (1, "a b c d e", 2, "s"), (2, "a b c d e", 3, "t")], "doc_id long, text string, component_id int, k1 string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates(spark, df).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    kept = one_of_each(spark, df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]
