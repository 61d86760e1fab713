"""Ranked lexical search over an index of compressed postings.

The index is cut into shards of about SHARD_BYTES of text, each made by the
task that reads it: documents are numbered by doc_id, and every term has a row
with its documents' numbers, as differences, and its counts, in seven-bit
bytes. A shard's first row has the ids and lengths of its documents.

A search joins the items' terms with the index, so that only their postings
move, and takes each shard by itself, against blocks of at most ITEMS items.
There documents come in order of doc_id by a k-way merge: a heap holds each
list's next document, lists advance together by windows of WINDOW documents,
and lists without a document in a window aren't touched. When a window is
past, its scores are whole; they meet a result heap of k entries, keyed by
score and then doc_id. The shards' heaps are merged over all.

A row of documents is a document, repeated ones too; a null doc_id comes after
all others. Null texts and such without a term are no documents for N. Rows of
queries that share an item_id, null too, are one item with the terms of all.
Other columns aren't read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from presswork.llm.common import BETWEEN_TERMS, Scratch, lower_words, sql_terms, text_blocks, tidy, unvarints, varints

#: Bytes of text in a shard, documents that are scored together, items that a shard meets at once.
SHARD_BYTES, WINDOW, ITEMS = 16 << 20, 512, 256
#: A shard's row without a term: df has the number of documents with a term, n the number of all terms, nulls the documents without an id.
INDEX = "shard long, term string, df long, n long, nulls long, docs binary, counts binary"


@dataclass
class Index:
    shards: DataFrame
    #: Documents with a term, and all terms.
    documents: int
    terms: int


def _column(raw: np.ndarray, ends: np.ndarray, parts: np.ndarray) -> pa.Array:
    """A binary column whose k-th value has the varints from parts[k] to parts[k + 1]."""
    at = np.concatenate([[0], ends])[parts].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(parts) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])


def _shard(number: int, ids: pa.Array, sizes: np.ndarray, words: pa.StringArray) -> Iterator[pa.RecordBatch]:
    """The rows of a shard: its documents have these ids and so many of the words, in turn."""
    has = sizes > 0
    if not has.any():
        return
    ids, sizes = ids.filter(pa.array(has)), sizes[has]
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    known = ids.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    known.sort()
    raw, ends = varints(np.diff(known.view(np.uint64), prepend=np.uint64(0)))
    n, n_ends = varints(sizes[order])
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("n", pa.int64()), ("nulls", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary())])
    yield pa.RecordBatch.from_pydict({"shard": [number], "term": [None], "df": [len(sizes)], "n": [int(sizes.sum())], "nulls": [len(sizes) - len(known)], "docs": [raw.tobytes()], "counts": [n.tobytes()]}, schema)
    coded = words.dictionary_encode()
    terms = coded.dictionary
    by_term = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[by_term] = np.arange(len(terms))
    pairs, tf = np.unique(rank[coded.indices.to_numpy()] * len(sizes) + np.repeat(place, sizes), return_counts=True)
    term, doc = np.divmod(pairs, len(sizes))
    parts = np.searchsorted(term, np.arange(len(terms) + 1))
    step = np.diff(doc, prepend=0)
    step[parts[:-1]] = doc[parts[:-1]]
    docs, counts = _column(*varints(step), parts), _column(*varints(tf), parts)
    rows = pa.RecordBatch.from_pydict(
        {
            "shard": pa.array(np.full(len(terms), number)),
            "term": terms.take(pa.array(by_term)),
            "df": np.diff(parts),
            "n": pa.nulls(len(terms), pa.int64()),
            "nulls": pa.nulls(len(terms), pa.int64()),
            "docs": docs,
            "counts": counts,
        },
        schema,
    )
    for at in range(0, len(terms), 10_000):
        yield rows.slice(at, 10_000)


def _indexed(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 24, 0
        ids, sizes, words = [], [], []

        def flush():
            if ids:
                yield from _shard(number, pa.concat_arrays(ids), np.concatenate(sizes), pa.concat_arrays(words))

        for batch in batches:
            for a, b, data, offs in text_blocks(batch.column("text")):
                found, starts, _ = lower_words(data, offs, BETWEEN_TERMS)
                ids.append(batch.column("doc_id").slice(a, b - a))
                sizes.append(np.diff(np.searchsorted(starts, offs)))
                words.append(found)
                held += len(data)
                if held >= shard_bytes:
                    yield from flush()
                    number, held, ids, sizes, words = number + 1, 0, [], [], []
        yield from flush()

    return tidy(run)


def indexed(spark: SparkSession, docs: DataFrame, scratch: Scratch, shard_bytes: int = SHARD_BYTES) -> Index:
    """The index of all of docs(doc_id, text), as a stored table."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_indexed(shard_bytes), INDEX)
    shards = scratch.cut(rows, "index")
    total = shards.where("term is null").agg(F.sum("df"), F.sum("n")).first()
    return Index(shards, total[0] or 0, total[1] or 0)


def best(lists: list[tuple[np.ndarray, np.ndarray]], k: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(score, document) of the k best, best first: lists have documents in order, and what each adds to its score."""
    heads = [(int(docs[0]), j) for j, (docs, _) in enumerate(lists) if len(docs)]
    heapq.heapify(heads)
    at = [0] * len(lists)
    sums = np.zeros(window, np.int64)
    kept: list[tuple[int, int]] = []  # (score, -document), the worst first
    while heads:
        base = heads[0][0]
        while heads and heads[0][0] < base + window:
            j = heads[0][1]
            docs, adds = lists[j]
            end = at[j] + int(np.searchsorted(docs[at[j] : at[j] + window], base + window))
            sums[docs[at[j] : end] - base] += adds[at[j] : end]
            at[j] = end
            if end < len(docs):
                heapq.heapreplace(heads, (int(docs[end]), j))
            else:
                heapq.heappop(heads)
        # an equal score comes later than what is kept, and loses
        found = np.flatnonzero(sums > (kept[0][0] if len(kept) == k else 0))
        if len(found) > k:
            found = found[sums[found] >= np.partition(sums[found], -k)[-k]]
        for d in found.tolist():
            entry = (int(sums[d]), -(base + d))
            if len(kept) < k:
                heapq.heappush(kept, entry)
            elif entry > kept[0]:
                heapq.heapreplace(kept, entry)
        sums[:] = 0
    return [(s, -d) for s, d in sorted(kept, reverse=True)]


def lengths_norm(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 - 75 + (75 n N) div L, exact where the product passes 64 bits."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        return 25 + 75 * n * documents // terms
    return np.array([25 + 75 * x * documents // terms for x in n.tolist()], np.int64)


def _searched(documents: int, terms: int, k: int, item: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(item)

    def run(table: pa.Table) -> pa.Table:
        head = table.filter(pc.is_null(table["term"])).to_pylist()[0]
        ids = np.cumsum(unvarints(head["docs"])).view(np.int64)
        m = lengths_norm(unvarints(head["counts"]).astype(np.int64), documents, terms)
        lists = defaultdict(list)
        for row in table.filter(pc.is_valid(table["term"])).select(["docs", "counts", "weight", "uses"]).to_pylist():
            docs, tf = np.cumsum(unvarints(row["docs"])).astype(np.int64), unvarints(row["counts"]).astype(np.int64)
            adds = row["weight"] * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
            for use in row["uses"]:
                lists[use["item"]].append((docs, adds * use["reps"] if use["reps"] > 1 else adds))
        rows = [(i, int(ids[d]) if d < len(ids) else None, s) for i, own in lists.items() for s, d in best(own, k)]
        return pa.table([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["item_id", "doc_id", "score"])

    return run


def search(spark: SparkSession, index: Index, queries: DataFrame, scratch: Scratch, k: int = 10, items: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item of queries(item_id, text): the k documents that score highest."""
    kind = queries.schema["item_id"].dataType
    words = queries.select("item_id", F.explode(sql_terms("text")).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("reps"))
    words = scratch.cut(words, "words")
    blocks = max(1, -(-words.select("item_id").distinct().count() // items))
    df = index.shards.where("term is not null").join(words.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * index.documents + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    uses = words.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block"), "term").agg(F.collect_list(F.struct(F.col("item_id").alias("item"), "reps")).alias("uses"))
    wanted = scratch.cut(uses.join(df.select("term", weight.alias("weight")), "term"), "wanted")
    postings = index.shards.where("term is not null").join(wanted, "term").select("shard", "block", "term", "nulls", "docs", "counts", "weight", "uses")
    heads = index.shards.where("term is null").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "term", "nulls", "docs", "counts")
    both = postings.unionByName(heads, allowMissingColumns=True)
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = both.groupBy("shard", "block").applyInArrow(_searched(index.documents, index.terms, k, kind), schema)
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, items: int = ITEMS) -> DataFrame:
    scratch = Scratch(spark, "lexical")
    return search(spark, indexed(spark, docs, scratch, shard_bytes), queries, scratch, k, items)


ORACLE_SQL = r"""
WITH words AS (
    SELECT number, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS number FROM documents)
), asked AS (
    SELECT item_id, term, count(*) AS reps
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term
), lengths AS (
    SELECT number, doc_id, count(*) AS n FROM words GROUP BY number, doc_id
), totals AS (
    SELECT count(*) AS d, sum(n)::BIGINT AS l FROM lengths
), norms AS (
    SELECT number, doc_id, 100 - 75 + (75 * n * d) // l AS m FROM lengths, totals
), counts AS (
    SELECT number, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY number, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * d + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), scores AS (
    SELECT item_id, number, sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (number)
    GROUP BY item_id, number
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores JOIN norms USING (number) WHERE score > 0
QUALIFY rank <= 10
"""
