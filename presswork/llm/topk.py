"""Exact top-k inner products by no-random-access aggregation.

Each dimension is a list of the candidates sorted by their component, read in
sequence from its high end for queries with a positive component there and from
its low end for those with a negative one. A candidate's score is bounded from
below by the components read so far plus the least the unread lists can hold,
and from above by those plus the lists' frontier values. Lists that weigh more
for a query are read deeper. Reading stops for a query once at most RESOLVE
candidates' upper bounds reach the k-th best lower bound; their scores are then
resolved.

Candidates are dealt to sites once and stay there; a site holds at most about
SITE numbers. The queries stream past every site, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.llm.common import Scratch

#: Numbers a site holds; candidates that may be left when reading stops.
SITE, RESOLVE = 1 << 19, 64
#: Lists are read on until an entry more tightens the bounds by less than this times the mean weight of a list, then less.
GAINS = (1.6, 0.9, 0.6, 0.4, 0.25)
#: Products and sums of whole numbers below these are exact in floating point.
EXACT_SINGLE, EXACT = 2.0**24, 2.0**53
#: By how much reading a normal list on tightens the bounds, an entry, at places of decreasing value: the ratio of tail to density.
_PLACES = np.linspace(4, -4, 81)
_SHARE = np.array([0.5 * (1 - np.sign(z) * (1 - np.exp(-2 * z * z / np.pi)) ** 0.5) for z in _PLACES])
_GAIN = np.maximum.accumulate(((1 - _SHARE) / (np.exp(-_PLACES * _PLACES / 2) / (2 * np.pi) ** 0.5))[::-1])[::-1]


class Lists:
    """The sorted lists of a site's candidates x (a row each). Sums of whole numbers are exact in the type of x."""

    def __init__(self, x: np.ndarray):
        self.x, (self.n, self.dims) = x, x.shape
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, order, axis=0)
        self.places = np.uint16 if self.n < 1 << 16 else np.uint32
        self.ranks = np.empty(x.shape, self.places)
        np.put_along_axis(self.ranks, order, np.broadcast_to(np.arange(self.n, dtype=self.places)[:, None], x.shape), axis=0)
        self.spread = x.std(axis=0, dtype=np.float64)

    def depths(self, q: np.ndarray, gain: float) -> np.ndarray:
        """How far each list is read until an entry more tightens the bounds by less than gain; the bounds hold for any depths."""
        weight = np.abs(q) * self.spread
        ratio = np.divide(gain, weight, out=np.full(len(q), np.inf), where=weight > 0)
        share = np.interp(-ratio, -_GAIN, _SHARE, left=0.0, right=1.0)
        return np.ceil(share * self.n).astype(np.int64)

    def bounds(self, q: np.ndarray, depth: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of the candidates at rows, after depth entries of each list."""
        last, d, high = self.n - 1, np.arange(self.dims), q > 0
        front = np.where(high, last - depth, depth).clip(0, last)
        frontier = np.where(depth > last, 0, q * self.sorted[front, d])
        worst = q * np.where(high, self.sorted[0], self.sorted[last])
        whole = len(rows) == self.n
        ranks, x = (self.ranks, self.x) if whole else (self.ranks[rows], self.x[rows])
        # entries read are those with a rank from first on, and differences below zero are large ones
        first = np.where(high, self.n - depth, 0).astype(self.places)
        seen = ((ranks - first) < depth.astype(self.places if self.n < np.iinfo(self.places).max else np.int64)).astype(x.dtype)
        sums, unread = (x * seen) @ q, seen @ np.stack([worst, frontier], axis=1).astype(x.dtype)
        return sums + worst.sum() - unread[:, 0], sums + frontier.sum() - unread[:, 1]

    def best(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, entries read): all that may be among the k best but those marked as own."""
        rows, floor, read = np.flatnonzero(~own), -np.inf, 0
        mean = float((np.abs(q) * self.spread).mean()) if self.dims else 0.0
        for gain in GAINS if mean else ():
            if len(rows) <= max(k, RESOLVE):
                break
            depth = self.depths(q, gain * mean)
            read = int(depth.sum())
            lower, upper = self.bounds(q, depth, rows)
            floor = max(floor, float(np.partition(lower, len(rows) - k)[len(rows) - k]))
            rows = rows[upper >= floor]
        # the scores of those that are left are resolved; if they are many, all lists are read for that
        return rows, self.x[rows] @ q, read if len(rows) <= max(k, RESOLVE) else self.x.size


def exact_scores(q: list[int], x: list[list[int]]) -> list[int]:
    """Scores of components too large for floating point, by Python's integers."""
    return [sum(a * b for a, b in zip(q, v)) for v in x]


def _key(score: int) -> bytes:
    """Bytes in the order of whole numbers of any size that components of 64 bits can give."""
    return (score + (1 << 191)).to_bytes(24, "big")


PART = "query_id long, vec_id long, score long, key binary, site long, read long, entries long"


def _top(k: int):
    def answers(number: int, ids: np.ndarray, x: np.ndarray, made: dict, q_ids: np.ndarray, qs: np.ndarray) -> Iterator[tuple]:
        big = float(np.abs(x.astype(float)).max(initial=0)) * max(x.shape[1], 1)
        most = float(np.abs(qs.astype(float)).max(initial=0))
        kind = np.float32 if big * most < EXACT_SINGLE else np.float64
        if kind not in made and big * most < EXACT:
            made[kind] = Lists(x.astype(kind))
        lists = made.get(kind)
        for q_id, q in zip(q_ids, qs):
            own = ids == q_id
            if lists:
                rows, scores, read = lists.best(q.astype(lists.x.dtype), own, k)
                scores = scores.astype(np.int64).tolist()
            else:
                rows, read = np.flatnonzero(~own), x.size
                scores = exact_scores(q.tolist(), x[rows].tolist())
            first = sorted(zip((-s for s in scores), ids[rows].tolist()))[:k]
            for s, i in first:
                yield int(q_id), i, min(max(-s, -(2**63)), 2**63 - 1), _key(-s), number, read, x.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        site, held, lists = None, [], None
        for batch in batches:
            dim, at, asks, ids = (np.asarray(batch.column(c)) for c in ("dim", "site", "asks", "vec_id"))
            flat = np.asarray(batch.column("v").flatten()) if len(dim) else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(dim)])
            edges = np.flatnonzero((dim[1:] != dim[:-1]) | (at[1:] != at[:-1]) | (asks[1:] != asks[:-1])) + 1
            rows = []
            for a, b in zip([0, *edges], [*edges, len(dim)]):
                if a == b:
                    continue
                if (dim[a], at[a]) != site:
                    site, held, lists = (dim[a], at[a]), [], None
                part = ids[a:b], flat[ends[a] : ends[b]].reshape(b - a, dim[a])
                if not asks[a]:
                    held.append(part)
                elif held:
                    if lists is None:
                        mine, x = (np.concatenate(c) for c in zip(*held))
                        lists, held = {}, [(mine, x)]
                    rows += answers(int(at[a]), *held[0], lists, *part)
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in PART.split(", ")])

    return run


def site_answers(spark: SparkSession, embeddings: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """Each query's k best of every site, with the list entries that were read there and that there are."""
    scratch = Scratch(spark, "topk")
    x = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    usable = embeddings.where(F.coalesce(ok, F.lit(False))).select("vec_id", whole.alias("v"), F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("row"))
    vectors = scratch.cut(usable, "vectors")
    sites = max(1, -(-(vectors.agg(F.sum("dim")).first()[0] or 0) // SITE))
    # rows that repeat are dealt out like others
    held = vectors.select("dim", F.pmod(F.xxhash64("row"), F.lit(sites)).alias("site"), F.lit(False).alias("asks"), "vec_id", "v")
    wanted = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    asked = wanted.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sites - 1).cast("long"))).alias("site"), F.lit(True).alias("asks"), "vec_id", "v")
    dealt = held.unionByName(asked).repartition("dim", "site").sortWithinPartitions("dim", "site", "asks")
    return dealt.mapInArrow(_top(k), PART)


def search(spark: SparkSession, embeddings: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all other vectors.

    Queries are the rows whose vec_id is divisible by `every`. Components are
    floor(scale * x), held to 64 bits. Rows with a null vec_id or vector, or
    with a null or non-finite component, take no part. Vectors are compared with
    those of their own length, which may be any. Rows that repeat a query's
    vec_id are the query's own; repeated candidates each take a rank. Ties go to
    the smaller vec_id. Ranks go by the exact scores, and a score beyond 64 bits
    is given as the nearest number of 64 bits. A query without candidates
    returns nothing, nor does an empty table. Other columns, whatever their
    names, are not read.
    """
    w = W.partitionBy("query_id").orderBy(F.desc("key"), "vec_id")
    part = site_answers(spark, embeddings, every, k, scale)
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def shares_read(spark: SparkSession, embeddings: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, read, entries): of the list entries that a query has, how many were read before it stopped."""
    each = site_answers(spark, embeddings, every, k, scale).groupBy("query_id", "site").agg(F.first("read").alias("read"), F.first("entries").alias("entries"))
    return each.groupBy("query_id").agg(F.sum("read").alias("read"), F.sum("entries").alias("entries"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
