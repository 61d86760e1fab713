"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same set of sources are one pattern; a pattern has
as many tokens as its documents. A flow routes tokens from patterns to the
sources' quotas. A pattern may be repeated: the first pass over its tokens is
free and every further pass costs more than the one before, so the flow repeats
only where a quota can't be met otherwise. The network has a node per pattern
and per source, whatever the number of documents. A pattern's flow becomes whole
passes over all its documents and one seeded selection for the rest.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.llm.common import Scratch, word_count

CYCLE, SHARE, REPEATS, SEED = (5, 2, 1), Fraction(3, 2), 2, "mix-1"


def targets(sizes: dict, weights: dict, share: Fraction = SHARE, repeats: int = REPEATS) -> dict:
    """Each source's exact share of `share` times all sizes by weight, held at
    `repeats` times its size; what that leaves over is shared again by weight."""
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > repeats * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in open_}
        for s in over:
            out[s] = Fraction(repeats * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def min_cost_flow(tokens: dict[tuple, int], quotas: dict, repeats: int = REPEATS) -> dict[tuple, dict]:
    """Tokens that each pattern sends to each of its sources.

    Successive shortest paths with potentials. Pass k over a pattern is an edge
    of the pattern's tokens with cost k * k: convex, so passes are used in
    order. Quotas that can't be met are met as far as the patterns allow.
    """
    nodes: dict = {}
    node = lambda x: nodes.setdefault(x, len(nodes))
    source, sink = node("from"), node("to")
    head: list[list[int]] = []
    to: list[int] = []
    cap: list[int] = []
    cost: list[int] = []

    def edge(a: int, b: int, room: int, price: int) -> int:
        while len(head) <= max(a, b):
            head.append([])
        for x, y, r, p in ((a, b, room, price), (b, a, 0, -price)):
            head[x].append(len(to))
            to.append(y)
            cap.append(r)
            cost.append(p)
        return len(to) - 2

    sends = {}
    for p in sorted(tokens, key=repr):
        for k in range(repeats):
            edge(source, node(("p", p)), tokens[p], k * k)
        for s in p:
            sends[p, s] = edge(node(("p", p)), node(("s", s)), repeats * tokens[p], 0)
    for s in sorted(quotas, key=repr):
        edge(node(("s", s)), sink, quotas[s], 0)
    head += [[] for _ in range(len(nodes) - len(head))]
    price = [0] * len(nodes)
    while True:
        far, via, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in head[a]:
                n = d + cost[e] + price[a] - price[to[e]]
                if cap[e] and n < far.get(to[e], n + 1):
                    far[to[e]], via[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        if sink not in far:
            return {p: {s: cap[sends[p, s] + 1] for s in p} for p in tokens}
        for i in range(len(price)):
            price[i] += far.get(i, far[sink])
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        room = min(cap[e] for e in path)
        for e in path:
            cap[e] -= room
            cap[e ^ 1] += room


def selected(scratch: Scratch, docs: DataFrame, passes: DataFrame) -> DataFrame:
    """docs(doc_id, pattern, size) with `copies`, given passes(pattern, whole, rest).

    Every document is taken `whole` times; documents in the order of the MD5 of
    seed and doc_id are taken once more until `rest` words are reached, the last
    one if more than half of it fits. The order's place where `rest` is reached
    is found in two rounds of 4096 slices of the digest, counted in aggregates;
    only the documents of one slice of 16 million are put in order. Tables of
    patterns have a row each and came from the driver, so they are broadcast.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(f":{SEED}")))
    docs = docs.withColumn("key", key).withColumn("s1", F.substring("key", 1, 3)).withColumn("s2", F.substring("key", 4, 3))
    docs = scratch.cut(docs, "keyed")
    null_safe = lambda a, b: a["pattern"].eqNullSafe(b["pattern"])

    def reached(part: DataFrame, goal: DataFrame, by: str) -> DataFrame:
        """For each pattern the slice in which its goal is reached, and the words before it."""
        sums = part.groupBy("pattern", by).agg(F.sum("size").alias("n"))
        w = W.partitionBy("pattern").orderBy(by)
        sums = sums.withColumn("upto", F.sum("n").over(w))
        joined = sums.join(goal, null_safe(sums, goal)).select(sums["pattern"], by, "n", "upto", "goal")
        hit = joined.where("upto >= goal").groupBy("pattern").agg(F.min(F.struct(by, (F.col("upto") - F.col("n")).alias("before"), "goal")).alias("x"))
        return hit.select("pattern", F.col(f"x.{by}").alias(f"{by}_at"), (F.col("x.goal") - F.col("x.before")).alias("goal"))

    goal = passes.where("rest > 0").select("pattern", F.col("rest").alias("goal"))
    one = scratch.cut(reached(docs, goal, "s1"), "slice")
    inside = docs.join(F.broadcast(one), null_safe(docs, one)).where("s1 = s1_at").select(docs["pattern"], "s2", "size")
    two = scratch.cut(reached(inside, one.select("pattern", "goal"), "s2"), "slice")
    cut = one.select("pattern", "s1_at").join(two.withColumnRenamed("pattern", "p2"), F.col("pattern").eqNullSafe(F.col("p2"))).drop("p2")
    cut = cut.withColumnRenamed("pattern", "p1")
    plan = passes.join(cut, passes["pattern"].eqNullSafe(cut["p1"]), "left").drop("p1").withColumnRenamed("pattern", "p0")
    marked = docs.join(F.broadcast(plan), docs["pattern"].eqNullSafe(plan["p0"])).drop("p0")
    before = (F.col("s1") < F.col("s1_at")) | ((F.col("s1") == F.col("s1_at")) & (F.col("s2") < F.col("s2_at")))
    on = (F.col("s1") == F.col("s1_at")) & (F.col("s2") == F.col("s2_at"))
    marked = marked.withColumn("on", F.coalesce(on, F.lit(False))).withColumn("extra", F.when(F.col("rest") > 0, F.coalesce(before, F.lit(True))).otherwise(F.lit(False)))
    # equal rows are one row with a count, so that no window holds a document's repeats
    at = ["pattern", "key", "doc_id", "size", "whole", "rest", "goal"]
    order = W.partitionBy("pattern").orderBy("key", "doc_id", "size")
    edge = marked.where("on").groupBy(*at).agg(F.count("*").alias("n"))
    edge = edge.withColumn("before", F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size") * F.col("n"))
    more = F.expr("if(rest <= 0 or goal is null, 0, if(size = 0, if(before <= goal, n, 0), least(n, greatest(0, (2 * (goal - before) + size) div (2 * size)))))")
    edge = edge.withColumn("m", more.cast("long")).select(*at, F.explode(F.array(F.struct(F.lit(True).alias("extra"), F.col("m").alias("c")), F.struct(F.lit(False).alias("extra"), (F.col("n") - F.col("m")).alias("c")))).alias("x"))
    edge = edge.where("x.c > 0").withColumn("lot", F.explode(F.expr("sequence(0, (x.c - 1) div 4096)"))).repartition("pattern", "key", "lot")
    edge = edge.withColumn("one", F.explode(F.expr("sequence(1, least(4096, x.c - lot * 4096))"))).withColumn("extra", F.col("x.extra")).select("doc_id", "pattern", "size", "whole", "extra")
    out = marked.where("not on").select("doc_id", "pattern", "size", "whole", "extra").unionByName(edge)
    return out.withColumn("copies", F.col("whole") + F.col("extra").cast("int")).select("doc_id", "pattern", "size", "copies")


def _mixed(spark: SparkSession, documents: DataFrame) -> tuple[Scratch, DataFrame, dict, dict]:
    scratch = Scratch(spark, "mixing")
    sized = scratch.cut(documents.select("doc_id", "source", word_count("text").alias("size")), "sized")
    sums = {r.source: r.n for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in sums if s is not None)) + [None] * (None in sums)
    wanted = targets(sums, {s: CYCLE[i % len(CYCLE)] for i, s in enumerate(names)})
    flow = min_cost_flow({(s,): n for s, n in sums.items()}, {s: round(t) for s, t in wanted.items()})
    rows = []
    for s in names:
        words = sum(flow[(s,)].values())
        whole = min(words // sums[s], REPEATS) if sums[s] else 0
        rows.append((s, sums[s], float(wanted[s]), int(whole), int(words - whole * sums[s])))
    plan = scratch.cut(spark.createDataFrame(rows, "pattern string, source_size long, target double, whole int, rest long"), "plan")
    picked = selected(scratch, sized.withColumnRenamed("source", "pattern"), plan.select("pattern", "whole", "rest"))
    return scratch, picked, sums, plan


def mix_overlapping(spark: SparkSession, documents: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """(doc_id, size, copies) of documents(doc_id, text, sources), whose sources are an array, for words wanted of each source.

    Documents of the same set of sources are one pattern; the flow says how many
    words each pattern gives, and a document counts for any of its sources.
    Sources without a quota, and nulls among them, are left out of the sets; a
    document without any is taken no time. The number of patterns must fit the
    driver.
    """
    scratch = Scratch(spark, "overlap")
    mine = F.array_sort(F.array_distinct(F.filter(F.coalesce("sources", F.array().cast("array<string>")), lambda s: s.isin(*quotas))))
    sized = scratch.cut(documents.select("doc_id", mine.alias("_s"), word_count("text").alias("size")).withColumn("pattern", F.to_json("_s")), "sized")
    sums = {r.pattern: (tuple(r.s), r.n) for r in sized.groupBy("pattern").agg(F.first("_s").alias("s"), F.sum("size").alias("n")).collect()}
    flow = min_cost_flow({s: n for s, n in sums.values() if s}, quotas)
    rows = []
    for pattern, (s, n) in sums.items():
        words = sum(flow[s].values()) if s else 0
        whole = min(words // n, REPEATS) if n else 0
        rows.append((pattern, int(whole), int(words - whole * n)))
    plan = scratch.cut(spark.createDataFrame(rows, "pattern string, whole int, rest long"), "plan")
    return selected(scratch, sized.select("doc_id", "pattern", "size"), plan).select("doc_id", "size", "copies")


def mix(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of documents.

    A null text has size 0 and is taken 0 words; a null source is a source, the
    last. Sources of size 0 have target 0. Rows that repeat are documents of
    their own; equal rows stand next to each other in the order and are taken
    one by one. The number of sources (not of documents) must fit the driver.
    """
    _, picked, _, plan = _mixed(spark, documents)
    plan = plan.select(F.col("pattern").alias("p"), "source_size", "target")
    out = picked.join(F.broadcast(plan), picked["pattern"].eqNullSafe(plan["p"]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixture(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, those without a doc_id or with a repeated one, too.

    Texts count whole, whatever their length; a null or empty one is taken no
    more often than its source. All columns come back as they were, whatever
    their names; an empty table gives an empty mix. Rows with one doc_id and
    source are told apart by their size, and of one size by their number.
    """
    scratch, picked, _, _ = _mixed(spark, documents)
    copies = scratch.cut(picked.groupBy("doc_id", "pattern").agg(F.count("*").alias("n"), F.max("copies").alias("copies")).where("copies > 0"), "copies")
    rows = documents.select(F.struct(*(documents[f"`{c}`"] for c in documents.columns)).alias("row"))

    def joined(other: DataFrame) -> DataFrame:
        other = other.withColumnsRenamed({"doc_id": "_id", "pattern": "_source"})
        return rows.join(other, rows["row.doc_id"].eqNullSafe(other["_id"]) & rows["row.source"].eqNullSafe(other["_source"]))

    out = joined(copies.where("n = 1")).select("row", "copies")
    again = copies.where("n > 1").select("doc_id", "pattern")
    if not again.isEmpty():
        own = ["_id", "_source", "_size"]
        theirs = joined(again).withColumn("_size", word_count("row.text")).withColumn("_k", F.row_number().over(W.partitionBy(*own).orderBy(F.xxhash64("row.text"))))
        keys = again.withColumnsRenamed({"doc_id": "d", "pattern": "p"})
        taken = picked.join(keys, picked["doc_id"].eqNullSafe(keys["d"]) & picked["pattern"].eqNullSafe(keys["p"]), "left_semi")
        taken = taken.select(F.col("doc_id").alias("d"), F.col("pattern").alias("p"), F.col("size").alias("s"), "copies", F.row_number().over(W.partitionBy("doc_id", "pattern", "size").orderBy(F.desc("copies"))).alias("k"))
        same = theirs["_id"].eqNullSafe(taken["d"]) & theirs["_source"].eqNullSafe(taken["p"]) & (F.col("_size") == F.col("s")) & (F.col("_k") == F.col("k"))
        out = out.unionByName(theirs.join(taken.where("copies > 0"), same).select("row", "copies"))
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


#: The same mix in SQL: sources by weight, water-filling by rounds, and the seeded order as one window.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source
), fill AS (
  SELECT 0 AS r, source, n, w, FALSE AS held, CAST(NULL AS DOUBLE) AS t FROM s
  UNION ALL
  SELECT r + 1, source, n, w, held OR w * lft / wsum > 2 * n, CASE WHEN held OR w * lft / wsum > 2 * n THEN 2.0 * n ELSE w * lft / wsum END
  FROM (SELECT *, 1.5 * sum(n) OVER () - coalesce(sum(2 * n) FILTER (WHERE held) OVER (), 0) AS lft, sum(w) FILTER (WHERE NOT held) OVER () AS wsum FROM fill WHERE r < 30)
), goal AS (
  SELECT source, n, t, CAST(round(t) AS BIGINT) AS q FROM fill WHERE r = 30
), p AS (
  SELECT *, CASE WHEN n = 0 THEN 0 ELSE least(q // n, 2) END AS whole, CASE WHEN n = 0 THEN 0 ELSE q - least(q // n, 2) * n END AS rest FROM goal
), o AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':{SEED}'), doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM d
)
SELECT o.doc_id, o.size, p.n AS source_size, p.t AS target,
  CAST(o.size * (p.whole + CASE WHEN p.rest > 0 AND o.upto - o.size / 2.0 <= p.rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source
"""
