"""Connected components by hooking and contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge (a, b); component is the smallest
    id that can be reached.

    Every round each vertex hooks onto the least of itself and its neighbours,
    in a seeded order, pointers are doubled, and the edges are rewritten between
    the roots, without loops and repeats. Edges shrink by a constant factor a
    round, so rounds grow with the logarithm of the vertices. No step gathers a
    vertex's neighbours: a hub costs one partial aggregate a task. Edges to null
    are ignored; without edges the result is empty.
    """
    pairs = scratch.cut(edges.select("a", "b").where("a <> b"), "edges")
    left = most = pairs.count()
    labels = scratch.small(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("root")), most, "labels")
    while left:
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
        hook = both.groupBy("a").agg(F.min(rank("b")).alias("low")).select(F.col("a").alias("v"), F.least("low", rank("a")).getField("v").alias("up"))
        hook = scratch.small(hook, 2 * left, "hook")
        up2 = hook.select(F.col("v").alias("up"), F.col("up").alias("up2"))
        hook = scratch.small(hook.join(up2, "up", "left").select("v", F.coalesce("up2", "up").alias("up")), 2 * left, "jump")
        of = lambda c: hook.select(F.col("v").alias(c), F.col("up").alias(f"{c}_up"))
        moved = pairs.join(of("a"), "a").join(of("b"), "b").where("a_up <> b_up")
        pairs = scratch.small(moved.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), left, "edges")
        left = pairs.count()
        labels = scratch.small(labels.join(of("root"), "root", "left").select("id", F.coalesce("root_up", "root").alias("root")), most, "labels")
    least = labels.groupBy("root").agg(F.min("id").alias("component"))
    return scratch.small(labels.join(least, "root").select("id", "component"), most, "components")
