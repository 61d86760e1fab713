"""Routing by thousands of patterns: an automaton over their literals leaves each address the one or two that can match.

From every pattern the runs of characters are read that each of its matches
must have; the run that the fewest other patterns share stands for it in an
Aho-Corasick automaton. A pass over an address gives the routes whose run is in
it, and Spark's own regular expressions decide between these, in order. A route
without such a run is tried on every address.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.arrow import arrow_function
from presswork.operators.dedup import Route

#: Characters that aren't themselves in a pattern, and those that stand for themselves behind a backslash.
SPECIAL, PLAIN_ESCAPES = set(".^$*+?{}[]()|\\"), set(".^$*+?{}[]()|\\/-_:=&%#@!~,;'\"<> ")


def required(pattern: str) -> list[str]:
    """Runs of characters that stand in every match, outside groups and classes; none where branches or flags leave that open."""
    if re.search(r"\(\?[a-zA-Z-]*[ix]", pattern):
        return []
    runs, run, depth, at = [], "", 0, 0
    while at < len(pattern):
        c, own, size = pattern[at], None, 1
        if c == "\\":
            size = 2
            if pattern[at + 1 : at + 2] == "Q":  # quoted to \E: not read
                return []
            own = pattern[at + 1] if pattern[at + 1 : at + 2] in PLAIN_ESCAPES else None
            if own is None and pattern[at + 1 : at + 2].isalnum() and pattern[at + 1] in "xupPkc0N":
                return []  # an escape of several characters
        elif c == "[":
            end = at + 1 + (pattern[at + 1 : at + 2] == "^")
            end += pattern[end : end + 1] == "]"
            while end < len(pattern) and pattern[end] != "]":
                if pattern[end] == "[":
                    return []  # a class in a class
                end += 2 if pattern[end] == "\\" else 1
            size = end + 1 - at
        elif c == "{":
            size = max(1, pattern.find("}", at) + 1 - at)
        elif c == "|" and not depth:
            return []
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c not in SPECIAL:
            own = c
        after = pattern[at + size : at + size + 1]
        if own is not None and not depth and after not in ("?", "*", "{"):
            run += own
            if after == "+":
                runs.append(run)
                run = ""
        else:
            runs.append(run)
            run = ""
        at += size
    return list(dict.fromkeys(r for r in [*runs, run] if r))


def chosen(routes: list[Route]) -> list[str]:
    """For each route the run that stands for it: the one that fewest routes have, the longest of these; empty if it has none."""
    runs = [required(r.pattern) for r in routes]
    shared = Counter(x for own in runs for x in own)
    return [min(own, key=lambda x: (shared[x], -len(x)), default="") for own in runs]


def candidates(routes: list[Route]):
    """A column function: numbers of the routes that can match an address, in order; null for null."""
    by_run: dict[str, list[int]] = {}
    always = []
    for k, run in enumerate(chosen(routes)):
        by_run.setdefault(run, []).append(k) if run else always.append(k)

    def built():
        a = ahocorasick.Automaton()
        for run, numbers in by_run.items():
            a.add_word(run, numbers)
        if by_run:
            a.make_automaton()
        return a

    made: list = []

    @arrow_function("array<int>")
    def run(url: pd.Series) -> pd.Series:
        if not made:
            made.append(built())
        a = made[0]
        return url.map(lambda u: sorted({k for _, own in (a.iter(u) if by_run else ()) for k in own}.union(always)), na_action="ignore")

    return run


def routed_by_many(df: DataFrame, routes: list[Route], default: str, url: str = "url") -> DataFrame:
    """As dedup.routed(), for many routes: df with `store` and `route_key` by the first that matches."""
    if not routes:
        return df.withColumns({"store": F.lit(default), "route_key": F.col(url)})
    # one literal each, which is folded into an array, and not one a route
    table = lambda values: F.split(F.lit("\0".join(values)), r"\x00", -1)
    patterns, stores = table([r.pattern for r in routes]), table([r.store for r in routes])
    groups = table([str(re.compile(r.pattern).groups) for r in routes]).cast("array<int>")
    u = F.col(url)
    own = lambda of, k: F.element_at(of, k + 1)
    hit = F.get(F.filter("_candidates", lambda k: F.rlike(u, own(patterns, k))), F.lit(0))
    found = df.withColumn("_candidates", candidates(routes)(u)).withColumn("_hit", hit)
    k = F.col("_hit")
    parts = F.transform(F.sequence(F.lit(1), own(groups, k)), lambda i: F.call_function("regexp_extract", u, own(patterns, k), i))
    key: Column = F.when(k.isNull(), u).when(own(groups, k) == 0, u).otherwise(F.array_join(parts, ""))
    return found.withColumns({"store": F.when(k.isNull(), default).otherwise(own(stores, k)), "route_key": key}).drop("_candidates", "_hit")
