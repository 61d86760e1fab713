"""Numbers and running values over a whole ordered list, by a prefix sum over stored ranges.

A list is sorted by range and written once; each row keeps its range and its
place there. Counts and sums of the ranges, a row each, give every range what
comes before it. Both passes read the one stored table: an exchange that ran
twice could cut its ranges differently, and sizes and places would not belong
together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.storage import cutter

#: The lower bits of a row's place, which is its range's number and its place there.
PLACE_BITS = 33


def _ties(df: DataFrame) -> list[Column]:
    """What orders rows that the caller's columns leave equal, and spreads them over ranges; rows that are equal in all stay together."""
    plain = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return [F.xxhash64(*plain)] if plain else []


@dataclass(frozen=True)
class Numbered:
    """A list in stored ranges: rows(row, range, place), and ranges(range, n, before) with the number of rows before each."""

    rows: DataFrame
    ranges: DataFrame
    total: int

    def all(self, idx: str = "idx") -> DataFrame:
        """Every row with its number, from 0; a column of that name is replaced."""
        base = self.ranges.select("range", "before")  # a row per range: as small as the sort's own list of bounds
        fields = [f for f in self.rows.schema["row"].dataType.fieldNames() if f != idx]
        return self.rows.join(F.broadcast(base), "range").select(*(F.col(f"row.`{f}`") for f in fields), (F.col("before") + F.col("place")).alias(idx))

    def between(self, first: int, stop: int, idx: str = "idx") -> DataFrame:
        """Rows numbered from first to stop - 1; of the stored ranges only those that have them are kept by the scan's filter."""
        met = self.ranges.where((F.col("before") < stop) & (F.col("before") + F.col("n") > first)).agg(F.min("range"), F.max("range")).first()
        part = self if met[0] is None else Numbered(self.rows.where(F.col("range").between(*met)), self.ranges, self.total)
        numbers = part.all(idx)
        return numbers.where((F.col(idx) >= first) & (F.col(idx) < stop))


def numbered(df: DataFrame, *order: str) -> Numbered:
    """df in stored ranges by these columns, nulls first; rows that are equal there are ordered by a hash of all their columns."""
    keys = [F.col(c).asc_nulls_first() for c in order] + _ties(df)
    at = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.struct("*").alias("row"), at.alias("_at"))
    stored = cutter(df.sparkSession, "numbered")(sorted_rows.select("row", F.shiftright("_at", PLACE_BITS).alias("range"), F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place")))
    ranges = _with_before(stored.groupBy("range").agg(F.count("*").alias("n")), "n")
    return Numbered(stored, ranges, ranges.agg(F.sum("n")).first()[0] or 0)


def _with_before(sums: DataFrame, value: str) -> DataFrame:
    """sums(range, ...) with what the ranges before add up to: a row per range, so one task may have them all."""
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast(sums.schema[value].dataType)
    return sums.withColumn("before", F.coalesce(F.sum(value).over(before), zero).cast(sums.schema[value].dataType))


def running(df: DataFrame, value: Column, name: str, *order: str) -> DataFrame:
    """df with `name`: the sum of value over all rows up to and with each, in this order; null values add nothing.

    Each range is summed by itself, and gets the sum of those before it: no
    task has more than a range.
    """
    own = numbered(df.withColumn("_value", value), *order)
    sums = _with_before(own.rows.groupBy("range").agg(F.sum("row._value").alias("s")), "s")
    inside = F.sum("row._value").over(W.partitionBy("range").orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    rows = own.rows.withColumn("_inside", inside).join(F.broadcast(sums.select("range", "before")), "range")
    zero = F.lit(0).cast(sums.schema["s"].dataType)
    return rows.select(*(F.col(f"row.`{c}`") for c in df.columns if c != name), (F.coalesce("_inside", zero) + F.col("before")).cast(sums.schema["s"].dataType).alias(name))


def circular_batch(words: DataFrame, order: str | list[str], start: int, limits: int) -> tuple[DataFrame, int]:
    """(place, idx, rows of words) of the next `limits` of a list read in circles, and the next start.

    A start behind the end begins anew; a batch of more than two rounds has only
    the tail, and leaves the start. Columns named idx or place are replaced.
    """
    own = numbered(words, *([order] if isinstance(order, str) else order))
    n = own.total
    if n == 0:
        return words.withColumns({"idx": F.lit(0).cast("long"), "place": F.lit(0).cast("long")}).limit(0), start
    start = 0 if start >= n else start
    over = start + limits > 2 * n
    size, after = (n - start, start) if over else (limits, (start + limits) % n)
    turns = []
    for turn in range(3):
        first, stop = max(start - turn * n, 0), min(start + size - turn * n, n)
        if first < stop:
            turns.append(own.between(first, stop).withColumn("place", F.col("idx") + turn * n - start))
    if not turns:
        return own.all().withColumn("place", F.col("idx")).limit(0), after
    return reduce(DataFrame.unionByName, turns), after
