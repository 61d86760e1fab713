"""A fluent query builder over tables, in which each call gives a new query.

    q = Query(spark).table("posts").where("n > 3").fields("id, n").order({"n": -1}).limit(10, 5)
    q.find(); q.count(); q.update({"n": 0}); q.delete(); q.add([{"id": 1, "n": 2}])

Statements return DataFrames; a caller writes them where they belong. No SQL
text is put together from values.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    spark: SparkSession
    source: DataFrame | str | None = None
    condition: str | Column | None = None
    columns: tuple[str, ...] = ()
    keys: tuple[tuple[str, int], ...] = ()
    most: int = 0
    start: int = 0
    formats: dict = field(default_factory=dict)

    def table(self, source: DataFrame | str) -> Query:
        return replace(self, source=source)

    def where(self, condition: str | Column | None) -> Query:
        """The condition; a later one takes the place of an earlier one."""
        return replace(self, condition=condition)

    def fields(self, columns: str) -> Query:
        return replace(self, columns=tuple(c.strip() for c in columns.split(",") if c.strip()))

    def order(self, keys: dict[str, int]) -> Query:
        """Columns in order of importance; below 0 is descending."""
        return replace(self, keys=tuple(keys.items()))

    def limit(self, count: int, start: int = 0) -> Query:
        """At most count rows from start on; a count of 0 or less is no limit."""
        return replace(self, most=count, start=start)

    def _frame(self) -> DataFrame:
        if self.source is None:
            raise ValueError("no table was given")
        return self.spark.table(self.source) if isinstance(self.source, str) else self.source

    def _met(self) -> Column:
        """Whether the condition holds; without one it does, and null is no."""
        c = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.lit(True) if c is None or self.condition == "" else F.coalesce(c, F.lit(False))

    def _rows(self) -> DataFrame:
        df = self._frame()
        return df if self.condition in (None, "") else df.where(self.condition)

    def find(self) -> DataFrame:
        df = self._rows()
        if self.keys:
            df = df.orderBy(*[F.desc(c) if d < 0 else F.asc(c) for c, d in self.keys])
        if self.most > 0:
            df = df.offset(self.start).limit(self.most) if self.start else df.limit(self.most)
        return df.selectExpr(*self.columns) if self.columns and self.columns != ("*",) else df

    def count(self) -> DataFrame:
        """One row `n`; a limit has no say in it."""
        return self._rows().agg(F.count("*").alias("n"))

    def add(self, rows: list[dict] | DataFrame) -> DataFrame:
        """The table with new rows; what a row doesn't name is null, by the name of the column."""
        df = self._frame()
        new = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame([[r.get(c) for c in df.columns] for r in rows], df.schema)
        return df.unionByName(new, allowMissingColumns=True)

    def update(self, values: dict) -> DataFrame:
        """The table with new values where the condition holds."""
        df, met = self._frame(), self._met()
        return df.withColumns({c: F.when(met, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()})

    def delete(self) -> DataFrame:
        """The table without the rows for which the condition holds; without one, no row is left."""
        return self._frame().where(~self._met())
