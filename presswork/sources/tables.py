"""Database tables by JDBC: reads in parts of like size, and upserts by a staging table.

Equal steps of a key make equal parts only if its values lie evenly. Here the
database counts rows by steps of the key, steps that hold too many are counted
again in smaller ones, and the parts' bounds are taken where the counts add up:
a query an answer of some hundred rows, whatever the table's size.
"""

from __future__ import annotations

import contextlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Steps of a count, and the part of a partition's rows that one step may hold before it is counted more finely.
STEPS, FINE = 200, 0.05


@dataclass
class Table:
    """A table of a database: its address, name and further options of Spark's JDBC source, as user and driver."""

    spark: SparkSession
    url: str
    name: str
    options: dict[str, str] | None = None

    def _asked(self, sql: str) -> list:
        """The rows of a query that the database answers; only for answers of a few rows."""
        return self.spark.read.format("jdbc").options(url=self.url, query=sql, **(self.options or {})).load().collect()

    def counts(self, key: str, parts: int) -> list[tuple[int, int, int]]:
        """(first, last, rows) of steps of a whole-number key that hold at most a small part of a partition's rows, or one value."""
        row = self._asked(f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT({key}) AS n FROM {self.name}")[0]
        low, high, total = (None if x is None else int(x) for x in row)
        if not total:
            return []
        most = max(1, int(FINE * total / parts))
        done, todo = [], [(low, high)]
        while todo:
            first, last = todo.pop()
            width = -(-(last - first + 1) // STEPS)
            # the database's own division of whole numbers, from zero on
            step = f"(({key} - ({first})) - MOD({key} - ({first}), {width})) / {width}"
            found = self._asked(f"SELECT s, COUNT(*) AS n FROM (SELECT {step} AS s FROM {self.name} WHERE {key} >= {first} AND {key} <= {last}) t GROUP BY s")
            for s, n in ((int(r[0]), int(r[1])) for r in found):
                a, b = first + s * width, min(first + (s + 1) * width - 1, last)
                if n > most and a < b:
                    todo.append((a, b))
                else:
                    done.append((a, b, n))
        return sorted(done)

    def predicates(self, key: str, parts: int) -> list[str]:
        """Conditions of at most so many parts, that each row meets one of; rows without a key are in the first.

        Parts differ by a twentieth or so, but for a single value that more rows have than a part should.
        """
        counts = self.counts(key, parts)
        total = sum(n for *_, n in counts)
        bounds, so_far, goal = [], 0, total / parts
        for (first, _, n), before in zip(counts, [None, *counts]):
            # a step goes to the part that it makes the more even
            if before is not None and len(bounds) < parts - 1 and so_far + n / 2 > goal * (len(bounds) + 1):
                bounds.append(first)
            so_far += n
        if not bounds:
            return ["1 = 1"]
        middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
        return [f"{key} < {bounds[0]} OR {key} IS NULL", *middle, f"{key} >= {bounds[-1]}"]

    def read(self, key: str | None = None, parts: int = 1) -> DataFrame:
        """The table, in parts of like size where a key is given."""
        if key is None:
            return self.spark.read.format("jdbc").options(url=self.url, dbtable=self.name, **(self.options or {})).load()
        return self.spark.read.jdbc(self.url, self.name, predicates=self.predicates(key, parts), properties=self.options or {})

    def write(self, df: DataFrame, mode: str = "append", name: str | None = None) -> None:
        df.write.format("jdbc").mode(mode).options(url=self.url, dbtable=name or self.name, **(self.options or {})).save()

    @contextlib.contextmanager
    def _connection(self):
        """One of the driver's own, whose statements are committed together or not at all."""
        properties = self.spark._jvm.java.util.Properties()
        for k, v in (self.options or {}).items():
            properties.setProperty(k, v)
        connection = self.spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            yield connection
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def run(self, *statements: str) -> list[int]:
        """Numbers of rows that the statements change, in one transaction."""
        with self._connection() as connection:
            changed = []
            for sql in statements:
                own = connection.createStatement()
                changed.append(own.executeUpdate(sql))
                own.close()
            return changed

    def upsert(self, df: DataFrame, keys: list[str], staging: str) -> tuple[int, int]:
        """(rows replaced, rows written): rows of df take the place of those with the same keys.

        Tasks write a staging table, which a retried task or job may do again;
        one transaction then moves its rows. df should have a row for each key;
        of rows with equal keys one is taken. A row without a key is added.
        """
        # names in the database's quotes, as Spark's own writer makes them
        quoted = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier
        self.write(df.dropDuplicates(keys), "overwrite", staging)
        same = " AND ".join(f"s.{quoted(k)} = t.{quoted(k)}" for k in keys)
        listed = ", ".join(quoted(c) for c in df.columns)
        replaced, written = self.run(
            f"DELETE FROM {self.name} t WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})",
            f"INSERT INTO {self.name} ({listed}) SELECT {listed} FROM {staging}",
        )
        self.run(f"DROP TABLE {staging}")
        return replaced, written
