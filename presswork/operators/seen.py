"""A first-seen store that is added to and pruned, and never rewritten.

Keys lie in partitions by the day they were first seen and a bucket of their
hash. Beside each partition lie Bloom filters of its keys. A batch is held
against the filters of its own buckets first, bucket by bucket; only partitions
that a filter says may hold one of its keys are read, and joined. New keys are
appended, filters before keys, so that a batch that dies between leaves filters
that say too much, never too little. What has outlived its time is dropped a
day at a time; within the last day rows are told by their time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.storage import cutter

#: Bits of a filter for each key, hashes of a key, and keys in one filter.
BITS, HASHES, FILTER_KEYS = 12, 8, 1 << 20
KEYS = "key string, first_seen timestamp, day date, bucket int"
FILTERS = "slice int, slices int, bits binary, day date, bucket int"


def _places(h1: np.ndarray, h2: np.ndarray, m: int) -> np.ndarray:
    """A row of bit numbers for each key."""
    a, b = h1.astype(np.uint64)[:, None], h2.astype(np.uint64)[:, None] | np.uint64(1)
    return ((a + np.arange(HASHES, dtype=np.uint64) * b) % np.uint64(m)).astype(np.int64)


def filter_of(h1: np.ndarray, h2: np.ndarray) -> bytes:
    """A Bloom filter of so many hashed keys."""
    bits = np.zeros(max(64, -(-len(h1) * BITS // 8) * 8), np.uint8)
    bits[_places(h1, h2, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys a filter may have; those that it has are always among them."""
    own = np.frombuffer(bits, np.uint8)
    at = _places(h1, h2, len(own) * 8)
    return ((own[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)


@dataclass
class SeenStore:
    """(key, first_seen) of all addresses that were ever added and are younger than `ttl_seconds`, where that is given."""

    spark: SparkSession
    folder: str
    buckets: int = 64
    ttl_seconds: int | None = None

    def _hashed(self, df: DataFrame, key: str) -> DataFrame:
        h1, h2 = F.xxhash64(F.col(key)), F.xxhash64(F.col(key), F.lit(1))
        return df.select(F.col(key).alias("key"), h1.alias("h1"), h2.alias("h2"), self._bucket(F.col(key)).alias("bucket"))

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(self.buckets)).cast("int")

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def days(self) -> list[dt.date]:
        """Days that the store has keys of."""
        path, fs = self._fs("keys")
        if not fs.exists(path):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(path))
        return sorted(dt.date.fromisoformat(n[4:]) for n in names if n.startswith("day="))

    def _cutoff(self, now: dt.datetime | None) -> dt.datetime | None:
        return now - dt.timedelta(seconds=self.ttl_seconds) if now is not None and self.ttl_seconds is not None else None

    def _read(self, name: str, schema: str, parts: list[str] | None = None) -> DataFrame:
        base = f"{self.folder}/{name}"
        paths = [base] if parts is None else [f"{base}/{p}" for p in parts]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def rows(self, now: dt.datetime | None = None) -> DataFrame:
        """(key, first_seen) of all keys that haven't outlived their time."""
        if not self.days():
            return self.spark.createDataFrame([], "key string, first_seen timestamp")
        own, cutoff = self._read("keys", KEYS), self._cutoff(now)
        if cutoff is not None:
            own = own.where((F.col("day") >= cutoff.date()) & (F.col("first_seen") > F.lit(cutoff)))
        return own.groupBy("key").agg(F.min("first_seen").alias("first_seen"))

    def met(self, df: DataFrame, key: str = "dedup_key", now: dt.datetime | None = None) -> DataFrame | None:
        """(key, first_seen) of the partitions that may have a key of df, by their filters; None if none has."""
        cutoff = self._cutoff(now)
        days = [d for d in self.days() if cutoff is None or d >= cutoff.date()]
        if not days:
            return None
        keys = self._hashed(df.where(F.col(key).isNotNull()).select(key).distinct(), key)
        filters = self._read("filters", FILTERS).where(F.col("day").isin(days))

        def probed(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            h1, h2 = keys["h1"].to_numpy(np.int64), keys["h2"].to_numpy(np.int64)
            hit = set()
            for f in filters.itertuples():
                own = (h1 % f.slices) == f.slice
                if (f.day, f.bucket) not in hit and own.any() and may_hold(f.bits, h1[own], h2[own]).any():
                    hit.add((f.day, f.bucket))
            return pd.DataFrame(sorted(hit), columns=["day", "bucket"])

        pairs = keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probed, "day date, bucket int").distinct()
        # a row for each partition of the store at most
        parts = [f"day={r.day}/bucket={r.bucket}" for r in pairs.collect()]
        if not parts:
            return None
        found = self._read("keys", KEYS, parts)
        return found if cutoff is None else found.where(F.col("first_seen") > F.lit(cutoff))

    def unseen(self, df: DataFrame, key: str = "dedup_key", now: dt.datetime | None = None) -> DataFrame:
        """Rows whose key the store doesn't have; a null key was never seen. df is read twice."""
        met = self.met(df, key, now)
        return df if met is None else df.join(met.select(F.col("key").alias(key)), key, "left_anti")

    def add(self, df: DataFrame, key: str = "dedup_key", time: str = "first_seen", now: dt.datetime | None = None) -> DataFrame:
        """Adds keys that the store hasn't, with their first time, and gives them as (key, first_seen); one that is seen again keeps its own.

        Rows without a key or a time are left out.
        """
        cut = cutter(self.spark, "seen")
        batch = cut(df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.min(F.col(time).cast("timestamp")).alias("first_seen")))
        new = cut(self.unseen(batch, "key", now).select("key", "first_seen", F.to_date("first_seen").alias("day"), self._bucket(F.col("key")).alias("bucket")))
        size = new.groupBy("day", "bucket").agg(F.count("*").alias("n"))
        slices = (1 + F.floor(F.col("n") / FILTER_KEYS)).cast("int")
        hashed = new.select("day", "bucket", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2")).join(size.select("day", "bucket", slices.alias("slices")), ["day", "bucket"])
        # numpy's remainder has the sign of the divisor, as pmod's
        sliced = hashed.withColumn("slice", F.pmod("h1", "slices").cast("int"))

        def filtered(rows: pd.DataFrame) -> pd.DataFrame:
            one = rows.iloc[0]
            bits = filter_of(rows["h1"].to_numpy(np.int64), rows["h2"].to_numpy(np.int64))
            return pd.DataFrame({"slice": [one["slice"]], "slices": [one["slices"]], "bits": [bits], "day": [one["day"]], "bucket": [one["bucket"]]})

        made = sliced.groupBy("day", "bucket", "slice").applyInPandas(filtered, FILTERS)
        # a task writes whole partitions, so that each has one file a batch
        made.repartition("day", "bucket").write.mode("append").partitionBy("day", "bucket").parquet(f"{self.folder}/filters")
        new.repartition("day", "bucket").write.mode("append").partitionBy("day", "bucket").parquet(f"{self.folder}/keys")
        return new.select("key", "first_seen")

    def purge(self, now: dt.datetime) -> list[dt.date]:
        """Drops the days that have wholly outlived their time, and gives them; keys before filters."""
        cutoff = self._cutoff(now)
        gone = [] if cutoff is None else [d for d in self.days() if d < cutoff.date()]
        for day in gone:
            for name in ("keys", "filters"):
                path, fs = self._fs(f"{name}/day={day}")
                fs.delete(path, True)
        return gone
