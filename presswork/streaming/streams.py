"""Structured Streaming forms: first-seen dedup, state with a time to live, and queues in micro-batches."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from presswork.operators.dedup import with_key
from presswork.storage import dropped_at_exit, settings, shared_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Times without a zone can't carry a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def first_seen(stream: DataFrame, url: str = "url", ts: str = "ts", keep: str = "10 days", salt: str = "") -> DataFrame:
    """Rows whose key wasn't seen within `keep`; state goes with the watermark."""
    return with_key(event_time(stream, ts), url, salt).withWatermark(ts, keep).dropDuplicatesWithinWatermark(["dedup_key"])


class FirstSeen(StatefulProcessor):
    """Lets a key's first row through, and again once it was first seen `ttl` ago by event time; seeing it in between doesn't renew it."""

    def __init__(self, ttl_seconds: int, ts: str):
        self.ttl, self.ts = ttl_seconds * 1_000_000, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("first", StructType([StructField("us", LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        df = pd.concat(list(rows)).sort_values(self.ts, kind="stable")
        us = df[self.ts].astype("datetime64[us, UTC]" if df[self.ts].dt.tz is not None else "datetime64[us]").astype("int64").to_numpy()
        first = self.seen.get()[0] if self.seen.exists() else None
        keep = np.zeros(len(us), bool)
        # from one row that is let through to the next: those between aren't looked at
        at = 0 if first is None else int(np.searchsorted(us, first + self.ttl))
        while at < len(us):
            keep[at], first = True, int(us[at])
            at = max(at + 1, int(np.searchsorted(us, first + self.ttl)))
        if first is not None:
            self.seen.update((first,))
        yield df[keep]

    def close(self) -> None:
        pass


def first_seen_ttl(stream: DataFrame, ttl_seconds: int, key: str = "dedup_key", ts: str = "ts") -> DataFrame:
    """first_seen with an exact time to live; the session must use the RocksDB state store."""
    return stream.groupBy(key).transformWithStateInPandas(FirstSeen(ttl_seconds, ts), outputStructType=stream.schema, outputMode="Append", timeMode="None")


def daily_counts(stream: DataFrame, config: str = "config_id", ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Rows per config and day, for update mode."""
    return event_time(stream, ts).withWatermark(ts, late).groupBy(F.window(ts, "1 day"), config).agg(F.count("*").alias("n")).select(config, F.col("window.start").cast("date").alias("day"), "n")


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", timeout: int = 600) -> None:
    """Runs all that is there in micro-batches through `sink`, and ends; what a batch did isn't done again."""
    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"the stream didn't end in {dt.timedelta(seconds=timeout)}")


def run_in_parts(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What a stateful stream over these parts gives, each part a batch of its own, with a restart from the checkpoint between them.

    The number of state partitions is that of the first batch: twice the cores
    that the session has.
    """
    spark = parts[0].sparkSession
    base = f"{shared_folder(spark)}/presswork/{name}-{uuid.uuid4().hex}"
    state = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(2 * spark.sparkContext.defaultParallelism)}
    for k, part in enumerate(parts):
        part.write.mode("append").parquet(f"{base}/in")
        if k == 0:
            dropped_at_exit(spark, base)
        with settings(spark, state):
            stream = build(spark.readStream.schema(part.schema).parquet(f"{base}/in"))
            run_available(stream, lambda b, _: b.write.mode("append").parquet(f"{base}/out"), f"{base}/state")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
