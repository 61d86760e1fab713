"""State over a run's events: its summary, once, when it is complete or out of time, and ids that are tried again when they are due.

Both keep event time: rows of a key are taken in the order of their times, so
that what comes out doesn't depend on how events fall into micro-batches, as
long as they are within `late` of what a batch before had; rows of the very
time of the watermark are late, so that it is never nothing. The session must use the
RocksDB state store (streams.ROCKSDB).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from presswork.operators.quality import DOWNLOAD_FAILED, OK, PARSE_FAILED

#: What an event says besides a page's status: so many pages were found, or that the list phase is over.
FOUND, LISTED = "found", "list_done"

SUMMARY = StructType(
    [
        StructField("config_id", StringType()),
        *(StructField(c, LongType()) for c in ("start_time", "end_time", "new_count", "parse_success_num", "parse_failed_num", "download_failed_num")),
        StructField("finished", BooleanType()),
        StructField("errors", StringType()),
    ]
)
COUNTS = StructType([StructField(c, LongType()) for c in ("start", "end", "new", "ok", "parse_failed", "download_failed", "listed", "emitted")])
ONE = StructType([StructField("n", LongType())])


def _sorted_rows(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


def _micros(times: pd.Series) -> np.ndarray:
    return times.astype("datetime64[us, UTC]" if times.dt.tz is not None else "datetime64[us]").astype("int64").to_numpy()


class Completion(StatefulProcessor):
    """Emits a run's summary at the event that completes it, or else what it has come to when its time is over.

    A run is complete when its list phase is done and every page that was found
    is parsed or has failed. Its time begins with its first event; events after
    its summary, or after its time, count no more.
    """

    def __init__(self, limit_seconds: int):
        self.limit = limit_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", COUNTS)
        self.errors = handle.getMapState("errors", StructType([StructField("name", StringType())]), ONE)

    def _row(self, key: Any, c: tuple, finished: bool, new_errors: Counter) -> pd.DataFrame:
        start, end, new, ok, parse_failed, download_failed, _, _ = c
        errors = Counter({k[0]: v[0] for k, v in self.errors.iterator()}) + new_errors
        named = ",".join(f"{k}:{errors[k]}" for k in sorted(errors))
        return pd.DataFrame([(str(key[0]), start // 1_000_000, end // 1_000_000, new, ok, parse_failed, download_failed, finished, named)], columns=SUMMARY.fieldNames())

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        df = _sorted_rows(rows, ["ts", "seq"])
        us = _micros(df["ts"])
        before = self.counts.get() if self.counts.exists() else None
        if before is None:
            before = (int(us[0]), int(us[0]), 0, 0, 0, 0, 0, 0)
            self.handle.registerTimer((before[0] + self.limit) // 1000 + 1)
        if before[7]:
            return
        start = before[0]
        df, us = df[us <= start + self.limit], us[us <= start + self.limit]
        if df.empty:
            return
        kind = df["kind"].to_numpy()
        new = before[2] + np.cumsum(np.where(kind == FOUND, df["n"].fillna(0).to_numpy(), 0)).astype(np.int64)
        ok, parse_failed, download_failed, listed = (b + np.cumsum(kind == k) for b, k in zip(before[3:7], (OK, PARSE_FAILED, DOWNLOAD_FAILED, LISTED)))
        done = np.flatnonzero((listed > 0) & (new == ok + parse_failed + download_failed))
        at = int(done[0]) if len(done) else len(df) - 1
        end = max(before[1], int(us[: at + 1].max()))
        after = (start, end, *(int(x[at]) for x in (new, ok, parse_failed, download_failed, listed)), int(bool(len(done))))
        errors = Counter(df["error"].iloc[: at + 1].dropna())
        if len(done):
            yield self._row(key, after, True, errors)
            # what is kept till the timer is that it was emitted
            self.errors.clear()
        else:
            for name, n in errors.items():
                old = self.errors.getValue((name,))[0] if self.errors.containsKey((name,)) else 0
                self.errors.updateValue((name,), (old + n,))
        self.counts.update(after)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        c = self.counts.get()
        if not c[7]:
            yield self._row(key, c, False, Counter())
            self.errors.clear()
            self.counts.update((*c[:7], 1))

    def close(self) -> None:
        pass


def completed(events: DataFrame, limit_seconds: int, late: str = "1 second") -> DataFrame:
    """The summary of every run of the stream events(config_id, seq, ts, kind, n, error), once.

    kind is FOUND with n pages, a status of one page, or LISTED. A run without
    an id is `None`. Names of errors are counted, as "name:n,name:n".
    """
    rows = events.select(F.coalesce(F.col("config_id").cast("string"), F.lit("None")).alias("config_id"), F.col("seq").cast("long").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), "kind", F.col("n").cast("long").alias("n"), "error")
    return rows.withWatermark("ts", late).groupBy("config_id").transformWithStateInPandas(Completion(limit_seconds), outputStructType=SUMMARY, outputMode="Append", timeMode="EventTime")


RETRIES = StructType([StructField("id", LongType()), StructField("due", LongType()), StructField("tries", IntegerType()), StructField("fate", StringType())])
#: An id is to be fetched again, or was tried often enough.
RETRY, DROPPED = "retry", "dropped"


#: Groups of ids that share a state: so many calls a batch, however many ids there are.
GROUPS = 1024
WAITING = StructType([StructField("ids", ArrayType(LongType())), StructField("us", ArrayType(LongType())), StructField("tries", ArrayType(IntegerType())), StructField("due", ArrayType(BooleanType()))])


class Retries(StatefulProcessor):
    """Keeps the last failure of every id of a group that hasn't succeeded since, and how many there were; emits an id when it is due, and drops it after its tries.

    All ids of a group are handled at once, in numpy: a call and a round trip to
    the state for each id would take longer than its rows do. A group has one
    timer, for what is due next.
    """

    def __init__(self, wait_seconds: int, most: int):
        self.wait, self.most = wait_seconds * 1_000_000, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", WAITING)

    def _kept(self) -> list[np.ndarray]:
        """(ids, time of the last failure, tries, whether it is still to be emitted), ids ascending."""
        columns = self.waiting.get() if self.waiting.exists() else ([], [], [], [])
        return [np.array(c, t) for c, t in zip(columns, (np.int64, np.int64, np.int64, bool))]

    def _timer(self, us: np.ndarray, due: np.ndarray) -> int | None:
        return (int(us[due].min()) + self.wait) // 1000 + 1 if due.any() else None

    def _keep(self, kept: list[np.ndarray]) -> None:
        self.waiting.update(tuple(c.tolist() for c in kept)) if len(kept[0]) else self.waiting.clear()

    def _out(self, ids: np.ndarray, us: np.ndarray, tries: np.ndarray, fate: str) -> pd.DataFrame:
        return pd.DataFrame({"id": ids, "due": us // 1_000_000, "tries": tries.astype(np.int32), "fate": fate})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        df = _sorted_rows(rows, ["id", "ts", "seq"])
        ids, us, bad = df["id"].to_numpy(np.int64), _micros(df["ts"]), ~df["good"].to_numpy(bool)
        old = self._kept()
        first = np.append(True, ids[1:] != ids[:-1])
        last = np.append(first[1:], True)
        # what is kept of each id of the batch
        at = np.minimum(np.searchsorted(old[0], ids[first]), max(0, len(old[0]) - 1))
        known = old[0][at] == ids[first] if len(old[0]) else np.zeros(len(at), bool)
        before = np.zeros(len(ids), np.int64)
        before[np.flatnonzero(first)[known]] = old[2][at[known]]
        # failures since the id's last success, and which try of those that lead to a drop each is
        failures = np.cumsum(bad)
        start = np.maximum.accumulate(np.where(first | np.append(False, ~bad[:-1]), np.arange(len(ids)), 0))
        tries = (failures - (failures - bad - before)[start] - 1) % self.most + 1
        dropped, open_ = bad & (tries == self.most), bad & (tries < self.most)
        retried = open_ & ~last & (us + self.wait < np.append(us[1:], 0))
        overdue = known.copy()
        overdue[known] = old[3][at[known]] & (old[1][at[known]] + self.wait < us[first][known])
        of_old = at[overdue]
        # an id's last row says what is kept of it
        stays, new = np.ones(len(old[0]), bool), open_ & last
        stays[at[known]] = False
        kept = [np.append(o[stays], n) for o, n in zip(old, (ids[new], us[new], tries[new], np.ones(new.sum(), bool)))]
        order = np.argsort(kept[0])
        kept = [c[order] for c in kept]
        was, now = self._timer(old[1], old[3]), self._timer(kept[1], kept[3])
        self._keep(kept)
        if was != now:
            if was is not None:
                self.handle.deleteTimer(was)
            if now is not None:
                self.handle.registerTimer(now)
        out = [
            self._out(ids[dropped], us[dropped], tries[dropped], DROPPED),
            self._out(ids[retried], us[retried] + self.wait, tries[retried], RETRY),
            self._out(old[0][of_old], old[1][of_old] + self.wait, old[2][of_old], RETRY),
        ]
        if any(len(o) for o in out):
            yield pd.concat(out, ignore_index=True)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ids, us, tries, due = self._kept()
        by = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        over = due & ((us + self.wait) // 1000 + 1 <= by)
        due = due & ~over
        self._keep([ids, us, tries, due])
        if (later := self._timer(us, due)) is not None:
            self.handle.registerTimer(later)
        if over.any():
            yield self._out(ids[over], us[over] + self.wait, tries[over], RETRY)

    def close(self) -> None:
        pass


def retries(attempts: DataFrame, wait_seconds: int, most: int, late: str = "1 second", groups: int = GROUPS) -> DataFrame:
    """(id, due, tries, fate) of the stream attempts(id, seq, ts, good).

    An id that failed is due `wait_seconds` later, unless another attempt comes
    by then; one that succeeded is forgotten; after `most` failures in a row it
    is dropped, and begins anew. Rows without an id or a time are left out.
    State is kept by groups of ids, a batch reads and writes that of the groups
    that it has ids of; a stream keeps the number that it began with.
    """
    rows = attempts.where("id is not null and ts is not null").select(F.col("id").cast("long").alias("id"), F.col("seq").cast("long").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.coalesce("good", F.lit(False)).alias("good"))
    grouped = rows.withColumn("id_group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    return grouped.withWatermark("ts", late).groupBy("id_group").transformWithStateInPandas(Retries(wait_seconds, most), outputStructType=RETRIES, outputMode="Append", timeMode="EventTime")
