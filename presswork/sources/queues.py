"""A durable queue of messages as a Spark data source, for batches and streams.

A queue is a folder. Tasks write segments of messages; a job's segments enter
the queue in one commit, the next version of a log that only one writer can
create, so a failed task or job leaves files that no version names. A version
has the live part of every segment; messages are numbered over all commits in
the order of the rows that were written.

    df.write.format("queue").mode("append").save(folder)
    spark.readStream.format("queue").load(folder)
    queues.pop(spark, folder, 100, newest=True)

The folder must be one that all machines mount, since tasks of a Python source
see files and no Hadoop store.
"""

from __future__ import annotations

import json
import os
import random
import threading
import time
import uuid
import weakref
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "queue"
SCHEMA = "seq long, value string"
#: Messages that a task holds before it writes a segment, log versions that stay, and tries of a commit.
SEGMENT_ROWS, KEPT, TRIES = 100_000, 16, 60


@dataclass
class Segment:
    """A file whose first message has the number `first`; those from `low` to `high` - 1 are live."""

    file: str
    first: int
    low: int
    high: int


@dataclass
class State:
    version: int = 0
    #: The number of the next message, and of each streaming writer the last batch that is in.
    next: int = 0
    segments: list[Segment] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)


class Log:
    """The versions of a queue's state."""

    def __init__(self, path: str):
        u = urlsplit(path)
        if u.scheme not in ("", "file"):
            raise ValueError(f"a queue needs a mounted folder, not {u.scheme}://")
        self.folder = u.path
        os.makedirs(f"{self.folder}/log", exist_ok=True)
        os.makedirs(f"{self.folder}/data", exist_ok=True)

    def read(self) -> State:
        for _ in range(TRIES):
            names = sorted(n for n in os.listdir(f"{self.folder}/log") if n.startswith("v"))
            if not names:
                return State()
            try:
                with open(f"{self.folder}/log/{names[-1]}", encoding="utf-8") as f:
                    raw = json.load(f)
            except FileNotFoundError:
                continue  # pruned since it was listed
            return State(raw["version"], raw["next"], [Segment(**s) for s in raw["segments"]], raw["batches"])
        raise RuntimeError(f"{self.folder}: versions went faster than they could be read")

    def change(self, f) -> State:
        """The state after f(state), as the next version; f is asked again if another writer was first, and gives False to leave it."""
        for k in range(TRIES):
            state = self.read()
            if f(state) is False:
                return state
            state.version += 1
            goal, draft = f"{self.folder}/log/v{state.version:020d}", f"{self.folder}/log/_{uuid.uuid4().hex}"
            with open(draft, "w", encoding="utf-8") as out:
                json.dump(asdict(state), out)
                out.flush()
                os.fsync(out.fileno())
            try:
                os.link(draft, goal)  # takes the name only if it is free
            except FileExistsError:
                time.sleep(random.random() * min(0.5, 0.01 * 2**k))
                continue
            finally:
                os.unlink(draft)
            for n in range(max(1, state.version - 2 * KEPT), state.version - KEPT):
                if os.path.exists(old := f"{self.folder}/log/v{n:020d}"):
                    os.unlink(old)
            return state
        raise RuntimeError(f"{self.folder}: lost {TRIES} races")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


def _enter(state: State, messages: list[Written | None]) -> None:
    for m in messages:
        for file, n in m.files if m else ():
            state.segments.append(Segment(file, state.next, state.next, state.next + n))
            state.next += n


def _write(folder: str, batches: Iterator[pa.RecordBatch]) -> Written:
    files, held, rows = [], [], 0

    def flush() -> None:
        name = f"{uuid.uuid4().hex}.parquet"
        pq.write_table(pa.concat_tables(held), f"{folder}/data/_{name}", compression="zstd")
        os.rename(f"{folder}/data/_{name}", f"{folder}/data/{name}")
        files.append((name, rows))

    for batch in batches:
        held.append(pa.table({"value": batch.column("value").cast(pa.string())}))
        rows += batch.num_rows
        if rows >= SEGMENT_ROWS:
            flush()
            held, rows = [], 0
    if rows:
        flush()
    return Written(files)


def _drop(folder: str, messages: list[Written | None]) -> None:
    for m in messages:
        for file, _ in m.files if m else ():
            if os.path.exists(f"{folder}/data/{file}"):
                os.unlink(f"{folder}/data/{file}")


class _Writer(DataSourceArrowWriter):
    def __init__(self, log: Log, overwrite: bool):
        self.log, self.overwrite = log, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.log.folder, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        def entered(state: State) -> None:
            if self.overwrite:
                state.segments = []
            _enter(state, messages)

        self.log.change(entered)

    def abort(self, messages: list[Written | None]) -> None:
        _drop(self.log.folder, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    """A batch that is committed again after a restart is in already, and its new files go."""

    def __init__(self, log: Log, writer: str):
        self.log, self.writer = log, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.log.folder, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        def entered(state: State):
            if state.batches.get(self.writer, -1) >= batchId:
                return False
            _enter(state, messages)
            state.batches[self.writer] = batchId

        before = self.log.read().next
        if self.log.change(entered).next == before and any(m and m.files for m in messages):
            _drop(self.log.folder, messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        _drop(self.log.folder, messages)


@dataclass
class Range(InputPartition):
    file: str
    first: int
    low: int
    high: int


def _read(folder: str, part: Range) -> Iterator[pa.RecordBatch]:
    at = part.first
    for batch in pq.ParquetFile(f"{folder}/data/{part.file}").iter_batches(batch_size=10_000):
        low, high = max(part.low - at, 0), min(part.high - at, batch.num_rows)
        if low < high:
            seq = pa.array(range(at + low, at + high), pa.int64())
            yield pa.RecordBatch.from_arrays([seq, batch.column(0).slice(low, high - low)], ["seq", "value"])
        at += batch.num_rows


def _ranges(state: State, low: int, high: int) -> list[Range]:
    return [Range(s.file, s.first, max(s.low, low), min(s.high, high)) for s in state.segments if max(s.low, low) < min(s.high, high)]


class _Reader(DataSourceReader):
    def __init__(self, log: Log, ranges: str | None):
        self.log, self.ranges = log, ranges

    def partitions(self) -> list[Range]:
        if self.ranges is not None:
            return [Range(*r) for r in json.loads(self.ranges)] or [Range("", 0, 0, 0)]
        state = self.log.read()
        return _ranges(state, 0, state.next) or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _read(self.log.folder, partition) if partition.file else ()


class _StreamReader(DataSourceStreamReader):
    def __init__(self, log: Log):
        self.log = log

    def initialOffset(self) -> dict:  # noqa: N802
        state = self.log.read()
        return {"seq": min((s.low for s in state.segments), default=state.next)}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"seq": self.log.read().next}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return _ranges(self.log.read(), start["seq"], end["seq"])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _read(self.log.folder, partition)


class QueueSource(DataSource):
    """Options: path; `writer`, a name for a streaming writer, which must stay the same over restarts."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _log(self) -> Log:
        return Log(self.options["path"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._log(), self.options.get("ranges"))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self._log())

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if "value" not in schema.fieldNames():
            raise ValueError("a queue's messages are a column named value")
        return _Writer(self._log(), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:  # noqa: N802
        return _StreamWriter(self._log(), self.options["writer"])


_REGISTERED: weakref.WeakSet = weakref.WeakSet()
_LOCK = threading.Lock()


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, once: while it is registered anew, other threads don't find it.

    The session becomes the calling thread's, by which Spark looks a format up.
    """
    with _LOCK:
        spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
        if spark not in _REGISTERED:
            spark.dataSource.register(QueueSource)
            _REGISTERED.add(spark)


def push(df: DataFrame, folder: str) -> None:
    """Adds df(value) in one commit, in the order of its rows."""
    register(df.sparkSession)
    df.select("value").write.format(NAME).mode("append").save(folder)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """(seq, value) of all live messages."""
    register(spark)
    return spark.read.format(NAME).load(folder)


def pop(spark: SparkSession, folder: str, n: int, newest: bool = True) -> DataFrame:
    """(seq, value) of the n newest or oldest messages, which leave the queue with this call; no two calls get the same."""
    register(spark)
    taken: list[Range] = []

    def trimmed(state: State):
        taken.clear()
        left, kept = n, []
        for s in sorted(state.segments, key=lambda s: s.first, reverse=newest):
            k = min(left, s.high - s.low)
            left -= k
            if k:
                taken.append(Range(s.file, s.first, s.high - k if newest else s.low, s.high if newest else s.low + k))
                s.low, s.high = (s.low, s.high - k) if newest else (s.low + k, s.high)
            if s.low < s.high:
                kept.append(s)
        state.segments = sorted(kept, key=lambda s: s.first)
        return bool(taken)

    Log(folder).change(trimmed)
    ranges = json.dumps([(r.file, r.first, r.low, r.high) for r in taken])
    return spark.read.format(NAME).option("ranges", ranges).load(folder)


def swept(folder: str, older_seconds: float = 86_400.0) -> int:
    """How many files went that no live segment needs and that are older than this; readers of popped messages must be done by then."""
    log, gone = Log(folder), 0
    live, now = {s.file for s in log.read().segments}, time.time()
    for name in os.listdir(f"{log.folder}/data"):
        path = f"{log.folder}/data/{name}"
        if name not in live and now - os.path.getmtime(path) > older_seconds:
            os.unlink(path)
            gone += 1
    return gone
