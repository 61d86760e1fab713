"""What the training-data operators share: scratch tables, Arrow batches and
vectorised work on UTF-8 bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.arrow import release
from presswork.storage import dropped_at_exit, shared_folder

#: Text bytes handled at once by the numpy kernels; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Rows that are worth a file and a task of their own, in tables of a few numbers a row.
FILE_ROWS = 20_000
#: Rows handled at once; 12 bits number the rows of a block.
BLOCK_ROWS = 1 << 12

#: Settings that hold while a table is cut: a finished cut's shuffle files go at once, and Arrow batches are small.
WHILE_CUTTING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are these for a while, and then as they were."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy(run):
    """run for mapInArrow, that leaves its worker without unused memory."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return through


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows, for functions that hold Python objects of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Scratch:
    """Tables that cut lineage, in the folder that the cluster shares.

    A lost executor costs a task, not the chain of joins before it. Shuffle
    files of a finished cut are dropped at once, since its result is on disk.
    Results are lazy and may read the tables, so these go when the application
    ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.made = spark, f"{shared_folder(spark)}/presswork/{name}-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame, name: str = "t", codec: str = "zstd") -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}-{name}"
        with settings(self.spark, WHILE_CUTTING):
            df.write.option("compression", codec).parquet(path)
        if self.made == 1:
            dropped_at_exit(self.spark, self.root)
        return self.spark.read.schema(df.schema).parquet(path)

    def small(self, df: DataFrame, rows: int, name: str = "t") -> DataFrame:
        """cut() of a table of about so many rows, in files of FILE_ROWS or more: many tiny files cost more than what is in them."""
        return self.cut(df.coalesce(max(1, -(-rows // FILE_ROWS))), name)

    def drop(self, *frames: DataFrame) -> None:
        """Deletes cut tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            for f in df.inputFiles()[:1]:
                path = jvm.org.apache.hadoop.fs.Path(f).getParent()
                path.getFileSystem(conf).delete(path, True)


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them) of a
    string column, in blocks; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, at + 1), at + BLOCK_ROWS, n)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


#: The bases of the prefix polynomials: odd, and without a pattern in their bits.
POWERS, MORE_POWERS = Powers(0x9E3779B97F4A7C15 | 5), Powers(0xC2B2AE3D27D4EB4F | 5)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prefix_hash(data: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """H with H[j] - H[i] = the polynomial of data[i:j], times base**i."""
    up, _ = powers.to(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't white space; no run
    crosses from one row to the next."""
    word = ~space[data]
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    before[offs[:-1][offs[:-1] < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    inner = offs[1:-1]
    after[inner[inner > 0] - 1] = False
    return starts, np.flatnonzero(word & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    h = prefix_hash(data, powers)
    _, down = powers.to(len(data) + 1)
    return mix64((h[ends] - h[starts]) * down[starts])


#: What lies between terms: all of ASCII but letters and digits.
BETWEEN_TERMS = np.zeros(256, bool)
BETWEEN_TERMS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
#: The same in SQL.
TERMS_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER_SQL, LOWER_SQL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_words(data: np.ndarray, offs: np.ndarray, space: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The words between `space` bytes with A-Z in lower case, and where they start and end."""
    starts, ends = word_spans(data, offs, space)
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(LOWER[data[~space[data]]])), starts, ends


def sql_terms(col) -> F.Column:
    """Terms of a text, as lower_words finds them; null for null."""
    return F.regexp_extract_all(F.translate(col, UPPER_SQL, LOWER_SQL), F.lit(TERMS_SQL), F.lit(0))


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each value ends in them) of unsigned numbers, seven bits a byte, low bits first."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(v) else 0, np.uint8)
    begin = ends - size
    for k in range(int(size.max()) if len(v) else 0):
        has = size > k
        more = size[has] > k + 1
        out[begin[has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
    return out, ends


def unvarints(raw: bytes) -> np.ndarray:
    """The numbers that varints() wrote, as uint64."""
    data = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.zeros(0, np.uint64)
    begin = np.concatenate([[0], last[:-1] + 1])
    if len(last) == len(data):
        return data.astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(begin, last - begin + 1)
    return np.add.reduceat((data & 127).astype(np.uint64) << (7 * place).astype(np.uint64), begin)


def per_row(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where each row's items begin among items at these byte positions, and the end."""
    return np.searchsorted(starts, offs).astype(np.int64)


def word_count(col) -> F.Column:
    """Number of runs that aren't white space; 0 for null."""
    return F.coalesce(F.expr(f"regexp_count({col}, '[^\\\\x20\\\\x09-\\\\x0D]+')"), F.lit(0)).cast("long")
