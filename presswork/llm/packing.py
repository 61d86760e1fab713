"""Best-fit packing planned over the histogram of lengths.

The plan needs only how many pieces have each length: best fit, longest first,
places runs of equal pieces into runs of equally full sequences, so its work and
its size follow the number of lengths and not of documents. Each document then
finds its slot by joining its rank within its length to the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.llm.common import Scratch, tidy

CAPACITY, END_ID, TOKENIZER = 4096, 1, "word_bpe_49k.json"
#: A task's caches of words and parts are emptied beyond this many, and when long words fill them.
CACHE_WORDS, CACHE_PARTS, CACHE_CHARS = 600_000, 400_000, 40


class _Numbered(dict):
    """Words and their numbers; a word that is asked for anew gets the next one."""

    def __init__(self) -> None:
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


def _joined(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of flat with these numbers one after the other, and their lengths; piece k ends at ends[k]."""
    start = ends[at - 1]
    n = ends[at] - start
    place = np.cumsum(n)
    return flat[np.repeat(start - place + n, n) + np.arange(place[-1])] if len(at) else flat[:0], n


class WordTokenizer:
    """Token ids by the tokenizers library, asked once for each part of a word.

    The tokenizer drops white space and lets no token reach across it, so a text's
    ids are its words' ids in order. Only space, tab and newline are split at;
    other white space stays inside a word, for the tokenizer to treat. It lowers
    case and splits a word into runs of letters, single digits and runs of other
    signs before it looks at them; for words of printable ASCII and Latin-1
    letters that is done here, and only the parts go to its model. All other
    words, and those that may hold special tokens, go through it whole.
    """

    ODD = re.compile("[^\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<[|]").search
    PARTS = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\na-z\u00df-\u00f6\u00f8-\u00ff0-9]+").findall
    #: Bytes that stand for themselves aren't named; the others follow from 256 on, in order.
    BYTES = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.encode, self.model = whole.encode_batch, whole.model.tokenize
        self.clear_parts()
        self.clear()

    def clear(self) -> None:
        self.index = _Numbered()
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def clear_parts(self) -> None:
        """Number 1 is the newline between words, which has no id."""
        self.parts = _Numbered()
        self.parts["\n"] = 1
        self.part_flat, self.part_ends = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def learn_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        if len(self.parts) > CACHE_PARTS:
            self.clear_parts()
        found = self.PARTS("\n".join(words).lower() + "\n")
        at = np.fromiter(map(self.parts.__getitem__, found), np.int64, len(found))
        if new := self.parts.new:
            ids = [[t.id for t in self.model(p.encode().decode("latin-1").translate(self.BYTES))] for p in new]
            self.part_ends = np.concatenate([self.part_ends, np.cumsum([len(x) for x in ids]) + len(self.part_flat)])
            self.part_flat = np.concatenate([self.part_flat, np.array([i for x in ids for i in x], np.uint32)])
            self.parts.new = []
        flat, n = _joined(self.part_flat, self.part_ends, at)
        upto = np.cumsum(n)[at == 1]
        return flat, np.diff(upto, prepend=0)

    def learn(self, words: list[str]) -> None:
        """Ids of the words that were numbered since the last call, in that order."""
        if not self.ODD("\n".join(words)):
            flat, n = self.learn_plain(words)
        else:
            odd = np.array([bool(self.ODD(w)) for w in words])
            plain_flat, plain_n = self.learn_plain([w for w, o in zip(words, odd) if not o])
            ids = [e.ids for e in self.encode([w for w, o in zip(words, odd) if o], add_special_tokens=False)]
            n = np.zeros(len(words), np.int64)
            n[~odd], n[odd] = plain_n, [len(x) for x in ids]
            flat, mine = np.zeros(n.sum(), np.uint32), np.repeat(odd, n)
            flat[~mine], flat[mine] = plain_flat, [i for x in ids for i in x]
        self.ends = np.concatenate([self.ends, np.cumsum(n) + len(self.flat)])
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > CACHE_WORDS:
            self.clear()
        get, numbered = self.index.__getitem__, []
        for t in texts:
            ws = t.replace("\n", " ").replace("\t", " ").split(" ")
            numbered.append(np.fromiter(map(get, ws), np.int64, len(ws)))
        if new := self.index.new:
            self.learn(new)
            self.index.new = []
        out = [_joined(self.flat, self.ends, at[at > 0])[0] for at in numbered]
        if new and sum(len(w) for w in new if len(w) > CACHE_CHARS) > 1 << 20:  # long words are seldom met again
            self.clear_parts()
            self.clear()
        return out


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts = batch.column(0).slice(at, 500), batch.column(1).slice(at, 500).fill_null("").to_pylist()
                which, piece, start, length, crc = [], [], [], [], []
                for i, x in enumerate(tok.ids(texts)):
                    x = np.append(x, np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(x), capacity)):
                        part = x[s : s + capacity]
                        which.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(which, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of their lengths, with the number of their part and their rank in it among those of their length."""
    part, length, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = np.asarray(batch.column(batch.schema.get_field_index("length")))
        if not len(n):
            continue
        head = np.concatenate([[0], np.flatnonzero(n[1:] != n[:-1]) + 1])
        runs = np.diff(np.append(head, len(n)))
        rank = np.arange(len(n)) - np.repeat(head, runs)
        if n[0] == length:
            rank[: runs[0]] += done
        length, done = n[-1], int(rank[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(rank)], [*batch.schema.names, "part", "r"])


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: (length, first rank, rank after the last,
    first sequence, pieces a sequence, offset) of runs of slots.

    Sequences with the same room left are kept as ranges of numbers. A run of
    equal pieces goes to the fullest sequences they fit, as many pieces as fit
    into each before the next, as best fit would place them one by one.
    """
    rooms: list[int] = []  # sorted rooms that some sequence has
    ranges: dict[int, list[tuple[int, int]]] = {}
    out, made = [], 0

    def put(room: int, a: int, b: int) -> None:
        if room and b > a:
            if room not in ranges:
                insort(rooms, room)
            ranges.setdefault(room, []).append((a, b))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                per = capacity // length
                n = -(-left // per)
                a, b, room = made, made + n, capacity
                made += n
            else:
                room = rooms[k]
                a, b = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[k]
                per = room // length
                n = min(b - a, -(-left // per))
                put(room, a + n, b)
                b = a + n
            took = min(left, n * per)
            out.append((length, rank, rank + took, a, per, capacity - room))
            last = took - (n - 1) * per
            put(room - per * length, a, b - 1)
            put(room - last * length, b - 1, b)
            left -= took
            rank += took
    return out


def pack(spark: SparkSession, documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    A null or empty text is the end id alone, one piece of length 1; a text of
    any length is cut into as many pieces as it takes. Rows that repeat, or have
    no doc_id, are packed one by one. Other columns, whatever their names, are
    not read. An empty table gives no piece.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    scratch = Scratch(spark, "packing")
    made = documents.select("doc_id", "text").mapInArrow(tidy(_pieces(path, capacity, end_id)), PIECES)
    pieces = scratch.cut(made.withColumn("row", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    slots = scratch.cut(spark.createDataFrame(plan(histogram, capacity), "length long, lo long, hi long, first long, per long, at long"), "plan")
    # ranges of (length, row): a length that many pieces have is dealt to as many tasks as it takes
    ranked = pieces.repartitionByRange("length", "row").sortWithinPartitions("length", "row").drop("row").mapInArrow(_ranked, f"{PIECES}, part int, r long")
    ranked = scratch.cut(ranked, "ranked")
    # a row for each part and, where parts meet inside a length, one more: it has a bound, as the plan has
    counts = ranked.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = scratch.cut(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "base")
    by_length = slots.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "first", "per", "at"))).alias("runs"))
    placed = ranked.join(F.broadcast(base), ["length", "part"]).join(F.broadcast(by_length), "length").withColumn("rank", F.col("r") + F.col("base"))
    # a length has few runs of slots; the rank falls into one of them
    placed = placed.withColumn("x", F.filter("runs", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"]))[0])
    inner = F.col("rank") - F.col("x.lo")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("x.first") + F.floor(inner / F.col("x.per"))).cast("long").alias("sequence_id"),
        (F.col("x.at") + (inner % F.col("x.per")) * F.col("length")).cast("long").alias("offset"),
    )
