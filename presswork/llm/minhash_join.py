"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct set of shingles has a signature of COORDINATES minima. The set is
posted under each pair (coordinate, value). Two sets with at least MATCHES equal
coordinates share MATCHES lists, so whatever order the lists have, they meet in
one of the first m - MATCHES + 1 of each set's m lists that hold anyone else
(lists of one come first and can hold no partner). Lists are ordered by length:
those short prefixes are merged and a pair's collisions counted, the MATCHES - 1
longest lists of a set are skipped, and probed by comparing the two signatures
for pairs that the count leaves below MATCHES. Pairs that reach MATCHES are
confirmed on the full sets, of 128 bits a shingle.

A list isn't expanded into all its pairs. Its members meet the one member that
shares most with others, and links give components. Only members of lists that
still hold several components meet again, and there the rarest shingles of the
full sets choose the pairs, so that a large group of half-similar texts costs no
square.

With similarity 0.8 a coordinate matches with probability 0.8, and fewer than 22
of 48 match with probability 3.4e-8: that is the chance to lose a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.llm.common import LOWER, MORE_POWERS, POWERS, Scratch, mix64, per_row, text_blocks, tidy, word_hashes, word_spans
from presswork.llm.graph import components

COORDINATES, MATCHES = 48, 22
_RNG = np.random.default_rng(20_240_607)
MULTIPLY = _RNG.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADD = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)
#: Bytes of a shingle in a full set: two independent hashes of 64 bits, which stand for its words.
ITEM = 16
#: Links of one document that a task confirms at most; a document with more has several tasks.
LINKS = 256


def shingles(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct shingles, sorted within each row, as pairs of hashes, and where each row's begin."""
    rows = len(offs) - 1
    low = LOWER[data]
    starts, ends = word_spans(data, offs)
    first = per_row(starts, offs)
    count = np.diff(first)
    row = np.repeat(np.arange(rows), count)
    left = first[1:][row] - np.arange(len(starts))  # words from this one to the row's end
    total = count[row]
    keep = (left >= width) | ((total < width) & (left == total))
    grows = [left > k for k in range(1, width)]
    last = mix64(np.minimum(total[keep], width).astype(np.uint64))
    pair = []
    for powers, m in ((POWERS, np.uint64(0xD6E8FEB86659FD93)), (MORE_POWERS, np.uint64(0xA0761D6478BD642F))):
        words = word_hashes(low, starts, ends, powers)
        h = words.copy()
        for k, grow in enumerate(grows, 1):
            nxt = np.zeros_like(words)
            nxt[:-k] = words[k:] if k <= len(words) else 0
            h = np.where(grow, h * m + nxt, h)
        pair.append(mix64(h[keep] ^ last))
    row = row[keep].astype(np.uint16)  # a block has at most BLOCK_ROWS rows
    order = np.argsort(pair[0], kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    out, row = np.stack(pair, axis=1)[order], row[order]
    if len(out):
        new = np.concatenate([[True], (out[1:] != out[:-1]).any(axis=1) | (row[1:] != row[:-1])])
        out, row = out[new], row[new]
    return out, np.searchsorted(row, np.arange(rows + 1)).astype(np.int64)


def signatures(items: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows with items, COORDINATES) minima; the caller leaves out empty rows."""
    x = (items[:, 0] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = np.empty((len(bounds), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(x * MULTIPLY[k] + ADD[k], bounds)
    return out


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offs in text_blocks(batch.column(1)):
                items, bounds = shingles(data, offs, width)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                keys = np.zeros((end - at, 2), np.int64)
                sig = np.zeros((0, COORDINATES), np.uint32)
                if len(full):
                    heads = bounds[:-1][full]
                    sig = signatures(items, heads)
                    for k in (0, 1):
                        keys[full, k] = np.add.reduceat(mix64(items[:, k] ^ np.uint64(0x5851F42D4C957F2D)), heads).view(np.int64)
                none = n == 0
                ends = np.concatenate([[0], np.cumsum(np.where(none, 0, COORDINATES))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, end - at),
                        pa.array(n),
                        pa.array(keys[:, 0], mask=none),
                        pa.array(keys[:, 1], mask=none),
                        pa.ListArray.from_arrays(pa.array(ends, mask=np.append(none, False)), pa.array(sig.view(np.int32).ravel())),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "sig"],
                )

    return run


def _sets(width: int):
    """Full sets, ITEM bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offs in text_blocks(batch.column(1)):
                items, bounds = shingles(data, offs, width)
                held = pa.Array.from_buffers(pa.binary(), end - at, [None, pa.py_buffer((bounds * ITEM).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(items))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), held], ["doc_id", "items"])

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets as lists of numbers, a shingle's first hash each."""
    for batch in batches:
        sets = [_unpack(x.as_buffer())[:, 0] for x in batch.column(1)]
        size = np.array([len(x) for x in sets], np.int32)
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.ListArray.from_arrays(ends, pa.array(flat))], ["id", "size", "items"])


def _unpack(raw) -> np.ndarray:
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _linked(percent: int):
    """Links of pairs (a, b), from rows (a, lot, b, items) that arrive lot by lot, the set of a itself, with a null b, first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, mine, size = None, np.zeros(0), 0
        for batch in batches:
            a, lots, b, items = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "lot", "b", "items"))
            keep = []
            for i in range(batch.num_rows):
                x = _unpack(items[i].as_buffer())
                if not b[i].is_valid:
                    lot, mine, size = (a[i].as_py(), lots[i].as_py()), x, len(x)
                    keep.append(False)
                    continue
                if lot != (a[i].as_py(), lots[i].as_py()):
                    raise ValueError(f"the set of {a[i]} is missing")
                # both are sorted by their first hashes; equal ones must have equal second ones
                at = np.searchsorted(mine[:, 0], x[:, 0]).clip(max=max(size - 1, 0))
                both = int(np.count_nonzero((mine[at] == x).all(axis=1))) if size else 0
                keep.append(100 * both >= percent * (size + len(x) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


def _matching(least: int):
    def rows(column) -> np.ndarray:
        return np.asarray(column.flatten()).reshape(-1, COORDINATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = batch.columns
            mask = pa.array(np.count_nonzero(rows(sa) == rows(sb), axis=1) >= least)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


class InvertedJoin:
    """Near-duplicate links of documents (doc_id, text), and their components.

    Nulls: a text that is null or holds no word has an empty set and no link; a
    row without doc_id gets no component and is kept. Texts of any length have
    all their shingles compared. Rows that repeat a doc_id with one text are one
    document. Equal sets have one row of candidates; of links that tie all
    count. Other columns, whatever their names, are not read. An empty table
    gives an empty result.
    """

    def __init__(self, spark: SparkSession, width: int = 4, percent: int = 80, matches: int = MATCHES):
        self.spark, self.width, self.percent, self.matches = spark, width, percent, matches
        self.scratch = Scratch(spark, "minhash")

    def signed(self, docs: DataFrame) -> DataFrame:
        return self.scratch.cut(docs.select("doc_id", "text").mapInArrow(tidy(_sign(self.width)), "doc_id long, n_shingles long, k1 long, k2 long, sig array<int>"), "signed")

    def sets_of(self, ids: DataFrame, docs: DataFrame) -> DataFrame:
        """Full sets (id, items) of the documents with these ids."""
        texts = docs.select("doc_id", "text").where("text is not null").join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        return self.scratch.cut(texts.mapInArrow(tidy(_sets(self.width)), "doc_id long, items binary").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id"), "sets", "none")

    def confirmed(self, pairs: DataFrame, sigs: DataFrame, docs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Of pairs (a, b, met) of ids, those with enough equal coordinates whose full sets are similar enough.

        met is how many lists the pair was counted in; a pair below enough is
        probed by its signatures. A set is moved once for each of its links as
        b, and once for up to LINKS of them as a.
        """
        pairs = self.scratch.cut(pairs, "pairs")
        side = lambda df, c, v: df.select(F.col("id").alias(c), F.col(v).alias(f"{v}_{c}"))
        probed = pairs.where(F.col("met") < self.matches).select("a", "b").join(side(sigs, "a", "sig"), "a").join(side(sigs, "b", "sig"), "b").select("a", "b", "sig_a", "sig_b")
        probed = probed.mapInArrow(_matching(self.matches), "a long, b long").unionByName(pairs.where(F.col("met") >= self.matches).select("a", "b"))
        probed = self.scratch.cut(probed, "probed")
        n = probed.count()
        if sets is None:
            sets = self.sets_of(probed.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs)
        lots = probed.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / LINKS).cast("int").alias("lots"))
        lots = self.scratch.small(lots, n, "lots")
        dealt = probed.join(lots, "a").select("a", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int").alias("lot"), "b")
        theirs = dealt.join(side(sets, "b", "items"), "b").select("a", "lot", "b", F.col("items_b").alias("items"))
        own = lots.join(side(sets, "a", "items"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(None).cast("long").alias("b"), F.col("items_a").alias("items"))
        both = own.unionByName(theirs).repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first())
        links = self.scratch.cut(both.mapInArrow(_linked(self.percent), "a long, b long"), "links")
        self.scratch.drop(sets, probed, pairs)
        return links

    def candidates(self, member: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of members (id, c) of different components that may be similar enough, by the rarest shingles of their full sets.

        Signatures can't tell 0.7 from 0.8 in a large group, full sets can. With
        shingles in the order of their counts, two similar sets share one of the
        first size - ceil(t size) + 1 of the larger and the first
        size - ceil(2t / (1 + t) size) + 1 of the smaller, and after the first
        that they share enough of both must be left.
        """
        t = self.percent
        need = lambda n, x, y: F.floor((n * x + (y - 1)) / y)  # noqa: E731  ceil(n * x / y) in whole numbers
        items = sets.mapInArrow(_listed, "id long, size int, items array<long>").join(member, "id")
        each = items.select("id", "c", "size", F.explode("items").alias("g"))
        counts = each.groupBy("g").agg(F.count("*").alias("n"))
        order = W.partitionBy("id").orderBy("n", "g")
        placed = each.join(counts, "g").withColumn("pos", F.row_number().over(order) - 1)
        first = placed.where((F.col("n") > 1) & (F.col("pos") <= F.col("size") - need(F.col("size"), t, 100)))
        first = self.scratch.cut(first.select("g", "id", "c", "size", "pos"), "rarest")
        small = first.where(F.col("pos") <= F.col("size") - need(F.col("size"), 2 * t, 100 + t))
        x, y = small.alias("x"), first.alias("y")
        after = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.id") < F.col("y.id")))
        left = F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos"))
        able = (F.col("x.size") * 100 >= t * F.col("y.size")) & (left * (100 + t) >= t * (F.col("x.size") + F.col("y.size")))
        met = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.c") != F.col("y.c")) & after & able)
        return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().withColumn("met", F.lit(0))

    def components(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) for every row of docs."""
        cut = self.scratch.cut
        signed = self.signed(docs)
        usable = signed.where("doc_id is not null and k1 is not null")
        same = usable.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").alias("id"), "sig")).alias("x"))
        classes = cut(same.select("k1", "k2", "x.id", "x.sig"), "classes")
        key = (F.shiftleft(F.col("at").cast("long"), 32)).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
        posted = classes.select("id", F.posexplode("sig").alias("at", "value")).select("id", key.alias("key"))
        # a table of its own, so that a join on a list that many share can be split; so for the heads below
        lists = cut(posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1"), "lists")
        shared = posted.join(lists, "key")
        by_id = W.partitionBy("id")
        ranked = shared.withColumn("m", F.count("*").over(by_id)).where(F.col("m") >= self.matches)
        ranked = ranked.withColumn("weight", F.sum("length").over(by_id)).withColumn("r", F.row_number().over(by_id.orderBy("length", "key")))
        prefix = cut(ranked.where(F.col("r") <= F.col("m") - self.matches + 1).select("id", "key", "weight"), "prefix")
        sigs = cut(classes.join(prefix.select("id").distinct(), "id", "left_semi").select("id", "sig"), "sigs")
        # First every list's members against the one that shares most with others: that joins most copies, in as many pairs as postings.
        head = cut(prefix.groupBy("key").agg(F.max(F.struct("weight", -F.col("id"))).alias("x")).select("key", (-F.col("x")["col2"]).alias("h")), "heads")
        star = prefix.join(head, "key").where("h <> id").groupBy(F.col("h").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("met"))
        links = self.confirmed(star, sigs, docs)
        joined = components(self.scratch, links)
        # Then members of lists that hold several components; one component's members need no more comparing.
        member = cut(prefix.join(joined, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c")), "member")
        mixed = member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
        member = cut(member.join(mixed, "key", "left_semi").select("id", "c").distinct(), "mixed")
        sets = self.sets_of(member, docs)
        more = self.confirmed(self.candidates(member, sets), sigs, docs, sets)
        if not more.isEmpty():
            joined = components(self.scratch, links.unionByName(more))
        of_class = classes.select("k1", "k2", "id").join(joined, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("c"))
        out = signed.select("doc_id", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2"], "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
        return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    return InvertedJoin(spark, width, percent).components(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, one of each group of near-duplicates: that with the smallest doc_id, unchanged, with all its columns.

    A null or empty text is linked with nothing and stays. Of rows that repeat a
    doc_id one, any, stays; rows without one all stay. Texts of any length are
    compared whole; columns of any name come back; an empty table gives no row.
    """
    found = near_duplicates(spark, docs, width, percent)
    gone = found.where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"]).select(docs.columns)
    return named.unionByName(docs.where("doc_id is null"))


#: The same components from all pairs that share a shingle, and what can be reached over links.
ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), g AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS x, b AS y FROM link UNION SELECT b, a FROM link
  UNION
  SELECT r.x, l.y FROM reach r JOIN (SELECT a AS x, b AS y FROM link UNION ALL SELECT b, a FROM link) l ON r.y = l.x
), least AS (
  SELECT x, min(least(x, y)) AS c FROM reach GROUP BY x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM s LEFT JOIN least ON doc_id = x
"""
