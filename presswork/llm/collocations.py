"""Phrase collocation mining by hierarchical naming of pairs.

Texts are read in chunks of about CHUNK_BYTES. A chunk's words are written as a
sequence of numbers into its own list of words; over all chunks the words'
counts are added, and a frequent word gets an id, which goes back to the chunks
that have it. Then, level by level, the chunks' neighbouring ids make pairs,
each chunk counts its different ones, and over all chunks a frequent pair
gets an id in turn, which is joined to the chunks and stands in the sequence
where the pair begins: the name of a phrase of one word more. Two neighbouring
phrases of k - 1 words overlap, so that their pair is the phrase of k words.

A name's two parts are its parents: the phrase without its last and without
its first word. Cuts find their counts by following them, and a phrase is
inside a longer one exactly if it is a parent, or a parent's parent; since a
parent occurs at least as often, it is enough to look at children.

A sequence moves once a level, with its chunk's names; words and pairs move
once a level, as one row a chunk that has them, so a frequent one costs as many
rows as there are chunks. Nothing is broadcast or collected.

A null lang is `und`, a null text is empty, each row counts, repeated ones too.
Words may be of any length. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from presswork.llm.common import Scratch, lower_words, text_blocks, tidy

LEAST, LONGEST, TOP = 30, 4, 2000
#: Dropped if a longer phrase has so many of a hundred of the occurrences.
SHARE = 80
CHUNK_BYTES = 16 << 20
#: Parts of a lang that are ranked by themselves before the whole is.
PARTS = 32
#: Bits of an id: the task, its chunk, and the number in the chunk.
CHUNK_BITS, CODE_BITS = 12, 27

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = BREAK.copy()
BETWEEN[[0x20, 0x09]] = True


def _packed(sequence: np.ndarray) -> bytes:
    """Numbers with 0 where no phrase goes on; several in a row are one."""
    none = sequence == 0
    return sequence[~(none & np.concatenate([[False], none[:-1]]))].astype(np.int32).tobytes()


def _chunk(number: int, words: list[pa.Array], langs: list[pa.Array], fresh: list[np.ndarray]) -> pa.RecordBatch:
    """A chunk's row: its different words with lang and count, and the sequence of their numbers, from 1, with a 0 between pieces."""
    word, lang = pa.concat_arrays(words).dictionary_encode(), pa.concat_arrays(langs).dictionary_encode()
    key = lang.indices.to_numpy().astype(np.int64) * max(len(word.dictionary), 1) + word.indices.to_numpy()
    own, code, n = np.unique(key, return_inverse=True, return_counts=True)
    new = np.concatenate(fresh)
    at = np.arange(len(code)) + np.cumsum(new)
    sequence = np.zeros(len(code) + int(new.sum()), np.int64)
    sequence[at] = code + 1
    k, w = np.divmod(own, max(len(word.dictionary), 1))
    listed = pa.StructArray.from_arrays([lang.dictionary.take(pa.array(k)), word.dictionary.take(pa.array(w)), pa.array(n.astype(np.int64))], ["lang", "word", "n"])
    offsets = pa.array([0, len(own)], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([_packed(sequence)], pa.binary()), pa.ListArray.from_arrays(offsets, listed)], ["chunk", "sequence", "words"])


def _chunked(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << CHUNK_BITS, 0
        words, langs, fresh = [], [], []
        for batch in batches:
            lang = pc.fill_null(batch.column("lang"), "und")
            for a, b, data, offs in text_blocks(batch.column("text")):
                found, starts, _ = lower_words(data, offs, BETWEEN)
                if not len(found):
                    continue
                row = np.repeat(np.arange(b - a), np.diff(np.searchsorted(starts, offs)))
                piece = np.cumsum(BREAK[data])[starts]
                words.append(found)
                langs.append(lang.slice(a, b - a).take(pa.array(row)))
                fresh.append(np.concatenate([[True], (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])]))
                held += len(data)
                if held >= chunk_bytes:
                    yield _chunk(number, words, langs, fresh)
                    number, held, words, langs, fresh = number + 1, 0, [], [], []
        if words:
            yield _chunk(number, words, langs, fresh)

    return tidy(run)


CHUNK = "chunk long, sequence binary, words array<struct<lang string, word string, n long>>"
LEVEL = "chunk long, sequence binary, ids binary"


def _pairs(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a number has a neighbour, both as one number)."""
    at = np.flatnonzero((sequence[:-1] > 0) & (sequence[1:] > 0))
    return at, (sequence[at].astype(np.int64) << 32) | sequence[at + 1]


def _named_words(sequences: pa.Table, names: pa.Table) -> pa.Table:
    """The sequence with only frequent words, numbered by their names."""
    sequence = np.frombuffer(sequences["sequence"][0].as_buffer(), np.int32)
    return _renamed(sequences["chunk"][0].as_py(), sequence, sequence - 1, np.arange(len(sequence)), names)


def _named_pairs(sequences: pa.Table, names: pa.Table) -> pa.Table:
    """The sequence with frequent pairs in the place of their first, numbered by their names."""
    sequence = np.frombuffer(sequences["sequence"][0].as_buffer(), np.int32)
    at, pair = _pairs(sequence)
    _, code = np.unique(pair, return_inverse=True)
    return _renamed(sequences["chunk"][0].as_py(), sequence, code, at, names)


def _renamed(chunk: int, sequence: np.ndarray, code: np.ndarray, at: np.ndarray, names: pa.Table) -> pa.Table:
    """A sequence of numbers into `ids`: at these places, what their code is named, and 0 elsewhere."""
    codes, ids = names["code"].to_numpy(), names["id"].to_numpy()
    number = np.zeros(int(max(codes.max(initial=0), code.max(initial=0))) + 2, np.int64)
    number[codes] = np.arange(1, len(codes) + 1)
    out = np.zeros(len(sequence), np.int64)
    out[at] = number[code]  # a code of -1, between pieces, finds the last, which no name has
    return pa.table({"chunk": pa.array([chunk], pa.int64()), "sequence": pa.array([_packed(out)], pa.binary()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary())})


def _counted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(own, left, right, n) of each chunk's different pairs; their code in the chunk is their place among them."""
    for batch in batches:
        for k in range(batch.num_rows):
            sequence, ids = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (("sequence", np.int32), ("ids", np.int64)))
            pair, n = np.unique(_pairs(sequence)[1], return_counts=True)
            rows = pa.RecordBatch.from_pydict(
                {
                    "own": pa.array((batch.column("chunk")[k].as_py() << CODE_BITS) + np.arange(len(pair), dtype=np.int64)),
                    "left": pa.array(ids[(pair >> 32) - 1]),
                    "right": pa.array(ids[(pair & 0xFFFFFFFF) - 1]),
                    "n": pa.array(n.astype(np.int32)),
                }
            )
            for at in range(0, len(pair), 50_000):
                yield rows.slice(at, 50_000)


PAIRS = "own long, left long, right long, n int"


def _own(chunk: str, code: str) -> Column:
    """A chunk's number of a word or pair, as one number over all chunks."""
    return (F.shiftleft(chunk, CODE_BITS) + F.col(code)).alias("own")


def _frequent(counts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """counts(own, keys, n) whose keys' counts add up to `least`: (own, id) with one id for all, the least of their own numbers.

    The first of them has the keys, too, and the sum as f. Chunks have counted
    before, so that a sum by groups and a join back would move the same rows
    twice.
    """
    same = W.partitionBy(*keys)
    summed = counts.withColumns({"f": F.sum("n").over(same), "id": F.min("own").over(same)}).where(F.col("f") >= least)
    first = F.col("own") == F.col("id")
    return summed.select("own", "id", first.alias("first"), *(F.when(first, F.col(c)).alias(c) for c in (*keys, "f")))


def _exact(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("decimal(19,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (l + r)), exactly: the quotient of what divides without a rest."""
    top, under = (_exact(2_000_000) * _exact(a)).cast("decimal(27,0)"), (_exact(left) + _exact(right)).cast("decimal(20,0)")
    return ((top - top % under) / under).cast("long")


def _with_parents(names: DataFrame, parts: DataFrame) -> DataFrame:
    """names(id, left, right, f) with the text and counts that their parents know."""
    a = parts.select([F.col(c).alias(f"a_{c}") for c in parts.columns])
    b = parts.select([F.col(c).alias(f"b_{c}") for c in parts.columns])
    return names.join(a, names["left"] == a["a_id"]).join(b, names["right"] == b["b_id"])


def named(spark: SparkSession, docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n), names by length) of all words and frequent phrases of docs(lang, text).

    Names of words are (id, lang, word, f), of longer phrases (id, left, right, f).
    """
    chunks = scratch.cut(docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(_chunked(chunk_bytes), CHUNK), "chunks")
    words = chunks.select("chunk", F.posexplode("words").alias("code", "w")).select(_own("chunk", "code"), "w.*")
    totals = scratch.cut(chunks.select(F.explode("words").alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("n")), "totals")
    found = scratch.cut(_frequent(words, ["lang", "word"], least), "words")
    out = [scratch.cut(found.where("first").select("id", "lang", "word", "f"), "names1")]
    level, step = chunks, _named_words
    for k in range(2, longest + 1):
        codes = found.select(F.shiftright("own", CODE_BITS).alias("chunk"), F.col("own").bitwiseAND(F.lit((1 << CODE_BITS) - 1)).alias("code"), "id")
        with_ids = level.select("chunk", "sequence").groupBy("chunk").cogroup(codes.groupBy("chunk")).applyInArrow(_or_none(step), LEVEL)
        before, (level, step) = (level, found), (scratch.cut(with_ids, f"level{k}"), _named_pairs)
        scratch.drop(*before)
        pairs = level.mapInArrow(tidy(_counted_pairs), PAIRS)
        if k < longest:
            found = scratch.cut(_frequent(pairs, ["left", "right"], least), f"pairs{k}")
            out.append(scratch.cut(found.where("first").select("id", "left", "right", "f"), f"names{k}"))
        else:
            last = pairs.groupBy("left", "right").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
            out.append(scratch.cut(last, f"names{k}").select(F.lit(None).cast("long").alias("id"), "left", "right", "f"))
    scratch.drop(level)
    return totals, out


def _or_none(step):
    """step for chunks that have names; a chunk without any has nothing to go on with."""

    def run(sequences: pa.Table, names: pa.Table) -> pa.Table:
        if not names.num_rows or not sequences.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "sequence": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
        return step(sequences, names)

    return run


def phrases(names: list[DataFrame]) -> list[DataFrame]:
    """For each length from 2: (id, left, right, lang, phrase, words, a, l, r, score), of the cut that scores lowest."""
    # what children ask of a parent: its count and last word, the counts of its last word, and those of its first and last runs of words, shortest first
    parts = names[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    out = []
    for k, own in enumerate(names[1:], 2):
        both = _with_parents(own, parts)
        # heads[j - 1]: the count of the first j words, for each j below k, and tails of the last j
        heads, tails = F.col("a_heads"), F.col("b_tails")
        cuts = [F.struct(_score(F.col("f"), heads[j - 1], tails[k - j - 1]).alias("score"), F.lit(j).alias("k"), heads[j - 1].alias("l"), tails[k - j - 1].alias("r")) for j in range(1, k)]
        cut = F.array_min(F.array(*cuts))
        made = both.select(
            "id",
            "left",
            "right",
            F.col("a_lang").alias("lang"),
            F.concat_ws(" ", "a_phrase", "b_last").alias("phrase"),
            F.col("b_last").alias("last"),
            "f",
            F.concat("a_heads", F.array("f")).alias("heads"),
            F.concat("b_tails", F.array("f")).alias("tails"),
            cut.alias("cut"),
        )
        parts = made.select("id", "lang", "phrase", "last", "f", "heads", "tails")
        out.append(made.select("id", "left", "right", "lang", "phrase", F.lit(k).alias("words"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
    return out


def outstanding(found: list[DataFrame], share: int = SHARE) -> DataFrame:
    """All phrases but those inside a longer one that has `share` of a hundred of their occurrences or more."""
    kept = []
    for own, longer in zip(found, [*found[1:], None]):
        if longer is not None:
            inside = longer.select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("within")).groupBy("id").agg(F.max("within").alias("within"))
            own = own.join(inside, "id", "left").where(F.col("within").isNull() | (_exact(100) * _exact(F.col("within")) < _exact(share) * _exact(F.col("a")))).drop("within")
        kept.append(own)
    return reduce(DataFrame.unionByName, kept)


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's `top` phrases."""
    scratch = Scratch(spark, "collocations")
    totals, names = named(spark, docs, scratch, least, longest, chunk_bytes)
    found = [scratch.cut(f, "phrases") for f in phrases(names)]
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first in parts of a lang, so that its last task has no more than so many parts' rows, whatever the number of phrases
    part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    first = outstanding(found, share).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, piece AS text
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    )
), words AS (
    SELECT lang, piece, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, w[s:s + k - 1] AS g
    FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM words CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k))
), f AS (
    SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g
), n AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT c.lang, c.k, c.g, c.a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
    FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.g = c.g[1:j]
    JOIN f r ON r.lang = c.lang AND r.g = c.g[j + 1:c.k]
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), inside AS (
    SELECT lang, part, max(a) AS within
    FROM (
        SELECT lang, a, g[s:s + j - 1] AS part
        FROM (SELECT lang, g, a, k, j, unnest(generate_series(1, k - j + 1)) AS s FROM (SELECT *, unnest(generate_series(2, k - 1)) AS j FROM candidates))
    )
    GROUP BY lang, part
), kept AS (
    SELECT s.*, array_to_string(s.g, ' ') AS phrase
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.g
    WHERE i.within IS NULL OR 100 * i.within < 80 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""
