"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its words, of its word
n-grams and of its words' character n-grams, whose ends are marked, each hashed
into one of BUCKETS rows; a linear layer and a softmax over the two classes
follow. A word n-gram has two vectors, one for its words and one for which of
them are equal: words never met in training have only the latter, and without it
a word said over and over can't be told. Vectors and layer are trained together by
stochastic gradient descent in numpy, on a bounded, documented sample of the
labelled rows. Scoring covers every byte of every text: with the model fixed, a
feature adds one number (its vector times the difference of the two classes'
weights), so a worker keeps BUCKETS floats and not the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import POWERS, mix64, prefix_hash, sliced, text_blocks, tidy, word_hashes, word_spans

#: Features are hashed into 2 ** BITS rows of DIM numbers: words, n-grams of so many words, and n-grams of so many characters of a word.
BITS, DIM, WORDS, CHARACTERS = 18, 12, (2, 3), (2, 3, 4)
BUCKETS = 1 << BITS
#: Stands before and after a word; no character.
MARK = 0xFFFFFFFF
#: The first labelled rows in a seeded order are learned from: at most so many, of at most so many bytes in all.
TRAIN_ROWS, TRAIN_BYTES = 3_000, 48 << 20
EPOCHS, RATE, SEED = 6, 0.5, 11
HELD_OUT_REMAINDER = 1


def spelled(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the rows' words, with a mark before and after each word, and the row of each."""
    lead = (data & 0xC0) != 0x80
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[lead]
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    inside = ~((code == 32) | ((code >= 9) & (code <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (row[1:] != row[:-1])
    word = np.cumsum(begins)[inside]  # from 1 on
    out = np.full(len(word) + 2 * int(begins.sum()), MARK, np.uint32)
    out[np.arange(len(word)) + 2 * word - 1] = code[inside]
    return out, np.repeat(row[begins], np.bincount(word, minlength=1)[1:] + 2)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the rows, with the row of each; case is kept, for it tells shouting from prose."""
    starts, ends = word_spans(data, offs)
    words, word_row = word_hashes(data, starts, ends), np.searchsorted(offs, starts, "right") - 1
    out = [(words, word_row)]
    for n in WORDS:
        at = np.flatnonzero(word_row[n - 1 :] == word_row[: len(words) - n + 1]) if len(words) >= n else np.zeros(0, np.int64)
        gram, same = np.full(len(at), n, np.uint64), np.full(len(at), n, np.uint64)
        for k in range(n):
            gram = mix64(gram + words[at + k])
            for j in range(k):
                same = same << np.uint64(1) | (words[at + j] == words[at + k])
        out += [(gram, word_row[at]), (mix64(same), word_row[at])]
    code, row = spelled(data, offs)
    h = prefix_hash(code)
    _, down = POWERS.to(len(code) + 1)
    marks = np.concatenate([[0], np.cumsum(code == MARK)])
    for n in CHARACTERS:
        if len(code) < n:
            continue
        # an n-gram lies in one word: its marks are at its ends, and one at least is a letter
        at = np.arange(len(code) - n + 1)
        at = at[(marks[at + n - 1] == marks[at + 1]) & (marks[at + n] - marks[at] < n)]
        out.append((mix64((h[at + n] - h[at]) * down[at] + np.uint64(n)), row[at]))
    return (np.concatenate([x for x, _ in out]) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([r for _, r in out])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.vectors, self.layer, self.bias = vectors, layer, bias

    @property
    def weights(self) -> np.ndarray:
        """What one feature of each bucket adds to the log odds of class 1."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32)

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])

    @classmethod
    def train(cls, texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
        """Without a row the model scores all texts one half."""
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
        docs = []
        for text in texts:
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            idx, n = np.unique(features(raw, np.array([0, len(raw)]))[0], return_counts=True)
            docs.append((idx.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)))
        y = np.asarray(labels, np.int64)
        if len(set(labels)) == 1:
            bias[labels[0]] = 4.0
        total, done = max(1, epochs * len(docs)), 0
        for _ in range(epochs if len(set(labels)) > 1 else 0):
            for i in rng.permutation(len(docs)):
                idx, w = docs[i]
                step = rate * (1 - done / total)
                done += 1
                mean = w @ vectors[idx]
                err = softmax(mean @ layer + bias)
                err[y[i]] -= 1
                back = layer @ err
                layer -= step * np.outer(mean, err)
                bias -= step * 0.1 * err
                # an average over thousands of features moves each by its share; scaled, so that long texts teach as much as short ones
                vectors[idx] -= (step * 20) * np.minimum(w, 0.05)[:, None] * back[None, :]
        return cls(vectors, layer, bias)


def _score(weights: np.ndarray, offset: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offs in text_blocks(batch.column(1)):
                idx, row = features(data, offs)
                n = np.bincount(row, minlength=end - at)
                z = np.bincount(row, weights[idx], end - at) / np.maximum(n, 1) + offset
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(p)], ["doc_id", "score"])

    return run


def remainder() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def learn(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, where: F.Column | None = None, size: int = TRAIN_BYTES) -> Model:
    """A model of labels.quality over documents.text.

    A document's label is the most frequent one of its rows in labels (1 on a
    tie); rows with nulls teach nothing. At most `rows` documents are taken, in
    the order of a seeded hash of doc_id, leaving out those whose text would
    bring the sum above `size` bytes: a sample of bounded size, whatever the
    table's and however long the texts. A taken text is learned from whole.
    """
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    known = known.where(where) if where is not None else known
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    order = F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")
    # twice the rows, since labels may name documents that aren't there
    picked = known.orderBy(*order).limit(2 * rows)
    named = lambda ids: documents.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    sizes = named(picked).groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("n")).orderBy(*order).limit(rows).collect()
    taken, left = [], size
    for r in sizes:
        if r.n <= left:
            taken.append((r.doc_id,))
            left -= r.n
    spark = documents.sparkSession
    chosen = named(picked.join(F.broadcast(spark.createDataFrame(taken, "doc_id long")), "doc_id"))
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    got = chosen.orderBy(*order).toArrow()
    return Model.train(got["text"].to_pylist(), got["quality"].to_pylist())


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row; a null text is an empty one, which gets the model's prior."""
    return documents.select("doc_id", "text").mapInArrow(tidy(_score(model.weights, model.offset)), "doc_id long, score double")


def classify(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents.

    held_out rows (crc32 of doc_id as text leaves 1 modulo 3) are never learned
    from. A null doc_id is not held out, and scored. A null text is an empty
    one; without a word it gets the model's prior. Every word of a text of any
    length counts. Ties at one half go to class 1. Rows that repeat are each
    scored; other columns, whatever their names, are not read. An empty table
    gives no row; without labels every score is one half.
    """
    model = learn(documents, labels, rows, remainder() != HELD_OUT_REMAINDER)
    out = scored(documents, model)
    held = F.coalesce(remainder() == HELD_OUT_REMAINDER, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _accept(weights: np.ndarray, offset: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            text = batch.schema.get_field_index("text")
            keep = [np.zeros(0, bool)]
            for at, end, data, offs in text_blocks(batch.column(text)):
                idx, row = features(data, offs)
                z = np.bincount(row, weights[idx], end - at) / np.maximum(np.bincount(row, minlength=end - at), 1) + offset
                keep.append(z >= 0)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return run


def accepted(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """The rows that the model doesn't reject (score one half or more), unchanged, with all their columns.

    A null or empty text has the model's prior; a text of any length is scored
    whole; rows that repeat stay or go together; an empty table gives no row.
    """
    return documents.mapInArrow(tidy(_accept(model.weights, model.offset)), documents.schema)
