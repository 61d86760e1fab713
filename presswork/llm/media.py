"""Media columns stored as content-defined chunks.

A payload is stored losslessly as a WAV file of 8-bit samples, its header apart.
A rolling gear hash over the samples cuts them into chunks, so that equal
stretches of different files give equal chunks wherever they stand. Joins on the
chunks' digests, without their bytes, leave one place that owns each. The store
has a bundle for each different file, with the chunks that no other place has,
compressed together, and each shared chunk once. A file is an ordered list of
digests, and is put together again, verified by its own digest, from the store.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import Scratch, sliced

UNIT, RATE = 64, 8000
#: Chunk sizes in bytes: none but a last one is smaller than LEAST, none is larger than MOST; a cut comes once in 2 ** BITS bytes.
LEAST, MOST, BITS = 256, 8192, 9
LEVEL = 9
#: Files that a task remembers, so as not to send one twice.
REMEMBERED = 50_000
GEAR = np.random.default_rng(4_096).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
WINDOW = 32


def payload(text: bytes) -> bytes:
    """The text with bytes 0 up to a positive multiple of UNIT."""
    return text + bytes(-len(text) % UNIT if text else UNIT)


def header(n: int) -> bytes:
    """What a mono file of n 8-bit samples begins with; the samples follow."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", (4 + len(fmt) + 8 + n) & 0xFFFFFFFF, b"WAVE") + fmt + struct.pack("<4sI", b"data", n & 0xFFFFFFFF)


def samples_of(media: bytes) -> bytes:
    """The samples of a mono file of 8-bit samples; raises ValueError for another file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE" or media[12:16] != b"fmt " or struct.unpack_from("<HHIIHH", media, 20) != (1, 1, RATE, RATE, 1, 8) or media[36:40] != b"data":
        raise ValueError("not a mono WAV file of 8-bit samples")
    return media[44:]


def gear(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: the sum of GEAR of the last WINDOW bytes, each shifted by its age."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < WINDOW:
        h[reach:] = h[reach:] + (h[:-reach] << np.uint32(reach))
        reach *= 2
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of data; the last is its length."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    marks = np.flatnonzero(gear(data) >> np.uint32(32 - BITS) == 0) + 1
    out, at = [], 0
    while len(data) - at > LEAST:
        k = np.searchsorted(marks, at + LEAST)
        end = min(int(marks[k]) if k < len(marks) else len(data), at + MOST, len(data))
        out.append(end)
        at = end
    return out if at == len(data) else [*out, len(data)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _files(column: pa.Array) -> Iterator[tuple[int, bytes, bytes]]:
    """(bytes of the text, samples, digest of the file) of each text."""
    for text in column:
        raw = (text.as_py() or "").encode()
        x = payload(raw)
        yield len(raw), x, hashlib.sha256(header(len(x)) + x).digest()


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sizes, keys, lists, ends = [], [], [], [0]
        for n, x, key in _files(batch.column(1)):
            sizes.append(n)
            keys.append(key)
            at = 0
            for end in cuts(x):
                lists.append(digest(x[at:end]))
                at = end
            ends.append(len(lists))
        chunks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lists, pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), chunks], ["doc_id", "n_bytes", "media", "chunks"])


#: A dictionary of DICTIONARY bytes is trained on the first SAMPLE texts in the order of a hash of their ids, SAMPLE_CHARS of each.
DICTIONARY, SAMPLE, SAMPLE_CHARS = 1 << 16, 2000, 4096


def dictionary(documents: DataFrame) -> bytes:
    """What chunks are compressed against; empty if the texts are too few to learn from. Chunks and digests don't depend on it."""
    h = F.xxhash64("doc_id")
    # the ids alone say which rows are first; then only those texts leave their tasks
    last = documents.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    rows = documents.where(h <= last).select(F.substring("text", 1, SAMPLE_CHARS).alias("t")).where(F.length("t") >= 64)
    got = sorted(rows.limit(SAMPLE).toArrow()["t"].to_pylist())
    try:
        return zstandard.train_dictionary(DICTIONARY, [t.encode() for t in got]).as_bytes() if len(got) >= 100 else b""
    except zstandard.ZstdError:
        return b""


def _packer(words: bytes):
    if not words:
        return zstandard.ZstdCompressor(level=LEVEL).compress
    known = zstandard.ZstdCompressionDict(words)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known).compress


def _unpacker(words: bytes):
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(words)} if words else {})).decompress


def _sent(words: bytes):
    """(media, z): files' samples, compressed; a task sends each file once, as far as it remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, sent = _packer(words), {}
        for batch in sliced(batches):
            keys, zs = [], []
            for _, x, key in _files(batch.column(0)):
                if key not in sent:
                    sent[key] = None
                    keys.append(key)
                    zs.append(pack(x))
            while len(sent) > REMEMBERED:
                del sent[next(iter(sent))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(zs, pa.binary())], ["media", "z"])

    return run


STORE = "media binary, head binary, sizes array<int>, shared array<int>, digest binary, z binary"
_STORE_TYPES = {"media": pa.binary(), "head": pa.binary(), "sizes": pa.list_(pa.int32()), "shared": pa.list_(pa.int32()), "digest": pa.binary(), "z": pa.binary()}


def _stored(words: bytes):
    """Bundles and shared chunks, from files that arrive one after the other, each with its marks before its samples.

    A mark is 2 * seq, or 2 * seq + 1 if the file owns that chunk. A file that several tasks sent is stored once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = _packer(words), _unpacker(words)
        key, marks, done = None, {}, False
        for batch in sliced(batches):
            rows = []
            for media, z, mark in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("media", "z", "marks"))):
                if (k := media.as_py()) != key:
                    key, marks, done = k, {}, False
                if not z.is_valid:
                    marks = {m >> 1: m & 1 for m in mark.as_py()}
                elif not done:
                    x, at, own, sizes, done = unpack(z.as_buffer()), 0, [], [], True
                    for seq, end in enumerate(cuts(x)):
                        sizes.append(end - at)
                        if seq not in marks:
                            own.append(x[at:end])
                        elif marks[seq]:
                            rows.append((None, None, None, None, digest(x[at:end]), pack(x[at:end])))
                        at = end
                    rows.append((key, header(len(x)), sizes, sorted(marks), None, pack(b"".join(own))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STORE_TYPES.values())], list(_STORE_TYPES))

    return run


def feature(samples: bytes) -> str:
    """Counts of samples by their high four bits, and of the changes of side of the middle level."""
    x = np.frombuffer(samples, np.uint8)
    high = x >= 128
    return ",".join(map(str, np.bincount(x >> 4, minlength=16))) + f";{int(np.count_nonzero(high[1:] != high[:-1]))}"


MEDIA = "media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _assembled(words: bytes):
    """What the media say, from (media, seq, head, sizes, z): a file's bundle arrives first, with seq -1, then its shared chunks in order."""
    types = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = [x.split()[0] for x in MEDIA.split(", ")]

    def told(key: bytes, head: bytes, sizes: list[int], own: bytes, shared: dict[int, bytes]) -> tuple:
        parts, at = [head], 0
        for seq, n in enumerate(sizes):
            if seq in shared:
                parts.append(shared[seq])
            else:
                parts.append(own[at : at + n])
                at += n
        media = b"".join(parts)
        if (sha := hashlib.sha256(media)).digest() != key:
            raise ValueError(f"the chunks of media {key.hex()} don't give its digest")
        x = samples_of(media)
        return key, len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-UNIT:]), len(media), sha.hexdigest(), feature(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, rows = _unpacker(words), None, []
        for batch in sliced(batches):
            for media, seq, head, sizes, z in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("media", "seq", "head", "sizes", "z"))):
                if seq.as_py() < 0:
                    if held:
                        rows.append(told(*held))
                    held = (media.as_py(), head.as_py(), sizes.as_py(), unpack(z.as_buffer()), {})
                elif held and held[0] == media.as_py():
                    held[4][seq.as_py()] = unpack(z.as_buffer())
                else:
                    raise ValueError(f"media {media.as_py().hex()} has chunks and no bundle")
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(told(*held)), types)], names)

    return run


class MediaStore:
    """Documents' payloads as media: recipes (doc_id, n_bytes, media, chunks), and a store of bundles
    (media, head, sizes, shared, z) and of shared chunks (digest, z)."""

    def __init__(self, spark: SparkSession):
        self.scratch = Scratch(spark, "media")

    def write(self, documents: DataFrame) -> None:
        cut = self.scratch.cut
        self.recipes = cut(documents.select("doc_id", "text").mapInArrow(_recipes, "doc_id long, n_bytes long, media binary, chunks array<binary>"), "recipes")
        self.uses = self.recipes.groupBy("media").agg(F.first("chunks").alias("chunks")).select("media", F.posexplode("chunks").alias("seq", "digest"))
        # the least place of a chunk that has several owns it; a file stands in a place as its hash, and if two had the same, both would own
        place = F.struct(F.xxhash64("media").alias("m"), "seq")
        owner = self.uses.groupBy("digest").agg(F.min(place).alias("x"), F.count("*").alias("n")).where("n > 1").select("digest", "x")
        self.marks = cut(self.uses.join(owner, "digest").select("media", "seq", "digest", (place == F.col("x")).alias("mine")), "marks")
        self.words = dictionary(documents)
        cut(self.scratch.spark.createDataFrame([(bytearray(self.words),)], "dictionary binary"), "dictionary")
        marked = self.marks.groupBy("media").agg(F.collect_list(F.col("seq") * 2 + F.col("mine").cast("int")).alias("marks"))
        sent = documents.select("text").mapInArrow(_sent(self.words), "media binary, z binary").select("media", "z", F.lit(None).cast("array<int>").alias("marks"))
        both = marked.select("media", F.lit(None).cast("binary").alias("z"), "marks").unionByName(sent).withColumn("kind", F.col("z").isNotNull())
        both = both.repartition("media").sortWithinPartitions("media", "kind").select("media", "z", "marks")
        self.store = cut(both.mapInArrow(_stored(self.words), STORE), "store", "none")

    def read(self) -> DataFrame:
        """One row per different media, from the stored chunks; raises if a file's digest doesn't hold."""
        bundles = self.store.where("media is not null").select("media", F.lit(-1).alias("seq"), "head", "sizes", "z", F.size("shared").alias("shared"))
        shared = self.store.where("digest is not null").select("digest", "z").join(self.marks, "digest")
        pieces = shared.select("media", "seq", F.lit(None).cast("binary").alias("head"), F.lit(None).cast("array<int>").alias("sizes"), "z")
        # files without shared chunks are read where they are
        moved = bundles.where("shared > 0").drop("shared").unionByName(pieces).repartition("media").sortWithinPartitions("media", "seq")
        told = lambda df: df.mapInArrow(_assembled(self.words), MEDIA)
        return told(bundles.where("shared = 0").drop("shared")).unionByName(told(moved))


def media_features(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) for every row.

    A null text is an empty one, whose payload is UNIT bytes 0. Equal texts are
    one media file. A text of any length is stored whole, in as many chunks as
    it takes. Rows that repeat give equal rows; a null doc_id stays null. Other
    columns, whatever their names, are not read. An empty table gives no row.
    """
    store = MediaStore(spark)
    store.write(documents)
    out = store.recipes.select("doc_id", "n_bytes", "media").join(store.read(), "media")
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
