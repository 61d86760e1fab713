"""WARC archives: a writer with revisit records, and a salvage reader.

An archive is a row (archive, data): the bytes of a file of gzip members, one a
record. Spark writes such rows to any store as Parquet and reads real files of
the same kind with the binaryFile source. The reader checks every member and
record; where a check fails it searches for the next member that opens, or the
next version line, goes on from there, and logs the bytes between as a gap. In
a member it does so on the decompressed bytes, of which a damaged member has
those before the damage. A record that ends where its length says, before
another or the end, is one even if a digest fails: all of it is the gap, since
what looks like records in it is what it quotes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import Scratch

VERSION, DATE = b"WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES, LEVEL = 4 << 20, 5
MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/[01]\.\d+\r?\n")
NO_END = "gzip: the member has no end"
#: Bytes tried at first when a member is opened during a search.
PROBE = 512


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:presswork:page:{'' if page_id is None else page_id}>"


def _safe(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record; a revisit has the HTTP head of the payload it leaves out."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", _safe(url)), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if revisit:
        head += [("WARC-Refers-To", urn(refers_to)), ("WARC-Profile", PROFILE)]
    else:
        block += payload
    head += [("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[bytes] = []
    size = 0

    def archive() -> pa.RecordBatch:
        data = b"".join(parts)
        return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(data).hexdigest()]), pa.array([len(parts)], pa.int64()), pa.array([data], pa.binary())], ["archive", "records", "data"])

    for batch in batches:
        ids, urls, pages, firsts, again = batch.columns
        for i in range(batch.num_rows):
            rec = record(ids[i].as_py(), urls[i].as_py(), (pages[i].as_py() or "").encode(), firsts[i].as_py(), again[i].as_py())
            z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            parts.append(z.compress(rec) + z.flush())
            size += len(parts[-1])
            if size >= ARCHIVE_BYTES:
                yield archive()
                parts, size = [], 0
    if parts:
        yield archive()


class Bad(Exception):
    """A check that a member or record fails; `end` is where the record ends, if that is known."""

    def __init__(self, reason: str, end: int = 0):
        super().__init__(reason)
        self.end = end


class Finder:
    """Where patterns come next in bytes that are read forward. A place found is
    kept until it is passed, so that damaged bytes are searched once and not once a damage."""

    def __init__(self, data: bytes):
        self.data, self.held = data, {}

    def next(self, pattern: bytes | re.Pattern, at: int) -> int:
        """The first place from `at` on, or the end."""
        since, place = self.held.get(pattern, (0, -1))
        if not since <= at <= place:
            if isinstance(pattern, bytes):
                place = self.data.find(pattern, at)
            else:
                place = m.start() if (m := pattern.search(self.data, at)) else -1
            place = len(self.data) if place < 0 else place
            self.held[pattern] = (at, place)
        return place


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at `at` holds, and where it ends; its length and CRC are checked."""
    z, parts, step, bytes_ = zlib.decompressobj(31), [], 1 << 13, memoryview(data)
    try:
        while not z.eof and at < len(data):
            piece = bytes_[at : at + step]
            parts.append(z.decompress(piece))
            at += len(piece)
            step = min(4 * step, 1 << 20)
    except zlib.error as e:
        raise Bad(f"gzip: {e}") from None
    if not z.eof:
        raise Bad(NO_END)
    return b"".join(parts), at - len(z.unused_data)


def _prefix(data: bytes, at: int, most: int = 0) -> tuple[bytes, int]:
    """What the gzip member at `at` holds, as far as it can be decompressed, or its first `most` bytes; and where they have been read."""
    z, parts, step, n = zlib.decompressobj(31), [], 1 << 16, 0
    while at < len(data) and not z.eof and not (most and n >= most):
        before, piece = z.copy(), data[at : at + step]
        try:
            parts.append(z.decompress(piece, most and most - n))
        except zlib.error:
            if step == 1:
                break
            z, step = before, 256 if step > 256 else 1
            continue
        at += len(piece) - len(z.unconsumed_tail)
        n += len(parts[-1])
    return b"".join(parts), at


def _opens(data: bytes, at: int) -> bool:
    """Whether a gzip member whose content starts with a version line begins here."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + PROBE], 16).startswith(b"WARC/")
    except zlib.error:
        return False


def _parse(find: Finder, at: int, proof: bool = False) -> tuple[dict, bytes, int]:
    """Header fields in lower case, block and end of the record at `at`; digests are checked, and with proof one is asked for."""
    raw = find.data
    if not (m := _VERSION_LINE.match(raw, at)):
        raise Bad("no version line")
    end = find.next(b"\r\n\r\n", m.end() - 2)
    if end == len(raw):
        raise Bad("the header has no end")
    if _VERSION_LINE.search(raw, m.end(), end):
        raise Bad("a version line in the header")
    head = {}
    for line in raw[m.end() : end].decode("utf-8", "replace").split("\r\n"):
        k, colon, v = line.partition(":")
        if line and not colon:
            raise Bad("a header line without a colon")
        head[k.strip().lower()] = v.strip()
    size = head.get("content-length", "")
    if not size.isdigit():
        raise Bad("no content length")
    body = end + 4
    if body + int(size) + 4 > len(raw) or raw[body + int(size) : body + int(size) + 4] != b"\r\n\r\n":
        raise Bad("the block doesn't end where its length says")
    block, stop = raw[body : body + int(size)], body + int(size) + 4
    # where the next record begins, or nothing is left, the framing is sound
    framed = stop if stop == len(raw) or raw.startswith(b"WARC/", stop) or raw.startswith(MAGIC, stop) else 0
    if (d := head.get("warc-block-digest", "")).startswith("sha1:"):
        proof = False
        if d[5:] != base32_sha1(block):
            raise Bad("block digest", framed)
    if head.get("warc-type") == "response" and (d := head.get("warc-payload-digest", "")).startswith("sha1:"):
        proof = False
        if d[5:] != base32_sha1(block.partition(b"\r\n\r\n")[2]):
            raise Bad("payload digest", framed)
    if proof:
        raise Bad("no digest, in a member that fails its check", framed)
    return head, block, stop


def _records(raw: bytes, proof: bool) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
    """(start, end, fields, block, "") of each good record of a member's content,
    and (start, end, None, b"", reason) of each gap."""
    at, gap, why, find = 0, None, "", Finder(raw)
    while at < len(raw):
        try:
            head, block, end = _parse(find, at, proof)
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            at = e.end or find.next(_VERSION_LINE, at + 1)
            continue
        if gap is not None:
            yield gap, at, None, b"", why
            gap = None
        yield at, end, head, block, ""
        at = end
    if gap is not None:
        yield gap, len(raw), None, b"", why


def _salvage_member(find: Finder, at: int) -> tuple[list[tuple[dict | None, bytes, str]], int, str]:
    """(fields, block, "") and (None, b"", reason) of the records and gaps in the gzip member at `at`,
    where to go on, and why no record was good, if so.

    A record of a member that fails its check needs a digest of its own, but not
    if the member is only cut off. Digests cover blocks; the fields of such a
    record are as they were read, and the log names the member.
    """
    data, broken = find.data, ""
    try:
        raw, end = _member(data, at)
    except Bad as e:
        raw, end, broken = _prefix(data, at)[0], 0, str(e)
    rows = list(_records(raw, broken not in ("", NO_END)))
    done = max((stop for _, stop, head, _, _ in rows if head is not None), default=0)
    if broken:
        if rows and rows[-1][2] is None:
            rows.pop()
        end = _next(find, max(at + 1, _prefix(data, at, done)[1]) if done else at + 1)
    if not done:
        return [], end, broken or (rows[0][4] if rows else "an empty member")
    out = [(head, block, why and f"{why} (bytes {start} to {stop} of the member's content)") for start, stop, head, block, why in rows]
    if broken:
        out.append((None, b"", f"{broken} (the member's content from byte {done} on)"))
    return out, end, ""


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
    """(offset, length, fields, block, "") of each good record, and (offset,
    length, None, b"", reason) of each gap of bytes that no good record holds.

    Offset and length are those of the member, if a record or gap is in one that
    has good records; the reason of such a gap names its bytes of the content.
    """
    at, gap, why, find = 0, None, "", Finder(data)
    while at < len(data):
        if data.startswith(MAGIC, at):
            found, end, bad = _salvage_member(find, at)
        else:
            try:
                head, block, end = _parse(find, at)
                found, bad = [(head, block, "")], ""
            except Bad as e:
                found, end, bad = [], e.end or _next(find, at + 1), str(e)
        if not found:
            if gap is None:
                gap, why = at, bad
            at = end
            continue
        if gap is not None:
            yield gap, at - gap, None, b"", why
            gap = None
        for head, block, reason in found:
            yield at, end - at, head, block, reason
        at = end
    if gap is not None:
        yield gap, len(data) - gap, None, b"", why


def _next(find: Finder, at: int) -> int:
    """The first place from `at` on where a member opens or a version line stands, or the end."""
    line, k = find.next(_VERSION_LINE, at), find.next(MAGIC, at)
    while k < line and not _opens(find.data, k):
        k = find.next(MAGIC, k + 1)
    return min(k, line)


READ = "archive string, offset long, length long, reason string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _number(value: str) -> int | None:
    tail = value.rstrip(">").rpartition(":")[2]
    return int(tail) if re.fullmatch(r"-?\d+", tail) else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in READ.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            archive, rows, held = batch.column(0)[i].as_py(), [], 0
            for offset, length, head, block, why in salvage(batch.column(1)[i].as_py() or b""):
                if head is None:
                    rows.append((archive, offset, length, why, *[None] * 7))
                else:
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = head.get("warc-type")
                    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                    n = len(payload) if kind == "response" else int(size[1]) if size else None
                    digest = head.get("warc-payload-digest", "")
                    # a response's digest was checked as it was parsed
                    digest = digest[5:] if digest.startswith("sha1:") else base32_sha1(payload) if kind == "response" else digest
                    refers = _number(head["warc-refers-to"]) if "warc-refers-to" in head else None
                    rows.append((archive, offset, length, None, _number(head.get("warc-record-id", "")), head.get("warc-target-uri"), kind, refers, n, digest, payload if kind == "response" else None))
                    held += len(payload)
                if held > 1 << 22 or len(rows) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def write_archives(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives (archive, records, data) of all rows of pages(page_id, url, html).

    Of rows with equal payloads of at least `least` bytes, the one with the
    smallest page_id is a response and the others revisit it. A null html is an
    empty payload, a null url an empty address; rows without page_id are
    responses, unless another page has their payload; rows that repeat the
    smallest page_id and its payload are responses too. A page of any length is
    one record. Other columns, whatever their names, are not read. An empty
    table gives no archive.
    """
    text = F.coalesce("html", F.lit(""))
    payload = F.encode(text, "utf-8")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(text).alias("n"))
    same = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first_id")
    joined = rows.join(same, "digest", "left")
    again = F.coalesce(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    return joined.select("page_id", "url", "html", "first_id", again.alias("again")).mapInArrow(_write, "archive string, records long, data binary")


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """All records and gaps of archives (archive or path, data or content); a gap has a reason and no record_type."""
    name, data = [c for c in ("archive", "path") if c in archives.columns][0], [c for c in ("data", "content") if c in archives.columns][0]
    return archives.select(F.col(name).alias("archive"), F.col(data).alias("data")).mapInArrow(_read, READ)


def quarantine(records: DataFrame) -> DataFrame:
    """The log of byte gaps."""
    return records.where("reason is not null").select("archive", "offset", "length", "reason")


class Incomplete(Exception):
    """Archives that don't give back what was written to them."""


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, from archives written and read back.

    Raises Incomplete, with the number of records and the first gaps of the
    quarantine log, if a record that was written isn't read.
    """
    scratch = Scratch(spark, "warc")
    archives = scratch.cut(write_archives(spark, pages, least), "archives", "none")
    return verified(scratch, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def verified(scratch: Scratch, archives: DataFrame) -> DataFrame:
    """The records of archives(archive, records, data), all that were written."""
    back = scratch.cut(read_archives(scratch.spark, archives).drop("payload"), "records")
    written = archives.agg(F.sum("records")).first()[0] or 0
    got = back.agg(F.count_if(F.col("reason").isNull()).alias("read"), F.count("reason").alias("gaps")).first()
    if got.read != written or got.gaps:
        log = [f"{r.archive} {r.offset}+{r.length}: {r.reason}" for r in quarantine(back).limit(5).collect()]
        raise Incomplete(f"{written} records written, {got.read} read, {got.gaps} gaps: {log}")
    return back


#: The same rows from the pages themselves; a digest is 32 groups of five bits of the SHA-1.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), s AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM s
"""
