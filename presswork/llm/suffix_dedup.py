"""Removal of repeated byte strings by a hash-compared suffix sort.

A string of SPAN bytes that occurs twice has the same anchor both times: the
least of its GRAM-byte hashes (the last one on a tie). Only anchors whose hash
occurs again can lie in a repeat, so only suffixes that start at those anchors
are sorted: bucket by bucket of equal anchors, by a mergesort that compares two
suffixes in logarithmic time, with a binary search over prefix polynomials for
their common extension. The same search to the left extends each pair backward;
a pair that agrees over SPAN bytes or more covers both stretches. Its bytes are
compared before it counts.

An anchor's stretch is all its windows' bytes. Where a whole stretch occurs
again, as it does inside every long repeat, an aggregate of its anchor and its
BLAKE2 digest finds that, and no bytes are moved; texts that are copies are found
by their SHA-256. Buckets of more than BUCKET different stretches aren't
sorted: their windows' hashes are counted, in blocks of windows with the anchor at
the same places, and where even those are too many, one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import POWERS, Scratch, mix64, prefix_hash, text_blocks

SPAN, GRAM = 200, 50
#: Buckets of up to so many different stretches are sorted; windows of larger ones are counted, by blocks of about BLOCK times SPAN windows.
BUCKET, BLOCK = 256, 1 << 13
KEYS = ["k1", "k2"]


def text_keys() -> list[F.Column]:
    """The first 128 bits of the text's SHA-256."""
    sha = F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)
    return [F.conv(F.substring(sha, at, 16), 16, -10).cast("long").alias(k) for k, at in (("k1", 1), ("k2", 17))]


def anchors(data: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """(row, anchor, first window start, last window start, gram hash, stretch hash) of all anchors; places are relative to the row."""
    width, n = span - gram + 1, len(data)
    sizes = np.diff(offs)
    none = np.zeros(0, np.int64)
    if n < span or not (sizes >= span).any():
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h = prefix_hash(data)
    _, down = POWERS.to(n + 1)
    g = (h[gram:] - h[:-gram]) * down[: n - gram + 1] * np.uint64(0xD1342543DE82EF95)
    low = (g & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(g), dtype=np.uint64))
    reach = 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - span + 1, 0))
    begin = np.cumsum(np.maximum(sizes - span + 1, 0)) - np.maximum(sizes - span + 1, 0)
    start = np.arange(len(row)) - begin[row] + offs[:-1][row]
    at = np.int64(0xFFFFFFFF) - (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    last = np.append(head[1:], len(at)) - 1
    a, first, final, row = at[head], start[head], start[last], row[head]
    # equal digests stand for equal bytes, so they don't come from the polynomials
    raw = memoryview(np.ascontiguousarray(data))
    stretch = b"".join([hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(first.tolist(), (final + span).tolist())])
    shape = (a - first).astype(np.uint64) * np.uint64(1 << 20) + (final - first).astype(np.uint64)
    base = offs[:-1][row]
    return row, a - base, first - base, final - base, mix64(g[a]), np.frombuffer(stretch, np.uint64) ^ mix64(shape)


ANCHORS = "k1 long, k2 long, a int, first int, final int, ah long, ch long, n int"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different stretch of a text with its count there. Where a
    stretch comes again in its text, what the further ones cover is in rows
    without ah: a text of one line over and over has a few rows, not one a line."""
    for batch in batches:
        for at, _, data, offs in text_blocks(batch.column(2)):
            row, a, first, final, ah, ch = anchors(data, offs)
            key = mix64(ah ^ mix64(ch + mix64(row.astype(np.uint64))))
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            more = np.ones(len(key), bool)
            more[one] = False
            more = np.flatnonzero(more)
            # places ascend within a row, so covers that touch follow each other
            head = np.ones(len(more), bool)
            head[1:] = (row[more[1:]] != row[more[:-1]]) | (first[more[1:]] > final[more[:-1]] + SPAN)
            start = more[head]
            end = more[np.append(np.flatnonzero(head)[1:], len(more)) - 1] if len(more) else more
            take = pa.array(np.concatenate([row[one], row[start]]) + at)
            known = np.arange(len(one) + len(start)) >= len(one)
            whole = lambda x, y, t: pa.array(np.concatenate([x, y]).astype(t))
            hashes = [pa.array(np.concatenate([x[one], x[start]]).view(np.int64), mask=known) for x in (ah, ch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), whole(a[one], a[start], np.int32), whole(first[one], first[start], np.int32), whole(final[one], final[end], np.int32), *hashes, whole(n, np.zeros(len(start)), np.int32)],
                ["k1", "k2", "a", "first", "final", "ah", "ch", "n"],
            )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each text."""
    for batch in batches:
        cols: list[list] = [[] for _ in range(8)]
        wanted = batch.column(3)
        for i in range(batch.num_rows):
            raw = memoryview(batch.column(2)[i].as_buffer())
            for x in wanted[i].as_py():
                for c, v in zip(cols, (x["ah"], x["single"], x["different"], batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), x["a"] - x["first"], x["first"], bytes(raw[x["first"] : x["final"] + SPAN]))):
                    c.append(v)
                if len(cols[0]) >= 4000:
                    yield _stretch_batch(cols)
                    cols = [[] for _ in range(8)]
        if cols[0]:
            yield _stretch_batch(cols)


STRETCH = "ah long, single boolean, different long, k1 long, k2 long, left int, first int, bytes binary"
_STRETCH_TYPES = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _stretch_batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _STRETCH_TYPES)], ["ah", "single", "different", "k1", "k2", "left", "first", "bytes"])


class Suffixes:
    """Strings side by side with their prefix polynomials; compares suffixes and prefixes by binary search."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.data, self.begin, self.end = data, begin, end
        self.h = prefix_hash(data)
        _, self.down = POWERS.to(len(data) + 1)

    def hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.h[at + size] - self.h[at]) * self.down[at]

    def extend(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How far the bytes from x and y on (step 1), or before them (step -1), agree, up to most."""
        lo, hi = np.zeros(len(x), np.int64), most.astype(np.int64)
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.hash(x, mid) == self.hash(y, mid) if step > 0 else self.hash(x - mid, mid) == self.hash(y - mid, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, ex: np.ndarray, y: np.ndarray, ey: np.ndarray) -> np.ndarray:
        """Whether the suffix from x to ex comes before the one from y to ey; false for equal ones."""
        n = self.extend(x, y, np.minimum(ex - x, ey - y), 1)
        over_x, over_y = x + n >= ex, y + n >= ey
        bx = self.data[np.minimum(x + n, len(self.data) - 1)]
        by = self.data[np.minimum(y + n, len(self.data) - 1)]
        return np.where(over_x, ~over_y, ~over_y & (bx < by))

    def mergesort(self, at: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of the suffixes at `at`, stable, within each run of equal group numbers.

        Bottom up: in every round each element finds its rank in the sibling run
        by binary search, all elements of all groups at once.
        """
        order = np.arange(len(at))
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(at) else order
        number = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1])])) if len(at) else order
        lo_g, size = heads[number], np.diff(np.append(heads, len(at)))[number]
        place, run = np.arange(len(at)) - lo_g, 1
        while len(at) and run < size.max():
            mine = place // run
            sib = mine ^ 1
            a = np.minimum(sib * run, size)
            b = np.minimum(sib * run + run, size)
            lo, hi = a.copy(), b.copy()
            right = (mine & 1) == 1
            while (todo := lo < hi).any():
                t = np.flatnonzero(todo)
                mid = (lo[t] + hi[t]) >> 1
                x, y = order[t], order[lo_g[t] + mid]
                # an element of the right run goes behind equal ones of the left run
                before = self.less(at[y], end[y], at[x], end[x])
                r = right[t]
                if r.any():
                    q = np.flatnonzero(r)
                    before[q] = ~self.less(at[x[q]], end[x[q]], at[y[q]], end[y[q]])
                lo[t] = np.where(before, mid + 1, lo[t])
                hi[t] = np.where(before, hi[t], mid)
            pair = (mine >> 1) * 2 * run
            new = lo_g + pair + (place - mine * run) + (lo - a)
            moved = np.empty_like(order)
            moved[new] = order
            order, run = moved, 2 * run
        return order


def covered(strings: list, left: np.ndarray, group: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and from its anchor on each stretch shares with
    others of its group in strings of span bytes or more; zeros if none.
    Stretches of a group stand together and differ from each other."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    end = np.cumsum(sizes)
    begin = end - sizes
    sx = Suffixes(data, begin, end)
    anchor = begin + left
    order = sx.mergesort(anchor, end, group)
    n = len(order)
    x = anchor[order]
    grp = group[order]
    back, ahead = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n < 2:
        return back, ahead
    room = (end - anchor)[order]
    common = sx.extend(x[:-1], x[1:], np.minimum(room[:-1], room[1:]), 1)
    common[grp[1:] != grp[:-1]] = 0
    i, r, gap = np.arange(n - 1), common.copy(), 1
    before = left[order]
    while True:
        live = r + np.minimum(before[i], before[i + gap]) >= span
        keep = r > 0
        p, q, rr = i[live], i[live] + gap, r[live]
        if len(p):
            ll = sx.extend(x[p], x[q], np.minimum(before[p], before[q]), -1)
            ok = np.flatnonzero(ll + rr >= span)
            # the hashes agree; now the bytes themselves
            ok = ok[[bool(np.array_equal(data[x[p[k]] - ll[k] : x[p[k]] + rr[k]], data[x[q[k]] - ll[k] : x[q[k]] + rr[k]])) if not (back[p[k]] >= ll[k] and back[q[k]] >= ll[k] and ahead[p[k]] >= rr[k] and ahead[q[k]] >= rr[k]) else False for k in ok]]
            for side in (p[ok], q[ok]):
                np.maximum.at(back, side, ll[ok])
                np.maximum.at(ahead, side, rr[ok])
        i, r = i[keep], r[keep]
        inside = i + gap < n - 1
        i, r = i[inside], r[inside]
        if not len(i):
            break
        r = np.minimum(r, common[i + gap])
        gap += 1
    out_b, out_a = np.empty_like(back), np.empty_like(ahead)
    out_b[order], out_a[order] = back, ahead
    return out_b, out_a


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found in whole buckets; buckets arrive one after the other, of at most BUCKET stretches."""
    names = ("ah", "single", "k1", "k2", "left", "first", "bytes")

    def run(rows: dict) -> pa.RecordBatch:
        left = np.array(rows["left"], np.int64)
        back, ahead = covered(rows["bytes"], left, np.array(rows["ah"], np.int64))
        hit = np.flatnonzero((ahead > 0) & np.array(rows["single"], bool))
        place = np.array(rows["first"], np.int64) + left
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(rows["k1"], np.int64)[hit]), pa.array(np.array(rows["k2"], np.int64)[hit]), pa.array((place - back)[hit].astype(np.int32)), pa.array((place + ahead)[hit].astype(np.int32))],
            ["k1", "k2", "s", "e"],
        )

    held: dict[str, list] = {c: [] for c in names}
    for batch in batches:
        for c in names:
            held[c] += batch.column(batch.schema.get_field_index(c)).to_pylist()
        if len(held["ah"]) > 4 * BUCKET:
            cut = len(held["ah"])
            while cut and held["ah"][cut - 1] == held["ah"][-1]:
                cut -= 1
            if cut:
                yield run({c: v[:cut] for c, v in held.items()})
                held = {c: v[cut:] for c, v in held.items()}
    if held["ah"]:
        yield run(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the windows of stretches of large buckets, in a row for each block of `width` places before the anchor.

    Equal windows have their anchor at the same place, so they meet in the same block.
    """
    names = ["ah", "block", "single", "k1", "k2", "start", "place", "windows"]
    types = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        ah, single, k1, k2, left, first, width = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("ah", "single", "k1", "k2", "left", "first", "width"))
        for i, raw in enumerate(batch.column(batch.schema.get_field_index("bytes"))):
            data = np.frombuffer(raw.as_buffer(), np.uint8)
            h = prefix_hash(data)
            _, down = POWERS.to(len(data) + 1)
            n = len(data) - SPAN + 1
            w = mix64((h[SPAN:] - h[:n]) * down[:n]).view(np.int64)
            at = 0
            while at < n:  # places count down from left to the anchor
                place = left[i] - at
                end = min(n, at + place % width[i] + 1)
                for c, v in zip(cols, (ah[i], place // width[i], single[i], k1[i], k2[i], first[i] + at, place, w[at:end])):
                    c.append(v)
                at = end
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


WINDOWS = "ah long, block int, single boolean, k1 long, k2 long, start int, place int, windows array<long>"


def repeated_runs(starts: np.ndarray, places: np.ndarray, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, byte after the last) of the runs of windows of a block that another window there equals."""
    n = np.array([len(w) for w in windows])
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.concatenate(windows).view(np.uint64) + mix64((places[row] - step).astype(np.uint64))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(count[which] > 1)
    if not len(hit):
        return hit, hit, hit
    new = np.concatenate([[True], (row[hit[1:]] != row[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)])
    head = hit[new]
    last = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
    return row[head], starts[row[head]] + step[head], starts[row[head]] + step[last] + SPAN


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found in blocks of large buckets, which arrive one after the other."""
    names = ("ah", "block", "single", "k1", "k2", "start", "place", "windows")

    def run(rows: dict) -> pa.RecordBatch:
        row, s, e = repeated_runs(np.array(rows["start"], np.int64), np.array(rows["place"], np.int64), rows["windows"])
        keep = np.array(rows["single"], bool)[row] if len(row) else np.zeros(0, bool)
        row, s, e = row[keep], s[keep], e[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.array(rows["k1"], np.int64)[row]), pa.array(np.array(rows["k2"], np.int64)[row]), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["k1", "k2", "s", "e"])

    held: dict[str, list] = {c: [] for c in names}
    for batch in batches:
        got = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names[:-1]}
        got["windows"] = [np.asarray(x.values) for x in batch.column(batch.schema.get_field_index("windows"))]
        key = list(zip(got["ah"], got["block"]))
        at = 0
        for i in range(len(key) + 1):
            if i == len(key) or (i > at and key[i] != key[i - 1]):
                if held["ah"] and (held["ah"][-1], held["block"][-1]) != key[at]:
                    yield run(held)
                    held = {c: [] for c in names}
                for c in names:
                    held[c] += got[c][at:i]
                at = i
    if held["ah"]:
        yield run(held)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[], [], []]
        for raw, spans in zip(batch.column(2), batch.column(3).to_pylist()):
            raw, at, left, runs = memoryview(raw.as_buffer()), 0, hashlib.sha256(), union([(x["s"], x["e"]) for x in spans])
            for s, e in runs:
                left.update(raw[at:s])
                at = e
            left.update(raw[at:])
            for c, v in zip(cols, (sum(e - s for s, e in runs), len(runs), left.hexdigest())):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string())))], ["k1", "k2", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """(k1, k2, s, e): stretches of each text, by its keys, that occur elsewhere in strings of SPAN bytes or more; they may overlap."""
    cut = scratch.cut
    texts = documents.select(*text_keys(), "text").where(F.octet_length("text") >= SPAN)
    found = cut(texts.mapInArrow(_anchors, ANCHORS), "anchors")
    inside = cut(found.where("ah is null").select(*KEYS, F.col("first").alias("s"), (F.col("final") + SPAN).alias("e")).distinct(), "inside")
    # a table of its own, so that a join on an anchor that many texts share can be split
    again = cut(found.where("ah is not null").groupBy("ah").agg(F.sum("n").alias("n")).where("n > 1").select("ah"), "again")
    held = found.join(again, "ah", "left_semi")
    # rows of one text's copies are one place with a count
    places = cut(held.groupBy("k1", "k2", "a", "first", "final", "ah", "ch").agg(F.sum("n").alias("n")), "places")
    scratch.drop(found)
    stretch = cut(places.groupBy("ah", "ch").agg(F.sum("n").alias("n"), F.min(F.struct(*KEYS, "a", "first", "final")).alias("x")), "stretches")
    whole = places.join(stretch.where("n > 1").select("ah", "ch"), ["ah", "ch"], "left_semi").select(*KEYS, F.col("first").alias("s"), (F.col("final") + SPAN).alias("e"))
    mixed = cut(stretch.groupBy("ah").agg(F.count("*").alias("different"), F.min("n").alias("least")).where("different > 1 and least = 1"), "mixed")
    need = stretch.join(mixed, "ah").select("ah", (F.col("n") == 1).alias("single"), "different", "x.*")
    need = need.groupBy(*KEYS).agg(F.collect_list(F.struct("ah", "single", "different", "a", "first", "final")).alias("wanted"))
    once = texts.dropDuplicates(KEYS)
    moved = once.join(need, KEYS).select(*KEYS, F.col("text").cast("binary").alias("text"), "wanted").mapInArrow(_stretches, STRETCH)
    moved = cut(moved, "bytes")
    spans = "k1 long, k2 long, s int, e int"
    few = moved.where(F.col("different") <= BUCKET).repartition("ah").sortWithinPartitions("ah").mapInArrow(_sorted, spans)
    width = F.greatest(F.lit(1), F.least(F.lit(SPAN), F.floor(F.lit(SPAN * BLOCK) / F.col("different")))).cast("int")
    large = moved.where(F.col("different") > BUCKET).withColumn("width", width)
    fits = F.col("different") <= SPAN * BLOCK
    some = large.where(fits).mapInArrow(_windows, WINDOWS).repartition("ah", "block").sortWithinPartitions("ah", "block").mapInArrow(_counted, spans)
    # larger still: a window a row, counted by partial aggregates
    each = large.where(~fits).mapInArrow(_windows, WINDOWS).select("ah", "single", *KEYS, "start", "place", F.posexplode("windows").alias("at", "w"))
    each = cut(each.select("ah", "single", *KEYS, (F.col("start") + F.col("at")).alias("s"), (F.col("place") - F.col("at")).alias("place"), "w"), "windows")
    twice = each.groupBy("ah", "place", "w").agg(F.count("*").alias("n")).where("n > 1").select("ah", "place", "w")
    most = each.where("single").join(twice, ["ah", "place", "w"], "left_semi").select(*KEYS, "s", (F.col("s") + SPAN).alias("e"))
    return whole.unionByName(inside).unionByName(few).unionByName(some).unionByName(most)


def remove_repeats(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of documents.

    A null text is an empty one. A text shorter than SPAN bytes loses nothing;
    one of SPAN bytes or more that another row repeats loses all. Texts of any
    length are searched whole. Rows that repeat a doc_id, or have none, are
    documents of their own. Other columns, whatever their names, are not read.
    An empty table gives no row.
    """
    scratch = Scratch(spark, "suffix")
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = documents.select("doc_id", *text_keys(), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("sha"))
    spans = repeated_spans(scratch, documents)
    copies = rows.where(F.col("n_bytes") >= SPAN).groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1").select(*KEYS)
    copies = scratch.cut(copies, "copies")
    spans = spans.join(copies, KEYS, "left_anti").groupBy(*KEYS).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    texts = documents.select(*text_keys(), F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= SPAN).join(copies, KEYS, "left_anti")
    part = texts.join(spans, KEYS).select(*KEYS, "text", "spans").mapInArrow(_kept, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")
    out = rows.join(part, KEYS, "left").join(copies.withColumn("copied", F.lit(True)), KEYS, "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


#: The same rows by counting all windows, two hexadecimal digits a byte; windows that touch are one run.
ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), p AS (
  SELECT doc_id, unnest(range(0, n - 199)) AS s, h FROM d WHERE n >= 200
), w AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS m FROM p
), r AS (
  SELECT doc_id, s FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)
), f AS (
  SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200, TRUE) AS new FROM r
), i AS (
  SELECT doc_id, s, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM f
), run AS (
  SELECT doc_id, k, min(s) AS a, max(s) + 200 AS b FROM i GROUP BY doc_id, k
), gap AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM run
  UNION ALL SELECT doc_id, max(b), NULL FROM run GROUP BY doc_id
), kept AS (
  SELECT gap.doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (coalesce(b, n) - a) AS BIGINT)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY gap.doc_id
), t AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM run GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(t.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(t.k, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
