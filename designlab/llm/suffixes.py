"""Suffix-sorted removal of byte strings that occur twice.

A byte is removed if a string of ``LENGTH`` bytes covers it that also starts anywhere else.  Suffixes must
meet their likes without shuffling one row per byte.  Every window of LENGTH bytes names an anchor, the
leftmost of its ``GRAM``-byte strings with the smallest hash; equal windows name equal anchors at equal
offsets.  Neighbouring windows with one anchor form a segment (about 85 windows).  Segments are
counted by anchor and content: an anchor found once is done, equal segments are repeats as a whole, and
only one copy of each different segment of a shared anchor is sorted.

Sorting compares suffixes by prefix polynomial hashes: binary search finds the common extension of two
suffixes, the next byte decides, and a mergesort (``sorted``) orders the suffixes at the anchors.  The suffixes
one byte further left follow by their first byte and the order already known.  Equal windows are
neighbours then; hash-equal neighbours are verified byte by byte.  Segments of an anchor with more
than ``BLOCK`` different ones are dealt over several blocks, and the windows of these blocks meet again
by 128-bit hash, so no anchor fills a task.

Defined cases: null and empty texts have no bytes; texts under LENGTH bytes stay; kept bytes may end inside
a character, so a digest is taken over bytes and ``remove`` returns binary; repeated rows remove each
other's text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.llm.stored import drop, stored
from designlab.llm.textarrays import (SLICE, hash_base, mix, per_doc, prefix_hash, slices, small_batches, span_hash,
                                       text_bytes)

LENGTH = 200
GRAM = 32
#: GRAM-byte strings of a window
SPREAD = LENGTH - GRAM + 1
#: different segments of one anchor per block
BLOCK = 4000
#: segment bytes per sorting group
GROUP_BYTES = 1 << 20
MASK = (1 << 64) - 1
LAST = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                       F.xxhash64("text").alias("h"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position of every window of ``data``, anchor hash)."""
    prefix = prefix_hash(data, 41)
    at = np.arange(len(data) - GRAM + 1)
    gram = mix(span_hash(prefix, at, at + GRAM, 41))
    # the position in the low bits makes the leftmost of equal hashes the smallest
    best = (gram >> np.uint64(22) << np.uint64(22)) | at.astype(np.uint64)
    width = 1
    while 2 * width <= SPREAD:
        best = np.minimum(best[:len(best) - width], best[width:])
        width *= 2
    best = np.minimum(best[:len(best) - (SPREAD - width)], best[SPREAD - width:])
    pos = (best & np.uint64((1 << 22) - 1)).astype(np.int64)
    return pos, gram[pos]


def _segments(data: np.ndarray, offsets: np.ndarray):
    """Arrays (doc, start, n, anchor, key, d1, d2) of the segments of a batch, chunk by chunk."""
    at = 0
    while at < len(data):
        chunk = data[at:at + SLICE + LENGTH - 1]
        if len(chunk) >= LENGTH:
            pos, key = anchors(chunk)
            start = np.arange(len(pos))
            doc = np.searchsorted(offsets, start + at, side="right") - 1
            ok = start + at + LENGTH <= offsets[doc + 1]
            start, pos, key, doc = start[ok], pos[ok], key[ok], doc[ok]
            new = np.ones(len(start), bool)
            new[1:] = (pos[1:] != pos[:-1]) | (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(start)))
            begin, doc = start[first], doc[first]
            end = begin + n - 1 + LENGTH
            a = pos[first] - begin
            shape = (n * 1024 + a).astype(np.uint64)
            digest = [mix(span_hash(prefix_hash(chunk, seed), begin, end, seed) + shape) for seed in (42, 43)]
            yield doc, begin + at - offsets[doc], n, a, key[first], *digest
        at += SLICE


def occurrences(keyed: DataFrame) -> DataFrame:
    """(id, h, start, n, a, key, d1, d2): every segment, with the anchor ``a`` bytes after its start."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                for doc, start, n, a, *hashes in _segments(*text_bytes(part.column("text"))):
                    rows = pa.array(doc)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(rows), part.column("h").take(rows), pa.array(start),
                         pa.array(n.astype(np.int32)), pa.array(a.astype(np.int32)),
                         *(pa.array(x.view(np.int64)) for x in hashes)],
                        names=["id", "h", "start", "n", "a", "key", "d1", "d2"])

    return (keyed.select("id", "h", "text")
            .mapInArrow(run, "id long, h long, start long, n int, a int, key long, d1 long, d2 long"))


def segment_bytes(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` segments (id, h, start, n, a, key, d1, d2, blocks) with their bytes."""
    per = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("start", "n", "a", "key", "d1", "d2", "blocks")).alias("s"))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                for i, found in enumerate(part.column("s").to_pylist()):
                    for r in found:
                        at = offsets[i] + r["start"]
                        r["seg"] = data[at:at + r.pop("n") - 1 + LENGTH].tobytes()
                        r.pop("start")
                    yield pa.RecordBatch.from_pylist(found, SEGMENT)

    return (keyed.select("id", "h", "text").join(per, ["id", "h"]).select("text", "s")
            .mapInArrow(run, "a int, key long, d1 long, d2 long, blocks int, seg binary"))


SEGMENT = pa.schema([("a", pa.int32()), ("key", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                     ("blocks", pa.int32()), ("seg", pa.binary())])


class Suffixes:
    """Suffixes of concatenated segments, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.ends = data, ends.tolist()
        self.prefix = prefix_hash(data, 44)
        self.hash = self.prefix.tolist()
        self.base = hash_base(44)
        self.raw = data.tobytes()
        #: powers of the base, known as long as the group lives
        self.shifts: dict[int, int] = {}

    def shift(self, n: int) -> int:
        if n not in self.shifts:
            self.shifts[n] = pow(self.base, n, 1 << 64)
        return self.shifts[n]

    def extension(self, x: int, y: int, most: int) -> int:
        """Length of the common prefix of the suffixes at x and y, at most ``most`` bytes."""
        if x > y:
            x, y = y, x
        p, scale = self.hash, self.shift(y - x)
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if ((p[x + mid] - p[x]) * scale - p[y + mid] + p[y]) & MASK == 0:
                low = mid
            else:
                high = mid - 1
        return low

    def compare(self, i: int, x: int, j: int, y: int) -> int:
        """Order of the suffix of segment i at x and that of segment j at y (a shorter one first)."""
        a, b = self.ends[i] - x, self.ends[j] - y
        n = self.extension(x, y, min(a, b))
        if n == min(a, b):
            return a - b
        return self.raw[x + n] - self.raw[y + n]


def equal_windows(keys: np.ndarray, anchor: np.ndarray, data: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Per segment, the offsets of its windows that another segment of the same key holds too.

    ``anchor`` is each segment's anchor, ``first`` the segments' bounds in ``data``.
    """
    m = len(keys)
    begin, end = first[:-1], first[1:]
    suffixes = Suffixes(data, end)
    where = (begin + anchor).tolist()
    by = functools.cmp_to_key(lambda i, j: suffixes.compare(i, where[i], j, where[j]))
    order = np.argsort(keys, kind="stable")
    bounds = np.flatnonzero(np.diff(keys[order])) + 1
    rank = np.empty(m, np.int64)
    at = 0
    for run in np.split(order, bounds):
        rank[sorted(run.tolist(), key=by)] = np.arange(at, at + len(run))
        at += len(run)
    marks_row, marks_at = [], []
    alive = np.arange(m)
    for o in range(SPREAD):
        alive = alive[anchor[alive] >= o]
        if not len(alive):
            break
        at = begin[alive] + anchor[alive] - o
        if o:
            # one byte further left: by that byte, then by the order of what follows it
            order = np.lexsort((rank[alive], data[at], keys[alive]))
            rank[alive[order]] = np.arange(len(alive))
        else:
            order = np.argsort(rank[alive])
        rows, at = alive[order], at[order]
        valid = at + LENGTH <= end[rows]
        rows, at = rows[valid], at[valid]
        if len(rows) < 2:
            continue
        full = span_hash(suffixes.prefix, at, at + LENGTH, 44)
        near = np.flatnonzero((full[1:] == full[:-1]) & (keys[rows][1:] == keys[rows][:-1]))
        # collision verification
        same = [k for k in near.tolist()
                if suffixes.raw[at[k]:at[k] + LENGTH] == suffixes.raw[at[k + 1]:at[k + 1] + LENGTH]]
        hit = np.unique(np.array([*same, *(k + 1 for k in same)], np.int64))
        marks_row.append(rows[hit])
        marks_at.append(anchor[rows[hit]] - o)
    out_row = np.concatenate(marks_row) if marks_row else np.zeros(0, np.int64)
    out_at = np.concatenate(marks_at) if marks_at else np.zeros(0, np.int64)
    order = np.argsort(out_row, kind="stable")
    return np.split(out_at[order], np.searchsorted(out_row[order], np.arange(1, m)))


def _sorted_group(table: pa.Table) -> pa.Table:
    data, first = text_bytes(table.column("seg"))
    found = equal_windows(table.column("key").to_numpy(), table.column("a").to_numpy().astype(np.int64), data, first)
    hit = np.flatnonzero([len(x) > 0 for x in found])
    rows = pa.array(hit)
    return pa.table([table.column(k).take(rows).combine_chunks() for k in ("key", "d1", "d2")]
                    + [pa.array([found[i] for i in hit], pa.list_(pa.int32()))], names=["key", "d1", "d2", "at"])


def _window_hashes(batches):
    """(key, d1, d2, pos, w1, w2) of every window of segments whose anchor has several blocks."""
    for batch in batches:
        data, first = text_bytes(batch.column("seg"))
        for i in range(batch.num_rows):
            seg = data[first[i]:first[i + 1]]
            at = np.arange(len(seg) - LENGTH + 1)
            w = [mix(span_hash(prefix_hash(seg, s), at, at + LENGTH, s)).view(np.int64) for s in (45, 46)]
            row = pa.array(np.full(len(at), i))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(row) for k in ("key", "d1", "d2")),
                                              pa.array(at.astype(np.int32)), pa.array(w[0]), pa.array(w[1])],
                                             names=["key", "d1", "d2", "pos", "w1", "w2"])


def repeated(keyed: DataFrame) -> DataFrame:
    """(id, h, runs): per document the window starts that occur elsewhere, as (start, n, at) segments.

    ``at`` lists offsets within the segment; null means all ``n`` windows.
    """
    every = stored(occurrences(keyed))
    # most anchors are found once: their segments go before anything else is made of them
    shared = every.groupBy("key").agg(F.count("*").alias("total")).where("total > 1").select("key")
    occ = stored(every.join(shared, "key"))
    drop(every)
    kinds = stored(occ.groupBy("key", "d1", "d2").agg(
        F.count("*").alias("c"), F.min(F.struct("id", "h", "start", "n", "a")).alias("rep")))
    keys = (kinds.groupBy("key").agg(F.count("*").alias("segments")).where("segments > 1")
            .select("key", F.ceil(F.col("segments") / BLOCK).cast("int").alias("blocks")))
    wanted = kinds.join(keys, "key").select("rep.*", "key", "d1", "d2", "blocks")
    segs = stored(segment_bytes(keyed, wanted))
    size = segs.agg(F.sum(F.octet_length("seg"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    salt = F.pmod(F.xxhash64("d1", "d2"), F.col("blocks"))
    # a key's segments share a group unless it has several blocks
    dealt = segs.withColumn("bin", F.pmod(F.xxhash64("key", salt), F.lit(groups)).cast("int"))
    marks = (dealt.groupBy("bin").applyInArrow(_sorted_group, "key long, d1 long, d2 long, at array<int>"))
    wide = segs.where("blocks > 1").mapInArrow(_window_hashes, "key long, d1 long, d2 long, pos int, w1 long, w2 long")
    twice = wide.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2")
    across = (wide.join(twice, ["w1", "w2"]).groupBy("key", "d1", "d2").agg(F.collect_set("pos").alias("at")))
    partly = marks.union(across).groupBy("key", "d1", "d2").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    seen = stored(kinds.where("c > 1").select("key", "d1", "d2", F.lit(None).cast("array<int>").alias("at"))
            .union(partly.join(kinds.where("c = 1").select("key", "d1", "d2"), ["key", "d1", "d2"])))
    drop(segs, kinds)
    return (occ.join(seen, ["key", "d1", "d2"]).groupBy("id", "h")
            .agg(F.collect_set(F.struct("start", "n", "at")).alias("runs")))


def _removed(part, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mask of the removed bytes of a batch with a ``runs`` column."""
    step = np.zeros(len(data) + 1, np.int32)
    for i, runs in enumerate(part.column("runs").to_pylist()):
        for r in runs or ():
            at = offsets[i] + r["start"]
            if r["at"] is None:
                step[at] += 1
                step[at + r["n"] - 1 + LENGTH] -= 1
            else:
                where = at + np.array(r["at"], np.int64)
                np.add.at(step, where, 1)
                np.subtract.at(step, where + LENGTH, 1)
    return np.cumsum(step[:-1]) > 0


def _marked(docs: DataFrame) -> DataFrame:
    keyed = _keyed(small_batches(docs))
    return keyed.join(repeated(keyed), ["id", "h"], "left").select("doc_id", "text", "runs")


def remove(docs: DataFrame) -> DataFrame:
    """(doc_id, kept): the remaining bytes of every document."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                keep = ~_removed(part, data, offsets)
                kept = [data[x:y][keep[x:y]].tobytes() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary())],
                                                 names=["doc_id", "kept"])

    return _marked(docs).mapInArrow(run, "doc_id long, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                gone = _removed(part, data, offsets)
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = offsets[:-1][np.diff(offsets) > 0]
                begins[inner] = gone[inner]
                digests = [hashlib.sha256(data[x:y][~gone[x:y]].tobytes()).hexdigest()
                           for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(per_doc(gone, offsets)),
                     pa.array(per_doc(begins, offsets)), pa.array(digests)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _marked(docs).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
