"""Numpy views of Arrow text columns: bytes, words, word hashes, word windows.

A column of texts becomes one byte array plus document offsets, so that a whole Arrow batch is
handled by a few vector operations.  Words are ``[^\\x20\\x09-\\x0D]+``; null texts count as empty.
Byte-sized temporaries are made for slices of ``SLICE`` bytes, so a very long text needs no more
memory than a few bytes per byte of text.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE = 1 << 18
#: bytes of an Arrow batch sent to Python (Spark's own bound is 64 MB for each batch of each running task)
BATCH_BYTES = 4 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; unless the session has its own bound, batches that Spark sends to Python end at BATCH_BYTES."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_BYTES))
    return df


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def string_array(data: np.ndarray, lengths: np.ndarray, binary: bool = False) -> pa.Array:
    """Arrow string (or binary) column from concatenated bytes and per-row lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    kind = pa.large_binary() if binary else pa.large_string()
    big = pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets.tobytes()),
                                                     pa.py_buffer(np.ascontiguousarray(data).tobytes())])
    return big.cast(pa.binary() if binary else pa.string())


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=4)
def byte_codes(seed: int) -> np.ndarray:
    """One random 64-bit code per byte value."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hash_base(seed: int) -> int:
    """Odd base of the polynomial hash (its inverse modulo 2^64 exists)."""
    return int(np.random.default_rng(seed + 7919).integers(1 << 60, 1 << 62)) * 2 + 1


@functools.lru_cache(maxsize=8)
def _powers(seed: int, inverse: bool, size: int) -> np.ndarray:
    base = hash_base(seed)
    if inverse:
        base = pow(base, -1, 1 << 64)
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(seed: int, size: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(size-1) modulo 2^64."""
    room = SLICE + 4096 if size <= SLICE + 4096 else 1 << size.bit_length()
    return _powers(seed, inverse, room)[:size]


def prefix_hash(data: np.ndarray, seed: int) -> np.ndarray:
    """p with p[0] = 0 and p[i+1] = p[i] + code(data[i]) * base^i (modulo 2^64)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_codes(seed)[data] * powers(seed, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hash of data[start:end], independent of where the span lies."""
    inverse = powers(seed, len(prefix), inverse=True)
    return (prefix[ends] - prefix[starts]) * inverse[starts]


class Words:
    """Words of a batch of texts: byte ``starts`` / ``ends`` and the ``doc`` row of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n_docs = len(offsets) - 1
        space = SPACE[data]
        if len(data):
            lengths = np.diff(offsets)
            filled = lengths > 0
            before = np.empty(len(data), bool)
            before[0], before[1:] = True, space[:-1]
            before[offsets[:-1][filled]] = True
            after = np.empty(len(data), bool)
            after[-1], after[:-1] = True, space[1:]
            after[offsets[1:][filled] - 1] = True
            self.starts = np.flatnonzero(~space & before)
            self.ends = np.flatnonzero(~space & after) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        #: rows of ``starts`` where each document begins (n_docs + 1)
        self.first = np.searchsorted(self.starts, offsets).astype(np.int64)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 1, data: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash per word (of ``data`` instead of the own bytes, if given)."""
        data = self.data if data is None else data
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + SLICE, side="right")))
            s, e = self.starts[at:to] - base, self.ends[at:to] - base
            prefix = prefix_hash(data[base:base + e[-1]], seed)
            out[at:to] = span_hash(prefix, s, e, seed) + (e - s).astype(np.uint64)
            at = to
        return mix(out)

    def windows(self, hashes: np.ndarray, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(word rows where a window of ``size`` words of one document starts, their hashes)."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1:])
        base = np.uint64(hash_base(seed + 31))
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total *= base
            total += hashes[j:j + n]
        return at, mix(total[at])

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Per document, the words flagged in ``keep`` joined by one space."""
        rows = np.flatnonzero(keep)
        doc = self.doc[rows]
        later = np.zeros(len(rows), bool)
        if len(rows):
            later[1:] = doc[1:] == doc[:-1]
        # the byte before a word that is not its document's first kept one becomes the separator
        step = np.zeros(len(self.data) + 1, np.int8)
        begin = self.starts[rows] - later
        step[begin] += 1  # no position occurs twice
        step[self.ends[rows]] -= 1
        mask = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        data = self.data.copy()
        data[begin[later]] = 0x20
        running = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=running[1:])
        return string_array(data[mask], np.diff(running[self.offsets]))


def covered(length: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions covered by any [start, start + size)."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, starts, 1)
    np.subtract.at(step, np.minimum(starts + size, length), 1)
    return np.cumsum(step[:-1]) > 0


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's slice first[i]:first[i+1]."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return np.diff(running[first])


def slices(batch, text: str = "text", most: int = 1 << 20):
    """Cut an Arrow batch into runs of rows of at most ``most`` text bytes (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
