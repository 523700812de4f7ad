"""Cost-balanced packing of whole documents into training sequences.

Documents are tokenised, an end id is appended, and groups of documents (by a hash of the
row and of the partition that it is read from, so that no source or key gathers in one task and
equal rows of one partition at most share a group) are packed on their own.  A task that is run
again deals its rows to the same groups.  Within a group the
capacities add up to the group's tokens exactly: full sequences of ``length`` and, for what is
left, one sequence per set bit, since a power of two needs no padding.  Documents are taken in
descending order of length; each goes to the sequence of lowest estimated cost (linear in tokens
plus quadratic in each piece, which is what attention within a piece costs) that has room for
it.  Where none has room, the lowest-cost open sequence is filled and the rest of the document is
placed again.

Defined cases: null and empty texts are one end id; equal rows are packed one by one; an empty
table gives an empty result; documents longer than a sequence become several pieces; a null
``doc_id`` is kept as null; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.llm.bpe import default_vocabulary, load
from designlab.llm.textarrays import slices, small_batches

LENGTH = 2048
END_ID = 1
#: text bytes per packing group: a group's ids (about one id per four bytes) fit a task many times over
GROUP_BYTES = 4 << 20
#: cost of n tokens in one piece: n * LINEAR + n * n * QUADRATIC
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def token_ids(docs: DataFrame, groups: int, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(bin, doc_id, ids): ids as little-endian unsigned 32-bit integers, the end id last."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = load(path)
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, counts = coder.encode_batch(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, np.uint32(end_id)).astype("<u4")
                offsets = np.concatenate([[0], np.cumsum((counts + 1) * 4)]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(counts),
                                               [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("bin"), part.column("doc_id"), packed],
                                                 names=["bin", "doc_id", "ids"])

    key = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.spark_partition_id()), F.lit(groups)).cast("int")
    return (small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("bin", key)
            .mapInArrow(run, "bin int, doc_id long, ids binary"))


def capacities(total: int, length: int = LENGTH) -> list[int]:
    """Sequence lengths that add up to ``total``: full ones, then one per set bit of the rest."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(length.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(sizes: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (row, start, size, sequence, offset) of documents of the given token counts."""
    room = capacities(int(sizes.sum()), length)
    used = [0] * len(room)
    costs = [0.0] * len(room)
    # pieces come in descending size: a sequence is in ``fitting`` (a heap by cost) once it has room for the
    # current piece, until then in ``small`` by its room; ``cheap`` has the small ones by cost, for cuts
    fitting: list[tuple[float, int]] = []
    small: dict[int, list[int]] = {}
    cheap: list[tuple[float, int]] = []
    is_small = [False] * len(room)
    reach = length + 1
    out = []

    def open_again(s: int) -> None:
        left = room[s] - used[s]
        is_small[s] = left < reach
        if left >= reach:
            heapq.heappush(fitting, (costs[s], s))
        elif left:
            small.setdefault(left, []).append(s)
            heapq.heappush(cheap, (costs[s], s))

    def place(row: int, start: int, size: int, s: int) -> None:
        out.append((row, start, size, s, used[s]))
        used[s] += size
        costs[s] += LINEAR * size + QUADRATIC * size * size
        open_again(s)

    for s in range(len(room)):
        open_again(s)
    # pieces by descending size, ties by row; a cut piece's rest is smaller and comes back in turn
    todo = [(-min(int(n), length), r, 0) for r, n in enumerate(sizes) if n]
    for r, n in enumerate(sizes):
        if n > length:
            todo += [(-min(length, int(n) - s), r, s) for s in range(length, int(n), length)]
    heapq.heapify(todo)
    while todo:
        size, row, start = heapq.heappop(todo)
        size = -size
        for left in range(reach - 1, size - 1, -1):
            for s in small.pop(left, ()):
                if is_small[s] and room[s] - used[s] == left:
                    is_small[s] = False
                    heapq.heappush(fitting, (costs[s], s))
        reach = size
        if fitting:
            place(row, start, size, heapq.heappop(fitting)[1])
        else:
            # none has room: fill the cheapest and put the rest back
            cost, s = heapq.heappop(cheap)
            while not is_small[s] or cost != costs[s]:
                cost, s = heapq.heappop(cheap)
            fits = room[s] - used[s]
            place(row, start, fits, s)
            heapq.heappush(todo, (fits - size, row, start + fits))
    return out


PIECES = ("doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


def pack_group(table: pa.Table, length: int = LENGTH) -> pa.Table:
    """Pieces of one group's documents."""
    # the same order on every attempt: by id, then ids
    rows = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
    ids = [memoryview(x) for x in rows.column("ids").to_pylist()]
    names = rows.column("doc_id").to_pylist()
    group = rows.column("bin")[0].as_py() if rows.num_rows else 0
    sizes = np.array([len(x) // 4 for x in ids], np.int64)
    out = {k: [] for k in ("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    for row, start, size, s, at in assign(sizes, length):
        piece = ids[row][4 * start:4 * (start + size)]
        for k, v in zip(out, (names[row], start, size, bytes(piece), zlib.crc32(piece), int(sizes[row]),
                              (group << 32) + s, at), strict=True):
            out[k].append(v)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH,
         group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per piece with its ids; sequences are filled without gaps."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))

    def run(table: pa.Table) -> pa.Table:
        return pack_group(table, length)

    return token_ids(docs, groups, vocabulary).groupBy("bin").applyInArrow(run, PIECES)


def op10_report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack(docs, vocabulary).drop("ids")
