"""Integer vectors packed in blocks, and the cells (query block, row block) of a query set against all rows.

Vectors are quantised to integers, written once, and dealt by a hash of their row number into blocks of
about ``BLOCK_ROWS`` rows, so that equal vectors, one label or one id never gather in a block.  A block is
one row with its ids and its matrix as bytes.  ``cells`` pairs every query block with every row block by an
equi-join on the cell, so a task holds a few blocks of each side whatever the number of rows and queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from designlab.llm.stored import stored

#: rows of a row block, queries of a query block, cells of a task (about)
BLOCK_ROWS = 4096
QUERY_ROWS = 8192
TASK_CELLS = 4
#: a null id inside a block; it sorts after all others
NULL_ID = np.int64(2**63 - 1)
#: scores beyond this are held there, so that a hundred times a score is still a long
SCORE_LIMIT = 1 << 56


def integer_rows(rows: DataFrame, scale: int, label: Column | None = None, vector: str = "embedding",
                 key: str = "vec_id") -> DataFrame:
    """(row, vec_id, label, v) written once: v is floor(scale * x) per component, ``row`` a number of its own.

    Rows with a null vector, or a null or non-finite component, or (where ``label`` is given) a null
    label take no part.  Components beyond 64 bits are held at the limit.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    usable = x.isNotNull() & finite
    if label is not None:
        usable &= label.isNotNull()
    # only what is used is read, so that other columns cannot clash with the helper columns
    part = rows.where(usable).select(
        F.col(key).cast("long").alias("vec_id"), (F.lit(0) if label is None else label).cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * float(scale)).cast("long")).alias("v"))
    return stored(part.withColumn("row", F.monotonically_increasing_id()))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one integer matrix; short vectors end in zeros."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(sizes.max(initial=0))
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    return matrix.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


BLOCK = "block int, n int, dim int, width int, row binary, vec_id binary, label binary, v binary"


def pack(table: pa.Table) -> dict:
    """Fields of one block, its rows in ascending order of id (nulls last)."""
    ids = table.column("vec_id").combine_chunks().fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype("<i8")
    row = table.column("row").to_numpy().astype("<i8")
    order = np.lexsort((row, ids))
    v = narrow(_matrix(table.column("v"))[order])
    return {"block": table.column("block")[0].as_py(), "n": len(ids), "dim": v.shape[1], "width": v.itemsize,
            "row": row[order].tobytes(), "vec_id": ids[order].tobytes(),
            "label": table.column("label").to_numpy().astype("<i8")[order].tobytes(), "v": v.tobytes()}


def longs(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<i8")


def matrix(fields: dict) -> np.ndarray:
    """The block's vectors, one per row."""
    return np.frombuffer(fields["v"], f"<i{fields['width']}").reshape(fields["n"], fields["dim"])


def deal(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """``rows`` with a ``block`` of about ``block_rows`` rows each, and the number of blocks."""
    count = max(1, -(-rows.count() // block_rows))
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")), count


def blocks(rows: DataFrame, block_rows: int | None = None) -> tuple[DataFrame, int]:
    """Packed blocks of ``integer_rows``, and their number (some may be missing where rows are few)."""
    dealt, count = deal(rows, block_rows or BLOCK_ROWS)

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([pack(table)], schema=as_arrow(BLOCK))

    return dealt.groupBy("block").applyInArrow(run, BLOCK), count


KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def as_arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def cells(queries: DataFrame, n_queries: int, rows: DataFrame, n_rows: int) -> DataFrame:
    """One row per (query block, row block): columns of ``queries`` with ``q_`` before them, of ``rows`` with ``r_``.

    Each side is repeated once per block of the other and met on the cell, which is the sort key as well,
    so that a task mostly sees the cells of one query block in a row.
    """
    left = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns),
                          F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("r_block"))
    right = rows.select(*(F.col(c).alias(f"r_{c}") for c in rows.columns),
                        F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q_block"))
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = n_queries * n_rows
    tasks = min(total, max(parts, -(-total // TASK_CELLS)))
    return (left.repartition(tasks, "q_block", "r_block")
            .join(right.repartition(tasks, "q_block", "r_block"), ["q_block", "r_block"]))


def cell_rows(batches) -> Iterator[tuple[dict, dict]]:
    """(query block's fields, row block's fields) of every joined row."""
    for batch in batches:
        for i in range(batch.num_rows):
            fields = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            yield ({k[2:]: v for k, v in fields.items() if k.startswith("q_")},
                   {k[2:]: v for k, v in fields.items() if k.startswith("r_")})


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with the rows of ``b``, held within SCORE_LIMIT."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    bound = reach(a) * reach(b) * wide
    if bound < 1 << 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < SCORE_LIMIT:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -SCORE_LIMIT, SCORE_LIMIT).astype(np.int64)


def reach(x: np.ndarray) -> int:
    """Largest absolute value."""
    return max(int(x.max()), -int(x.min()))


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first by descending score, ties by ascending id; all of them, if fewer."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Best:
    """The k first (score, id) of each key seen so far, over the blocks of one task."""

    def __init__(self, k: int):
        self.k = k
        self.held: dict = {}

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        at = first(scores, ids, self.k)
        scores, ids = scores[at], ids[at]
        if key in self.held:
            scores, ids = (np.concatenate(x) for x in zip(self.held[key], (scores, ids), strict=True))
            at = first(scores, ids, self.k)
            scores, ids = scores[at], ids[at]
        if len(scores):
            self.held[key] = scores, ids

    def floor(self, key) -> int | None:
        """The k-th score of the key, if it has k."""
        scores = self.held.get(key, ((), ()))[0]
        return int(scores[-1]) if len(scores) >= self.k else None

    def flush(self) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, number of rows of each, scores, ids) of what is held, which is then forgotten."""
        held, self.held = self.held, {}
        none = np.zeros(0, np.int64)
        return (list(held), np.array([len(s) for s, _ in held.values()], np.int64),
                np.concatenate([none, *(s for s, _ in held.values())]), np.concatenate([none, *(i for _, i in held.values())]))


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)
