"""Exact top-k inner products over an impact-ordered index, score at a time.

The index holds blocks of integer vectors.  In a block each dimension is a posting list of all its rows
in ascending order of value, cut into at most 256 segments of equal quantised value.  What a row adds to a
query's score in a dimension, counted from the least that any row of the block adds there, is the posting's
impact: it is not negative, and it is largest at the list's end where the query's component is positive, at
its beginning where it is negative.

A query takes the segments of all dimensions in descending order of impact (down to a falling threshold, so
that numpy handles many at once) and adds them to one accumulator per row.  A row's score is then at most
its accumulator, plus what quantising can hide, plus the threshold (or the dimension's largest impact, if
that is less) for every list in which the row has not come up.  Rows under a floor (the k-th best exact
score so far) are proven out.  The query leaves the block only on that proof: when the rest of the possible
members is scored exactly, which happens as soon as it costs less than the next segments.  So every result
is exact.  The first block gives each query its floor for all the others.

Defined cases: rows with a null vector, or a null or non-finite component, take no part; a null ``vec_id``
is no query, and comes last among equal scores; rows that share the query's ``vec_id`` are its own and not
returned; repeated rows count one by one, and a repeated query has its rows once per copy; vectors of
unequal length are compared as if the shorter one ended in zeros; scores beyond 2^56 are held there (blocks
with components that large are scored without the index); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from designlab.llm import vectorblocks as vb
from designlab.llm.stored import stored

TOP = 10
LEVELS = 256
#: thresholds of the rounds, as shares of the largest impact
ROUNDS = (0.375, 0.3125, 0.25, 0.1875, 0.125, 0.0625, 0.0)

INDEX = vb.BLOCK + ", low binary, step binary, postings binary, ends binary"


def index_block(v: np.ndarray) -> dict:
    """Postings of a block: per dimension the rows in ascending order of level, and where each level ends."""
    v = v.astype(np.int64)
    low = v.min(0)
    step = (v.max(0) - low) // LEVELS + 1
    level = ((v - low) // step).astype(np.int16)
    postings = np.argsort(level, axis=0, kind="stable").T.astype("<u2" if len(v) <= 1 << 16 else "<u4")
    ends = np.stack([np.cumsum(np.bincount(level[:, d], minlength=LEVELS)) for d in range(v.shape[1])]).astype("<u4") \
        if v.shape[1] else np.zeros((0, LEVELS), "<u4")
    return {"low": low.astype("<i8").tobytes(), "step": step.astype("<i8").tobytes(), "postings": postings.tobytes(),
            "ends": ends.tobytes()}


def build(rows: DataFrame, block_rows: int = vb.BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The index of ``vectorblocks.integer_rows``, and its number of blocks; written once."""
    dealt, count = vb.deal(rows, block_rows)

    def run(table: pa.Table) -> pa.Table:
        fields = vb.pack(table)
        v = vb.matrix(fields)
        narrow = v.itemsize < 8  # wider components would overflow the level arithmetic
        fields |= index_block(v) if narrow else dict.fromkeys(("low", "step", "postings", "ends"))
        return pa.Table.from_pylist([fields], schema=vb.as_arrow(INDEX))

    return stored(dealt.groupBy("block").applyInArrow(run, INDEX)), count


class Segments:
    """One block of the index, ready for queries."""

    def __init__(self, fields: dict):
        self.ids, self.v = vb.longs(fields["vec_id"]), vb.matrix(fields)
        self.n, self.dim = self.v.shape
        self.indexed = fields["postings"] is not None and self.dim > 0
        if self.indexed:
            self.low, self.step = vb.longs(fields["low"]), vb.longs(fields["step"])
            width = len(fields["postings"]) // (self.n * self.dim)
            self.postings = np.frombuffer(fields["postings"], f"<u{width}").reshape(self.dim, self.n).astype(np.intp)
            # starts[d, l]: postings of dimension d under level l
            self.starts = np.zeros((self.dim, LEVELS + 1), np.int64)
            self.starts[:, 1:] = np.frombuffer(fields["ends"], "<u4").reshape(self.dim, LEVELS)
            self.top = (self.starts < self.n).sum(1) - 1
            self.level = np.repeat(np.tile(np.arange(LEVELS), self.dim),
                                   np.diff(self.starts, axis=1).ravel()).reshape(self.dim, self.n).astype(np.float64)

    def exact(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        return vb.inner(query[None], self.v[at])[0]

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> np.ndarray:
        """Rows of the block that may be among the first k, given ``floor`` (the k-th score known so far)."""
        others = np.flatnonzero(self.ids != own)
        wide = min(len(query), self.dim)
        reach = vb.reach(query) if len(query) else 0
        weight = np.abs(query[:wide].astype(np.int64))
        if not self.indexed or len(others) <= k or reach * vb.reach(self.v) * wide >= 1 << 50:
            return others
        up = query[:wide] > 0
        low, step, top, starts = self.low[:wide], self.step[:wide], self.top[:wide], self.starts[:wide]
        gain = weight * step  # impact of one level
        largest = (gain * top).astype(np.float64)
        base = int(np.where(up, query[:wide] * low, query[:wide] * (low + (top + 1) * step - 1)).sum())
        hidden = int((weight * (step - 1)).sum())
        acc, seen = np.zeros(self.n), np.zeros(self.n)
        done = np.zeros(wide, np.int64)
        dims, high = np.arange(wide), int(largest.max())
        if high == 0:
            return others
        for r, share in enumerate(ROUNDS):
            threshold = int(high * share)  # whole numbers: the bound below is exact
            done = self._advance(acc, seen, done, self._reached(threshold, gain, up, starts, top, dims), gain, up, top, dims)
            capped = largest > threshold
            most = acc - threshold * seen + (base + hidden + largest[~capped].sum() + threshold * capped.sum())
            if floor is None:
                # any k rows give a floor; the best accumulators give a good one
                likely = others[np.argpartition(-most[others], k)[:k]]
                floor = int(self.exact(query, likely).min())
            possible = others[most[others] >= floor]
            if share == 0.0:
                return possible
            following = self._reached(int(high * ROUNDS[r + 1]), gain, up, starts, top, dims).sum() - done.sum()
            if len(possible) * wide <= following:
                return possible
        return possible

    def _reached(self, threshold: int, gain, up, starts, top, dims) -> np.ndarray:
        """Postings per dimension in the segments of at least this impact."""
        # levels from the list's strong end: impact = gain * level (up) or gain * (top - level) (down)
        first = np.where(gain > 0, -(-threshold // np.maximum(gain, 1)), LEVELS)
        first = np.minimum(first, top + 1)
        return np.where(up, self.n - starts[dims, first], starts[dims, np.maximum(top + 1 - first, 0)])

    def _advance(self, acc, seen, done, reached, gain, up, top, dims) -> np.ndarray:
        """Add the postings between ``done`` and ``reached`` to the accumulators."""
        rows, impacts = [], []
        for d in dims[reached > done].tolist():
            if up[d]:
                part = slice(self.n - reached[d], self.n - done[d])
                impacts.append(self.level[d, part] * gain[d])
            else:
                part = slice(done[d], reached[d])
                impacts.append((top[d] - self.level[d, part]) * gain[d])
            rows.append(self.postings[d, part])
        if rows:
            rows = np.concatenate(rows)
            acc += np.bincount(rows, np.concatenate(impacts), self.n)
            seen += np.bincount(rows, minlength=self.n)
        return reached


ASKING = vb.BLOCK + ", floor binary"
FOUND = "row long, vec_id long, score long"
NO_FLOOR = -(1 << 62)


def search(queries: DataFrame, n_queries: int, index: DataFrame, n_index: int, k: int = TOP) -> DataFrame:
    """(row, vec_id, score): of each query row the rows that may be among its first k, k at most per task."""

    def run(batches):
        best, block, floors = vb.Best(k), None, {}

        def emit():
            keys, counts, scores, ids = best.flush()
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(keys, np.int64), counts)), vb.id_array(ids),
                                               pa.array(scores)], names=["row", "vec_id", "score"])

        for query, part in vb.cell_rows(batches):
            if query["block"] != block:
                if best.held:
                    yield emit()
                block, floors = query["block"], vb.longs(query["floor"])
            segments = Segments(part)
            rows, ids, v = vb.longs(query["row"]).tolist(), vb.longs(query["vec_id"]), vb.matrix(query).astype(np.int64)
            for i, row in enumerate(rows):
                known = [x for x in (best.floor(row), int(floors[i])) if x is not None and x > NO_FLOOR]
                floor = max(known) if known else None
                at = segments.search(v[i], ids[i], k, floor)
                scores = segments.exact(v[i], at)
                if floor is not None:
                    at, scores = at[scores >= floor], scores[scores >= floor]
                best.add(row, scores, segments.ids[at])
        yield emit()

    return vb.cells(queries, n_queries, index, n_index).mapInArrow(run, FOUND)


def with_floors(asking: DataFrame, floors: DataFrame) -> DataFrame:
    """Query rows packed in blocks, with the floor known for each."""

    def run(table: pa.Table) -> pa.Table:
        fields = vb.pack(table)
        by_row = dict(zip(table.column("row").to_pylist(), table.column("floor").to_pylist(), strict=True))
        fields["floor"] = np.array([by_row[r] for r in vb.longs(fields["row"]).tolist()], "<i8").tobytes()
        return pa.Table.from_pylist([fields], schema=vb.as_arrow(ASKING))

    return (asking.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR)))
            .groupBy("block").applyInArrow(run, ASKING))


def top_k(rows: DataFrame, query: Column, scale: int = 1024, k: int = TOP,
          block_rows: int = vb.BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each row where ``query`` holds.

    ``rows`` has vec_id and embedding; ``query`` is a condition on vec_id.
    """
    whole = vb.integer_rows(rows, scale)
    index, n_index = build(whole, block_rows)
    queries = whole.where(query)
    asking, n_asking = vb.deal(queries, vb.QUERY_ROWS)
    none = queries.select("row", F.lit(NO_FLOOR).alias("floor")).limit(0)
    first = index.where("block = 0")
    found = stored(search(with_floors(asking, none), n_asking, first, 1, k))
    if n_index > 1:
        floors = found.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
        rest = index.where("block > 0").withColumn("block", F.col("block") - 1)
        found = found.union(search(stored(with_floors(asking, floors.select("row", "floor"))), n_asking, rest, n_index - 1, k))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .join(queries.select("row", F.col("vec_id").alias("query_id")), "row")
            .select("query_id", "rank", "vec_id", "score"))


def op13_report(rows: DataFrame) -> DataFrame:
    """The 10 highest scores of every hundredth row."""
    return top_k(rows.select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.e, r.e) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
