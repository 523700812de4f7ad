"""Hard-negative mining by slots of the score range.

Each anchor has a few positives: its first rows of the same label by score.  The negatives of a positive
are the first rows of another label whose score lies in a window of shares of the positive's score.  The
windows of one anchor overlap, so they are not searched one by one: the distinct upper limits of an
anchor's positives cut the scores into disjoint slots (from one limit down to the next lower one), each
task keeps the first k rows of each slot over its blocks, and the slots are reduced to k rows again over
all tasks.  In descending order the slots of an anchor are one list of at most positives x k rows, and
the answer of a positive is the first k of the suffix that begins with its own slot, cut at its lower limit:
rows beyond the k-th of a slot are never among the first k of a suffix that holds this slot.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; a
null ``vec_id`` is no anchor, and comes last among equal scores; rows that share the anchor's ``vec_id``
are its own and never serve it; repeated rows count one by one, and a repeated anchor has its rows once per
copy; vectors of unequal length are compared as if the shorter one ended in zeros; a positive with a
negative score has an empty window; scores beyond 2^56 are held there; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from designlab.llm import vectorblocks as vb
from designlab.llm.stored import stored

POSITIVES = 5
NEGATIVES = 10
#: a negative's score lies between these hundredths of the positive's
LOW, HIGH = 30, 90
NONE = -(1 << 62)


def _descending(key: str) -> Window:
    return Window.partitionBy(*key.split()).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())


FOUND = "row long, slot int, vec_id long, score long"


def _emit(best: vb.Best) -> pa.RecordBatch:
    keys, counts, scores, ids = best.flush()
    pairs = np.array(keys, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(pairs[:, 0], counts)), pa.array(np.repeat(pairs[:, 1], counts).astype(np.int32)),
         vb.id_array(ids), pa.array(scores)], names=["row", "slot", "vec_id", "score"])


def _combined(cells: DataFrame, k: int, search) -> DataFrame:
    """The first k rows of each (anchor row, slot): in each task over its blocks, then over all tasks."""

    def run(batches):
        best, block = vb.Best(k), None
        for query, rows in vb.cell_rows(batches):
            if query["block"] != block and best.held:
                yield _emit(best)
            block = query["block"]
            search(best, query, rows)
        yield _emit(best)

    found = cells.mapInArrow(run, FOUND).withColumn("place", F.row_number().over(_descending("row slot")))
    return found.where(F.col("place") <= k)


def positives(anchors: DataFrame, n_anchors: int, rows: DataFrame, n_rows: int, k: int = POSITIVES) -> DataFrame:
    """(row, place, vec_id, score): the first k rows of each anchor's label, the anchor's own left out."""

    def search(best, query, block):
        scores = vb.inner(vb.matrix(query), vb.matrix(block))
        ids, labels = vb.longs(block["vec_id"]), vb.longs(block["label"])
        for row, own, label, score in zip(vb.longs(query["row"]).tolist(), vb.longs(query["vec_id"]),
                                          vb.longs(query["label"]), scores, strict=True):
            at = np.flatnonzero((labels == label) & (ids != own))
            best.add((row, 0), score[at], ids[at])

    return _combined(vb.cells(anchors, n_anchors, rows, n_rows), k, search).select("row", "place", "vec_id", "score")


LIMITED = vb.BLOCK + ", least binary, limits binary"


def limited_blocks(anchors: DataFrame, limits: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Blocks of the anchors that have a window, with the slots' upper limits (descending) and the least lower limit."""
    dealt, count = vb.deal(anchors, vb.QUERY_ROWS)

    def run(table: pa.Table) -> pa.Table:
        fields = vb.pack(table)
        by_row = dict(zip(table.column("row").to_pylist(), zip(table.column("least").to_pylist(),
                                                               table.column("limits").to_pylist(), strict=True), strict=True))
        order = [by_row[r] for r in vb.longs(fields["row"]).tolist()]
        fields["least"] = np.array([x for x, _ in order], "<i8").tobytes()
        fields["limits"] = np.array([(x + [NONE] * most)[:most] for _, x in order], "<i8").tobytes()
        return pa.Table.from_pylist([fields], schema=vb.as_arrow(LIMITED))

    return dealt.join(limits, "row").groupBy("block").applyInArrow(run, LIMITED), count


def slot_rows(anchors: DataFrame, n_anchors: int, rows: DataFrame, n_rows: int, most: int,
              k: int = NEGATIVES) -> DataFrame:
    """(row, slot, vec_id, score): the first k rows of another label in each slot of each anchor.

    Slot i holds the scores from limit i (included) down to limit i + 1; scores under the anchor's least
    lower limit are in no window.
    """

    def search(best, query, block):
        scores = vb.inner(vb.matrix(query), vb.matrix(block))
        ids, labels = vb.longs(block["vec_id"]), vb.longs(block["label"])
        limits = vb.longs(query["limits"]).reshape(-1, most)
        for row, own, label, least, upper, score in zip(
                vb.longs(query["row"]).tolist(), vb.longs(query["vec_id"]), vb.longs(query["label"]),
                vb.longs(query["least"]), limits, scores, strict=True):
            upper = upper[upper > NONE]
            at = np.flatnonzero((labels != label) & (ids != own) & (score <= upper[0]) & (score >= least))
            slot = len(upper) - np.searchsorted(upper[::-1], score[at]) - 1
            for s in np.unique(slot).tolist():
                hit = at[slot == s]
                best.add((row, s), score[hit], ids[hit])

    return _combined(vb.cells(anchors, n_anchors, rows, n_rows), k, search)


def mine(rows: DataFrame, anchor: Column, scale: int = 256, label: Column | None = None, n_positives: int = POSITIVES,
         n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    ``rows`` has vec_id, label and embedding; ``label`` may replace the label, ``anchor`` is a condition on vec_id.
    """
    whole = vb.integer_rows(rows, scale, F.col("label") if label is None else label)
    packed, n_rows = vb.blocks(whole)
    packed = stored(packed)
    anchors = whole.where(anchor)
    asking, n_asking = vb.blocks(anchors, vb.QUERY_ROWS)
    found = stored(positives(stored(asking), n_asking, packed, n_rows, n_positives))

    upper, lower = F.expr(f"score * {high} div 100"), F.expr(f"(score * {low} + 99) div 100")
    windows = found.where("score >= 0").select(
        "row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        upper.alias("upper"), lower.alias("lower"))
    limits = windows.groupBy("row").agg(F.min("lower").alias("least"),
                                        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"))
    limited, n_limited = limited_blocks(anchors, limits, n_positives)
    slots = slot_rows(stored(limited), n_limited, packed, n_rows, n_positives, n_negatives)

    # an anchor's slots in descending order: positives x negatives rows at most
    entry = F.struct("slot", "place", "vec_id", "score")
    merged = slots.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("slots"))
    windows = windows.join(limits.select("row", "limits"), "row")
    own_slot = F.array_position("limits", F.col("upper")) - 1
    suffix = F.filter("slots", lambda s: (s["slot"] >= F.col("own")) & (s["score"] >= F.col("lower")))
    return (windows.withColumn("own", own_slot).join(merged, "row")
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "positive_score",
                    F.posexplode(F.slice(suffix, 1, n_negatives)).alias("at", "found"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("found.vec_id").alias("negative_id"), "positive_score",
                    F.col("found.score").alias("negative_score")))


def op11_report(rows: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row; every seventh row's label is moved on by one first."""
    rows = rows.select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 100 == 0, label=moved)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
