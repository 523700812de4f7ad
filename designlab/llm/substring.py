"""Substring deduplication by difference-cover anchors.

A word is removed if a window of ``WINDOW`` words covers it whose word sequence also starts in a
document with a smaller id.  Hashing every window would shuffle a row per word; instead only the
positions ``p`` with ``p mod PERIOD`` in ``COVER`` carry an anchor, a hash of ``ANCHOR`` words.
For any two positions i and j some shift below PERIOD puts both on cover positions, and
ANCHOR + PERIOD - 1 = WINDOW, so two equal windows share an aligned anchor.  Anchors found in two
documents extend to the windows around them, and only those windows are hashed (128 bits) and
sorted: the smallest id per window decides, so a passage costs one row per copy and window, and no
pairs.  Copies that a slice of the texts already settles (a smaller id holds the window there) do not
meet the others, so one task gets few rows of a hot window.

Defined cases: null and empty texts have no words; a row without ``doc_id`` counts as larger than
all others; rows of the same ``doc_id`` do not remove each other's words; documents under
WINDOW words stay as they are; an empty table gives an empty result; other columns are
kept by ``remove`` and ignored by the report.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from designlab.llm.stored import drop, plain_names, stored
from designlab.llm.textarrays import Words, covered, mix, per_doc, slices, small_batches, text_bytes
from designlab.session import measured

WINDOW = 13
# fixed values: a perfect difference cover
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
LAST = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds ``_id`` (null ids last) and ``_h``, which tell rows apart unless they are equal.

    ``_h`` is a hash of the text for the rows of a repeated id and 0 for all others, so that it costs next to
    nothing in the rows per anchor and window.
    """
    ids = small_batches(docs).select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"))
    many = measured(ids.groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").select("_id", F.lit(True).alias("_many")))
    own = F.when(F.col("_many"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return ids.join(many, "_id", "left").select(*docs.columns, "_id", own.alias("_h"))


def _words(batch):
    for part in slices(batch):
        yield part, Words(*text_bytes(part.column("text")))


def _settled(ids: np.ndarray, *keys: np.ndarray, between: bool = False) -> np.ndarray:
    """Mask of the rows of a slice whose keys have a smaller id there (with ``between``: and a larger one)."""
    out = np.zeros(len(ids), bool)
    if len(ids):
        order = np.argsort(keys[0], kind="stable")
        new = np.zeros(len(ids), bool)
        new[0] = True
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        begin, run, own = np.flatnonzero(new), np.cumsum(new) - 1, ids[order]
        found = own > np.minimum.reduceat(own, begin)[run]
        if between:
            found &= own < np.maximum.reduceat(own, begin)[run]
        out[order] = found
    return out


def _dealt(key: np.ndarray, settled: np.ndarray) -> pa.Array:
    """``key``, but settled rows, which need not meet the others, get keys of their own: no task gets all copies."""
    out = key.copy()
    out[settled] = mix(key[settled] + np.arange(1, np.count_nonzero(settled) + 1, dtype=np.uint64))
    return pa.array(out.view(np.int64))


def anchors(keyed: DataFrame) -> DataFrame:
    """(key, _id, _h, pos, settled): hashes of the ANCHOR words at the cover positions of each document.

    Settled rows are known to have an anchor that two documents hold; their keys are replaced.
    """
    on = np.zeros(PERIOD, bool)
    on[list(COVER)] = True

    def run(batches):
        for batch in batches:
            for part, words in _words(batch):
                at, keys = words.windows(words.hashes(11), ANCHOR, 11)
                pos = at - words.first[words.doc[at]]
                use = on[pos % PERIOD]
                rows, keys = pa.array(words.doc[at[use]]), keys[use]
                ids = part.column("_id").take(rows)
                settled = _settled(ids.to_numpy(), keys, between=True)
                yield pa.RecordBatch.from_arrays(
                    [_dealt(keys, settled), ids, part.column("_h").take(rows), pa.array(pos[use].astype(np.int32)),
                     pa.array(settled)], names=["key", "_id", "_h", "pos", "settled"])

    return keyed.select("_id", "_h", "text").mapInArrow(run, "key long, _id long, _h long, pos int, settled boolean")


def _positions(column, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word rows, list sizes) of a column of per-document positions."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(x) if x is not None else 0 for x in column.to_pylist()], np.int64)
    return flat + np.repeat(words.first[:-1], sizes), sizes


def windows(found: DataFrame) -> DataFrame:
    """(a, b, _id, _h, pos, settled): 128-bit hashes of the windows that extend an anchor listed in ``at``.

    Settled rows are known to have a window that a smaller id holds; their ``a`` is replaced.
    """
    def run(batches):
        for batch in batches:
            for part, words in _words(batch):
                rows, _ = _positions(part.column("at"), words)
                start, a = words.windows(words.hashes(11), WINDOW, 11)
                _, b = words.windows(words.hashes(12), WINDOW, 12)
                # windows that hold an anchor: start in (anchor - PERIOD, anchor]
                near = covered(len(words) + PERIOD, rows, PERIOD)[PERIOD - 1:] if len(rows) else None
                use = near[start] if near is not None and len(start) else np.zeros(len(start), bool)
                doc = words.doc[start[use]]
                pos = start[use] - words.first[doc]
                doc, a, b = pa.array(doc), a[use], b[use]
                ids = part.column("_id").take(doc)
                settled = _settled(ids.to_numpy(), a, b)
                yield pa.RecordBatch.from_arrays(
                    [_dealt(a, settled), pa.array(b.view(np.int64)), ids, part.column("_h").take(doc),
                     pa.array(pos.astype(np.int32)), pa.array(settled)], names=["a", "b", "_id", "_h", "pos", "settled"])

    return (found.select("_id", "_h", "text", "at")
            .mapInArrow(run, "a long, b long, _id long, _h long, pos int, settled boolean"))


def repeated(keyed: DataFrame) -> DataFrame:
    """(_id, _h, at): per document the starts of windows that an earlier document holds too."""
    key, window = Window.partitionBy("key"), Window.partitionBy("a", "b")
    # a row per anchor and per window is shuffled once and never written; the written steps have a row per document
    shared = (anchors(keyed).withColumn("lo", F.min("_id").over(key)).withColumn("hi", F.max("_id").over(key))
              .where("settled or lo < hi"))
    at = stored(shared.groupBy("_id", "_h").agg(F.collect_set("pos").alias("at")))
    later = (windows(keyed.join(at, ["_id", "_h"])).withColumn("lo", F.min("_id").over(window))
             .where("settled or _id > lo"))
    found = stored(later.groupBy("_id", "_h").agg(F.collect_set("pos").alias("at")))
    drop(at)
    return found


def _kept(part, words: Words) -> np.ndarray:
    rows, _ = _positions(part.column("at"), words)
    return ~covered(len(words), rows, WINDOW) if len(rows) else np.ones(len(words), bool)


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words removed; a changed text is its kept words joined by one space."""
    plain = plain_names(docs)
    keyed = _keyed(plain)
    rows = keyed.join(repeated(keyed), ["_id", "_h"], "left").select(*plain.columns, "at")
    schema = StructType([*plain.schema.fields, StructField("at", ArrayType(IntegerType()))])

    def run(batches):
        for batch in batches:
            for part, words in _words(batch):
                keep = _kept(part, words)
                changed = pa.array(per_doc(~keep, words.first) > 0)
                i = part.schema.get_field_index("text")
                text = pc.if_else(changed, words.joined(keep), part.column("text").cast(pa.string()))
                yield part.set_column(i, "text", text)

    return rows.mapInArrow(run, schema).drop("at").toDF(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per document."""
    keyed = _keyed(docs.select("doc_id", "text"))
    rows = keyed.join(repeated(keyed), ["_id", "_h"], "left")

    def run(batches):
        for batch in batches:
            for part, words in _words(batch):
                keep = _kept(part, words)
                digests = [hashlib.sha256(x.as_buffer()).hexdigest() for x in words.joined(keep)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts), pa.array(per_doc(~keep, words.first)),
                     pa.array(digests)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "at")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS lo FROM win) WHERE doc_id > lo),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM rep),
per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
k AS (
  SELECT doc_id, d.w, coalesce(len(ps), 0) AS n_removed, ps FROM d LEFT JOIN per USING (doc_id)),
pos AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
txt AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT k.doc_id, len(k.w)::BIGINT AS n_words, k.n_removed::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM k LEFT JOIN txt USING (doc_id)
"""
