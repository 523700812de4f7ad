"""Quality rules as a short-circuit cascade.

Every rule is a vector function over a batch of texts.  ``plan_cascade`` runs all rules on a
sample chosen by a hash of ``doc_id``, inside the tasks that read it, measures each rule's seconds per word and the share of documents that it
rejects, and orders rules by rejection per cost; ``apply_cascade`` then evaluates them in that
order, each only on the documents that the rules before it have kept.  The verdict does not
depend on the order, so a different measurement changes the speed and never the result.

Defined cases: null and empty texts have no words and fail the base rule; repeated rows are
judged one by one; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are passed through by ``filter_quality`` and ignored by ``quality_report``.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.llm.textarrays import SPACE, Words, mix, per_doc, slices, small_batches, text_bytes

#: documents in the sample that orders the cascade, in all and in one task (it bounds planning work; verdicts
#: don't depend on it)
SAMPLE_DOCS = 2_000
MIN_WORDS = 20
REPEAT_WINDOW = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
LETTER = np.zeros(256, bool)
LETTER[128:] = True
LETTER[ord("A"):ord("Z") + 1] = True
LETTER[ord("a"):ord("z") + 1] = True


def _once(measure: Callable[[Words], object]) -> Callable[[Words], object]:
    """``measure`` computed once per batch: the report and the rules read the same arrays."""
    @functools.wraps(measure)
    def known(words: Words):
        found = words.__dict__.setdefault("measured", {})
        if measure.__name__ not in found:
            found[measure.__name__] = measure(words)
        return found[measure.__name__]

    return known


@_once
def n_symbols(words: Words) -> np.ndarray:
    return per_doc(SYMBOL[words.data], words.offsets)


@_once
def word_chars(words: Words) -> np.ndarray:
    """Code points inside words: bytes that are neither white space nor UTF-8 continuation bytes."""
    return per_doc(~SPACE[words.data] & ((words.data & 0xC0) != 0x80), words.offsets)


def _first_seen(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): rows sorted by (doc, key) with their row order kept; whether a row starts a new (doc, key)."""
    order = np.lexsort((keys, doc))
    d, k = doc[order], keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return order, new


@_once
def worded_lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them equal to an earlier line of the document)."""
    data, offsets = words.data, words.offsets
    newline = np.flatnonzero(data == 0x0A)
    filled = offsets[:-1][np.diff(offsets) > 0]
    starts = np.unique(np.concatenate([filled, newline + 1]))
    starts = starts[starts < len(data)]
    # a start at a document's end belongs to the next document, which has it anyway
    ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
    if len(starts):
        doc_end = offsets[np.searchsorted(offsets, starts, side="right")]
        ends = np.minimum(ends, doc_end)
        ends = ends - (data[ends - 1] == 0x0A)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    line = Words.__new__(Words)
    line.data, line.starts, line.ends = data, starts, ends
    keys = line.hashes(5)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    _, new = _first_seen(doc, keys)
    order = np.lexsort((keys, doc))
    repeated = np.bincount(doc[order][~new], minlength=words.n_docs)
    return np.bincount(doc, minlength=words.n_docs), repeated


def repeat_words(words: Words) -> np.ndarray:
    """Words inside windows of REPEAT_WINDOW words that occur at least twice in the document."""
    at, keys = words.windows(words.hashes(), REPEAT_WINDOW)
    if not len(at):
        return np.zeros(words.n_docs, np.int64)
    # documents never share a key: the key is mixed with the document's row
    keys = mix(keys + words.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    twice = same[1:] | same[:-1]
    step = np.zeros(len(words) + REPEAT_WINDOW + 1, np.int64)
    begin = at[order[twice]]
    step[begin] += 1
    step[begin + REPEAT_WINDOW] -= 1
    return per_doc(np.cumsum(step)[:len(words)] > 0, words.first)


def letter_words(words: Words) -> np.ndarray:
    """Words that hold an ASCII letter or any non-ASCII character."""
    running = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(LETTER[words.data], out=running[1:])
    return per_doc(running[words.ends] > running[words.starts], words.first)


@dataclass(frozen=True)
class Rule:
    """``rejects(words)`` says per document of the batch whether the rule rejects it."""

    name: str
    rejects: Callable[[Words], np.ndarray]


def _dup_lines(words: Words) -> np.ndarray:
    lines, repeated = worded_lines(words)
    return 100 * repeated > 30 * lines


#: thresholds in percent of a document's words (or lines)
RULES = (
    Rule("symbols", lambda w: 100 * n_symbols(w) > 50 * w.counts),
    Rule("word_length", lambda w: (word_chars(w) < 2 * w.counts) | (word_chars(w) > 20 * w.counts)),
    Rule("duplicate_lines", _dup_lines),
    Rule("letter_words", lambda w: 100 * letter_words(w) < 70 * w.counts),
)
BY_NAME = {r.name: r for r in RULES}


def _subset(words: Words, rows: np.ndarray) -> Words:
    """The words object of some documents of a batch, with what is measured of them already."""
    lengths = np.diff(words.offsets)
    keep = np.repeat(rows, lengths)
    part = Words(words.data[keep], np.concatenate([[0], np.cumsum(lengths[rows])]))
    part.measured = {k: tuple(x[rows] for x in v) if isinstance(v, tuple) else v[rows]
                     for k, v in words.__dict__.get("measured", {}).items()}
    return part


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for part in slices(batch):
        yield part, Words(*text_bytes(part.column("text")))


def plan_cascade(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[dict]:
    """Rules with measured cost (seconds per 1e6 words) and rejected share, best first.

    About ``sample_docs`` documents are measured, chosen by a hash of their id, where they are read: no text
    leaves its task.  Rows of one id are chosen together, so a task also stops at ``sample_docs`` rows.  The
    collected table has one row per rule.
    """
    names = [r.name for r in RULES]
    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))

    def measure(batches):
        left = sample_docs
        for batch in batches:
            batch = batch.slice(0, left)
            left -= batch.num_rows
            for _, words in _batches(batch) if batch.num_rows else ():
                for name in names:
                    began = time.perf_counter()
                    bad = BY_NAME[name].rejects(words)
                    took = time.perf_counter() - began
                    yield pa.RecordBatch.from_pydict({
                        "rule": [name], "seconds": [took], "words": [len(words)],
                        "docs": [words.n_docs], "rejected": [int(bad.sum())]})

    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("cascade")), F.lit(1 << 40)) < int(share * (1 << 40))
    rows = (small_batches(docs).where(drawn).select("text")
            .mapInArrow(measure, "rule string, seconds double, words long, docs long, rejected long")
            .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("words").alias("words"),
                                 F.sum("docs").alias("docs"), F.sum("rejected").alias("rejected")).collect())
    found = {r["rule"]: r for r in rows}
    plan = []
    for name in names:
        r = found.get(name)
        cost = 1e6 * r["seconds"] / max(r["words"], 1) if r else 0.0
        share = r["rejected"] / max(r["docs"], 1) if r else 0.0
        plan.append({"rule": name, "cost": cost, "rejects": share, "gain": share / max(cost, 1e-9)})
    return sorted(plan, key=lambda p: (-p["gain"], p["cost"]))


def cascade(words: Words, order: list[str], alive: np.ndarray) -> np.ndarray:
    """Documents that pass every rule; a rule sees only those still alive."""
    alive = alive.copy()
    for name in order:
        rows = np.flatnonzero(alive)
        if not len(rows):
            break
        part = words if len(rows) == words.n_docs else _subset(words, alive)
        alive[rows[BY_NAME[name].rejects(part)]] = False
    return alive


REPORT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean")


def quality_report(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per document: base counts, ``base_failed`` and the cascade's verdict ``kept``."""
    order = order or [p["rule"] for p in plan_cascade(docs)]

    def judge(batches):
        for batch in batches:
            for part, words in _batches(batch):
                repeats = repeat_words(words)
                base = (words.counts, word_chars(words), n_symbols(words), worded_lines(words)[1], repeats)
                failed = (words.counts < MIN_WORDS) | (100 * repeats > 30 * words.counts)
                kept = cascade(words, order, ~failed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in base),
                     pa.array(failed), pa.array(kept)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept"])

    return (small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(judge, REPORT))


def filter_quality(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``docs`` without the rejected rows, all columns unchanged (no shuffle: rows are judged in place)."""
    order = order or [p["rule"] for p in plan_cascade(docs)]

    def keep(batches):
        for batch in batches:
            for part, words in _batches(batch):
                failed = (words.counts < MIN_WORDS) | (100 * repeat_words(words) > 30 * words.counts)
                yield part.filter(pa.array(cascade(words, order, ~failed)))

    return small_batches(docs).mapInArrow(keep, docs.schema)


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (
  SELECT doc_id, w, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
         len([x FOR x IN w IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS n_letter
  FROM d),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM b WHERE len(w) >= 8)),
rep AS (
  SELECT doc_id, unnest(range(i, i + 8)) AS p FROM
    (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n_rep FROM rep GROUP BY doc_id),
f AS (
  SELECT b.doc_id, n_words, word_chars, n_symbols, len(lines) AS n_lines, n_letter,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_rep, 0) AS n_repeat_words
  FROM b LEFT JOIN r USING (doc_id)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_symbols <= 50 * n_words AND word_chars >= 2 * n_words
         AND word_chars <= 20 * n_words AND 100 * n_dup_lines <= 30 * n_lines
         AND 100 * n_letter >= 70 * n_words AS kept
FROM g
"""
