"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, characters that are not letters become one space, and every run of 1 to 3
characters is hashed into ``BUCKETS`` buckets.  Training counts the buckets per language over at most
``FIT_ROWS`` labelled documents of each language (a sample by text hash beyond that); the matrix
of log-probabilities (languages x BUCKETS floats) is broadcast.  A document's n-grams select columns
of that matrix and their sum per language is the score, in numpy over a whole slice of documents.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ties go to the
alphabetically first language; without labelled rows every document is ``und``; repeated rows are
judged one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from designlab.llm.textarrays import mix, slices

BUCKETS = 1 << 16
#: training documents of each language at most
FIT_ROWS = 5000
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
NONE = "und"


def held_out(doc_id) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Per code point: is it a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, offsets per text, texts with a letter)."""
    # every text stands between spaces, so that no n-gram spans two texts with letters on both sides
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "replace"), "<u4") for t in texts]
    first = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
    code = np.concatenate(codes) if codes else np.zeros(0, "<u4")
    is_letter = letters()[code]
    running = np.concatenate([[0], np.cumsum(is_letter)])
    has = running[first[1:]] > running[first[:-1]]
    code = np.where(is_letter, code, 0x20).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    # runs of non-letters count as one space
    keep = np.ones(len(code), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1] | (doc[1:] != doc[:-1])
    code, doc, is_letter = code[keep], doc[keep], is_letter[keep]
    keys, docs = [], []
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        key, some = np.full(m, n, np.uint64), np.zeros(m, bool)
        for j in range(n):
            key = key * np.uint64(0x110000) + code[j:j + m]
            some |= is_letter[j:j + m]
        use = some & (doc[:m] == doc[n - 1:])
        keys.append((mix(key[use]) % np.uint64(BUCKETS)).astype(np.int64))
        docs.append(doc[:m][use])
    key, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, docs))
    order = np.argsort(doc, kind="stable")
    return key[order], np.searchsorted(doc[order], np.arange(len(texts) + 1)), has


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities, log priors) from (text, lang) rows."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return [], np.zeros((0, BUCKETS), np.float32), np.zeros(0)
    share = F.create_map(*(F.lit(x) for k, n in totals.items() for x in (k, min(1.0, fit_rows / n))))
    point = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.where(point < F.element_at(share, F.col("lang")))

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                key, first, _ = ngrams(part.column("text").to_pylist())
                for i, lang in enumerate(part.column("lang").to_pylist()):
                    own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    own += np.bincount(key[first[i]:first[i + 1]], minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(sums), pa.string()),
                                          "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"lang": [table.column("lang")[0].as_py()], "counts": pa.array([counts.tobytes()], pa.binary())})

    rows = (sample.mapInArrow(run, "lang string, counts binary").groupBy("lang")
            .applyInArrow(total, "lang string, counts binary").collect())
    counts = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in rows}
    langs = sorted(counts)
    matrix = np.stack([counts[x] for x in langs]) + SMOOTHING
    logs = np.log(matrix / matrix.sum(1, keepdims=True)).astype(np.float32)
    prior = np.array([totals[x] for x in langs], float)
    return langs, logs, np.log(prior / prior.sum())


def score(texts: list[str | None], model) -> tuple[list[str], np.ndarray]:
    """(language, posterior probability) of each text."""
    langs, logs, prior = model
    key, first, has = ngrams(texts)
    if not langs:
        return [NONE] * len(texts), np.zeros(len(texts))
    total = np.empty((len(texts), len(langs)))
    for k in range(len(langs)):
        running = np.concatenate([[0.0], np.cumsum(logs[k][key], dtype=np.float64)])
        total[:, k] = running[first[1:]] - running[first[:-1]] + prior[k]
    best = total.argmax(1)
    odds = np.exp(total - total.max(1, keepdims=True))
    return ([langs[b] if h else NONE for b, h in zip(best, has, strict=True)],
            np.where(has, 1 / odds.sum(1), 0.0))


def predict(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                langs, points = score(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"),
                                                  pa.array(langs, pa.string()), pa.array(points)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def report(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs.where(~held_out(F.col("doc_id")))))
