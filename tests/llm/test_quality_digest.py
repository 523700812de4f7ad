"""Quality rules and digest index against direct Python on edge cases; against SQL on the tables."""

import hashlib
import re

import pytest

from designlab.llm import digest_index, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(300))
TEXTS = [None, "", " \n\t ", "one", LONG, LONG, LONG.replace(" ", "\n"), "a b c d e f g h " * 5, "x\n" * 40 + LONG,
         "x \nx\nx \n\n \n" + LONG, "#$ " * 30, "é" * 50 + " " + LONG, "a\x0bb\x0cc\rd\x1ce f " * 10,
         "\n".join(["same line here"] * 10), "12 34 56 " * 10 + LONG[:60], "long " + "z" * 3_000_000]


def direct(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n, rep = len(words), len(hit)
    failed = n < 20 or 100 * rep > 30 * n
    chars, sym, dup = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    letters = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words)
    kept = not failed and 100 * sym <= 50 * n and 2 * n <= chars <= 20 * n and 100 * dup <= 30 * len(lines) \
        and 100 * letters >= 70 * n
    return n, chars, sym, dup, rep, failed, kept


def test_quality_edges(spark):
    rows = [(i, t, "lang", 1.5) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept double")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.quality_report(docs).collect()}
    assert got == {i: direct(t) for i, t in enumerate(TEXTS)}
    stays = quality.filter_quality(docs)
    assert stays.columns == docs.columns
    assert sorted(r["doc_id"] for r in stays.collect()) == [i for i, t in enumerate(TEXTS) if direct(t)[-1]]
    assert quality.quality_report(docs.limit(0)).count() == 0


def test_order_does_not_change_verdicts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    names = [r.name for r in quality.RULES]
    one = quality.quality_report(docs, names).collect()
    two = quality.quality_report(docs, names[::-1]).collect()
    assert sorted(one) == sorted(two)
    assert {p["rule"] for p in quality.plan_cascade(docs)} == set(names)


def test_digest_groups(spark):
    rows = [(5, "a  b"), (3, "a\n\tb"), (9, "a b"), (3, "a b"), (None, "a b"), (4, None), (7, ""), (8, " "), (None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = digest_index.op6_report(docs).collect()
    assert len(got) == len(rows)
    kept = sorted((r["doc_id"], r["group_size"]) for r in got if r["kept"] and r["doc_id"] is not None)
    assert kept == [(3, 5), (4, 2), (8, 1)]
    assert sum(r["kept"] for r in got) == 4
    assert {r["text_sha256"] for r in got if r["keep_id"] == 3} == {hashlib.sha256(b"a b").hexdigest()}
    assert digest_index.op6_report(docs.limit(0)).count() == 0


def test_index_remembers_batches(spark):
    index = digest_index.temporary_index(spark)
    schema = "doc_id long, text string, digest string"
    first = spark.createDataFrame([(10, "x", "c"), (11, "y", "c")], schema)
    second = spark.createDataFrame([(1, "x ", "c"), (2, "x", "c"), (3, "z", "c"), (4, "z", "c")], schema)
    digest_index.dedup(first, index).collect()
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in digest_index.dedup(second, index).collect()}
    assert got == {1: (1, True), 2: (10, False), 3: (3, True), 4: (3, False)}
    assert index.table().count() == 4
    # a batch sent again after a failure gives the same answer
    again = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in digest_index.dedup(second, index).collect()}
    assert again == got


def test_sample_is_measured_in_place(spark):
    schema = "doc_id long, text string"
    same = spark.createDataFrame([(7, LONG)] * 300 + [(None, "# # #")] * 300, schema)
    plan = {p["rule"]: p for p in quality.plan_cascade(same, sample_docs=50)}
    assert set(plan) == {r.name for r in quality.RULES} and all(0 <= p["rejects"] <= 1 for p in plan.values())
    docs = spark.createDataFrame([(i, LONG) for i in range(400)] + [(400 + i, "# $ % & < > " * 9) for i in range(400)], schema)
    plan = {p["rule"]: p["rejects"] for p in quality.plan_cascade(docs, sample_docs=200)}
    assert 0.3 < plan["symbols"] < 0.7 and plan["word_length"] == plan["letter_words"] == plan["symbols"]
    # a sample of everything counts every document
    plan = {p["rule"]: p["rejects"] for p in quality.plan_cascade(docs, sample_docs=10_000)}
    assert plan["symbols"] == 0.5 and plan["duplicate_lines"] == 0
