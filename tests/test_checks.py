"""Consistency check: one clean set, then each of the nine faults once."""

import pytest

from designlab.operators import checks

EXPECTED = 2


def _frames(spark, design, status, results):
    d = spark.createDataFrame(design, "a double, b string, row_no long")
    s = spark.createDataFrame(status, "a double, b string, row_no long, success int")
    r = spark.createDataFrame(results, "a double, b string")
    return (checks.keyed(d, ["a", "b"], "row_no"), checks.keyed(s, ["a", "b"], "row_no", ["success"]),
            checks.keyed(r, ["a", "b"]))


CLEAN = (
    [(1.0, "x", 1), (2.0, "x", 2), (3.0, "x", 3)],
    [(1.0, "x", 1, 1), (2.0, "x", 2, 1), (3.0, "x", 3, 0)],
    [(1.0, "x"), (1.0, "x"), (2.0, "x"), (2.0, "x")],
)


def _report(spark, design, status, results):
    rows = checks.report(*_frames(spark, design, status, results), expected=EXPECTED).collect()
    return {r["kind"]: r["errors"] for r in rows}


def test_clean_set_passes(spark):
    rep = _report(spark, *CLEAN)
    assert rep["total"] == 0


@pytest.mark.parametrize("kind", ["duplicate_design", "duplicate_status", "missing", "matched_twice", "no_results",
                                  "too_few", "too_many", "failed_with_results", "strays"])
def test_each_fault_once(spark, kind):
    design, status, results = (list(x) for x in CLEAN)
    if kind == "duplicate_design":
        design.append((1.0000001, "x", 4))           # same key at 6 significant digits
    elif kind in ("duplicate_status", "matched_twice"):
        status.append((2.0, "x", 4, 1))
    elif kind == "missing":
        status = status[1:]
    elif kind == "no_results":
        results = [r for r in results if r[0] != 1.0]
    elif kind == "too_few":
        results = results[1:]
    elif kind == "too_many":
        results.append((1.0, "x"))
    elif kind == "failed_with_results":
        results.append((3.0, "x"))
    elif kind == "strays":
        results += [(9.0, "x"), (8.0, "y")]
    rep = _report(spark, design, status, results)
    assert rep[kind] >= 1
    if kind == "strays":
        assert rep["strays"] == 1                     # counted once whatever the number
    if kind == "missing":
        assert rep["total"] == 1                      # a missing row counts once and nothing else


def test_first_repeat_row(spark):
    d = spark.createDataFrame([(1.0, 5), (2.0, 6), (1.0, 9), (2.0, 7)], "a double, row_no long")
    r = checks.first_repeat(checks.keyed(d, ["a"], "row_no"), "design").first()
    assert (r["repeat_rows"], r["repeated_keys"], r["first_repeat_row"]) == (2, 2, 7)


def test_verdict_uses_first_status_match(spark):
    design = [(1.0, "x", 1)]
    status = [(1.0, "x", 5, 0), (1.0, "x", 2, 1)]      # first in file order (row 2) says success
    results = [(1.0, "x"), (1.0, "x")]
    v = checks.verdicts(*_frames(spark, design, status, results), expected=EXPECTED).first()
    assert v["success"] == 1 and v["verdict"] == "ok" and v["n_status"] == 2


def test_duplicate_matches(spark):
    design = [(1.0, "x", 1), (2.0, "x", 2)]
    status = [(1.0, "x", 3, 1), (1.0, "x", 7, 0), (2.0, "x", 4, 1), (1.0, "x", 8, 0), (1.0, "x", 9, 1)]
    d, s, _ = _frames(spark, design, status, [])
    rows = sorted((r.n_design, r.n_status, r.status_row) for r in checks.duplicate_matches(d, s).collect())
    assert rows == [(1, 4, 3), (1, 4, 7), (1, 4, 8), (1, 4, 9)]    # every match, not only the first two


def test_line_numbers_follow_scan_order(spark):
    df = spark.createDataFrame([(v,) for v in "abcdefg"], "v string").coalesce(1)
    got = [(r.v, r.row_no) for r in checks.with_line_numbers(df).orderBy("row_no").collect()]
    assert got == [(v, i + 2) for i, v in enumerate("abcdefg")]


def test_keys_compare_by_position(spark):
    df = spark.createDataFrame([(0, "1", None, "2"), (1, None, "1", "2"), (2, "1", "2", None), (3, "1", "", "2"),
                                (4, "a|b", "c", ""), (5, "a", "b|c", ""), (6, "1d", "2f", ""), (7, "1", "2", "")],
                               "i int, a string, b string, c string")
    key = {r.i: r.key for r in checks.keyed(df, ["a", "b", "c"], None, ["i"]).collect()}
    assert key[0] == key[3] and key[2] == key[7]
    assert len(set(key.values())) == 6
