"""Hard negatives and exact top-k search against direct Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from designlab.llm import hard_negatives, impact_index, vectorblocks

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, row string, block int, Q_BLOCK string, v int"


def random_rows(n, dim, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, spread, (4, dim))
    label = rng.integers(0, 4, n)
    v = centre[label] + rng.normal(0, spread, (n, dim))
    # a third of the rows is one vector, under ids of their own
    v[::3] = v[0]
    return [(i, [float(x) for x in v[i]], int(label[i])) for i in range(n)]


EDGE = [(None, [0.5, 0.1], 1), (7, None, 1), (100, [0.5, NAN], 1), (9, [0.5, INF], 0), (11, [0.5, None], 1),
        (200, [0.5, 0.25], None), (300, [], 2), (12, [0.5], 1), (14, [0.25, 0.5, 0.125], 1), (13, [0.5, 0.1], 1),
        (13, [0.5, 0.1], 1), (400, [0.5, 0.1], 1), (400, [0.5, 0.1], 1), (15, [0.3, 0.1], 2), (16, [0.3, 0.1], 2),
        (500, [-0.5, -0.1], 3), (17, [-0.001, 0.0], 3), (18, [0.0, 0.0], 4), (600, [0.0, 0.0], 4)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", 1) for r in rows], SCHEMA)


def whole(rows, scale, label=False):
    out = []
    for i, e, c in rows:
        if e is None or any(x is None or not math.isfinite(x) for x in e) or (label and c is None):
            continue
        out.append((i, [math.floor(scale * x) for x in e], c))
    return out


def dot(a, b):
    return max(-(1 << 56), min(1 << 56, sum(x * y for x, y in zip(a, b, strict=False))))


def order(hits):
    """Descending score, then id, null ids last."""
    return sorted(hits, key=lambda h: (-h[0], h[1] is None, h[1] or 0))


def direct_top(rows, every, k=10):
    part = whole(rows, 1024)
    out = []
    for q, e, _ in part:
        if q is not None and q % every == 0:
            hits = order([(dot(e, x), i) for i, x, _ in part if i != q])[:k]
            out += [(q, r, i, s) for r, (s, i) in enumerate(hits, 1)]
    return out


def direct_negatives(rows, every):
    part = whole(rows, 256, label=True)
    out = []
    for a, e, c in part:
        if a is None or a % every:
            continue
        scored = order([(dot(e, x), i, y) for i, x, y in part if i != a])
        for s, p, _ in [h for h in scored if h[2] == c][:5]:
            hits = [h for h in scored if h[2] != c and 30 * s <= 100 * h[0] <= 90 * s][:10]
            out += [(a, p, r, n, s, t) for r, (t, n, _) in enumerate(hits, 1)]
    return out


def same(got, want):
    def key(row):
        return [(x is None, x or 0) for x in row]

    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("n, dim, block", [(400, 8, 60), (500, 40, 128), (90, 1, 1000)])
def test_top_k_matches_brute_force(spark, n, dim, block):
    rows = random_rows(n, dim, n)
    got = impact_index.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, block_rows=block)
    same(got.collect(), direct_top(rows, 20))


def test_segments_leave_on_proof_only():
    """Many queries against one block: nothing that belongs to the first k is left out, and most of the rest is."""
    rng = np.random.default_rng(5)
    v = rng.normal(0, 120, (3000, 32)).astype(np.int16)
    v[500:1500] = v[499]
    fields = {"n": len(v), "dim": 32, "width": 2, "v": v.tobytes(), "vec_id": np.arange(3000, dtype="<i8").tobytes()}
    segments = impact_index.Segments(fields | impact_index.index_block(v))
    left = 0
    for q in [*rng.normal(0, 120, (40, 32)).astype(np.int64), v[700].astype(np.int64), np.zeros(32, np.int64)]:
        scores = v.astype(np.int64) @ q
        want = vectorblocks.first(scores, segments.ids, 10)
        for floor in (None, int(scores[want].min())):
            at = segments.search(q, -1, 10, floor)
            assert set(want.tolist()) <= set(at.tolist())
        left += len(at)
    assert left < 42 * 3000 / 4


def test_top_k_edges(spark):
    got = impact_index.top_k(frame(spark, EDGE), F.col("vec_id") % 100 == 0)
    same(got.collect(), direct_top(EDGE, 100))
    assert impact_index.op13_report(frame(spark, EDGE).limit(0)).count() == 0
    assert impact_index.op13_report(frame(spark, [(1, [1.0], 0)])).count() == 0


def test_huge_components_are_exact_or_held(spark):
    rows = [(i, [x, 1.0], 0) for i, x in enumerate([1e30, -1e30, 1e7, 1e9, 3e13, -2.0])]
    got = impact_index.top_k(frame(spark, rows), F.col("vec_id") >= 0)
    held = [(i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(1024 * x))) for x in e], c) for i, e, c in rows]
    want = []
    for q, e, _ in held:
        want += [(q, r, i, s) for r, (s, i) in enumerate(order([(dot(e, x), i) for i, x, _ in held if i != q]), 1)]
    same(got.collect(), want)


@pytest.mark.parametrize("n, dim", [(300, 4), (400, 24)])
def test_hard_negatives_match_brute_force(spark, n, dim, monkeypatch):
    monkeypatch.setattr(vectorblocks, "BLOCK_ROWS", 64)
    rows = random_rows(n, dim, n)
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    same(got.collect(), direct_negatives(rows, 10))


def test_hard_negatives_edges(spark):
    got = hard_negatives.mine(frame(spark, EDGE), F.col("vec_id") % 100 == 0)
    want = direct_negatives(EDGE, 100)
    assert {400, 600} <= {w[0] for w in want}
    same(got.collect(), want)
    assert hard_negatives.op11_report(frame(spark, EDGE).limit(0)).count() == 0


def test_moved_labels(spark):
    rows = [(0, [1.0], 9), (7, [1.0], 8), (8, [0.9], 9), (100, [1.0], 0), (3, [0.5], 0), (4, [0.5], 5)]
    moved = [(i, e, (c + 1) % 10 if i % 7 == 0 else c) for i, e, c in rows]
    same(hard_negatives.op11_report(frame(spark, rows)).collect(), direct_negatives(moved, 100))
