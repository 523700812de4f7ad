"""Scaling, composite, top-k, bins and groups (FIXTURES 8)."""

import numpy as np
from pyspark.sql import functions as F

from designlab.operators import board, dist


def test_minmax_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, c double")
    rows = board.minmax_scale(df, ["a", "c"]).collect()
    assert [r["a_scaled"] for r in rows] == [0.0, 1.0, None]
    assert [r["c_scaled"] for r in rows] == [0.0, 0.0, 0.0]


def test_topk_ties_and_null(spark):
    df = spark.createDataFrame([("m3", 1.0), ("m1", 1.0), ("m0", None), ("m2", 2.0)], "model_name string, mae double")
    assert [r.model_name for r in board.top_k(df, "mae", 4).collect()] == ["m1", "m3", "m2", "m0"]


def test_best_per_metric_and_winners(spark):
    df = spark.createDataFrame([("a", 1.0, 0.9), ("b", 2.0, 0.95), ("c", None, None)], "model_name string, mae double, r2 double")
    best = board.best_per_metric(df, ["mae", "r2"])
    got = {r.metric: r.model_name for r in best.collect()}
    assert got == {"mae": "a", "r2": "b"}
    w = {r.model_name: (r.labels, r.label) for r in board.winners_merged(best).collect()}
    assert w == {"a": ("mae", "Best MAE"), "b": ("r2", "Best R2")}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (5.0,)], "x double")
    h = dist.histogram(df, "x", 10).orderBy("bin").collect()
    counts, edges = np.histogram([0.0, 1.0, 10.0, 5.0], bins=10)
    assert [r["count"] for r in h] == counts.tolist()
    assert np.allclose([r["lo_edge"] for r in h], edges[:-1])
    const = dist.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).collect()
    assert sum(r["count"] for r in const) == 2


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (2.0, 4.0), (3.0, 9.0), (5.0, 7.0)], "x double, y double")
    out = {r["bin"]: (r["n"], r["median"]) for r in dist.right_closed_bins(df, "x", "y", 0.0, 3.0, 4).collect()}
    # (0,1] -> x=1 ; (1,2] -> x=2 ; (2,3] -> x=3 ; 0 (left edge) and 5 (outside) are dropped
    assert out == {1: (1, 2.0), 2: (1, 4.0), 3: (1, 9.0)}


def test_box_stats_groups(spark):
    rows = [("a", float(v)) for v in range(1, 11)] + [("a", 100.0), ("b", 3.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    st, outl = dist.box_stats(df, "g", "v")
    s = {r["g"]: r for r in st.collect()}
    assert s["a"]["n_outliers"] == 1 and s["a"]["whisker_hi"] == 10.0
    assert s["b"]["q1"] == s["b"]["q3"] == 3.0
    assert outl.count() == 1


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(0, 1, 500)], "x double")
    k = dist.kde_1d(df, "x", grid=400).orderBy("i").toPandas()
    area = np.trapezoid(k["density"], k["x"]) if hasattr(np, "trapezoid") else np.trapz(k["density"], k["x"])
    assert abs(area - 1.0) < 1e-3


def test_hexbin_counts_all_points(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(0, 1, (300, 2))], "x double, y double")
    h = dist.hexbin(df, "x", "y", 10)
    assert h.agg(F.sum("count")).first()[0] == 300


def _hexbin_reference(x, y, gridsize):
    # matplotlib's two-lattice assignment written directly in numpy
    nx = gridsize
    ny = int(nx / np.sqrt(3))
    xmin, xmax, ymin, ymax = x.min(), x.max(), y.min(), y.max()
    pad = 1e-9 * (xmax - xmin)
    xmin, xmax = xmin - pad, xmax + pad
    sx, sy = (xmax - xmin) / nx, (ymax - ymin) / ny
    ix, iy = (x - xmin) / sx, (y - ymin) / sy
    ix1, iy1 = np.round(ix), np.round(iy)
    ix2, iy2 = np.floor(ix), np.floor(iy)
    d1 = (ix - ix1) ** 2 + 3.0 * (iy - iy1) ** 2
    d2 = (ix - ix2 - 0.5) ** 2 + 3.0 * (iy - iy2 - 0.5) ** 2
    first = d1 < d2
    cells = {}
    for f, a, b, c, d in zip(first, ix1, iy1, ix2, iy2):
        key = (1, int(a), int(b)) if f else (2, int(c), int(d))
        cells[key] = cells.get(key, 0) + 1
    return cells


def test_hexbin_matches_direct_formula(spark):
    rng = np.random.default_rng(4)
    pts = rng.normal(0, 1, (500, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "x double, y double")
    got = {(r.lattice, r.i, r.j): r["count"] for r in dist.hexbin(df, "x", "y", 12).collect()}
    assert got == _hexbin_reference(pts[:, 0], pts[:, 1], 12)


def test_search_draws_bounds_and_determinism(spark):
    from designlab.operators import search
    t = spark.range(2000).withColumnRenamed("id", "trial")
    u = search.u(1, "p", F.col("trial"))
    df = t.select(search.draw_int(u, 1, 8).alias("i"), search.draw_log_uniform(u, 1e-5, 5e-2).alias("lr"),
                  search.draw_log_int(u, 16, 512).alias("units"), search.draw_choice(u, ["a", "b", "c"]).alias("c"),
                  search.draw_step_int(u, 16, 256, 16).alias("s")).toPandas()
    assert df["i"].between(1, 8).all() and set(df["i"]) == set(range(1, 9))
    assert df["lr"].between(1e-5, 5e-2).all()
    assert df["units"].between(16, 512).all()
    assert set(df["c"]) == {"a", "b", "c"}
    assert (df["s"] % 16 == 0).all() and df["s"].between(16, 256).all()
    again = t.select(search.draw_int(u, 1, 8).alias("i")).toPandas()
    assert (again["i"] == df["i"]).all()
    grid = search.product_table(spark, {"a": [1, 2], "b": ["x", "y", "z"]})
    assert grid.count() == 6
    assert search.seeded_sample(grid, 4, "config_id", 3).count() == 4


def test_layer_matrix_zero_and_null(spark):
    df = spark.createDataFrame([("a", "[8, 0, 4]"), ("b", "[16]")], "model_name string, layer_sizes string")
    want = {False: [8, None, 4, 16, None, None], True: [8, 0, 4, 16, 0, 0]}
    for fill, units in want.items():
        rows = board.layer_matrix(df, ["model_name"], fill=fill).orderBy("model_name", "layer").collect()
        assert [r.units for r in rows] == units


def _density(x, grid, cut=3.0):
    n, sd = len(x), np.std(x, ddof=1)
    bw = sd * n ** -0.2
    g = np.linspace(x.min() - cut * bw, x.max() + cut * bw, grid)
    k = np.exp(-0.5 * ((g[:, None] - x[None, :]) / bw) ** 2).sum(1)
    return g, k / (n * bw * np.sqrt(2 * np.pi)), bw


def test_binned_kde_stays_within_its_bound(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.normal(0, 3, 900)] + [(None, float(v)) for v in rng.exponential(2, 500)] \
        + [("tied", 1.0)] * 50 + [("one", 2.0)] + [("b", 1.0)] * 400 + [("b", float(v)) for v in rng.uniform(0, 100, 30)] \
        + [("a", float("nan")), ("a", None), ("a", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {}
    for r in dist.kde_1d(df, "v", 60, group="g").collect():
        got.setdefault(r.g, {})[r.i] = (r.x, r.density)
    assert set(got) == {"a", "b", None}  # a group without spread has no density
    whole = {r.i: (r.x, r.density) for r in dist.kde_1d(df, "v", 60).collect()}
    for g, points in [*got.items(), ("whole", whole)]:
        x = np.array([v for k, v in rows if (g == "whole" or k == g) and v is not None and np.isfinite(v)])
        at, want, bw = _density(x, 60)
        assert np.allclose([points[i][0] for i in range(60)], at)
        error = np.abs(np.array([points[i][1] for i in range(60)]) - want).max()
        assert error <= 1 / (8 * dist.KDE_BINS ** 2) / (bw * np.sqrt(2 * np.pi))


def test_binned_kde_2d_stays_within_its_bound(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 2, 400)
    y = 0.8 * x + rng.normal(0, 0.5, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)] + [(None, 1.0)], "x double, y double")
    got = {(r.i, r.j): r for r in dist.kde_2d(df, "x", "y", 20).collect()}
    cov = np.cov(x, y) * 400 ** (-1 / 3)
    inv, norm = np.linalg.inv(cov), 400 * 2 * np.pi * np.sqrt(np.linalg.det(cov))
    assert len(got) == 400
    for (i, j), r in got.items():
        d = np.stack([r.x - x, r.y - y])
        want = np.exp(-0.5 * np.einsum("an,ab,bn->n", d, inv, d)).sum() / norm
        assert abs(r.density - want) <= 400 / (4 * dist.KDE_BINS_2D ** 2) / norm


def test_outlier_rows_keep_their_columns_and_null_groups(spark):
    rows = [(i, "a", float(i % 7)) for i in range(70)] + [(100, "a", 99.0), (101, None, 5.0), (102, None, 5.0), (103, None, -40.0)]
    rows += [(200 + i, None, 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    stats, out = dist.box_stats(df, "g", "x")
    assert sorted((r.id, r.g, r.x) for r in out.collect()) == [(100, "a", 99.0), (103, None, -40.0)]
    assert {r.g: r.n_outliers for r in stats.collect()} == {"a": 1, None: 1}
