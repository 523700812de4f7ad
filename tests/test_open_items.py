"""Operators behind the report queries: fitted models on shared inputs, principal components, wide layers, space sink."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from designlab.operators import board, design, dist, space, surrogate


def test_apply_linear_keeps_every_row_and_model(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0), (3, float("nan"), 1.0)], "id int, a double, b double")
    out = surrogate.apply_linear({"x": (np.array([1.0, 10.0]), 0.5), "y": (np.array([0.0, 1.0]), 0.0)}, df, ["a", "b"])
    assert out.columns == ["id", "a", "b", "model_name", "y_pred"]
    got = {(r.id, r.model_name): r.y_pred for r in out.collect()}
    assert got == {(1, "x"): 32.5, (1, "y"): 3.0, (2, "x"): None, (2, "y"): None, (3, "x"): None, (3, "y"): None}


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3)) + 5
    rows = [tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0)]
    got = dist.pca(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(z.T @ z / 200)
    for r in got:
        v = vectors[:, 3 - r.pc]
        v = v * np.sign(v[np.abs(v).argmax()])
        assert abs(r.explained - values[3 - r.pc] / 3) < 1e-9
        assert abs(r.loading - v["abc".index(r.column)]) < 1e-7
    flat = spark.createDataFrame([(1.0, 2.0)] * 3, "a double, b double")
    assert [r.explained for r in dist.pca(flat, ["a", "b"]).where("column = 'a'").collect()] == [0.5, 0.5]


def test_layer_matrix_wide(spark):
    df = spark.createDataFrame([("m2", 0.2, "[8, 4]"), ("m1", 0.1, "[16]"), ("m3", 0.3, "[2, 0, 1]")],
                               "model_name string, mae double, layer_sizes string")
    got = board.layer_matrix_wide(df, ["mae"], 3).orderBy("layer").collect()
    assert [tuple(r) for r in got] == [(1, 16, 8, 2), (2, 0, 4, 0), (3, 0, 0, 1)]


def test_space_file_round_trip(spark, tmp_dir):
    rows = [(1, "T", [30.0, 50.0], "degC", None, 10.0, 20.0, {"i0": [1.0]}), (0, "W", [1.0], "um", "m", 1e-6, 0.0, None),
            (2, "derived", None, None, None, 1.0, 0.0, None)]
    schema = ("pos int, name string, values array<double>, unit string, convert_to string, scaling_factor double, offset double, "
              "linked map<string, array<double>>")
    space.write_space(spark.createDataFrame(rows, schema), tmp_dir + "/s")
    back = space.read_space(spark, tmp_dir + "/s")
    assert [tuple(r)[1:7] for r in back.orderBy("pos").collect()] == [r[1:7] for r in sorted(rows)]
    levels = {r.name: r.levels for r in space.scaled_levels(back).collect()}
    assert levels == {"T": [320.0, 520.0], "W": [1e-6]}  # a parameter without values is left out
    assert space.scaled_levels(back).where(F.col("name") == "T").first().linked == {"i0": [1.0]}


def test_closest_pair_and_early_abandon():
    rng = np.random.default_rng(12)
    for n, d in ((2, 1), (3, 2), (50, 3), (400, 10), (300, 1)):
        x = rng.uniform(size=(n, d)) * rng.uniform(0.01, 1000, d)
        diff = x[:, None] - x[None]
        want = np.sqrt((diff * diff).sum(-1))[np.triu_indices(n, 1)].min()
        assert design.closest_pair(x) == want
        assert design.closest_pair(x, want / 2) == want
        assert design.closest_pair(x, want * 2) <= want * 2
    assert design.closest_pair(np.zeros((1, 3))) == np.inf
    assert design.closest_pair(np.zeros((5, 3))) == 0.0


def test_maximin_of_many_points_has_the_same_candidates_in_both_scales(spark):
    bounds = {"a": (0.0, 1.0), "b": (0.0, 1000.0), "c": (5.0, 5.0)}
    for scale in ("physical", "unit"):
        got = design.maximin_lhs_generated(spark, bounds, samples=12, iterations=30, seed=4, num_partitions=3, scale=scale)
        lows, widths = np.array([0.0, 0.0, 5.0]), np.array([1.0, 1000.0, 0.0])
        unit = np.array([1.0, 1000.0, 1.0]) if scale == "unit" else np.ones(3)
        score = [design.closest_pair(design._candidate_lhs(it, 4, 12, lows, widths) / unit) for it in range(30)]
        row = got.first()
        assert row.iteration == int(np.argmax(score)) and row.min_dist == max(score)
    big = design.maximin_lhs_generated(spark, {f"x{i}": (0.0, 1.0) for i in range(6)}, samples=2000, iterations=8, seed=1)
    assert big.count() == 2000 and big.first().min_dist > 0


def test_scrambled_sobol_is_a_net(spark):
    names = {f"x{i}": (0.0, 1.0) for i in range(10)}
    ids = spark.range(0, 512, 1, 3).withColumnRenamed("id", "design_id")
    pdf = design.sobol_scrambled(ids, names, seed=7).toPandas()
    for n in names:  # 2^k points: one in each interval of length 2^-k, for every k
        for k in (1, 4, 9):
            part = pdf[pdf["design_id"] < 2 ** k][n].to_numpy()
            assert sorted(np.floor(part * 2 ** k).astype(int)) == list(range(2 ** k))
    # the first two dimensions: one point in every elementary box
    for k in range(10):
        boxes = np.floor(pdf["x0"] * 2 ** k) * 2 ** 9 + np.floor(pdf["x1"] * 2 ** (9 - k))
        assert boxes.nunique() == 512
    other = design.sobol_scrambled(ids, names, seed=8).toPandas()
    shift = np.abs(other["x0"] - pdf["x0"])
    assert shift.nunique() > 100  # not one digital shift
    far = spark.createDataFrame([(2 ** 40,), (2 ** 52 - 1,), (None,)], "design_id long")
    rows = design.sobol_scrambled(far, {"x0": (0.0, 1.0)}).collect()
    assert all(0 <= r.x0 < 1 for r in rows[:2]) and rows[2].x0 is None
    with pytest.raises(Exception, match="Sobol index"):
        design.sobol_scrambled(spark.createDataFrame([(2 ** 52,)], "design_id long"), {"x0": (0.0, 1.0)}).collect()


@pytest.mark.parametrize("block", [2048, 40])
def test_all_pairs_histogram(spark, block):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 5)) * [1, 2, 3, 4, 0] + 1
    rows = [([float(v) for v in r],) for r in x] + [(None,), ([1.0, None, 1.0, 1.0, 1.0],), ([1.0, float("nan"), 1.0, 1.0, 1.0],)]
    got = dist.all_pairs_hist(spark.createDataFrame(rows, "e array<double>"), "e", 12, block_rows=block).orderBy("bin").collect()
    sd = x.std(0)
    z = (x - x.mean(0)) / np.where(sd == 0, 1, sd)
    d = np.sqrt(((z[:, None] - z[None]) ** 2).sum(-1))[np.triu_indices(150, 1)]
    count, edges = np.histogram(d, 12)
    assert [r["count"] for r in got] == count.tolist()
    assert np.allclose([r.lo_edge for r in got], edges[:-1]) and abs(got[-1].hi_edge - edges[-1]) < 1e-9
    assert sum(r.share for r in got) == pytest.approx(1) and all(r.se == 0 for r in got)
    assert dist.all_pairs_hist(spark.createDataFrame(rows[:1], "e array<double>"), "e", 12).count() == 0


def test_pairs_inside_random_blocks_estimate_the_histogram(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(2000, 3))
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "e array<double>")
    whole = {r.bin: r.share for r in dist.all_pairs_hist(df, "e", 8).collect()}
    part = dist.all_pairs_hist(df, "e", 8, diagonal=True, block_rows=100).orderBy("bin").collect()
    assert 0 < sum(r["count"] for r in part) < 2000 * 110
    # the bins differ a little: each estimate's own range is used
    edges = {r.bin: r.lo_edge for r in dist.all_pairs_hist(df, "e", 8).collect()}
    d = np.sqrt((((x - x.mean(0)) / x.std(0))[:, None] - ((x - x.mean(0)) / x.std(0))[None]) ** 2 @ np.ones(3))
    d = d[np.triu_indices(2000, 1)]
    for r in part:
        want = ((d >= r.lo_edge) & (d < r.hi_edge)).mean()
        assert r.se > 0 or r["count"] == 0
        assert abs(r.share - want) <= 5 * r.se + 1e-3
    assert len(whole) == len(edges) == 8


def test_all_pairs_are_not_shuffled(spark):
    x = np.random.default_rng(5).normal(size=(120, 3))
    cells = dist._pair_cells(spark.createDataFrame([([float(v) for v in r],) for r in x], "z array<double>"), False, 10)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    found = [(r.i, r.j, r.n_i * r.n_j if r.i < r.j else r.n_i * (r.n_i - 1) // 2) for r in cells.collect()]
    assert len({c[:2] for c in found}) == len(found) and all(i <= j for i, j, _ in found)
    assert sum(c[2] for c in found) == 120 * 119 // 2


def _pair_tables():
    rng = np.random.default_rng(17)
    plain = rng.normal(size=(700, 24))
    twice = plain.copy()
    twice[rng.random(700) < 0.4] = plain[0]
    far = rng.standard_cauchy(size=(700, 5))
    close = np.repeat(plain[:70], 10, axis=0) + 1e-9 * rng.normal(size=(700, 24))
    for x in (plain, twice, far, close, rng.integers(0, 3, size=(700, 3)).astype(float), np.eye(700)):
        yield (x - x.mean(0)) / np.where(x.std(0) == 0, 1, x.std(0))


@pytest.mark.parametrize("bins", [1, 30, 400])
def test_cells_of_products_give_the_counts_of_the_distances(bins, monkeypatch):
    monkeypatch.setattr(dist, "PAIR_TILE", (64, 200))
    for z in _pair_tables():
        cells = [(z[:300], None), (z[300:], None), (z[:300], z[300:])]
        d = [np.sqrt(((x[r + 1:] if y is None else y) - x[r]) ** 2 @ np.ones(z.shape[1])) for x, y in cells for r in range(len(x))]
        lo, hi = np.inf, 0.0
        for cell in cells:
            lo, hi = dist._widened(*cell, lo, hi)
        assert np.allclose([lo, hi], [min(v.min(initial=np.inf) for v in d), max(v.max(initial=0) for v in d)], rtol=1e-12, atol=1e-12)
        for x, y in cells:
            want = np.zeros(bins, np.int64)
            for r in range(len(x)):
                v = (x[r + 1:] if y is None else y) - x[r]
                v = np.sqrt((v * v).sum(axis=1))
                at = np.clip(np.floor((v - lo) * (bins / (hi - lo))), 0, bins - 1).astype(np.int64)
                want += np.bincount(at, minlength=bins)
            assert dist._bin_counts(x, y, lo, hi, bins).tolist() == want.tolist()


def test_products_leave_few_distances_to_form(monkeypatch):
    formed, form = [], dist._distances

    def noted(*args):
        formed.append(len(args[-1]))
        return form(*args)

    monkeypatch.setattr(dist, "_distances", noted)
    x = np.random.default_rng(23).normal(size=(1500, 64))
    lo, hi = dist._widened(x, None, np.inf, 0.0)
    assert dist._bin_counts(x, None, lo, hi, 30).sum() == 1500 * 1499 // 2
    assert 0 < sum(formed) < 1500 * 1499 // 2 / 100


def test_large_tables_have_larger_blocks(spark):
    rows = spark.createDataFrame([([float(v)],) for v in range(600)], "z array<double>")
    cells = dist._pair_cells(rows, False, 2)  # 300 blocks would give 45,150 cells
    n = cells.selectExpr("count(*)", "sum(if(i < j, n_i * n_j, n_i * (n_i - 1) / 2))").first()
    assert n[0] <= 64 * 65 // 2 and n[1] == 600 * 599 // 2
    assert dist._pair_cells(rows, True, 2).agg({"n_i": "avg"}).first()[0] < 4
