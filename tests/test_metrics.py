"""Regression metrics: hand fixtures (zero / constant target, single row, empty, NaN pair, two targets)."""

import math

import numpy as np

from designlab.operators.metrics import best_epoch, multi_output_metrics, regression_metrics


def _m(spark, rows, **kw):
    df = spark.createDataFrame(rows, "y_true double, y_pred double")
    return regression_metrics(df, **kw).first()


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(10, 3, 200)
    p = y + rng.normal(0, 1, 200)
    r = _m(spark, list(zip(y.tolist(), p.tolist())))
    e = y - p
    assert math.isclose(r["mae"], np.mean(np.abs(e)), rel_tol=1e-12)
    assert math.isclose(r["rmse"], np.sqrt(np.mean(e ** 2)), rel_tol=1e-12)
    assert math.isclose(r["r2"], 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2), rel_tol=1e-10)
    assert math.isclose(r["mape"], np.mean(np.abs(e / y)) * 100, rel_tol=1e-12)
    assert math.isclose(r["max_error"], np.max(np.abs(e)), rel_tol=1e-12)
    assert math.isclose(r["median_ae"], np.median(np.abs(e)), rel_tol=1e-12)


def test_zero_target_mape(spark):
    r = _m(spark, [(0.0, 1.0), (2.0, 2.0)])
    assert r["mape"] == float("inf")
    g = _m(spark, [(0.0, 1.0), (2.0, 1.0)], mape_eps=1e-8)
    assert g["mape"] == 50.0


def test_constant_target_r2(spark):
    assert _m(spark, [(3.0, 3.0), (3.0, 3.0)])["r2"] == 1.0
    assert _m(spark, [(3.0, 2.0), (3.0, 3.0)])["r2"] == 0.0


def test_single_row(spark):
    r = _m(spark, [(2.0, 1.0)])
    assert r["n"] == 1 and r["mae"] == 1.0 and r["median_ae"] == 1.0


def test_empty(spark):
    df = spark.createDataFrame([], "y_true double, y_pred double")
    r = regression_metrics(df).first()
    assert r["n"] == 0 and r["mae"] is None


def test_null_pair_skipped(spark):
    r = _m(spark, [(1.0, None), (2.0, 1.0)])
    assert r["n"] == 1


def test_two_targets(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0, 10.0), (3.0, 3.0, 20.0, 22.0)], "y0 double, p0 double, y1 double, p1 double")
    r = multi_output_metrics(df, [("y0", "p0"), ("y1", "p1")]).first()
    assert math.isclose(r["mae"], (0.5 + 1.0) / 2)
    assert math.isclose(r["rmse"], math.sqrt((0.5 + 2.0) / 2))
    assert r["max_error"] == 1.0


def test_best_epoch_first_tie(spark):
    h = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.2), (1, 2, 0.2), (2, 0, float("nan")), (2, 1, 0.9)],
                              "run_id int, epoch int, val_loss double")
    got = {r["run_id"]: (r["val_loss_best"], r["best_epoch"]) for r in best_epoch(h).collect()}
    assert got == {1: (0.2, 1), 2: (0.9, 1)}
