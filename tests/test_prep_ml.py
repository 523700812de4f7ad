"""Splits, scaling, fitting and plug-in prediction."""

import math

import numpy as np
from pyspark.sql import functions as F

from designlab.operators import prep, surrogate


def test_row_split_exact_fractions(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s = {r["split"]: r["count"] for r in prep.row_split(df, ["k"], 0.2, 0.1, 42).groupBy("split").count().collect()}
    assert s["test"] == 200 and s["val"] == 800 - int(800 * 0.9) and s["train"] == int(800 * 0.9)


def test_group_split_no_shared_group(spark):
    df = spark.range(3000).select((F.col("id") % 97).alias("g"), F.col("id"))
    out = prep.group_split(df, "g", 0.2, 0.1, 42)
    per = out.groupBy("g").agg(F.countDistinct("split").alias("k"))
    assert per.where(F.col("k") > 1).count() == 0
    groups = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.countDistinct("g").alias("n")).collect()}
    assert groups["test"] == math.ceil(97 * 0.2) and groups["val"] == math.ceil((97 - 20) * 0.1)


def test_standardise_train_stats(spark):
    df = spark.createDataFrame([(float(x), 7.0) for x in range(10)], "a double, c double")
    st = prep.fit_standard(df, ["a", "c"])
    z = prep.apply_standard(df, st, ["a", "c"]).toPandas()
    assert abs(z["a_z"].mean()) < 1e-12 and abs(z["a_z"].std(ddof=0) - 1) < 1e-12
    assert (z["c_z"] == 0).all()


def test_linear_recovered(spark):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=400), rng.normal(size=400)
    y = 3 * x1 - 2 * x2 + 5
    df = spark.createDataFrame(list(zip(x1.tolist(), x2.tolist(), y.tolist())), "x1 double, x2 double, y double")
    model = surrogate.fit_surrogate(df, ["x1", "x2"], "y", "linear")
    m = surrogate.score(model, df, "y").first()
    assert m["mae"] < 1e-6 and m["r2"] > 0.999999


def test_plug_predict_and_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    out = surrogate.plug_predict(df, surrogate.LinearFormula([1.0, 10.0], 0.5), ["a", "b"]).collect()
    assert [r["y_pred"] for r in out] == [21.5, 43.5]
    train = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(50)], "x double, y double")
    model = surrogate.fit_surrogate(train, ["x"], "y")
    name = surrogate.model_name("/data/results_001.csv")
    assert name.startswith("model_results_001__")
    surrogate.save_model(model, tmp_dir, name)
    loaded = surrogate.load_model(tmp_dir, name)
    a = [r.prediction for r in model.transform(train).collect()]
    b = [r.prediction for r in loaded.transform(train).collect()]
    assert a == b
    log = spark.createDataFrame([(name, 0.1), ("model_gone__250101_000000", 0.2)], "model_name string, mae double")
    kept = [r.model_name for r in surrogate.logged_with_artifacts(log, spark, tmp_dir).collect()]
    assert kept == [name]


def test_splits_independent_of_partitioning(spark):
    base = spark.range(0, 2000, 1, 1).select((F.col("id") % 211).alias("g"), F.col("id"))
    a = sorted((r.id, r.split) for r in prep.row_split(base, ["id"], 0.2, 0.1, 7).collect())
    b = sorted((r.id, r.split) for r in prep.row_split(base.repartition(13), ["id"], 0.2, 0.1, 7).collect())
    assert a == b
    c = sorted((r.id, r.split) for r in prep.group_split(base, "g", 0.2, 0.1, 7).collect())
    d = sorted((r.id, r.split) for r in prep.group_split(base.repartition(9), "g", 0.2, 0.1, 7).collect())
    assert c == d


def test_build_and_train_logs_a_run(spark, tmp_dir):
    import os

    from designlab.sources import files
    rng = np.random.default_rng(5)
    x1, x2 = rng.uniform(0, 1, 300), rng.uniform(0, 1, 300)
    y = 2 * x1 + 3 * x2
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                               "sim long, x1 double, x2 double, y double")
    log = os.path.join(tmp_dir, "log")
    out = surrogate.build_and_train(spark, df.drop("sim"), outputs=1, kind="linear", data_file="res_001.csv",
                                    models_folder=os.path.join(tmp_dir, "models"), log_path=log)
    assert out["log_row"]["mae"] < 1e-6 and out["log_row"]["num_features"] == 2
    logged = files.read_run_log(spark, log).collect()
    assert len(logged) == 1 and logged[0]["model_name"].startswith("model_res_001__")
    gb = surrogate.build_and_train(spark, df, outputs=["y"], kind="gbt", group_key="sim", maxIter=5,
                                   validationIndicatorCol="v", seed=1)
    assert gb["metrics"].count() == 1


def test_build_and_train_two_outputs(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(2 * a), float(3 * a + 1)) for a in x], "x double, y1 double, y2 double")
    out = surrogate.build_and_train(spark, df, outputs=2, kind="linear")
    assert sorted(r.output for r in out["metrics"].collect()) == ["y1", "y2"]
    assert out["log_row"]["num_outputs"] == 2 and out["log_row"]["mae"] < 1e-6


def test_splits_move_no_rows_and_keep_copies_together(spark):
    df = spark.range(0, 600, 1, 6).select("id", (F.col("id") % 300).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("g"))
    for out in (prep.row_split(df, ["k"]), prep.group_split(df, "g")):
        # every row is still in the task that read it
        assert out.where(F.spark_partition_id() != F.floor(F.col("id") / 100)).count() == 0
    rows = prep.row_split(df, ["k"])
    assert rows.count() == 600
    assert rows.groupBy("k").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    groups = prep.group_split(df, "g")
    assert groups.where("g IS NULL").select("split").distinct().count() == 1
    for size in (0.0, 1.0):
        assert {r.split for r in prep.row_split(df, ["k"], size, 0.0).collect()} == {"test" if size else "train"}
    assert prep.row_split(df.limit(0), ["k"]).count() == 0


def test_ridge_from_gram_matches_direct_solution(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4)) * [1.0, 5.0, 0.1, 2.0] + [0, 3, -1, 10]
    x[:, 3] = 7.0  # a constant input has no say
    y = x @ [2.0, -1.0, 30.0, 0.0] + rng.normal(size=300)
    cols = ["a", "b", "c", "k"]
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)] + [(None, 1.0, 1.0, 7.0, 5.0), (1.0, 1.0, 1.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, y double")
    stats = surrogate.gram(df, cols, "y")
    assert stats["n"] == 300
    z = (x - x.mean(0))[:, :3] / x.std(0)[:3]
    for reg in (0.0, 0.1, 2.0):
        want = np.linalg.solve(z.T @ z / 300 + reg * np.eye(3), z.T @ (y - y.mean()) / 300) / x.std(0)[:3]
        got, intercept = surrogate.ridge(stats, reg)
        assert np.allclose(got, [*want, 0.0], atol=1e-9)
        assert abs(intercept - (y.mean() - want @ x.mean(0)[:3])) < 1e-9


def test_ridge_sweep_log_is_idempotent(spark, tmp_dir):
    from designlab.sources import files
    df = spark.range(500).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("y", 3 * F.col("a") - F.col("b") + F.sin("id"))
    split = prep.row_split(df, ["id"])
    rows = surrogate.ridge_sweep(split, ["a", "b"], "y", {"r0": 0.0, "r1": 1.0}).withColumn("data_file", F.lit("d.csv"))
    for part in (rows, rows, rows.where("model_name = 'r1'")):
        files.append_run_log(spark, part, tmp_dir + "/log")
    files.append_run_log(spark, rows.withColumn("run_id", F.concat(F.lit("again-"), "model_name")), tmp_dir + "/log")
    log = files.read_run_log(spark, tmp_dir + "/log").collect()
    assert sorted(r.model_name for r in log) == ["r0", "r0", "r1", "r1"]
    best = {r.model_name: r for r in log}
    assert best["r0"].rmse < best["r1"].rmse and best["r0"].val_loss_best < best["r1"].val_loss_best
    assert (best["r0"].epochs, best["r0"].best_epoch, best["r0"].num_features) == (1, 0, 2)
    test = split.where("split = 'test'").toPandas()
    b, b0 = surrogate.ridge(surrogate.gram(split.where("split = 'train'"), ["a", "b"], "y"), 1.0)
    assert abs(best["r1"].mae - np.abs(test["y"] - (test[["a", "b"]].to_numpy() @ b + b0)).mean()) < 1e-9


def test_boosted_history_keeps_the_best_round(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 1, 400)
    rows = [(float(v), float(np.sin(9 * v) + rng.normal(0, 0.6)), i % 4 == 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, held boolean").cache()
    train, val = df.where("not held"), df.where("held")
    model, history = surrogate.fit_boosted(train, val, ["x"], "y", rounds=12, run_id="g", maxDepth=5, stepSize=0.5, seed=3)
    losses = [r.val_loss for r in history.orderBy("epoch").collect()]
    assert len(losses) == 12
    best = int(np.argmin(losses))
    assert 0 < best + 1 < 12 and model.stages[-1].getNumTrees == best + 1
    p = surrogate.predict(model, val).toPandas()
    assert abs(((p["prediction"] - p["y"]) ** 2).mean() - losses[best]) < 1e-9
    from designlab.operators.metrics import best_epoch
    assert best_epoch(history).first().best_epoch == best


def test_training_run_writes_a_whole_log_row(spark, tmp_dir):
    from designlab.sources import files
    df = spark.range(300).select((F.col("id") % 23).cast("double").alias("a"), F.cos("id").alias("b"), (F.col("id") % 23 * 2 + F.sin("id")).alias("y"))
    for kind, options in (("linear", {}), ("gbt", {"maxIter": 4, "stepSize": 0.3, "seed": 1})):
        for _ in range(2):
            surrogate.build_and_train(spark, df, outputs=1, kind=kind, data_file="/x/res_7.csv", log_path=tmp_dir, run_id=f"run-{kind}", **options)
    log = {r.optimizer: r for r in files.read_run_log(spark, tmp_dir).collect()}
    assert len(log) == 2 and files.read_run_log(spark, tmp_dir).count() == 2
    assert log["gbt"].epochs == 4 and log["gbt"].learning_rate == 0.3 and 0 <= log["gbt"].best_epoch < 4 and log["gbt"].early_stopping
    for row in log.values():
        assert row.data_file == "res_7.csv" and row.val_loss_best > 0 and row.inference_time_ms > 0 and row.median_ae is not None
    paths = spark.createDataFrame([("/a/b/c.csv",), ("c.csv",), ("a/b/",), (None,)], "p string")
    assert [r[0] for r in paths.select(surrogate.base_name_of("p")).collect()] == ["c.csv", "c.csv", "b", None]
