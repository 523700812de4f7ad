"""Surrogate-model queries: fits, scoring, persistence, sweeps, plug-in predictors, curves, log union."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from designlab.functions.numeric import bind_stats, round_to
from designlab.operators import board, clean, dist, prep, surrogate
from designlab.plans.q_prep import ROW_SPLIT_SQL
from designlab.plans.registry import register
from designlab.plans.standins import PREDICTIONS_SQL, RUNLOG_CTES, predictions, run_log
from designlab.plans.tables import table
from designlab.session import checkpoint_dir, cut_lineage
from designlab.sources import files

SEED = 42
ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
INPUTS = ("l_quantity", "l_discount", "l_tax")
LABEL = "l_extendedprice"

# Plug-in predictor of the stand-in (fixed values): price = 900 + 1000 q - 20000 discount + 5000 tax
PLUG_COEF = (1000.0, -20000.0, 5000.0)
PLUG_INTERCEPT = 900.0
# Constant inputs of the response curve (fixed values)
CURVE_CONSTANTS = {"l_discount": 0.05, "l_tax": 0.04}


def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _plug_sql(q: str, d: str, t: str) -> str:
    c = PLUG_COEF
    return (f"((({q} * {_f(0.0)} + {_f(PLUG_INTERCEPT)}) + {q} * {_f(c[0])}) + {d} * {_f(c[1])}) "
            f"+ {t} * {_f(c[2])}")


def _split(spark, d):
    li = table(spark, d, "lineitem").select(*ROW_KEY, *INPUTS, LABEL)
    return prep.row_split(li, ROW_KEY, 0.2, 0.1, SEED)


@register("linear_fit", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, count(*) AS n FROM lineitem""")
def linear_fit(spark, d):
    """L7 (single input): ordinary least squares through Spark ML's normal-equation solver."""
    li = table(spark, d, "lineitem").select("l_quantity", LABEL)
    va = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    m = LinearRegression(featuresCol="features", labelCol=LABEL, solver="normal", regParam=0.0,
                         standardization=False).fit(va)
    return li.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(float(m.coefficients[0])).alias("slope"), F.lit(float(m.intercept)).alias("intercept"), "n")


@register("fit_score")
def fit_score(spark, d):
    """Linear, huber, early-stopped GBT and forest surrogates fitted on train rows,
    scored on the held-out test rows (one metric row per learner)."""
    split = cut_lineage(_split(spark, d))
    train = split.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    test = split.where(F.col("split") == "test")
    fits = {
        "linear": surrogate.fit_surrogate(train.where(~F.col("is_val")), INPUTS, LABEL, "linear"),
        "huber": surrogate.fit_surrogate(train.where(~F.col("is_val")), INPUTS, LABEL, "linear",
                                         loss="huber", regParam=0.01),
        "gbt": surrogate.fit_surrogate(train, INPUTS, LABEL, "gbt", maxIter=20, maxDepth=4,
                                       validationIndicatorCol="is_val", validationTol=0.001, seed=SEED),
        "rf": surrogate.fit_surrogate(train.where(~F.col("is_val")), INPUTS, LABEL, "rf",
                                      numTrees=10, maxDepth=6, seed=SEED),
    }
    out = surrogate.score_many(fits, test, LABEL, "learner")
    return out.select("learner", "n", "mae", "rmse", "r2", "mape", "max_error", "median_ae")


@register("pca_2d")
def pca_2d(spark, d):
    """Embeddings standardised with population std, first two principal components,
    each flipped so its largest absolute loading is positive."""
    emb = table(spark, d, "embeddings")
    vec = emb.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    st = vec.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()["s"]
    n = float(st["count"])
    mean = [float(x) for x in st["mean"]]
    sd = [float((v * (n - 1) / n) ** 0.5) if n > 1 else 0.0 for v in st["variance"]]
    sd = [s if s > 0 else 1.0 for s in sd]          # parameter-sized: one value per dimension
    m_arr = F.array(*[F.lit(x) for x in mean])
    s_arr = F.array(*[F.lit(x) for x in sd])
    z = emb.select("vec_id", "label", F.zip_with(F.zip_with(F.col("embedding").cast("array<double>"), m_arr,
                                                            lambda x, m: x - m), s_arr, lambda x, s: x / s).alias("z"))
    model = PCA(k=2, inputCol="zv", outputCol="pc").fit(z.select(array_to_vector("z").alias("zv")))
    pcs = model.pc.toArray()
    cols = []
    for k in range(2):
        v = pcs[:, k]
        sign = 1.0 if v[abs(v).argmax()] >= 0 else -1.0
        w = F.array(*[F.lit(float(sign * x)) for x in v])
        cols.append(F.aggregate(F.zip_with("z", w, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
                    .alias(f"pc{k + 1}"))
    return z.select("vec_id", "label", *cols)


RIDGE = {f"ridge_{reg}": reg for reg in (0.0, 0.001, 0.01, 0.03, 0.1, 0.3, 1.0, 10.0)}


def _ridge_sql(settings: dict[str, float]) -> str:
    """CTEs ending in ``sc`` (model_name, split, y_true, y_pred): the 3 x 3 ridge system solved by determinants."""
    x = INPUTS
    one = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}, covar_pop({c}, {LABEL}) / stddev_pop({c}) AS c{i}"
                    for i, c in enumerate(x, 1))
    two = ", ".join(f"corr({x[i]}, {x[j]}) AS r{i + 1}{j + 1}" for i, j in ((0, 1), (0, 2), (1, 2)))
    pred = " + ".join(f"b{i} * ({c} - m{i}) / s{i}" for i, c in enumerate(x, 1))
    return f"""{ROW_SPLIT_SQL},
cfg AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {_f(1.0 + reg)})" for n, reg in settings.items())}) t(model_name, a)),
tr AS (SELECT {one}, {two}, avg({LABEL}) AS my FROM rs WHERE split = 'train'),
de AS (SELECT *, a * (a * a - r23 * r23) - r12 * (r12 * a - r23 * r13) + r13 * (r12 * r23 - a * r13) AS det FROM tr, cfg),
be AS (SELECT *, (c1 * (a * a - r23 * r23) - r12 * (c2 * a - r23 * c3) + r13 * (c2 * r23 - a * c3)) / det AS b1,
              (a * (c2 * a - r23 * c3) - c1 * (r12 * a - r23 * r13) + r13 * (r12 * c3 - c2 * r13)) / det AS b2,
              (a * (a * c3 - c2 * r23) - r12 * (r12 * c3 - c2 * r13) + c1 * (r12 * r23 - a * r13)) / det AS b3 FROM de),
sc AS (SELECT model_name, split, {LABEL} AS y_true, my + {pred} AS y_pred FROM rs, be WHERE split <> 'train'),
me AS (SELECT model_name, count(*) AS n, avg(abs(y_true - y_pred)) AS mae, sqrt(avg(pow(y_true - y_pred, 2))) AS rmse,
              1 - sum(pow(y_true - y_pred, 2)) / (var_pop(y_true) * count(*)) AS r2,
              avg(abs((y_true - y_pred) / y_true)) * 100 AS mape, max(abs(y_true - y_pred)) AS max_error,
              median(abs(y_true - y_pred)) AS median_ae FROM sc WHERE split = 'test' GROUP BY model_name),
va AS (SELECT model_name, avg(pow(y_true - y_pred, 2)) AS val_loss_best FROM sc WHERE split = 'val' GROUP BY model_name)"""


LOGGED = ("mae", "rmse", "r2", "mape", "max_error", "median_ae")
DIGITS = {"r2": 8}
LOGGED_SQL = ", ".join(f"round({c}, {DIGITS.get(c, 4)}) AS {c}" for c in LOGGED) + ", round(val_loss_best / 1000.0, 3) AS val_loss_best_k"


def _logged(log):
    return [round_to(c, DIGITS.get(c, 4)).alias(c) for c in LOGGED] + [round_to(F.col("val_loss_best") / 1000.0, 3).alias("val_loss_best_k")]


@register("sweep", sql=f"""WITH {_ridge_sql(RIDGE)}
SELECT model_name, 'lineitem.parquet' AS data_file, 'ridge' AS optimizer, 3 AS num_features, 1 AS epochs, 0 AS best_epoch, {LOGGED_SQL}
FROM me JOIN va USING (model_name)""", digits=None)
def sweep(spark, d):
    """Eight ridge settings from one Gram matrix, logged twice under their run ids as a retried
    sweep would, and read back: one full log row per setting."""
    rows = surrogate.ridge_sweep(cut_lineage(_split(spark, d)), INPUTS, LABEL, RIDGE)
    rows = rows.withColumn("data_file", F.lit("lineitem.parquet")).withColumn("run_id", F.concat(F.lit("sweep-"), "model_name"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex[:8]}"
    files.append_run_log(spark, rows, path)
    files.append_run_log(spark, rows.where("model_name < 'ridge_0.1'"), path)
    log = files.read_run_log(spark, path)
    return log.select("model_name", "data_file", "optimizer", "num_features", "epochs", "best_epoch", *_logged(log))


@register("train_log", sql=f"""WITH {_ridge_sql({"linear": 0.0})}
SELECT 'lineitem.parquet' AS data_file, 'linear' AS optimizer, 3 AS num_features, 1 AS num_outputs, 100 AS epochs, 0 AS best_epoch,
       CAST(0.2 AS DOUBLE) AS test_size, {LOGGED_SQL} FROM me JOIN va USING (model_name)""", digits=None)
def train_log(spark, d):
    """A whole training run on a linear surrogate; its log row read back."""
    li = table(spark, d, "lineitem").select(*ROW_KEY, *INPUTS, LABEL)
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex[:8]}"
    surrogate.train_and_log(spark, li, INPUTS, [LABEL], ROW_KEY, data_file=f"{d}/lineitem.parquet", log_path=path, run_id="train")
    log = files.read_run_log(spark, path)
    return log.select("data_file", "optimizer", "num_features", "num_outputs", "epochs", "best_epoch", "test_size", *_logged(log))


CHOSEN = {"ridge_0.0": 0.0, "ridge_0.1": 0.1, "ridge_1.0": 1.0}


@register("fitted_models_by_inputs", sql=f"""WITH {_ridge_sql(CHOSEN)},
x AS (SELECT DISTINCT {", ".join(INPUTS)} FROM lineitem)
SELECT model_name, {", ".join(f"x.{c}" for c in INPUTS)},
       round(my + {" + ".join(f"b{i} * (x.{c} - m{i}) / s{i}" for i, c in enumerate(INPUTS, 1))}, 4) AS y_pred FROM x, be""", digits=None)
def fitted_models_by_inputs(spark, d):
    """Three fitted models applied to one shared input table (every distinct input of lineitem)."""
    stats = surrogate.gram(_split(spark, d).where("split = 'train'"), INPUTS, LABEL)
    x = table(spark, d, "lineitem").select(*INPUTS).distinct()
    out = surrogate.apply_linear({n: surrogate.ridge(stats, reg) for n, reg in CHOSEN.items()}, x, INPUTS)
    return out.select("model_name", *INPUTS, round_to("y_pred", 4).alias("y_pred"))


@register("pca_loadings", sql="""
WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
SELECT pc, "column", round(CASE WHEN pc = 1 THEN (1 + r) / 2 ELSE (1 - r) / 2 END, 6) AS explained, round(sqrt(0.5), 6) AS loading
FROM r, (VALUES (1), (2)) p(pc), (VALUES ('l_extendedprice'), ('l_quantity')) c("column")""")
def pca_loadings(spark, d):
    """Explained variance and absolute loadings of the principal components of two standardised columns."""
    out = dist.pca(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("pc", "column", "explained", F.abs("loading").alias("loading"))


@register("model_roundtrip")
def model_roundtrip(spark, d):
    """Save the fitted pipeline under model_<base>__yymmdd_HHMMSS in the
    shared folder, load it back, time per-row inference, and score held-out rows."""
    split = cut_lineage(_split(spark, d))
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    model = surrogate.fit_surrogate(train, INPUTS, LABEL, "linear")
    name = surrogate.model_name(f"{d}/lineitem.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex[:8]}"
    surrogate.save_model(model, folder, name)
    loaded = surrogate.load_model(folder, name)
    scored, ms = surrogate.timed_inference(loaded, test)
    m = surrogate.score(loaded, test, LABEL)
    same = model.transform(test).select(*ROW_KEY, F.col("prediction").alias("p0")).join(
        scored.select(*ROW_KEY, F.col("prediction").alias("p1")), list(ROW_KEY)).agg(
        F.max(F.abs(F.col("p0") - F.col("p1"))).alias("max_diff"))
    return m.select(F.lit(name).alias("model_name"), "n", "mae", "rmse", "r2",
                    F.lit(ms).alias("inference_time_ms")).withColumn("max_diff", same.scalar())


@register("solver_csv")
def solver_csv(spark, d):
    """A5: lineitem written as a solver export ('%' preamble, last comment line = header) into the
    shared folder, then read back with the header taken from the preamble."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/solver-{uuid.uuid4().hex[:8]}"
    cols = [*INPUTS, LABEL]
    table(spark, d, "lineitem").select(*cols).write.mode("overwrite").csv(f"{folder}/body")
    preamble = ["% Model,lineitem", "% Version,6.3", "% Date,\"Jan 1 2025, 00:00\"", "% Dimension,1",
                f"% Expressions,{len(cols)}", "% Description,stand-in export", "% " + ",".join(cols)]
    spark.createDataFrame([(x,) for x in preamble], "value string").coalesce(1).write.mode("overwrite").text(
        f"{folder}/preamble")
    return files.read_solver_csv(spark, [f"{folder}/preamble", f"{folder}/body"])


@register("plug_predict", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round({_plug_sql('l_quantity', 'l_discount', 'l_tax')}, 6) AS y_pred FROM lineitem""")
def plug_predict(spark, d):
    """A foreign predictor object with .predict applied to Arrow batches (mapInPandas)."""
    li = table(spark, d, "lineitem").select(*ROW_KEY, *INPUTS)
    model = surrogate.LinearFormula(PLUG_COEF, PLUG_INTERCEPT)
    return surrogate.plug_predict(li, model, INPUTS).select(*ROW_KEY, "y_pred")


@register("fixed_input_curve", sql=f"""
SELECT l_quantity, {_f(CURVE_CONSTANTS['l_discount'])} AS l_discount, {_f(CURVE_CONSTANTS['l_tax'])} AS l_tax,
       round({_plug_sql('l_quantity', _f(CURVE_CONSTANTS['l_discount']), _f(CURVE_CONSTANTS['l_tax']))}, 6) AS y_pred
FROM (SELECT DISTINCT l_quantity FROM lineitem)""")
def fixed_input_curve(spark, d):
    """Response over the observed sweep values with the other inputs held constant."""
    sweep_vals = table(spark, d, "lineitem").select("l_quantity").distinct()
    x = clean.fixed_inputs(sweep_vals, CURVE_CONSTANTS, "l_quantity", list(INPUTS))
    model = surrogate.LinearFormula(PLUG_COEF, PLUG_INTERCEPT)
    return surrogate.plug_predict(x, model, INPUTS)


def _composite_top(spark, d, k):
    return board.top_k(board.composite_score(run_log(spark, d)), "composite", k)


@register("models_by_inputs", sql=f"""{RUNLOG_CTES},
rl AS (SELECT *, 1 - r2 AS r2_inverted FROM runlog),
st AS (SELECT min(mae) mn1, max(mae) mx1, min(rmse) mn2, max(rmse) mx2, min(r2_inverted) mn3, max(r2_inverted) mx3,
              min(median_ae) mn4, max(median_ae) mx4 FROM rl),
sc AS (SELECT rl.*, ((CASE WHEN mx1 = mn1 THEN 0.0 ELSE (mae - mn1) / (mx1 - mn1) END)
                    + (CASE WHEN mx2 = mn2 THEN 0.0 ELSE (rmse - mn2) / (mx2 - mn2) END)
                    + (CASE WHEN mx3 = mn3 THEN 0.0 ELSE (r2_inverted - mn3) / (mx3 - mn3) END)
                    + (CASE WHEN mx4 = mn4 THEN 0.0 ELSE (median_ae - mn4) / (mx4 - mn4) END)) / 4.0 AS composite FROM rl, st),
top AS (SELECT model_name, mae, median_ae FROM sc ORDER BY composite NULLS LAST, model_name LIMIT 3)
SELECT model_name, l_quantity, round(mae + (median_ae / 10.0) * l_quantity, 6) AS y_pred
FROM top, (SELECT DISTINCT l_quantity FROM lineitem)""")
def models_by_inputs(spark, d):
    """Each of the three best models (stand-in predictor y = mae + median_ae/10 * q) applied to one
    shared input table; the bounded model list rides along as one bound array, no join."""
    top = _composite_top(spark, d, 3).select("model_name", "mae", "median_ae")
    models = top.agg(F.collect_list(F.struct("model_name", "mae", "median_ae")).alias("models"))
    x = bind_stats(table(spark, d, "lineitem").select("l_quantity").distinct(), models, "_m")
    x = x.select("l_quantity", F.explode("_m.models").alias("m"))
    return x.select(F.col("m.model_name").alias("model_name"), "l_quantity",
                    (F.col("m.mae") + (F.col("m.median_ae") / 10.0) * F.col("l_quantity")).alias("y_pred"))


@register("curve_overlay", sql=f"""
WITH {PREDICTIONS_SQL}
SELECT time_s, round(avg(y_true), 6) AS y_sim, round(avg(y_pred), 6) AS y_model, count(*) AS n
FROM predictions GROUP BY time_s""")
def curve_overlay(spark, d):
    """Simulated curve beside the predicted one at the same sweep value (one aggregate)."""
    return predictions(spark, d).groupBy("time_s").agg(
        F.avg("y_true").alias("y_sim"), F.avg("y_pred").alias("y_model"), F.count(F.lit(1)).alias("n"))


@register("log_union", sql=f"""{RUNLOG_CTES},
old AS (SELECT model_name, data_file, mae FROM runlog),
new AS (SELECT model_name || '_retrained' AS model_name, data_file, mae, batch_norm FROM runlog
        WHERE model_name IN (SELECT model_name FROM runlog ORDER BY mae NULLS LAST, model_name LIMIT 3))
SELECT model_name, data_file, round(mae, 6) AS mae, coalesce(batch_norm, false) AS batch_norm
FROM (SELECT * FROM old UNION ALL BY NAME SELECT * FROM new)""")
def log_union(spark, d):
    """A log written before ``batch_norm`` existed, unioned by name with new rows that
    carry it; the missing column is filled with its default (false)."""
    log = run_log(spark, d)
    old = log.select("model_name", "data_file", "mae")
    new = board.top_k(log, "mae", 3).select(F.concat(F.col("model_name"), F.lit("_retrained")).alias("model_name"),
                                           "data_file", "mae", "batch_norm")
    return files.union_logs(old, new, {"batch_norm": False}).select("model_name", "data_file", "mae", "batch_norm")


@register("error_rows", sql=f"""
WITH {PREDICTIONS_SQL}
SELECT model_name, l_orderkey, l_linenumber, round(time_s / 10.0, 6) AS current, round(y_pred - y_true, 6) AS signed_error,
       round(y_true - y_pred, 6) AS residual, round(abs(y_true - y_pred), 6) AS abs_error
FROM predictions ORDER BY abs(y_true - y_pred), model_name, l_orderkey, l_linenumber""")
def error_rows(spark, d):
    """Signed error, residual, absolute error and time/10 per prediction, ordered by |error|."""
    p = predictions(spark, d)
    return p.select("model_name", "l_orderkey", "l_linenumber", (F.col("time_s") / 10.0).alias("current"),
                    (F.col("y_pred") - F.col("y_true")).alias("signed_error"),
                    (F.col("y_true") - F.col("y_pred")).alias("residual"),
                    F.abs(F.col("y_true") - F.col("y_pred")).alias("abs_error")) \
        .orderBy("abs_error", "model_name", "l_orderkey", "l_linenumber")


@register("dense_curve_scored", sql=f"""
WITH t AS (SELECT l_discount, l_tax, min(l_quantity) AS t_min, max(l_quantity) AS t_max FROM lineitem GROUP BY 1, 2),
p AS (SELECT l_discount, l_tax, i, CASE WHEN i = 199 THEN t_max ELSE t_min + i * ((t_max - t_min) / 199.0) END AS t
      FROM t, range(200) r(i))
SELECT l_discount, l_tax, i, round(t, 6) AS t, round({_plug_sql('t', 'l_discount', 'l_tax')}, 6) AS y_pred FROM p""")
def dense_curve_scored(spark, d):
    """200 evenly spaced sweep values between each trial's min and max, its inputs fixed, scored
    by the plug-in predictor."""
    from designlab.operators import dist
    tr = dist.trial_ranges(table(spark, d, "lineitem"), ("l_discount", "l_tax"), "l_quantity")
    pts = dist.dense_curves(tr, ("l_discount", "l_tax"), 200)
    model = surrogate.LinearFormula(PLUG_COEF, PLUG_INTERCEPT)
    return surrogate.plug_predict(pts, model, ["t", "l_discount", "l_tax"]).select(
        "l_discount", "l_tax", "i", "t", "y_pred")


@register("csv_scan", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount,
       l_extendedprice FROM lineitem""")
def csv_scan(spark, d):
    """A3: lineitem written as a header CSV (zero discounts written as the token 'NA') into the shared
    folder, read back with an explicit schema: NA tokens and empty cells become NULL."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex[:8]}"
    li = table(spark, d, "lineitem")
    li.select("l_orderkey", "l_linenumber", "l_quantity",
              F.when(F.col("l_discount") == 0, F.lit("NA")).otherwise(F.col("l_discount").cast("string")).alias("l_discount"),
              "l_extendedprice").write.mode("overwrite").option("header", True).csv(folder)
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, l_extendedprice double"
    return files.read_csv(spark, folder, schema)
