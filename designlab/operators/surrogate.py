"""Surrogate models with Spark ML: fit, score, persist, sweep, and plug-in predictors.

Scaling uses population statistics (one aggregate) baked into the pipeline as a
``SQLTransformer`` so the fitted ``PipelineModel`` carries it when saved.
Foreign predictors run in ``mapInPandas`` on Arrow batches, shipped once per
executor by a broadcast variable.
"""

from __future__ import annotations

import datetime as _dt
import functools
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from designlab.functions.numeric import nan_to_null
from designlab.operators.metrics import best_epoch, regression_metrics
from designlab.session import cut_lineage, measured


def scaler_stage(train: DataFrame, cols: Sequence[str], suffix: str = "_z") -> SQLTransformer:
    """Population-std standardisation fitted on ``train`` (std 0 -> 1), as a persistable stage.

    The statistics are one aggregate row (two numbers per column) read once.
    """
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    exprs = []
    for i, c in enumerate(cols):
        m = row[f"m{i}"] if row[f"m{i}"] is not None else 0.0
        s = row[f"s{i}"] if row[f"s{i}"] else 1.0
        exprs.append(f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def make_learner(kind: str = "linear", label: str = "y", features: str = "features", **params):
    """Regression learner.  linear (loss 'squaredError' | 'huber', regParam), gbt (lossType
    'squared' | 'absolute', optional validationIndicatorCol for early stopping, L8), rf."""
    if kind == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, **params)
    if kind == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, **params)
    if kind == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, **params)
    raise ValueError(f"unknown learner {kind}")


def fit_surrogate(train: DataFrame, inputs: Sequence[str], label: str, kind: str = "linear",
                  scale: bool = True, **params) -> PipelineModel:
    """Scaler (population std, train only) -> assembler -> learner; one model per output.

    Learners take no missing inputs, so training rows that lack one are left out; scoring keeps
    every row (see ``predict``).
    """
    train = train.na.drop("any", subset=[*inputs, label])
    stages = []
    feats = list(inputs)
    if scale:
        stages.append(scaler_stage(train, inputs))
        feats = [f"{c}_z" for c in inputs]
    stages.append(VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"))
    stages.append(make_learner(kind, label, **params))
    return Pipeline(stages=stages).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row of ``df`` with its prediction; NULL where an input is missing (NULL or NaN)."""
    lacks = F.exists(vector_to_array("features"), F.isnan)
    return model.transform(df).withColumn("prediction", F.when(~lacks, F.col("prediction")))


def score(model: PipelineModel, df: DataFrame, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """L9 + E3-E8: batch predict, then the metric table (rows without a prediction have no error)."""
    pred = predict(model, df).withColumnRenamed("prediction", "y_pred")
    return regression_metrics(pred.withColumn("y_true", F.col(label).cast("double")), group_cols)


def score_many(models: dict[str, PipelineModel], df: DataFrame, label: str, name_col: str = "model_name") -> DataFrame:
    """Score several fitted models on the same rows in one metric pass (one row per model).

    Predictions of all models are stacked with their name, so the exact median
    and every other metric come from a single grouped aggregate.
    """
    stacked = None
    for name, model in models.items():
        pred = predict(model, df).select(F.lit(name).alias(name_col), F.col(label).cast("double").alias("y_true"),
                                          F.col("prediction").alias("y_pred"))
        stacked = pred if stacked is None else stacked.unionByName(pred)
    return regression_metrics(stacked, [name_col])


def base_name(path: str) -> str:
    """Last part of a path."""
    return path.rstrip("/").rsplit("/", 1)[-1]


def base_name_of(col) -> Column:
    """I7 as a column: last part of a path, NULL for NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, r"([^/]*)/*$", 1)


def model_name(data_path: str, now: _dt.datetime | None = None) -> str:
    """A10: ``model_<file base>__yymmdd_HHMMSS``."""
    import os
    base = os.path.splitext(base_name(data_path))[0]
    return f"model_{base}__{(now or _dt.datetime.now()).strftime('%y%m%d_%H%M%S')}"


def save_model(model: PipelineModel, folder: str, name: str) -> str:
    """A10: persist the fitted pipeline (scaler included) under ``folder/name``."""
    path = f"{folder.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, name: str) -> PipelineModel:
    """Load a pipeline saved by ``save_model``."""
    return PipelineModel.load(f"{folder.rstrip('/')}/{name}")


def timed_inference(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, float]:
    """Per-row inference time in ms around a materialised scoring pass."""
    t0 = time.perf_counter()
    scored = predict(model, df)
    n = scored.select(F.count(F.col("prediction"))).first()[0]
    dt = time.perf_counter() - t0
    return scored, (dt / n * 1000.0) if n else float("nan")


def sweep(spark: SparkSession, train: DataFrame, test: DataFrame, inputs: Sequence[str], label: str,
          configs: Sequence[dict], parallelism: int = 4) -> DataFrame:
    """One fit + metrics + log row per configuration, several fits at once on a cached
    training set (driver threads submit concurrent Spark jobs)."""
    train = train.cache()

    def run(cfg: dict) -> dict:
        cfg = dict(cfg)
        kind = cfg.pop("kind", "linear")
        name = cfg.pop("name")
        t0 = time.perf_counter()
        model = fit_surrogate(train, inputs, label, kind, **cfg)
        dur = time.perf_counter() - t0
        m = score(model, test, label).first().asDict()
        return {"model_name": name, "learner": kind, "params": repr(sorted(cfg.items())),
                "training_duration": dur, **{k: (float(v) if v is not None else None) for k, v in m.items()}}

    # fits and their scoring jobs overlap across threads
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, configs))
    train.unpersist()
    schema = ("model_name string, learner string, params string, training_duration double, n double, "
              "mae double, rmse double, r2 double, mape double, max_error double, median_ae double")
    return spark.createDataFrame(pd.DataFrame(rows), schema=schema)


# ---------------------------------------------------------------- ridge settings from one Gram matrix

def gram(train: DataFrame, inputs: Sequence[str], label: str) -> dict:
    """Means, population standard deviations and covariances of inputs and label: one aggregate row.

    Rows that lack a value are left out.  Its size is the square of the number of inputs.
    """
    names = [*inputs, label]
    x = {c: F.col(f"`{c}`").cast("double") for c in names}
    rows = train.select(*[x[c].alias(f"_{i}") for i, c in enumerate(names)]).na.drop("any")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"_{i}").alias(f"m{i}") for i in range(len(names))],
                   *[F.covar_pop(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(names), len(names)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    return {"n": row["n"], "mean": np.array([row[f"m{i}"] or 0.0 for i in range(len(names))]), "cov": cov}


def ridge(stats: dict, reg: float) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of least squares with ``reg`` times the squared norm of the coefficients of
    the standardised inputs (population std, 0 -> 1), from ``gram``."""
    cov, mean = stats["cov"], stats["mean"]
    sd = np.sqrt(np.diag(cov)[:-1])
    sd[sd == 0] = 1.0
    corr = cov[:-1, :-1] / np.outer(sd, sd)
    b = np.linalg.lstsq(corr + reg * np.eye(len(sd)), cov[:-1, -1] / sd, rcond=None)[0] / sd
    return b, float(mean[-1] - b @ mean[:-1])


def ridge_sweep(split: DataFrame, inputs: Sequence[str], label: str, settings: dict[str, float],
                split_col: str = "split") -> DataFrame:
    """Every ridge setting (name -> strength) fitted on the train rows and scored on the others.

    The train rows are read once for one Gram matrix, from which each setting is solved exactly; the other
    rows once for the metrics of all settings.  One run-log row per setting: held-out metrics, and the mean
    squared error on the validation rows as ``val_loss_best``.
    """
    stats = gram(split.where(F.col(split_col) == "train"), inputs, label)
    fitted = {name: ridge(stats, reg) for name, reg in settings.items()}
    scored = apply_linear(fitted, split.where(F.col(split_col) != "train"), inputs).select(
        F.col(split_col).alias("_split"), "model_name", F.col(label).cast("double").alias("y_true"), "y_pred")
    by_split = measured(regression_metrics(scored, ["_split", "model_name"]))
    val = by_split.where(F.col("_split") == "val").select("model_name", (F.col("rmse") * F.col("rmse")).alias("val_loss_best"))
    return (by_split.where(F.col("_split") == "test").drop("_split").join(val, "model_name", "left")
            .withColumns({"optimizer": F.lit("ridge"), "loss_function": F.lit("squaredError"), "epochs": F.lit(1),
                          "best_epoch": F.lit(0), "num_features": F.lit(len(inputs)), "num_outputs": F.lit(1),
                          "early_stopping": F.lit(False)}))


def apply_linear(fitted: dict, df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with each fitted model's name and prediction (model_name, y_pred), without a join."""
    predictions = F.array(*[F.struct(F.lit(name).alias("model_name"), _linear(inputs, b, b0).alias("y_pred"))
                            for name, (b, b0) in fitted.items()])
    return df.withColumn("_p", F.explode(predictions)).select(*df.columns, "_p.*")


def _linear(inputs: Sequence[str], coefficients, intercept: float):
    """Linear formula; NULL where an input is missing (NULL or NaN)."""
    out = F.lit(float(intercept))
    for c, b in zip(inputs, coefficients, strict=True):
        out = out + nan_to_null(F.col(f"`{c}`").cast("double")) * F.lit(float(b))
    return out


# ---------------------------------------------------------------- validation history

def boosted_history(model: PipelineModel, val: DataFrame, loss: str = "squared") -> list[float]:
    """Validation loss after each boosting round of a fitted gradient-boosting pipeline."""
    rows = val
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    learner = model.stages[-1]
    rows = rows.where(F.col(learner.getLabelCol()).isNotNull() & ~F.exists(vector_to_array("features"), F.isnan))
    return [float(x) for x in learner.evaluateEachIteration(rows, loss)]


def fit_boosted(train: DataFrame, val: DataFrame, inputs: Sequence[str], label: str, rounds: int = 20,
                run_id: str = "run", **params) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees kept at their best validation round, and the loss table (run_id, epoch, val_loss).

    All rounds are fitted and scored on ``val`` (``metrics.best_epoch`` reads the table); boosting is
    sequential, so the rounds up to the best are fitted again as the model that is kept.
    """
    spark = train.sparkSession
    full = fit_surrogate(train, inputs, label, "gbt", maxIter=rounds, **params)
    losses = boosted_history(full, val, params.get("lossType", "squared"))
    history = spark.createDataFrame([(run_id, i, x) for i, x in enumerate(losses)], "run_id string, epoch int, val_loss double")
    best = best_epoch(history).first()
    keep = int(best["best_epoch"]) + 1 if best else rounds  # without validation rows every round is kept
    if keep < rounds:
        full = fit_surrogate(train, inputs, label, "gbt", maxIter=keep, **params)
    return full, history


# ---------------------------------------------------------------- J1

def plug_predict(df: DataFrame, predictor, inputs: Sequence[str], out_col: str = "y_pred",
                 transform: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """Apply any object with ``.predict(matrix)`` to Arrow batches of the input columns.

    The predictor is broadcast once; ``transform`` optionally scales the batch first.
    """
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(predictor)
    cols = list(inputs)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.DoubleType())])

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = bc.value
        for pdf in batches:
            x = pdf[cols]
            if transform is not None:
                x = transform(x)
            pdf[out_col] = pd.Series(model.predict(x.to_numpy(dtype=float)), index=pdf.index).astype(float)
            yield pdf
    return df.mapInPandas(fn, schema)


class LinearFormula:
    """Minimal predictor with ``.predict``: y = X @ coef + intercept (a stand-in foreign model)."""

    def __init__(self, coef: Sequence[float], intercept: float = 0.0):
        self.coef = [float(c) for c in coef]
        self.intercept = float(intercept)

    def predict(self, x):
        out = x[:, 0] * 0.0 + self.intercept
        for i, c in enumerate(self.coef):
            out = out + x[:, i] * c
        return out


# ---------------------------------------------------------------- train-and-log workflow

def build_and_train(spark: SparkSession, data: DataFrame, outputs: int | Sequence[str] = 1, kind: str = "linear",
                    row_key: Sequence[str] | None = None, **options) -> dict:
    """Whole training run on a results table: drop incomplete rows, take the last ``outputs`` columns (or
    the named ones) as outputs and the others as inputs, and hand over to ``train_and_log``."""
    from designlab.operators import clean

    data = clean.drop_incomplete(data)
    inputs, outs = clean.split_io(data, outputs)
    return train_and_log(spark, data, inputs, outs, list(row_key or data.columns), kind, **options)


def train_and_log(spark: SparkSession, data: DataFrame, inputs: Sequence[str], outs: Sequence[str], row_key: Sequence[str],
                  kind: str = "linear", test_size: float = 0.2, val_size: float = 0.1, group_key=None, seed: int = 42,
                  data_file: str = "data.csv", models_folder: str | None = None, log_path: str | None = None,
                  run_id: str | None = None, **params) -> dict:
    """Split (rows, or whole groups when ``group_key`` is given), fit one surrogate per output on the
    training rows (scaler fitted there too), score the held-out rows, optionally save the pipelines and
    write a run-log row.

    Boosted trees are kept at their best validation round.  A run that is repeated under the same ``run_id``
    replaces its log row.  Returns a dict with the fitted models, the metric table and the log row.
    """
    import datetime as dt

    from designlab.operators import prep
    from designlab.sources import files

    if group_key is not None:
        split = prep.group_split(data, group_key, test_size, val_size, seed)
    else:
        split = prep.row_split(data, row_key, test_size, val_size, seed)
    split = cut_lineage(split)  # every fit, the scores and the history read it
    train, val, test = (split.where(F.col("split") == x) for x in ("train", "val", "test"))
    rounds = int(params.get("maxIter", 20 if kind == "gbt" else 100))
    boosted = kind == "gbt"

    t0 = time.perf_counter()
    models, histories = {}, []
    for o in outs:
        if boosted:
            own = {k: v for k, v in params.items() if k not in ("maxIter", "validationIndicatorCol")}
            models[o], history = fit_boosted(train, val, inputs, o, rounds, run_id=o, **own)
            histories.append(history)
        else:
            models[o] = fit_surrogate(train, inputs, o, kind, **params)
    duration = time.perf_counter() - t0

    stacked = None
    inf_ms = []
    for o, m in models.items():
        inf_ms.append(timed_inference(m, test)[1])
        for name, rows in (("test", test), ("val", val)):
            part = predict(m, rows).select(F.lit(name).alias("rows"), F.lit(o).alias("output"),
                                           F.col(o).cast("double").alias("y_true"), F.col("prediction").alias("y_pred"))
            stacked = part if stacked is None else stacked.unionByName(part)
    both = measured(regression_metrics(stacked, ["rows", "output"]))
    per_output = both.where("rows = 'test'").drop("rows")
    summary = per_output.agg(F.avg("mae").alias("mae"), F.sqrt(F.avg(F.col("rmse") * F.col("rmse"))).alias("rmse"),
                             F.avg("r2").alias("r2"), F.avg("mape").alias("mape"),
                             F.max("max_error").alias("max_error"), F.avg("median_ae").alias("median_ae")).first()
    if histories:
        # the run's loss is the mean over its outputs, round by round
        history = functools.reduce(DataFrame.unionByName, histories).groupBy("epoch").agg(F.avg("val_loss").alias("val_loss"))
        best = best_epoch(history.withColumn("run_id", F.lit("run"))).first()
    else:
        best = both.where("rows = 'val'").agg(F.avg(F.col("rmse") * F.col("rmse")).alias("val_loss_best"),
                                              F.lit(0).cast("long").alias("best_epoch")).first()

    now = dt.datetime.now()
    name = model_name(data_file, now)
    if models_folder:
        for o, m in models.items():
            save_model(m, models_folder, name if len(models) == 1 else f"{name}__{o}")
    row = {"model_name": name, "data_file": base_name(data_file), "trained_at": now.replace(microsecond=0),
           "training_duration": duration, "num_features": len(inputs), "num_outputs": len(outs),
           "test_size": float(test_size), "loss_function": str(params.get("loss", params.get("lossType", "squaredError"))),
           "optimizer": kind, "inference_time_ms": float(sum(inf_ms) / len(inf_ms)),
           "learning_rate": float(params.get("stepSize", 0.1)) if boosted else None, "epochs": rounds,
           "early_stopping": boosted, "batch_norm": False,
           "val_loss_best": best and best["val_loss_best"], "best_epoch": best and int(best["best_epoch"]),
           **{k: (float(v) if v is not None else None) for k, v in summary.asDict().items()}}
    if log_path:
        fields = [f for f in files.RUN_LOG_SCHEMA.fields if f.name in row]
        rows = spark.createDataFrame([[row[f.name] for f in fields]], T.StructType(fields))
        files.append_run_log(spark, rows.withColumn("run_id", F.lit(run_id or name)), log_path)
    return {"models": models, "metrics": per_output, "log_row": row}


def saved_models(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the pipelines saved under ``folder`` (read from their metadata files)."""
    meta = spark.read.text(f"{folder.rstrip('/')}/*/metadata")
    return meta.select(F.regexp_extract(F.input_file_name(), r"/([^/]+)/metadata/[^/]*$", 1).alias("model_name")) \
        .where(F.col("model_name") != "").distinct()


def logged_with_artifacts(log: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Run-log rows whose model was saved (rows without an artifact are skipped)."""
    return log.join(saved_models(spark, folder), "model_name", "left_semi")
