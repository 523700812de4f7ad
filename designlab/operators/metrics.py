"""Regression scores (MAE, RMSE, R2, MAPE, max error, median AE) per group.

Everything except the median comes from one hash aggregate with map-side
partial aggregation; the median is exact by radix selection (or approximate
on request), so no group is ever gathered into one task and no row is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.functions.numeric import null_safe_join
from designlab.operators.select import exact_median, quantiles_of_keys, with_sort_key
from designlab.session import cut_lineage

METRIC_COLS = ("n", "mae", "rmse", "r2", "mape", "max_error", "median_ae")


def _ape(y, p):
    """Absolute percentage error term as numpy computes it (zero target -> inf, 0/0 -> NaN)."""
    err = y - p
    return (F.when(y == 0, F.when(err == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
            .otherwise(F.abs(F.try_divide(err, y))))


def metric_aggs(y_col: str = "y_true", p_col: str = "y_pred", mape_eps: float | None = None):
    """Aggregate expressions shared by every metric table (one pass)."""
    y, p = F.col(y_col), F.col(p_col)
    err = y - p
    if mape_eps is None:
        mape = F.avg(_ape(y, p)) * 100
    else:
        mape = F.avg(F.when(F.abs(y) >= mape_eps, F.abs(F.try_divide(err, y)))) * 100
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        mape.alias("mape"),
        F.max(F.abs(err)).alias("max_error"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    sse, sst = F.col("_sse"), F.col("_sst")
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - F.try_divide(sse, sst)))
    return (df.withColumn("rmse", F.sqrt(F.try_divide(sse, F.col("n").cast("double"))))
              .withColumn("r2", r2)
              .drop("_sse", "_sst"))


def regression_metrics(df: DataFrame, group_cols: Sequence[str] = (), y_col: str = "y_true",
                       p_col: str = "y_pred", mape_eps: float | None = None,
                       median_approx: bool = False) -> DataFrame:
    """One row per group: n, mae, rmse, r2, mape, max_error, median_ae.

    Rows whose target or prediction is NULL are skipped (pandas drops them first).
    ``mape_eps`` switches to the guarded MAPE that skips |y| < eps.
    """
    group_cols = list(group_cols)
    y, p = F.col(y_col).cast("double"), F.col(p_col).cast("double")
    data = df.where(y.isNotNull() & p.isNotNull()).select(*group_cols, y.alias(y_col), p.alias(p_col))
    if median_approx:
        med = exact_median(data.withColumn("_ae", F.abs(y - p)), "_ae", group_cols, "median_ae", approx=True)
    else:
        # scores and median read the same slim rows, so a costly input (a join) is evaluated once
        data = cut_lineage(with_sort_key(data, F.abs(F.col(y_col) - F.col(p_col))))
        med = quantiles_of_keys(data.where(F.col("_k").isNotNull()).select(*group_cols, "_k"), [0.5], group_cols, ["median_ae"])
    base = _finish(data.groupBy(*group_cols).agg(*metric_aggs(y_col, p_col, mape_eps)))
    if group_cols:
        out = null_safe_join(base, med, group_cols, "left")
    else:
        out = base.withColumn("median_ae", med.select("median_ae").scalar())
    return out.select(*group_cols, *METRIC_COLS)


def multi_output_metrics(df: DataFrame, outputs: Sequence[tuple[str, str]],
                         group_cols: Sequence[str] = (), mape_eps: float | None = None) -> DataFrame:
    """Uniform average over outputs, as scikit-learn's multioutput default does.

    ``outputs`` is a list of (target column, prediction column).  RMSE is the
    square root of the mean per-output MSE; max error is reported for the first
    output only (scikit-learn has no multi-output max error).
    """
    group_cols = list(group_cols)
    stacked = None
    for i, (y, p) in enumerate(outputs):
        part = df.select(*group_cols, F.lit(i).alias("output"),
                         F.col(y).cast("double").alias("y_true"), F.col(p).cast("double").alias("y_pred"))
        stacked = part if stacked is None else stacked.unionByName(part)
    per = regression_metrics(stacked, group_cols + ["output"], mape_eps=mape_eps)
    per = per.withColumn("mse", F.col("rmse") * F.col("rmse"))
    return per.groupBy(*group_cols).agg(
        F.max("n").alias("n"),
        F.avg("mae").alias("mae"),
        F.sqrt(F.avg("mse")).alias("rmse"),
        F.avg("r2").alias("r2"),
        F.avg("mape").alias("mape"),
        F.max(F.when(F.col("output") == 0, F.col("max_error"))).alias("max_error"),
        F.avg("median_ae").alias("median_ae"),
    )


def best_epoch(history: DataFrame, group_cols: Sequence[str] = ("run_id",),
               epoch_col: str = "epoch", loss_col: str = "val_loss") -> DataFrame:
    """Best validation loss and its epoch per run; the first epoch wins ties."""
    group_cols = list(group_cols)
    h = history.where(F.col(loss_col).isNotNull() & ~F.isnan(loss_col))
    return h.groupBy(*group_cols).agg(
        F.min(loss_col).alias("val_loss_best"),
        F.min_by(F.col(epoch_col), F.struct(F.col(loss_col), F.col(epoch_col))).cast("long").alias("best_epoch"),
    )
