"""Scores, leaderboards and run-log reports over the stand-in predictions / run log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from designlab.functions.numeric import round_to
from designlab.operators import board, metrics
from designlab.plans.registry import register
from designlab.plans.standins import (ACTIVATIONS, LOSSES, METRICS_SQL, OPTIMIZERS, PREDICTIONS_SQL,
                                      RUNLOG_CTES, predictions, run_log)
from designlab.plans.tables import table

FILE_NATION = 3
FILE_FILTER = f"results_nation_{FILE_NATION}.csv"
SCORE_METRICS = ("mae", "rmse", "r2", "median_ae")


def _composite_sql() -> str:
    mins = ", ".join(f"min({m}) AS mn_{m}, max({m}) AS mx_{m}" for m in ("mae", "rmse", "r2_inverted", "median_ae"))
    scaled = ", ".join(
        f"CASE WHEN {m} IS NULL THEN NULL WHEN mx_{m} = mn_{m} THEN 0.0 ELSE ({m} - mn_{m}) / (mx_{m} - mn_{m}) END AS s_{m}"
        for m in ("mae", "rmse", "r2_inverted", "median_ae"))
    return f"""{RUNLOG_CTES},
rl AS (SELECT *, 1 - r2 AS r2_inverted FROM runlog),
st AS (SELECT {mins} FROM rl),
sc AS (SELECT rl.*, {scaled} FROM rl, st),
comp AS (SELECT *, (s_mae + s_rmse + s_r2_inverted + s_median_ae) / 4.0 AS composite FROM sc)"""


COMPOSITE_CTES = _composite_sql()


@register("metrics_by_model", sql=f"""
WITH {PREDICTIONS_SQL},{METRICS_SQL}
SELECT model_name, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       round(mape, 6) AS mape, round(max_error, 6) AS max_error, round(median_ae, 6) AS median_ae
FROM metrics""", headline=True)
def metrics_by_model(spark, d):
    """MAE, RMSE, R2, MAPE, max error, median AE per model (exact median)."""
    return metrics.regression_metrics(predictions(spark, d), ["model_name"])


@register("mape_guarded", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n,
       count(*) FILTER (WHERE abs(l_discount) < 1e-8) AS n_skipped,
       round(avg(CASE WHEN abs(l_discount) >= 1e-8 THEN abs((l_discount - l_tax) / l_discount) END) * 100, 6) AS mape_guarded
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def mape_guarded(spark, d):
    """E6 guarded MAPE: targets with |y| < 1e-8 are skipped (target discount, prediction tax)."""
    li = table(spark, d, "lineitem")
    y, p = F.col("l_discount"), F.col("l_tax")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.abs(y) < 1e-8, F.lit(1))).alias("n_skipped"),
        (F.avg(F.when(F.abs(y) >= 1e-8, F.abs(F.try_divide(y - p, y)))) * 100).alias("mape_guarded"),
    )


@register("composite_leaderboard", sql=f"""{COMPOSITE_CTES}
SELECT model_name, data_file, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       round(median_ae, 6) AS median_ae, round(composite, 6) AS composite,
       row_number() OVER (ORDER BY composite NULLS LAST, model_name) AS rank
FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 10""", headline=True)
def composite_leaderboard(spark, d):
    """Flagship (E12, E13, G3): min-max scaled MAE, RMSE, 1-R2, median AE; mean; top 10."""
    scored = board.composite_score(run_log(spark, d))
    top = board.top_k(scored, "composite", 10)
    top = top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.asc_nulls_last("composite"), "model_name")).cast("long"))
    return top.select("model_name", "data_file", "mae", "rmse", "r2", "median_ae", "composite", "rank")


def _best_sql() -> str:
    parts = []
    for i, m in enumerate(SCORE_METRICS):
        order = f"{m} DESC" if m == "r2" else m
        parts.append(f"""(SELECT {i} AS metric_pos, '{m}' AS metric, model_name, mae, rmse, r2, median_ae,
                 {m} AS value FROM runlog WHERE {m} IS NOT NULL AND NOT isnan({m})
                 ORDER BY {order}, model_name LIMIT 1)""")
    return f"{RUNLOG_CTES},\nbest AS ({' UNION ALL '.join(parts)})"


BEST_CTES = _best_sql()


@register("best_per_metric", sql=f"""{BEST_CTES}
SELECT metric_pos, metric, model_name, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       round(median_ae, 6) AS median_ae, round(value, 6) AS value FROM best""")
def best_per_metric(spark, d):
    """Best model per metric in one aggregate pass (r2 descending, others ascending)."""
    return board.best_per_metric(run_log(spark, d), SCORE_METRICS)


@register("winners_merged", sql=f"""{BEST_CTES}
SELECT model_name, string_agg(metric, '/' ORDER BY metric_pos) AS labels, min(metric_pos) AS first_pos,
       'Best ' || upper(string_agg(metric, '/' ORDER BY metric_pos)) AS label
FROM best GROUP BY model_name""")
def winners_merged(spark, d):
    """One row per winning model, labels joined by '/'."""
    return board.winners_merged(board.best_per_metric(run_log(spark, d), SCORE_METRICS))


@register("topk_mae", sql=f"""{RUNLOG_CTES}
SELECT model_name, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM runlog
ORDER BY mae NULLS LAST, model_name LIMIT 15""")
def topk_mae(spark, d):
    """15 smallest MAE (TakeOrderedAndProject, NULL last, name breaks ties)."""
    return board.top_k(run_log(spark, d), "mae", 15).select("model_name", "mae", "r2")


@register("topk_r2", sql=f"""{RUNLOG_CTES}
SELECT model_name, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM runlog
ORDER BY r2 DESC NULLS LAST, model_name LIMIT 15""")
def topk_r2(spark, d):
    """15 largest R2."""
    return board.top_k(run_log(spark, d), "r2", 15, ascending=False).select("model_name", "mae", "r2")


def _rank_distance_sql() -> str:
    dists = ", ".join(
        (f"max(r2) OVER () - r2 AS r2_dist" if m == "r2" else f"{m} - min({m}) OVER () AS {m}_dist")
        for m in SCORE_METRICS)
    scaled = ", ".join(
        f"round(CASE WHEN max({m}_dist) OVER () = min({m}_dist) OVER () THEN 0.0 ELSE "
        f"({m}_dist - min({m}_dist) OVER ()) / (max({m}_dist) OVER () - min({m}_dist) OVER ()) END, 6) AS {m}_dist_scaled"
        for m in SCORE_METRICS)
    rounded = ", ".join(f"round({m}_dist, 6) AS {m}_dist" for m in SCORE_METRICS)
    return f"""{RUNLOG_CTES},
top AS (SELECT * FROM runlog ORDER BY mae NULLS LAST, model_name LIMIT 15),
dd AS (SELECT model_name, {dists} FROM top)
SELECT model_name, {rounded}, {scaled} FROM dd"""


@register("rank_distance", sql=_rank_distance_sql())
def rank_distance(spark, d):
    """distance from the best inside the top-15 frame, then scaled over the frame."""
    top = board.top_k(run_log(spark, d), "mae", 15)
    out = board.distance_from_best(top, SCORE_METRICS)
    return out.select("model_name", *[f"{m}_dist" for m in SCORE_METRICS],
                      *[f"{m}_dist_scaled" for m in SCORE_METRICS])


@register("model_ids", sql=f"""{RUNLOG_CTES}
SELECT printf('Model_%03d', row_number() OVER (ORDER BY log_seq, model_name) - 1) AS model_id,
       model_name, round(mae, 6) AS mae
FROM runlog WHERE data_file = '{FILE_FILTER}'""")
def model_ids(spark, d):
    """Filter one data file, number models Model_000.. in log order (distributed rank)."""
    log = run_log(spark, d, FILE_NATION).where(F.col("data_file") == FILE_FILTER)
    return board.readable_ids(log, ["log_seq", "model_name"]).select("model_id", "model_name", "mae")


@register("filter_file", sql=f"""{RUNLOG_CTES}
SELECT model_name, data_file, round(mae, 6) AS mae FROM runlog WHERE data_file = '{FILE_FILTER}'""")
def filter_file(spark, d):
    """Equality filter on data_file, which the scoring below it takes over."""
    return run_log(spark, d, FILE_NATION).where(F.col("data_file") == FILE_FILTER).select("model_name", "data_file", "mae")


@register("layer_units", sql=f"""{RUNLOG_CTES}
SELECT model_name, num_layers, layer_sizes,
       CAST(list_sum(CAST(layer_sizes AS INTEGER[])) AS BIGINT) AS total_units,
       round(mae, 6) AS mae FROM runlog""")
def layer_units(spark, d):
    """Parse '[a, b]' layer text and add total_units."""
    log = run_log(spark, d)
    return log.select("model_name", "num_layers", "layer_sizes",
                      board.total_units().alias("total_units"), "mae")


@register("scatter_pairs", sql=f"""{RUNLOG_CTES}
SELECT model_name, CAST(list_sum(CAST(layer_sizes AS INTEGER[])) AS BIGINT) AS total_units,
       round(mae, 6) AS mae, round(rmse, 6) AS rmse, learning_rate FROM runlog""")
def scatter_pairs(spark, d):
    """Metric / hyper-parameter pairs for scatter charts."""
    log = run_log(spark, d)
    return log.select("model_name", board.total_units().alias("total_units"), "mae", "rmse", "learning_rate")


@register("layer_matrix", sql=f"""{RUNLOG_CTES},
top AS (SELECT model_name, CAST(layer_sizes AS INTEGER[]) AS a FROM runlog
        ORDER BY mae NULLS LAST, model_name LIMIT 200),
mx AS (SELECT max(len(a)) AS m FROM top),
lay AS (SELECT model_name, a, unnest(range(1, m + 1)) AS layer FROM top, mx)
SELECT model_name, CAST(layer AS BIGINT) AS layer, CAST(nullif(a[layer], 0) AS BIGINT) AS units FROM lay""")
def layer_matrix(spark, d):
    """200 best by MAE, layer list padded to the longest, zero units -> NULL."""
    top = board.top_k(run_log(spark, d), "mae", 200)
    return board.layer_matrix(top, ["model_name"])


ONE_HOT = {"activation": ACTIVATIONS, "optimizer": OPTIMIZERS, "loss_function": LOSSES}


def _one_hot_sql() -> str:
    cols = ", ".join(f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, vs in ONE_HOT.items() for v in vs)
    return f"""{COMPOSITE_CTES}
SELECT model_name, batch_norm, {cols} FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 20"""


@register("one_hot", sql=_one_hot_sql())
def one_hot(spark, d):
    """Top 20 by composite; categorical columns one-hot, booleans pass through."""
    top = board.top_k(board.composite_score(run_log(spark, d)), "composite", 20)
    return board.one_hot(top, ONE_HOT, keep=["model_name", "batch_norm"])


MEAN_COLS = ("mae", "rmse", "r2", "median_ae", "num_layers", "learning_rate")


@register("top5_mean", sql=f"""{COMPOSITE_CTES},
top AS (SELECT * FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 5)
SELECT {", ".join(f"round(avg({c}), 6) AS {c}" for c in MEAN_COLS)} FROM top""")
def top5_mean(spark, d):
    """Mean of the top-5 rows over numeric columns."""
    top = board.top_k(board.composite_score(run_log(spark, d)), "composite", 5)
    return board.numeric_means(top, MEAN_COLS)


def _unpivot_sql(src: str, col: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS {col} FROM {src}" for c in MEAN_COLS)


@register("best_vs_top5", sql=f"""{COMPOSITE_CTES},
top AS (SELECT * FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 5),
best AS (SELECT * FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 1),
mean5 AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in MEAN_COLS)} FROM top),
a AS ({_unpivot_sql("best", "best")}),
b AS ({_unpivot_sql("mean5", "top5_mean")})
SELECT metric, round(best, 6) AS best, round(top5_mean, 6) AS top5_mean FROM a FULL JOIN b USING (metric)""")
def best_vs_top5(spark, d):
    """Best row beside the top-5 mean, paired by metric (full outer join)."""
    scored = board.composite_score(run_log(spark, d))
    best = board.unpivot_metrics(board.top_k(scored, "composite", 1).select(*MEAN_COLS), MEAN_COLS, "best")
    mean5 = board.unpivot_metrics(board.numeric_means(board.top_k(scored, "composite", 5), MEAN_COLS),
                                  MEAN_COLS, "top5_mean")
    return best.join(mean5, on="metric", how="full")


@register("top3_models", sql=f"""{COMPOSITE_CTES}
SELECT model_name, round(composite, 6) AS composite FROM comp ORDER BY composite NULLS LAST, model_name LIMIT 3""")
def top3_models(spark, d):
    """Three best models by composite."""
    return board.top_k(board.composite_score(run_log(spark, d)), "composite", 3).select("model_name", "composite")


@register("top20_models", sql=f"""{RUNLOG_CTES}
SELECT model_name, round(mae, 6) AS mae FROM runlog ORDER BY mae NULLS LAST, model_name LIMIT 20""")
def top20_models(spark, d):
    """20 best by MAE for curve charts."""
    return board.top_k(run_log(spark, d), "mae", 20).select("model_name", "mae")


@register("best_trial", sql=f"""{RUNLOG_CTES}
SELECT model_name, round(mae, 6) AS mae, num_layers, layer_sizes, activation, optimizer, loss_function,
       learning_rate, batch_norm FROM runlog ORDER BY mae NULLS LAST, model_name LIMIT 1""")
def best_trial(spark, d):
    """Best trial of a study by MAE with its parameters."""
    return board.top_k(run_log(spark, d), "mae", 1).select(
        "model_name", "mae", "num_layers", "layer_sizes", "activation", "optimizer", "loss_function",
        "learning_rate", "batch_norm")


@register("report_columns", sql=f"""{RUNLOG_CTES}
SELECT model_name, num_layers, layer_sizes, learning_rate, activation, round(mae, 6) AS mae,
       round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(1 - r2, 6) AS r2_inverted FROM runlog""")
def report_columns(spark, d):
    """Select / reorder named report columns, with 1 - r2."""
    log = run_log(spark, d)
    return log.select("model_name", "num_layers", "layer_sizes", "learning_rate", "activation",
                      "mae", "rmse", "r2", (1 - F.col("r2")).alias("r2_inverted"))


def _multi_sql() -> str:
    one = """SELECT l_returnflag, {i} AS output, count(*) AS n, avg(abs(y - p)) AS mae,
       sum((y - p) * (y - p)) / count(*) AS mse,
       CASE WHEN var_pop(y) * count(*) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
            ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
       avg(abs((y - p) / y)) * 100 AS mape, max(abs(y - p)) AS max_error, median(abs(y - p)) AS median_ae
  FROM (SELECT l_returnflag, {y} AS y, {p} AS p FROM lineitem JOIN part ON l_partkey = p_partkey)
  GROUP BY l_returnflag"""
    per = (one.format(i=0, y="l_extendedprice", p="l_quantity * p_retailprice") + " UNION ALL "
           + one.format(i=1, y="l_extendedprice / l_quantity", p="p_retailprice"))
    return f"""WITH per AS ({per})
SELECT l_returnflag, max(n) AS n, round(avg(mae), 6) AS mae, round(sqrt(avg(mse)), 6) AS rmse,
       round(avg(r2), 6) AS r2, round(avg(mape), 6) AS mape,
       round(max(CASE WHEN output = 0 THEN max_error END), 6) AS max_error,
       round(avg(median_ae), 6) AS median_ae
FROM per GROUP BY l_returnflag"""


@register("multi_output_metrics", sql=_multi_sql())
def multi_output_metrics(spark, d):
    """Two targets (line price, unit price), uniform average of per-output scores."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_quantity", "l_extendedprice")
    pt = table(spark, d, "part").select("p_partkey", "p_retailprice")
    j = li.join(pt, li.l_partkey == pt.p_partkey).select(
        "l_returnflag",
        F.col("l_extendedprice").alias("y0"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p0"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("y1"), F.col("p_retailprice").alias("p1"))
    return metrics.multi_output_metrics(j, [("y0", "p0"), ("y1", "p1")], ["l_returnflag"])


@register("best_epoch", sql="""
WITH h AS (
  SELECT user_id, date_diff('day', CAST((SELECT min(ts) FROM events) AS DATE), CAST(ts AS DATE)) AS epoch,
         avg(value) AS val_loss
  FROM events GROUP BY 1, 2)
SELECT user_id, round(min(val_loss), 6) AS val_loss_best, CAST(arg_min(epoch, (val_loss, epoch)) AS BIGINT) AS best_epoch
FROM h WHERE val_loss IS NOT NULL AND NOT isnan(val_loss) GROUP BY user_id""")
def best_epoch(spark, d):
    """History stand-in = daily mean of events.value per user; best loss and first epoch at it."""
    ev = table(spark, d, "events")
    first_day = ev.select(F.to_date(F.min("ts"))).scalar()
    hist = ev.groupBy("user_id", F.datediff(F.to_date("ts"), first_day).alias("epoch")).agg(
        F.avg("value").alias("val_loss"))
    return metrics.best_epoch(hist, ["user_id"])


# ---------------------------------------------------------------- metric lists of the original reports

def _best_list_sql(metrics_: tuple[str, ...]) -> str:
    parts = [f"""(SELECT {i} AS metric_pos, '{m}' AS metric, model_name, {m} AS value FROM runlog
                 WHERE {m} IS NOT NULL AND NOT isnan({m}) ORDER BY {m}{' DESC' if m == 'r2' else ''}, model_name LIMIT 1)"""
             for i, m in enumerate(metrics_)]
    return f"{RUNLOG_CTES},\nbest AS ({' UNION ALL '.join(parts)})"


@register("best_models", sql=f"""{_best_list_sql(board.BEST_FOUR)}
SELECT metric_pos, metric, model_name, round(value, 4) AS value FROM best""", digits=None)
def best_models(spark, d):
    """Best model by MAE, R2, RMSE and best validation loss."""
    return board.best_per_metric(run_log(spark, d)).select("metric_pos", "metric", "model_name", round_to("value", 4).alias("value"))


@register("best_models_seven", sql=f"""{_best_list_sql(board.BEST_SEVEN)}
SELECT metric_pos, metric, model_name, round(value, 4) AS value FROM best""", digits=None)
def best_models_seven(spark, d):
    """Best model by each of the seven logged metrics."""
    best = board.best_per_metric(run_log(spark, d), board.BEST_SEVEN)
    return best.select("metric_pos", "metric", "model_name", round_to("value", 4).alias("value"))


@register("best_models_merged", sql=f"""{_best_list_sql(board.BEST_FOUR)}
SELECT model_name, string_agg(metric, '/' ORDER BY metric_pos) AS labels, min(metric_pos) AS first_pos,
       'Best ' || upper(string_agg(metric, '/' ORDER BY metric_pos)) AS label
FROM best GROUP BY model_name""")
def best_models_merged(spark, d):
    """The winners of the four metrics, one row per model."""
    return board.winners_merged(board.best_per_metric(run_log(spark, d)))


def _six_sql() -> str:
    six = board.COMPOSITE_SIX
    stats = ", ".join(f"min({m}) AS mn_{m}, max({m}) AS mx_{m}" for m in six)
    scaled = ", ".join(f"CASE WHEN {m} IS NULL THEN NULL WHEN mx_{m} = mn_{m} THEN 0.0 "
                       f"ELSE ({m} - mn_{m}) / (mx_{m} - mn_{m}) END AS s_{m}" for m in six)
    total = " + ".join(f"coalesce(s_{m}, 0.0)" for m in six)
    count = " + ".join(f"(s_{m} IS NOT NULL)::INTEGER" for m in six)
    return f"""{RUNLOG_CTES},
st AS (SELECT {stats} FROM runlog),
sc AS (SELECT runlog.*, {scaled} FROM runlog, st)
SELECT model_name, round(({total}) / ({count}), 6) AS composite FROM sc ORDER BY ({total}) / ({count}) NULLS LAST, model_name LIMIT 10"""


@register("composite_six", sql=_six_sql())
def composite_six(spark, d):
    """Composite of MAE, RMSE, validation loss, MAPE, median AE and inference time; a missing one is left out."""
    scored = board.composite_score(run_log(spark, d), board.COMPOSITE_SIX)
    return board.top_k(scored, "composite", 10).select("model_name", "composite")


def _board_sql(metric: str) -> str:
    return f"""{RUNLOG_CTES}
SELECT model_name, round({metric}, 6) AS {metric} FROM runlog ORDER BY {metric} NULLS LAST, model_name LIMIT 15"""


@register("topk_rmse", sql=_board_sql("rmse"))
def topk_rmse(spark, d):
    """15 smallest RMSE."""
    return board.top_k(run_log(spark, d), "rmse", 15).select("model_name", "rmse")


@register("topk_median_ae", sql=_board_sql("median_ae"))
def topk_median_ae(spark, d):
    """15 smallest median absolute errors."""
    return board.top_k(run_log(spark, d), "median_ae", 15).select("model_name", "median_ae")


WIDE_MODELS = 12


@register("layer_matrix_wide", sql=f"""{RUNLOG_CTES},
top AS (SELECT row_number() OVER (ORDER BY mae NULLS LAST, model_name) AS rk, CAST(layer_sizes AS INTEGER[]) AS a FROM runlog
        QUALIFY rk <= {WIDE_MODELS}),
mx AS (SELECT max(len(a)) AS m FROM top)
SELECT CAST(layer AS BIGINT) AS layer, {", ".join(f"CAST(max(coalesce(a[layer], 0)) FILTER (WHERE rk = {i}) AS BIGINT) AS rank_{i}" for i in range(1, WIDE_MODELS + 1))}
FROM top, (SELECT unnest(range(1, m + 1)) AS layer FROM mx) GROUP BY layer""")
def layer_matrix_wide(spark, d):
    """Layer x rank matrix of the 12 best models, missing layers 0."""
    return board.layer_matrix_wide(board.top_k(run_log(spark, d), "mae", WIDE_MODELS), ["mae", "model_name"], WIDE_MODELS)


@register("mape_guarded_metrics", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(abs(l_discount - l_tax)), 6) AS mae,
       round(avg(CASE WHEN abs(l_discount) >= 1e-8 THEN abs((l_discount - l_tax) / l_discount) END) * 100, 6) AS mape
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def mape_guarded_metrics(spark, d):
    """The metric table with its guarded MAPE (targets with |y| < 1e-8 skipped)."""
    m = metrics.regression_metrics(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_discount", "l_tax", mape_eps=1e-8)
    return m.select("l_returnflag", "l_linestatus", "n", "mae", "mape")
