"""Driver tables in the roles of experiment data.

The driver's tables hold no experiments, so each role is derived from them:

* predictions: lineitem joined to part; target ``l_extendedprice``, prediction
  ``l_quantity * p_retailprice``, model = supplier, sweep variable = quantity.
* run log: per-supplier scores of those predictions plus hyper-parameter
  columns derived from the supplier row.
* design / status / results: orders / orders with success = status 'F' / lineitem.

Every role has a Spark builder and the same definition as SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from designlab.operators.metrics import regression_metrics
from designlab.plans.tables import table
from designlab.session import cut_lineage

# Categorical hyper-parameter values of the stand-in run log (fixed values)
ACTIVATIONS = ("relu", "tanh", "elu", "selu")
OPTIMIZERS = ("Adam", "RMSprop", "SGD")
LOSSES = ("mse", "mae", "huber")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    return j.select(
        F.col("l_suppkey").alias("model_key"),
        F.format_string("model_%05d", F.col("l_suppkey")).alias("model_name"),
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("time_s"),
        F.col("l_extendedprice").alias("y_true"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("y_pred"),
    )


PREDICTIONS_SQL = """
predictions AS (
  SELECT l_suppkey AS model_key, printf('model_%05d', l_suppkey) AS model_name,
         l_orderkey, l_linenumber, l_quantity AS time_s, l_extendedprice AS y_true,
         l_quantity * p_retailprice AS y_pred
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _lit_array(values) -> F.Column:
    return F.array(*[F.lit(v) for v in values])


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def run_log(spark: SparkSession, sf_dir: str, nation: int | None = None) -> DataFrame:
    """One log row per supplier-model: scores + hyper-parameter columns; of one data file (``nation``), only
    that file's predictions are read and scored.

    The log is small (one row per model) but expensive (it scores every
    prediction), and reports read it several times (statistics subqueries,
    top-k, joins), so it is written once to the checkpoint folder.
    """
    return cut_lineage(_run_log(spark, sf_dir, nation))


def _run_log(spark: SparkSession, sf_dir: str, nation: int | None) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pred = predictions(spark, sf_dir)
    if nation is not None:
        sup = sup.where(F.col("s_nationkey") == nation)
        pred = pred.join(sup, pred.model_key == sup.s_suppkey, "left_semi")
    m = regression_metrics(pred, ["model_key", "model_name"])
    j = m.join(sup, m.model_key == sup.s_suppkey)
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    n_layers = (nk % 4 + 1).cast("int")
    sizes = F.transform(F.sequence(F.lit(1), n_layers), lambda i: (F.lit(16) * ((nk + i) % 8)).cast("int"))
    return j.select(
        "model_name",
        F.concat(F.lit("results_nation_"), nk.cast("string"), F.lit(".csv")).alias("data_file"),
        k.alias("log_seq"),
        n_layers.cast("long").alias("num_layers"),
        F.concat(F.lit("["), F.array_join(sizes, ", "), F.lit("]")).alias("layer_sizes"),
        F.element_at(_lit_array(ACTIVATIONS), (k % 4 + 1).cast("int")).alias("activation"),
        F.element_at(_lit_array(OPTIMIZERS), (k % 3 + 1).cast("int")).alias("optimizer"),
        F.element_at(_lit_array(LOSSES), (F.floor(k / 3) % 3 + 1).cast("int")).alias("loss_function"),
        F.pow(F.lit(10.0), -(k % 4 + 1).cast("double")).alias("learning_rate"),
        (k % 2 == 0).alias("batch_norm"),
        "n", "mae", "rmse", "r2", "mape", "max_error", "median_ae",
        # a tenth of the models have no validation loss
        F.when(k % 10 != 7, F.col("rmse") * F.col("rmse") * (0.9 + (k % 5) / 20.0)).alias("val_loss_best"),
        (F.lit(0.25) + (k * 7 % 11) / 16.0).alias("inference_time_ms"),
    )


METRICS_SQL = """
metrics AS (
  SELECT model_key, model_name, count(*) AS n,
         avg(abs(y_true - y_pred)) AS mae,
         sqrt(sum((y_true - y_pred) * (y_true - y_pred)) / count(*)) AS rmse,
         CASE WHEN var_pop(y_true) * count(*) = 0
              THEN CASE WHEN sum((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) END AS r2,
         avg(abs((y_true - y_pred) / y_true)) * 100 AS mape,
         max(abs(y_true - y_pred)) AS max_error,
         median(abs(y_true - y_pred)) AS median_ae
  FROM predictions GROUP BY model_key, model_name)"""

RUNLOG_SQL = f"""
runlog AS (
  SELECT model_name,
         'results_nation_' || CAST(s_nationkey AS VARCHAR) || '.csv' AS data_file,
         s_suppkey AS log_seq,
         CAST(s_nationkey % 4 + 1 AS BIGINT) AS num_layers,
         '[' || array_to_string(list_transform(range(1, s_nationkey % 4 + 2),
                                               lambda i: 16 * ((s_nationkey + i) % 8)), ', ') || ']' AS layer_sizes,
         ({_sql_list(ACTIVATIONS)})[s_suppkey % 4 + 1] AS activation,
         ({_sql_list(OPTIMIZERS)})[s_suppkey % 3 + 1] AS optimizer,
         ({_sql_list(LOSSES)})[CAST(floor(s_suppkey / 3) % 3 + 1 AS BIGINT)] AS loss_function,
         pow(10.0, -CAST(s_suppkey % 4 + 1 AS DOUBLE)) AS learning_rate,
         s_suppkey % 2 = 0 AS batch_norm,
         n, mae, rmse, r2, mape, max_error, median_ae,
         CASE WHEN s_suppkey % 10 <> 7 THEN rmse * rmse * (CAST(0.9 AS DOUBLE) + (s_suppkey % 5) / CAST(20.0 AS DOUBLE)) END AS val_loss_best,
         CAST(0.25 AS DOUBLE) + (s_suppkey * 7 % 11) / CAST(16.0 AS DOUBLE) AS inference_time_ms
  FROM metrics JOIN supplier ON model_key = s_suppkey)"""

RUNLOG_CTES = f"WITH {PREDICTIONS_SQL},{METRICS_SQL},{RUNLOG_SQL}"
