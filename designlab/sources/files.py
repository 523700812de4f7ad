"""Sources and sinks at the edges: CSV (plain, unit-tagged, solver), design exports, run logs, models.

Readers always take an explicit schema where the layout is known (no
inference pass); sinks are Spark writers, never a driver-side file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from designlab.functions.numeric import bind_stats, nans_to_nulls, sig6
from designlab.operators.clean import unit_split

# Missing-value tokens pandas reads as NA (fixed values)
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, comment: str | None = None,
             observe: Observation | None = None) -> DataFrame:
    """A3: header CSV with an explicit schema; NA tokens and NaN become NULL.

    A cell that is no value of its column's type becomes NULL; ``observe`` gets their number per column
    (``bad_<column>``) in the pass that computes the result.
    """
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if comment:
        r = r.option("comment", comment)
    text_schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    raw = r.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in text_schema.fields])).csv(path)
    cols, bad = [], []
    for f in text_schema.fields:
        c = F.trim(F.col(f"`{f.name}`"))
        c = F.when(~c.isin(*NA_TOKENS), c)
        typed = c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        bad.append(F.count(F.when(c.isNotNull() & typed.isNull(), 1)).alias(f"bad_{f.name}"))
    if observe is not None:
        raw = raw.observe(observe, *bad)
    return nans_to_nulls(raw.select(*cols))


def read_unit_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: unit-tagged CSV read as text, cells stripped of ``[unit]``, units moved to the header."""
    raw = spark.read.option("header", True).csv(path)
    return unit_split(raw)


def solver_header(spark: SparkSession, path: str | list[str], comment: str = "%") -> list[str]:
    """A5: column names = the last comment line of the preamble.

    Only the files' first lines are read: the preamble ends with the first line that is no comment.
    """
    import itertools
    import re
    text = spark.read.text(path if isinstance(path, str) else path[0])
    n, lines = 256, []
    while not lines or (len(lines) == n // 4 and lines[-1].startswith(comment)):
        lines = [r.value for r in text.take(n)]
        n *= 4
    last = [*itertools.takewhile(lambda line: line.startswith(comment), lines)][-1]
    body = last.lstrip(comment).strip()
    return [c for c in re.split(r"\s{2,}|,|\t", body) if c]


def read_solver_csv(spark: SparkSession, path: str | list[str], comment: str = "%", sep: str = ",") -> DataFrame:
    """A5: solver output with ``%`` comment preamble; numeric body typed as double."""
    names = solver_header(spark, path, comment)
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return nans_to_nulls(spark.read.option("comment", comment).option("sep", sep).schema(schema).csv(path))


def design_text(design: DataFrame, units: dict[str, str | None], keep: Sequence[str] = ("design_id",)) -> DataFrame:
    """Columns with a unit become ``%.6g[unit]`` text, unitless columns stay numeric."""
    cols = [F.col(k) for k in keep if k in design.columns]
    for c in design.columns:
        if c in keep:
            continue
        u = units.get(c)
        cols.append(F.concat(sig6(c), F.lit(f"[{u}]")).alias(c) if u else F.col(c))
    return design.select(*cols)


def write_design_csv(design: DataFrame, units: dict[str, str | None], path: str,
                     order_col: str = "design_id") -> None:
    """A6 sink: unit-tagged design CSV with header, rows in design order."""
    text = design_text(design, units).orderBy(order_col).drop(order_col)
    text.write.mode("overwrite").option("header", True).csv(path)


LIST_SEP = ", "


def param_values(design: DataFrame, units: dict[str, str | None], params: Sequence[str],
                 order_col: str = "design_id", legacy_round: bool = False) -> DataFrame:
    """Transposed parameter list ``name "v1, v2, ..." [unit]`` in pieces, one per value: (pos, param,
    order column, piece).

    The pieces of a parameter in design order, joined by ``, ``, are its list: the first piece has the name
    before it, the last the unit behind it.  ``legacy_round`` rounds to 6 decimals before formatting (the
    original's precision loss); the default keeps 6 significant digits.
    """
    ends = design.agg(F.min(order_col).alias("first"), F.max(order_col).alias("last"))
    rows = bind_stats(design.select(order_col, *params), ends, "_ends")
    stacked = rows.select(order_col, "_ends", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(p).alias("param"), F.lit(units.get(p) or "").alias("unit"),
                 F.col(p).cast("double").alias("v")) for i, p in enumerate(params)])).alias("_s")).select(order_col, "_ends", "_s.*")
    # numpy's round: rint(v * 1e6) / 1e6 (half to even on the binary value)
    v = F.bround(F.col("v") * F.lit(1e6), 0) / F.lit(1e6) if legacy_round else F.col("v")
    head = F.when(F.col(order_col) == F.col("_ends.first"), F.concat("param", F.lit(' "'))).otherwise("")
    tail = F.when(F.col(order_col) == F.col("_ends.last"), F.concat(F.lit('" ['), "unit", F.lit("]"))).otherwise("")
    return stacked.select("pos", "param", order_col, F.concat(head, F.coalesce(sig6(v), F.lit("")), tail).alias("piece"))


def write_param_list(values: DataFrame, path: str, order_col: str = "design_id") -> None:
    """A7 sink of any length: one folder per parameter whose files, in order of name, hold its list.

    Pieces are range-sorted, so a list is written by many tasks; ``, `` is the files' line separator.
    """
    (values.orderBy("param", order_col).select("param", "piece").write.mode("overwrite")
     .partitionBy("param").option("lineSep", LIST_SEP).text(path))


def read_param_list(spark: SparkSession, path: str) -> DataFrame:
    """(param, piece) of a written parameter list."""
    return spark.read.option("lineSep", LIST_SEP).text(path).select("param", F.col("value").alias("piece"))


# ---------------------------------------------------------------- run log

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("data_file", T.StringType()),
    T.StructField("trained_at", T.TimestampType()), T.StructField("training_duration", T.DoubleType()),
    T.StructField("num_layers", T.IntegerType()), T.StructField("layer_sizes", T.StringType()),
    T.StructField("learning_rate", T.DoubleType()), T.StructField("epochs", T.IntegerType()),
    T.StructField("batch_size", T.IntegerType()), T.StructField("batch_norm", T.BooleanType()),
    T.StructField("test_size", T.DoubleType()), T.StructField("num_features", T.IntegerType()),
    T.StructField("num_outputs", T.IntegerType()), T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()), T.StructField("r2", T.DoubleType()), T.StructField("mape", T.DoubleType()),
    T.StructField("max_error", T.DoubleType()), T.StructField("median_ae", T.DoubleType()),
    T.StructField("val_loss_best", T.DoubleType()), T.StructField("best_epoch", T.IntegerType()),
    T.StructField("inference_time_ms", T.DoubleType()), T.StructField("activation", T.StringType()),
    T.StructField("loss_function", T.StringType()), T.StructField("optimizer", T.StringType()),
    T.StructField("dropout_rate", T.DoubleType()), T.StructField("early_stopping", T.BooleanType()),
])


def union_logs(old: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """H1: union by name, columns missing on either side filled (NULL or a given default)."""
    out = old.unionByName(new, allowMissingColumns=True)
    for c, v in (defaults or {}).items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def append_run_log(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Add rows to the Parquet run log (an absent log starts empty); the schema is fixed.

    The log is partitioned by ``data_file`` and ``run_id`` (the model name where the rows have none).  A write
    is staged and then replaces exactly its own partitions, so a run that is retried adds no row twice, and
    runs that write at the same time do not meet.  A report on one data file reads only its partitions.
    """
    aligned = spark.createDataFrame([], RUN_LOG_SCHEMA).unionByName(rows, allowMissingColumns=True)
    run = F.coalesce(F.col("run_id"), F.col("model_name")) if "run_id" in rows.columns else F.col("model_name")
    aligned.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG_SCHEMA.fields], run.alias("run_id")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("data_file", "run_id").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run log; a log written before a column existed gets NULL (or the default) there."""
    try:
        log = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as ex:
        # only an absent log is an empty one; any other fault is raised
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    log = log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields if f.name in log.columns])
    return union_logs(spark.createDataFrame([], RUN_LOG_SCHEMA), log, {"batch_norm": False})
