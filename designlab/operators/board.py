"""Leaderboards over run logs: scaling, composite scores, top-k, winners, layer tables.

Column statistics reach each row through one scalar subquery (a single
aggregate pass, computed once and reused) instead of a join or a window over
the whole table.  Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject:
every partition keeps k rows, the driver merges k x partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from designlab.functions.numeric import bind_stats, nan_to_null
from designlab.operators.rank import dist_rank


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min) per column; a constant column maps to 0, NULL and NaN give NULL.

    (Spark ML's MinMaxScaler maps a constant column to 0.5 and scales vectors, so
    we use our own single aggregate.)
    """
    values = [nan_to_null(F.col(c).cast("double")) for c in cols]
    stats = df.agg(*[F.min(v).alias(f"mn_{i}") for i, v in enumerate(values)],
                   *[F.max(v).alias(f"mx_{i}") for i, v in enumerate(values)])
    out = bind_stats(df, stats, "_mm")
    s = F.col("_mm")
    for i, c in enumerate(cols):
        mn, mx = s.getField(f"mn_{i}"), s.getField(f"mx_{i}")
        x = values[i]
        scaled = F.when(x.isNull(), F.lit(None).cast("double")).when(mx == mn, F.lit(0.0)).otherwise(
            F.try_divide(x - mn, mx - mn))
        out = out.withColumn(f"{c}{suffix}", scaled)
    out = out.drop("_mm")
    return out


def row_mean(cols: Sequence) -> Column:
    """Mean of the non-null values among ``cols`` (NULL when all are NULL)."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    count = sum((F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cs), F.lit(0))
    return F.when(count > 0, total / count)


# Metric families of the composite score (fixed values)
COMPOSITE_SIX = ("mae", "rmse", "val_loss_best", "mape", "median_ae", "inference_time_ms")
COMPOSITE_FOUR = ("mae", "rmse", "r2_inverted", "median_ae")


def composite_score(df: DataFrame, metrics: Sequence[str] = COMPOSITE_FOUR,
                    score_col: str = "composite") -> DataFrame:
    """Min-max scale each metric over all rows, then average the scaled values per row.

    ``r2_inverted`` (1 - r2) is derived when requested and absent.
    """
    if "r2_inverted" in metrics and "r2_inverted" not in df.columns:
        df = df.withColumn("r2_inverted", 1 - F.col("r2"))
    scaled = minmax_scale(df, metrics)
    scaled = scaled.withColumn(score_col, row_mean([f"{m}_scaled" for m in metrics]))
    return scaled.drop(*[f"{m}_scaled" for m in metrics])


def top_k(df: DataFrame, metric: str, k: int, ascending: bool = True,
          tie_cols: Sequence[str] = ("model_name",)) -> DataFrame:
    """k best rows by ``metric``; NULL and NaN metrics last, ties by ``tie_cols``."""
    value = nan_to_null(F.col(metric).cast("double"))
    key = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return df.orderBy(key, *[F.asc(c) for c in tie_cols]).limit(k)


def with_rank(df: DataFrame, metric: str, ascending: bool = True,
              tie_cols: Sequence[str] = ("model_name",), rank_col: str = "rank") -> DataFrame:
    """Exact 1-based leaderboard position for every row (distributed rank)."""
    m = nan_to_null(F.col(metric).cast("double"))
    key = [F.when(m.isNull(), 1).otherwise(0), m if ascending else -m]
    return dist_rank(df, key + [F.col(c) for c in tie_cols], rank_col=rank_col)


# Metric directions (fixed values): r2 is better when larger, every other metric when smaller.
BEST_SEVEN = ("mae", "rmse", "val_loss_best", "mape", "median_ae", "inference_time_ms", "r2")
BEST_FOUR = ("mae", "r2", "rmse", "val_loss_best")


def best_per_metric(df: DataFrame, metrics: Sequence[str] = BEST_FOUR, name_col: str = "model_name",
                    keep: Sequence[str] | None = None) -> DataFrame:
    """One row per metric: the best model for it (r2 descending, others ascending; ties by name).

    Single aggregate pass: one ``min_by`` per metric, then ``inline`` to rows.
    """
    keep = list(keep) if keep else [name_col] + [m for m in metrics if m != name_col]
    aggs = []
    for i, m in enumerate(metrics):
        v = F.col(m).cast("double")
        order_val = -v if m == "r2" else v
        order = F.when(v.isNotNull() & ~F.isnan(v), F.struct(order_val.alias("v"), F.col(name_col).alias("n")))
        row = F.struct(F.lit(i).alias("metric_pos"), F.lit(m).alias("metric"),
                       *[F.col(c) for c in keep], v.alias("value"))
        aggs.append(F.min_by(row, order).alias(f"b{i}"))
    wide = df.agg(*aggs)
    arr = F.filter(F.array(*[F.col(f"b{i}") for i in range(len(metrics))]), lambda x: x.isNotNull())
    return wide.select(F.inline(arr))


def winners_merged(best: DataFrame, name_col: str = "model_name") -> DataFrame:
    """One row per winning model; its metric labels joined by '/' in metric order, and the chart
    label ``Best MAE/RMSE``."""
    out = best.groupBy(name_col).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("metric_pos", "metric"))),
                                 lambda x: x.getField("metric")), "/").alias("labels"),
        F.min("metric_pos").alias("first_pos"),
    )
    return out.withColumn("label", F.concat(F.lit("Best "), F.upper("labels")))


def distance_from_best(top: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Inside a small top-k frame: v - min (r2: max - v), then min-max scaled over the frame.

    The frame is k rows (k <= a few dozen), so an unpartitioned window is bounded.
    """
    w = Window.partitionBy()
    out = top
    for m in metrics:
        v = F.col(m).cast("double")
        d = (F.max(v).over(w) - v) if m == "r2" else (v - F.min(v).over(w))
        out = out.withColumn(f"{m}_dist", d)
    for m in metrics:
        d = F.col(f"{m}_dist")
        mn, mx = F.min(d).over(w), F.max(d).over(w)
        out = out.withColumn(f"{m}_dist_scaled", F.when(mx == mn, F.lit(0.0)).otherwise((d - mn) / (mx - mn)))
    return out


def numeric_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean of each listed column over its values that are neither NULL nor NaN (one aggregate)."""
    return df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in cols])


def unpivot_metrics(df: DataFrame, cols: Sequence[str], value_name: str = "value") -> DataFrame:
    """Wide one-row metrics -> long (metric, value)."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"),
                                                 F.col(c).cast("double").alias(value_name)) for c in cols])))


def layers_array(text_col: str = "layer_sizes") -> Column:
    """'[128, 64]' -> array<int>."""
    return F.from_json(F.col(text_col), "array<int>")


def total_units(text_col: str = "layer_sizes") -> Column:
    return F.aggregate(layers_array(text_col), F.lit(0).cast("long"), lambda acc, x: acc + x)


def layer_matrix(df: DataFrame, id_cols: Sequence[str], text_col: str = "layer_sizes",
                 fill: bool = False) -> DataFrame:
    """Long layer table padded to the longest list: (ids.., layer, units); zero units -> NULL, with ``fill`` NULL -> 0."""
    arr = layers_array(text_col)
    max_layers = df.select(F.max(F.size(arr))).scalar()
    padded = df.select(*id_cols, arr.alias("_a")).withColumn(
        "layer", F.explode(F.sequence(F.lit(1), max_layers)))
    units = F.get(F.col("_a"), F.col("layer") - 1)
    return padded.select(*id_cols, F.col("layer").cast("long").alias("layer"),
                         (F.coalesce(units, F.lit(0)) if fill else F.nullif(units, F.lit(0))).cast("long").alias("units"))


def layer_matrix_wide(top: DataFrame, order_cols: Sequence[str], k: int, text_col: str = "layer_sizes") -> DataFrame:
    """One row per layer, one column per rank (``rank_1`` the best of the k rows); missing layers are 0."""
    ranked = top.withColumn("_rk", F.row_number().over(Window.orderBy(*[F.asc_nulls_last(c) for c in order_cols])))
    long = layer_matrix(ranked, ["_rk"], text_col, fill=True)
    return long.groupBy("layer").agg(*[F.max(F.when(F.col("_rk") == i, F.col("units"))).alias(f"rank_{i}") for i in range(1, k + 1)])


def one_hot(df: DataFrame, categories: dict[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per (column, category); booleans pass through, a NULL is 0 everywhere.

    The declared categories come first, then any other value that the rows hold: ``df`` is a short
    list of best rows, so its distinct values are few.
    """
    seen = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in categories]).first()
    cols = [F.col(c) for c in keep]
    for c, values in categories.items():
        for v in [*values, *(x for x in seen[c] if x not in values)]:
            cols.append(F.col(c).eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}"))
    return df.select(*cols)


def readable_ids(df: DataFrame, order_cols: Sequence, id_col: str = "model_id",
                 fmt: str = "Model_%03d") -> DataFrame:
    """Sequential readable id in log order (exact, distributed rank)."""
    ranked = dist_rank(df, order_cols, rank_col="_rk")
    return ranked.withColumn(id_col, F.format_string(fmt, F.col("_rk") - 1)).drop("_rk")
