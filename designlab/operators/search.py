"""Hyper-parameter grids and search-space sampling.

A configuration table is an ordinary DataFrame: one row per trial, one column
per hyper-parameter, every draw a seeded md5 uniform of (seed, parameter, trial).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from designlab.functions.numeric import hash_uniform


def product_table(spark: SparkSession, lists: dict[str, Sequence], id_col: str = "config_id",
                  num_partitions: int | None = None) -> DataFrame:
    """Cartesian product of value lists (any literal type), last list varying fastest."""
    names = list(lists)
    radices = [len(lists[n]) for n in names]
    total = math.prod(radices)
    strides = [math.prod(radices[i + 1:]) for i in range(len(names))]
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = spark.range(0, total, 1, parts).withColumnRenamed("id", id_col)
    cols = [F.col(id_col)]
    for n, r, s in zip(names, radices, strides):
        idx = (F.floor(F.col(id_col) / F.lit(s)) % F.lit(r)).cast("int")
        cols.append(F.element_at(F.array(*[F.lit(v) for v in lists[n]]), idx + 1).alias(n))
    return ids.select(*cols)


def seeded_sample(df: DataFrame, k: int, id_col: str, seed: int = 42) -> DataFrame:
    """K rows without replacement, chosen by a seeded md5 order of the id (top-k, bounded)."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    return df.withColumn("_k", key).orderBy("_k", id_col).limit(k).drop("_k")


# ---------------------------------------------------------------- L14 draws

def draw_int(u: Column, lo: int, hi: int) -> Column:
    """Integer uniform on [lo, hi]."""
    return (F.lit(lo) + F.least(F.floor(u * F.lit(hi - lo + 1)), F.lit(hi - lo))).cast("int")


def draw_step_int(u: Column, lo: int, hi: int, step: int) -> Column:
    """Integer on lo, lo + step, ..., <= hi."""
    n = (hi - lo) // step + 1
    return (F.lit(lo) + F.lit(step) * F.least(F.floor(u * F.lit(n)), F.lit(n - 1))).cast("int")


def draw_uniform(u: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + u * F.lit(float(hi - lo))


def draw_log_uniform(u: Column, lo: float, hi: float) -> Column:
    """exp(ln lo + u (ln hi - ln lo))."""
    a, b = math.log(lo), math.log(hi)
    return F.exp(F.lit(a) + u * F.lit(b - a))


def draw_log_int(u: Column, lo: int, hi: int) -> Column:
    """Integer log-uniform on [lo, hi]: floor(exp(ln lo + u (ln(hi + 1) - ln lo))), capped at hi."""
    a, b = math.log(lo), math.log(hi + 1)
    return F.least(F.floor(F.exp(F.lit(a) + u * F.lit(b - a))), F.lit(hi)).cast("int")


def draw_choice(u: Column, values: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * F.lit(len(values))) + 1).cast("int"))


def layer_list(trial: Column, n_layers: Column, lo: int, hi: int, seed: int) -> Column:
    """Variable-length layer list: one log-int draw per layer ``units_l{i}``."""
    a, b = math.log(lo), math.log(hi + 1)

    def one(i):
        txt = F.concat_ws("|", F.lit(str(seed)), F.concat(F.lit("units_l"), (i - 1).cast("string")), trial.cast("string"))
        u = F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return F.least(F.floor(F.exp(F.lit(a) + u * F.lit(b - a))), F.lit(hi)).cast("int")
    return F.transform(F.sequence(F.lit(1), n_layers), one)


def u(seed: int, name: str, trial: Column) -> Column:
    return hash_uniform(seed, name, trial)
