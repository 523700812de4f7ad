"""Distributed ranks, radix selection and exact quantiles against single-machine references."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from designlab.operators import select
from designlab.operators.rank import dist_rank
from designlab.operators.select import exact_quantiles, key_value, select_ranks, with_sort_key


def _skewed(spark, n=3000):
    # one hot group holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        ((F.col("id") * 7919) % 1009).cast("double").alias("v"), F.col("id"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_global_rank_matches_row_number(spark, parts):
    df = _skewed(spark)
    r = dist_rank(df, [F.col("v"), F.col("id")], rank_col="r", num_partitions=parts)
    ref = r.withColumn("w", F.row_number().over(Window.orderBy("v", "id")))
    assert ref.where(F.col("r") != F.col("w")).count() == 0
    assert r.count() == 3000


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_grouped_rank_with_hot_group(spark, parts):
    df = _skewed(spark)
    r = dist_rank(df, [F.col("v"), F.col("id")], ["g"], rank_col="r", count_col="n", num_partitions=parts)
    ref = r.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("v", "id"))) \
        .withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("g")))
    assert ref.where((F.col("r") != F.col("w")) | (F.col("n") != F.col("c"))).count() == 0


def test_exact_quantiles_match_numpy(spark):
    df = _skewed(spark)
    qs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r["g"]: r for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        want = np.percentile(sub["v"].to_numpy(), [q * 100 for q in qs])
        have = [got[g][f"q{int(q * 100):02d}"] for q in qs]
        assert np.allclose(have, want, rtol=0, atol=1e-9)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, float("nan")), (1, 3.0)], "g int, v double")
    row = exact_quantiles(df, "v", [0.5], ["g"], ["m"]).first()
    assert row["m"] == 2.0


def test_single_row_group(spark):
    df = spark.createDataFrame([(1, 5.0)], "g int, v double")
    assert exact_quantiles(df, "v", [0.25, 0.75], ["g"], ["a", "b"]).first().asDict() == {"g": 1, "a": 5.0, "b": 5.0}


def test_tied_hot_value_is_spread(spark):
    # a third of the rows share one value: the range exchange still splits them
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    r = dist_rank(df, [F.col("v")], rank_col="r", num_partitions=6)
    sizes = [row[0] for row in r.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 1000
    assert sorted(x.r for x in r.collect()) == list(range(1, 3001))


SPECIAL = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324,
           1.7976931348623157e308, -1.7976931348623157e308, 1.0 - 2.0 ** -53, 1.0 + 2.0 ** -52, 3.0, 1e22, 0.1]


def test_sort_key_is_the_bits_of_the_double(spark):
    rng = np.random.default_rng(11)
    bits = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    values = [v for v in bits.view(np.float64).tolist() if not math.isnan(v)] + SPECIAL
    values += [s * 2.0 ** e for e in range(-1074, 1024) for s in (1, -1)]
    values += [math.nextafter(2.0 ** e, 0) for e in range(-1073, 1024)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    rows = with_sort_key(df, F.col("v"), "k").select("v", "k", key_value(F.col("k")).alias("back")).collect()
    for r in rows:
        if r.v is None or math.isnan(r.v):
            assert r.k is None
            continue
        raw = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-raw if r.v < 0 else raw), r.v
        assert r.back == r.v


@pytest.mark.parametrize("broadcast_rows, digit", [(100_000, 16), (3, 16), (100_000, 4)])
def test_select_ranks_with_hot_group_and_value(spark, broadcast_rows, digit, monkeypatch):
    monkeypatch.setattr(select, "DIGIT_BITS", digit)  # 4: many passes before the buckets are small
    df = _skewed(spark).withColumn("v", F.when(F.col("id") % 5 == 0, F.lit(-0.0)).when(F.col("id") % 7 == 0, F.lit(-math.inf))
                                   .when(F.col("id") % 11 == 0, F.lit(math.inf)).otherwise(F.col("v") - 400))
    keyed = with_sort_key(df, F.col("v")).select("g", "_k")
    got = select_ranks(keyed, ["g"], lambda n: [F.lit(0), n - 1, F.floor(n / 3), n, F.lit(None).cast("long")],
                       broadcast_rows).collect()
    assert len(got) == 50
    for row in got:
        ref = sorted(r._k for r in keyed.where(F.col("g") == row.g).collect())
        assert tuple(row)[1:] == (len(ref), ref[0], ref[-1], ref[len(ref) // 3], None, None)
        if row.g == 3:
            break


def test_quantiles_of_special_values(spark):
    rows = [("a", v) for v in (-math.inf, -0.0, 0.0, 5.0, math.inf)] + [("b", math.inf)] * 3 + [("c", None), ("c", math.nan)] \
        + [(None, 2.0)] * 4 + [(None, -2.0)] * 2
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: tuple(r)[1:] for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0], ["g"]).collect()}
    assert got == {"a": (-math.inf, 0.0, 0.0, math.inf), "b": (math.inf,) * 4, None: (-2.0, -0.0 + -2.0 + 4.0 * 0.25, 2.0, 2.0)}
    assert exact_quantiles(df.limit(0), "v", [0.5], ["g"]).count() == 0


def test_null_group_keeps_rank_quantile_and_median(spark):
    from designlab.operators import metrics, rank
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 7.0)], "g string, v double")
    assert rank.dist_rank(df, ["v"], ["g"]).count() == 4
    assert {r.g: r.m for r in exact_quantiles(df, "v", [0.5], ["g"], ["m"]).collect()} == {"a": 1.5, None: 6.0}
    pairs = df.selectExpr("g", "v AS y_true", "0D AS y_pred")
    assert {r.g: r.median_ae for r in metrics.regression_metrics(pairs, ["g"]).collect()} == {"a": 1.5, None: 6.0}


def test_nan_counts_as_missing_on_boards(spark):
    from designlab.operators import board
    df = spark.createDataFrame([("a", 0.5), ("b", float("nan")), ("c", 0.9)], "model_name string, r2 double")
    assert [r.model_name for r in board.top_k(df, "r2", 3, ascending=False).collect()] == ["c", "a", "b"]
    scaled = {r.model_name: r.r2_scaled for r in board.minmax_scale(df, ["r2"]).collect()}
    assert scaled == {"a": 0.0, "b": None, "c": 1.0}
    assert abs(board.numeric_means(df, ["r2"]).first().r2 - 0.7) < 1e-12
