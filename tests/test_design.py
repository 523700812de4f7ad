"""Design generators: properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from designlab.operators import design, space

BOUNDS = {"a": (0.0, 1.0), "b": (10.0, 20.0), "c": (-5.0, 5.0)}


def _ids(spark, n, parts=4):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "design_id")


def test_full_factorial_count_order(spark):
    lv = {"x": [1.0, 2.0], "y": [10.0, 20.0, 30.0], "z": [5.0, 6.0]}
    rows = design.full_factorial(spark, lv).orderBy("design_id").collect()
    assert len(rows) == 12 and len({(r.x, r.y, r.z) for r in rows}) == 12
    assert [(r.x, r.y, r.z) for r in rows[:3]] == [(1.0, 10.0, 5.0), (1.0, 10.0, 6.0), (1.0, 20.0, 5.0)]


def test_grid_linspace(spark):
    g = design.grid(spark, {"a": (0.0, 1.0)}, 5).orderBy("design_id").collect()
    assert [r.a for r in g] == list(np.linspace(0, 1, 5))
    assert [r.a for r in design.grid(spark, {"a": (2.0, 3.0)}, 1).collect()] == [2.0]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_lhs_one_point_per_stratum(spark, parts):
    n = 200
    d = design.lhs(_ids(spark, n, parts), BOUNDS, seed=7, num_partitions=parts).toPandas()
    for name, (lo, hi) in BOUNDS.items():
        u = (d[name] - lo) / (hi - lo)
        strata = np.floor(u * n).astype(int)
        assert sorted(strata.tolist()) == list(range(n))
    assert len(d) == n


def test_lhs_partition_independent(spark):
    a = design.lhs(_ids(spark, 100, 1), BOUNDS, seed=3, num_partitions=1).orderBy("design_id").collect()
    b = design.lhs(_ids(spark, 100, 8), BOUNDS, seed=3, num_partitions=16).orderBy("design_id").collect()
    assert a == b


def test_random_within_bounds_and_seeded(spark):
    d1 = design.random_uniform(_ids(spark, 500), BOUNDS, seed=1).orderBy("design_id").toPandas()
    d2 = design.random_uniform(_ids(spark, 500, 7), BOUNDS, seed=1).orderBy("design_id").toPandas()
    assert d1.equals(d2)
    for name, (lo, hi) in BOUNDS.items():
        assert d1[name].min() >= lo and d1[name].max() < hi


def test_sobol_dyadic_property(spark):
    d = design.sobol(_ids(spark, 256), {f"x{i}": (0.0, 1.0) for i in range(10)}, seed=None).toPandas()
    for c in d.columns[1:]:
        cells = np.floor(d[c].to_numpy() * 256).astype(int)
        assert sorted(cells.tolist()) == list(range(256))
    # scrambled: still one point per dyadic interval (digital shift keeps the net property)
    s = design.sobol(_ids(spark, 64), {"x0": (0.0, 1.0), "x1": (0.0, 1.0)}, seed=5).toPandas()
    assert sorted(np.floor(s["x1"] * 64).astype(int).tolist()) == list(range(64))


def test_fractional_factorial_signs(spark):
    d = design.fractional_factorial(spark, "a b ab", {"p": (0.0, 1.0), "q": (0.0, 1.0), "r": (0.0, 1.0)})
    rows = d.orderBy("design_id").collect()
    assert len(rows) == 4
    for r in rows:
        sa, sb, sab = (2 * r.p - 1), (2 * r.q - 1), (2 * r.r - 1)
        assert sa * sb == sab
    with pytest.raises(ValueError):
        design.parse_generators("a b c d e f g h")


def test_maximin_not_worse_than_candidates(spark):
    ids = _ids(spark, 200).withColumn("it", F.floor(F.col("design_id") / 20).cast("long"))
    best = design.maximin_lhs(ids, BOUNDS, "it", seed=11).toPandas()
    cands = design.lhs_in_groups(ids, BOUNDS, "it", seed=11).toPandas()

    def mind(g):
        x = g[list(BOUNDS)].to_numpy()
        dd = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        np.fill_diagonal(dd, np.inf)
        return dd.min()
    dists = cands.groupby("it")[list(BOUNDS)].apply(mind)
    assert math.isclose(best["min_dist"].iloc[0], dists.max())
    assert best["it"].iloc[0] == dists[dists == dists.max()].index.min()


def test_linked_formula_and_lookup(spark):
    df = spark.createDataFrame([(30.0,), (45.0,)], "T double")
    out = space.with_linked(df, {"T": ("degC", ["i0_ref_O2"])}, koh=1.0,
                            lookup={"i0_ref_O2": [(30.0, 0.014)]}).collect()
    assert out[0]["i0_ref_O2"] == 0.014
    assert math.isclose(out[1]["i0_ref_O2"], 3.353 * math.exp(-1458.2 / (45.0 + 273.15)))
    with pytest.raises(NotImplementedError):
        space.linked_column("W", "x", F.col("T"), None, 1.0)
    # a base absent from the design is skipped
    assert space.with_linked(df.select(F.col("T").alias("W")), {"T": ("degC", ["i0_ref_O2"])}).columns == ["W"]


@pytest.mark.parametrize("n", [1, 2, 7, 256, 1000])
def test_lhs_permuted_one_point_per_stratum(spark, n):
    d = design.lhs_permuted(_ids(spark, n, 3), BOUNDS, n, seed=9).toPandas()
    assert len(d) == n
    for name, (lo, hi) in BOUNDS.items():
        strata = np.floor((d[name] - lo) / (hi - lo) * n).astype(int)
        assert sorted(strata.tolist()) == list(range(n))
    again = design.lhs_permuted(_ids(spark, n, 5), BOUNDS, n, seed=9).orderBy("design_id").toPandas()
    assert np.allclose(again[list(BOUNDS)].to_numpy(), d.sort_values("design_id")[list(BOUNDS)].to_numpy())


def test_design_space_from_table(spark):
    from designlab.operators.doe import DesignSpace
    df = spark.createDataFrame([(1.0, 30.0), (2.0, 50.0), (2.0, 30.0), (-0.0, 50.0)], "a double, t double")
    ds = DesignSpace.from_table(df, [space.TableParam("A", "a", "um", "m", 1e-6, 0.0),
                                     space.TableParam("T", "t", "degC", None, 1.0, 0.0, ("i0_ref_O2",))], koh=1.0)
    assert ds.params[0].levels == [0.0, 1e-6, 2e-6] and ds.units["A"] == "m"
    ff = ds.full_factorial()
    assert ff.count() == 6 and "i0_ref_O2" in ff.columns


@pytest.mark.parametrize("parts", [1, 7])
def test_maximin_generated_is_best_lhs(spark, parts):
    best = design.maximin_lhs_generated(spark, BOUNDS, samples=15, iterations=40, seed=5, num_partitions=parts).toPandas()
    assert len(best) == 15
    for name, (lo, hi) in BOUNDS.items():
        strata = np.floor((best[name] - lo) / (hi - lo) * 15).astype(int)
        assert sorted(strata.tolist()) == list(range(15))
    lows = np.array([b[0] for b in BOUNDS.values()])
    widths = np.array([b[1] - b[0] for b in BOUNDS.values()])

    def mind(x):
        dd = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        np.fill_diagonal(dd, np.inf)
        return dd.min()
    scores = [mind(design._candidate_lhs(i, 5, 15, lows, widths)) for i in range(40)]
    assert best["iteration"].iloc[0] == int(np.argmax(scores))
    assert math.isclose(best["min_dist"].iloc[0], max(scores))
