"""Space files, unit CSV, solver CSV, design exports, run log."""

import json
import os
import pathlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from designlab.operators import space
from designlab.sources import files

# A parameter space of our own in the documented file layout; T and its linked columns are names that formulas know
SPACE = {"parameters": {
    "gap": {"values": [2, 5, 7], "unit": "mm", "convert_to": "m", "scaling_factor": 1e-3},
    "T": {"values": [25, 45, 65, 85], "unit": "degC",
          "linked": {"i0_ref_O2": [0.11, 0.12, 0.13, 0.14], "i0_ref_H2": [0.21, 0.22, 0.23, 0.24]}},
    "porosity": {"values": [0.15, 0.35, 0.55, 0.95], "scaling_factor": 1.0},
    "load": {"values": [3, 4, 6], "unit": "kN", "convert_to": "N", "scaling_factor": 1000},
    "i0_ref_O2": {"unit": "A/m^2"},
}}


def test_read_space_keeps_order_and_scales(spark, tmp_dir):
    p = os.path.join(tmp_dir, "space.json")
    with open(p, "w") as f:
        json.dump(SPACE, f)
    sp = space.read_space(spark, p)
    assert [r.name for r in sp.orderBy("pos").collect()] == list(SPACE["parameters"])
    params = space.collect_params(space.scaled_levels(sp))
    assert [x.name for x in params] == ["gap", "T", "porosity", "load"]
    assert params[0].levels == [v * 1e-3 + 0.0 for v in (2, 5, 7)] and params[0].unit == "m"
    assert params[3].levels == [3000.0, 4000.0, 6000.0]
    assert params[1].linked["i0_ref_O2"][0] == 0.11


def test_empty_space(spark, tmp_dir):
    p = os.path.join(tmp_dir, "empty.json")
    with open(p, "w") as f:
        json.dump({"other": 1}, f)
    assert space.read_space(spark, p).count() == 0


def test_design_text_and_param_list(spark):
    df = spark.createDataFrame([(0, 7.0617e-05, 0.6031749561242999), (1, 8.6806e-05, 0.66)], "design_id long, W double, eps double")
    t = files.design_text(df, {"W": "m", "eps": None}).orderBy("design_id").collect()
    assert t[0]["W"] == "7.0617e-05[m]" and t[0]["eps"] == 0.6031749561242999


def _lists(path):
    """The written list of each parameter: its files in order of name."""
    return {d.name.removeprefix("param="): "".join(f.read_text() for f in sorted(d.glob("part-*")))
            for d in pathlib.Path(path).glob("param=*")}


@pytest.mark.parametrize("n", [2, 7, 150_000])
def test_param_list_of_any_length(spark, tmp_dir, n):
    df = spark.range(0, n, 1, 5).select((n - 1 - F.col("id")).alias("design_id"), (7.0617e-05 + (n - 1 - F.col("id")) * 1e-5).alias("W"),
                                        F.lit(0.6031749561242999).alias("eps"))
    files.write_param_list(files.param_values(df, {"W": "m", "eps": None}, ["W", "eps"]), tmp_dir + "/l")
    got = _lists(tmp_dir + "/l")
    assert got["eps"] == 'eps "' + ", ".join(["0.603175"] * n) + '" [], '
    values = [v for v in got["W"].removeprefix('W "').removesuffix('" [m], ').split(", ")]
    assert values[:2] == ["7.0617e-05", "8.0617e-05"] and len(values) == n
    assert all(abs(float(v) / (7.0617e-05 + i * 1e-5) - 1) < 1e-5 for i, v in enumerate(values))
    back = files.read_param_list(spark, tmp_dir + "/l")
    assert {r["param"]: r["count"] for r in back.groupBy("param").count().collect()} == {"W": n, "eps": n}
    files.write_param_list(files.param_values(df.where("design_id < 2"), {"W": "m"}, ["W"], legacy_round=True), tmp_dir + "/r")
    assert _lists(tmp_dir + "/r")["W"] == 'W "7.1e-05, 8.1e-05" [m], '


def test_unit_csv_roundtrip(spark, tmp_dir):
    p = os.path.join(tmp_dir, "u.csv")
    with open(p, "w") as f:
        f.write("W_mem,T,eps\n7.0617e-05[m],48.8955[degC],0.6\n8e-05[m],50[degC],0.7\n")
    out = files.read_unit_csv(spark, p)
    assert out.columns == ["W_mem [m]", "T [degC]", "eps"]
    assert sorted(r["T [degC]"] for r in out.collect()) == [48.8955, 50.0]


def test_solver_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.csv")
    with open(p, "w") as f:
        f.write("% Model,IV.mph\n% Version,6.3\n% E_cell,I_density\n0.5,1.25\n0.6,NaN\n")
    df = files.read_solver_csv(spark, p)
    assert df.columns == ["E_cell", "I_density"]
    rows = df.orderBy("E_cell").collect()
    assert rows[0]["I_density"] == 1.25 and rows[1]["I_density"] is None


def test_run_log_append_and_union(spark, tmp_dir):
    p = os.path.join(tmp_dir, "log")
    assert files.read_run_log(spark, p).count() == 0
    old = spark.createDataFrame([("m1", 0.5)], "model_name string, mae double")
    files.append_run_log(spark, old, p)
    new = spark.createDataFrame([("m2", 0.4, True)], "model_name string, mae double, batch_norm boolean")
    files.append_run_log(spark, new, p)
    log = files.read_run_log(spark, p)
    got = {r.model_name: r.batch_norm for r in log.collect()}
    assert got == {"m1": False, "m2": True}
    assert log.where(F.col("model_name") == "m1").first()["mae"] == 0.5


def test_design_space_workflow(spark, tmp_dir):
    from designlab.operators.doe import DesignSpace
    p = os.path.join(tmp_dir, "space.json")
    with open(p, "w") as f:
        json.dump(SPACE, f)
    ds = DesignSpace.from_json(spark, p, koh=1.0)
    assert ds.names == ["gap", "T", "porosity", "load"]
    lhs = ds.latin_hypercube(30, seed=2)
    assert lhs.columns == ["design_id", "gap", "T", "porosity", "load", "i0_ref_O2", "i0_ref_H2"]
    assert lhs.count() == 30
    ff = ds.full_factorial()
    assert ff.count() == 3 * 4 * 4 * 3
    mm = ds.maximin_latin_hypercube(10, 5, seed=3)
    assert sorted(r.design_id for r in mm.collect()) == list(range(10))
    out = os.path.join(tmp_dir, "lhs_csv")
    ds.save_csv(lhs, out)
    text = spark.read.option("header", True).csv(out)
    first = text.first()
    assert first["gap"].endswith("[m]") and first["T"].endswith("[degC]") and first["i0_ref_O2"].endswith("[A/m^2]")
    lst = os.path.join(tmp_dir, "lhs_list")
    ds.save_param_list(lhs, lst)
    lines = _lists(lst)
    assert len(lines) == 6 and lines["gap"].startswith('gap "') and lines["gap"].endswith('" [m], ')
    looked = DesignSpace.from_json(spark, p, koh=1.0, use_lookup=True).full_factorial()
    vals = {r["T"]: r["i0_ref_O2"] for r in looked.select("T", "i0_ref_O2").distinct().collect()}
    assert vals[25.0] == 0.11 and vals[85.0] == 0.14


def test_read_csv_na_tokens(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.csv")
    with open(p, "w") as f:
        f.write("a,b,c\n1.5,NA,x\n,2,\nNaN,3,y\nabc,4,z\n")
    seen = Observation()
    df = files.read_csv(spark, p, "a double, b int, c string", observe=seen)
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(1.5, None, "x"), (None, 2, None), (None, 3, "y"), (None, 4, "z")]
    assert seen.get == {"bad_a": 1, "bad_b": 0, "bad_c": 0}


def test_run_log_prunes_by_data_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "plog")
    rows = spark.createDataFrame([("m1", "a.csv", 0.5), ("m2", "b.csv", 0.4)], "model_name string, data_file string, mae double")
    files.append_run_log(spark, rows, p)
    log = files.read_run_log(spark, p).where(F.col("data_file") == "a.csv")
    assert [r.model_name for r in log.collect()] == ["m1"]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "a.csv" in plan
