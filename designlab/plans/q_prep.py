"""Split, scaling and search-space queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from designlab.operators import board, prep, search
from designlab.plans.registry import register
from designlab.plans.standins import RUNLOG_CTES, run_log
from designlab.plans.tables import table

SEED = 42
TEST, VAL = 0.2, 0.1
ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
NUM4 = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
SAMPLE_K = 100

# Search space of the tuning study (fixed values)
N_LAYERS = (1, 8)
UNITS = (16, 512)
DROPOUT = (0.0, 0.4)
BATCH_NORM = (True, False)
LEARNING_RATE = (1e-5, 5e-2)
OPTIMIZER_CHOICES = ("adam", "nadam", "adamw", "rmsprop")
BATCH_SIZES = (16, 32, 64, 128, 256)
EPOCHS = (40, 60, 80, 120, 150)
ACTIVATION_CHOICES = ("relu", "tanh", "swish", "gelu")
LOSS_CHOICES = ("mse", "mae", "huber")
WEIGHT_DECAY = (1e-6, 1e-3)


def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _key_sql(cols) -> str:
    return " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)


ROW_SPLIT_SQL = f"""
r AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}|' || {_key_sql(ROW_KEY)})) AS rk, count(*) OVER () AS n FROM lineitem),
rs AS (SELECT *, CASE WHEN rk <= ceil(n * {_f(TEST)}) THEN 'test'
                      WHEN rk - ceil(n * {_f(TEST)}) > floor((n - ceil(n * {_f(TEST)})) * {_f(1.0 - VAL)}) THEN 'val'
                      ELSE 'train' END AS split FROM r)"""


@register("row_split", sql=f"""WITH {ROW_SPLIT_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split FROM rs""")
def row_split(spark, d):
    """L1, L4: exact 20 % test rows (ceil) in seeded hash order, last 10 % of training rows for validation."""
    li = table(spark, d, "lineitem").select(*ROW_KEY)
    return prep.row_split(li, ROW_KEY, TEST, VAL, SEED)


@register("group_split", sql=f"""
WITH k AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS gk FROM lineitem),
r AS (SELECT gk, row_number() OVER (ORDER BY md5('{SEED}|' || gk), gk) AS rk, count(*) OVER () AS g FROM k),
lab AS (SELECT gk, CASE WHEN rk <= ceil(g * {_f(TEST)}) THEN 'test'
                        WHEN rk <= ceil(g * {_f(TEST)}) + ceil((g - ceil(g * {_f(TEST)})) * {_f(VAL)}) THEN 'val'
                        ELSE 'train' END AS split FROM r)
SELECT l_orderkey, l_linenumber, split FROM lineitem JOIN lab ON CAST(l_orderkey AS VARCHAR) = lab.gk""")
def group_split(spark, d):
    """L2, L3: whole orders ('simulations') to one side; 20 % test groups, 10 % of the rest validation."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return prep.group_split(li, "l_orderkey", TEST, VAL, SEED)


def _std_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUM4)
    z = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END, 6) AS {c}_z"
                  for c in NUM4)
    restored = ("round((l_extendedprice - m_l_extendedprice) / s_l_extendedprice * s_l_extendedprice "
                "+ m_l_extendedprice, 6) AS price_restored")
    return f"""WITH {ROW_SPLIT_SQL},
st AS (SELECT {stats} FROM rs WHERE split = 'train')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split, {z}, {restored} FROM rs, st"""


@register("standardise", sql=_std_sql())
def standardise(spark, d):
    """Population-std scaling fitted on the training rows only, then the target inverted back."""
    li = table(spark, d, "lineitem").select(*ROW_KEY, *NUM4)
    split = prep.row_split(li, ROW_KEY, TEST, VAL, SEED)
    stats = prep.fit_standard(split.where(F.col("split") == "train"), NUM4)
    z = prep.apply_standard(split, stats, NUM4)
    z = prep.invert_standard(z, stats, "l_extendedprice", "l_extendedprice_z", "price_restored")
    return z.select(*ROW_KEY, "split", *[f"{c}_z" for c in NUM4], "price_restored")


@register("minmax", sql=f"""
WITH st AS (SELECT {", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in NUM4)} FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {", ".join(f"round(CASE WHEN mx_{c} = mn_{c} THEN 0.0 ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, 6) AS {c}_scaled" for c in NUM4)}
FROM lineitem, st""")
def minmax(spark, d):
    """Columns scaled to [0, 1] over the table (constant column -> 0)."""
    li = table(spark, d, "lineitem").select(*ROW_KEY, *NUM4)
    return board.minmax_scale(li, NUM4).select(*ROW_KEY, *[f"{c}_scaled" for c in NUM4])


GRID_COLS = ("activation", "optimizer", "loss_function", "learning_rate", "batch_norm", "num_layers")


def _grid_sql() -> str:
    tabs = ", ".join(f"(SELECT {c}, row_number() OVER (ORDER BY {c}) AS i{k} FROM (SELECT DISTINCT {c} FROM runlog)) t{k}"
                     for k, c in enumerate(GRID_COLS))
    order = ", ".join(f"i{k}" for k in range(len(GRID_COLS)))
    return f"""{RUNLOG_CTES},
g AS (SELECT row_number() OVER (ORDER BY {order}) - 1 AS config_id, {", ".join(GRID_COLS)} FROM {tabs})
SELECT * FROM g ORDER BY md5('{SEED}|' || CAST(config_id AS VARCHAR)), config_id LIMIT {SAMPLE_K}"""


@register("config_grid", sql=_grid_sql())
def config_grid(spark, d):
    """Product of the distinct hyper-parameter values seen in the run log; seeded sample of 100."""
    log = run_log(spark, d)
    wide = log.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in GRID_COLS]).first()   # categorical, bounded
    lists = {c: list(wide[c]) for c in GRID_COLS}
    grid = search.product_table(spark, lists)
    types = dict(log.select(*GRID_COLS).dtypes)
    grid = grid.select("config_id", *[F.col(c).cast(types[c]).alias(c) for c in GRID_COLS])
    return search.seeded_sample(grid, SAMPLE_K, "config_id", SEED)


def _hu_sql(name: str, trial: str = "s_suppkey") -> str:
    return (f"(CAST(('0x' || substr(md5('{SEED}|{name}|' || CAST({trial} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / {_f(4294967296.0)})")


def _choice_sql(name: str, values) -> str:
    lst = "[" + ", ".join(repr(v) if not isinstance(v, bool) else ("true" if v else "false") for v in values) + "]"
    return f"({lst})[CAST(floor({_hu_sql(name)} * {len(values)}) + 1 AS BIGINT)]"


UNIT_STEPS = (16, 512, 16)


@register("stepped_draw", sql=f"""
SELECT s_suppkey AS trial_id,
       CAST({UNIT_STEPS[0]} + {UNIT_STEPS[2]} * least(floor({_hu_sql('units')} * {(UNIT_STEPS[1] - UNIT_STEPS[0]) // UNIT_STEPS[2] + 1}),
                                                      {(UNIT_STEPS[1] - UNIT_STEPS[0]) // UNIT_STEPS[2]}) AS INTEGER) AS units
FROM supplier""")
def stepped_draw(spark, d):
    """Stepped integer draw 16, 32, ..., 512 per trial."""
    t = table(spark, d, "supplier").select(F.col("s_suppkey").alias("trial_id"))
    return t.select("trial_id", search.draw_step_int(search.u(SEED, "units", F.col("trial_id")), *UNIT_STEPS).alias("units"))


def _search_sql() -> str:
    a, b = math.log(UNITS[0]), math.log(UNITS[1] + 1)
    la, lb = math.log(LEARNING_RATE[0]), math.log(LEARNING_RATE[1])
    wa, wb = math.log(WEIGHT_DECAY[0]), math.log(WEIGHT_DECAY[1])
    unit_u = (f"(CAST(('0x' || substr(md5('{SEED}|units_l' || CAST(i - 1 AS VARCHAR) || '|' || CAST(s_suppkey AS VARCHAR)), 1, 8)) AS BIGINT)"
              f" / {_f(4294967296.0)})")
    n_layers = f"CAST({N_LAYERS[0]} + least(floor({_hu_sql('n_layers')} * {N_LAYERS[1] - N_LAYERS[0] + 1}), {N_LAYERS[1] - N_LAYERS[0]}) AS INTEGER)"
    return f"""
WITH t AS (SELECT s_suppkey, {n_layers} AS n_layers,
                  {_f(DROPOUT[0])} + {_hu_sql('dropout')} * {_f(DROPOUT[1] - DROPOUT[0])} AS dropout,
                  {_choice_sql('batch_norm', BATCH_NORM)} AS batch_norm,
                  round(exp({_f(la)} + {_hu_sql('learning_rate')} * {_f(lb - la)}), 12) AS learning_rate,
                  {_choice_sql('optimizer', OPTIMIZER_CHOICES)} AS optimizer_drawn,
                  round(exp({_f(wa)} + {_hu_sql('weight_decay')} * {_f(wb - wa)}), 12) AS weight_decay,
                  {_choice_sql('batch_size', BATCH_SIZES)} AS batch_size,
                  {_choice_sql('epochs', EPOCHS)} AS epochs,
                  {_choice_sql('activation', ACTIVATION_CHOICES)} AS activation,
                  {_choice_sql('loss', LOSS_CHOICES)} AS loss FROM supplier)
SELECT s_suppkey AS trial_id, n_layers,
       list_transform(range(1, n_layers + 1), lambda i: CAST(least(floor(exp({_f(a)} + {unit_u} * {_f(b - a)})), {UNITS[1]}) AS INTEGER)) AS layer_sizes,
       round(dropout, 12) AS dropout, batch_norm, learning_rate,
       CASE WHEN weight_decay > 0 THEN 'adamw' ELSE optimizer_drawn END AS optimizer, weight_decay,
       batch_size, epochs, activation, loss FROM t"""


@register("search_space", sql=_search_sql(), digits=12)
def search_space(spark, d):
    """One sampled configuration per supplier (int, log-int layers, uniform, log-uniform,
    categorical), with the rule 'positive weight decay forces adamw'."""
    sup = table(spark, d, "supplier").select(F.col("s_suppkey").alias("trial_id"))
    t = F.col("trial_id")
    n_layers = search.draw_int(search.u(SEED, "n_layers", t), *N_LAYERS)
    wd = search.draw_log_uniform(search.u(SEED, "weight_decay", t), *WEIGHT_DECAY)
    drawn_opt = search.draw_choice(search.u(SEED, "optimizer", t), OPTIMIZER_CHOICES)
    out = sup.select(
        "trial_id", n_layers.alias("n_layers"),
        search.draw_uniform(search.u(SEED, "dropout", t), *DROPOUT).alias("dropout"),
        search.draw_choice(search.u(SEED, "batch_norm", t), BATCH_NORM).alias("batch_norm"),
        search.draw_log_uniform(search.u(SEED, "learning_rate", t), *LEARNING_RATE).alias("learning_rate"),
        F.when(wd > 0, F.lit("adamw")).otherwise(drawn_opt).alias("optimizer"),
        wd.alias("weight_decay"),
        search.draw_choice(search.u(SEED, "batch_size", t), BATCH_SIZES).alias("batch_size"),
        search.draw_choice(search.u(SEED, "epochs", t), EPOCHS).alias("epochs"),
        search.draw_choice(search.u(SEED, "activation", t), ACTIVATION_CHOICES).alias("activation"),
        search.draw_choice(search.u(SEED, "loss", t), LOSS_CHOICES).alias("loss"))
    out = out.withColumn("layer_sizes", search.layer_list(t, F.col("n_layers"), *UNITS, SEED))
    return out.select("trial_id", "n_layers", "layer_sizes", "dropout", "batch_norm", "learning_rate", "optimizer",
                      "weight_decay", "batch_size", "epochs", "activation", "loss")
