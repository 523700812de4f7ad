"""Design-generation queries over a parameter space derived from lineitem.

Levels are the distinct values of lineitem columns (scaled like a space file),
and sampled designs have one point per order (``design_id = o_orderkey``), so
the work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from designlab.operators import design, space
from designlab.plans.registry import register
from designlab.plans.tables import table
from designlab.session import checkpoint_dir
from designlab.sources import files

SEED = 42
KOH = 1.0
SAMPLES = 20          # points per maximin candidate
GRID_K = 3
FRACTION = "a b c abc"

# Stand-in space (fixed values): name, column, unit, convert_to, scaling factor, offset, linked names
SPACE = [
    space.TableParam("W_mem", "l_quantity", "um", "m", 1e-6, 0.0),
    space.TableParam("T", "l_linenumber", "degC", None, 10.0, 20.0, ("i0_ref_O2", "i0_ref_H2")),
    space.TableParam("eps_H2", "l_discount", None, None, 1.0, 0.0),
    space.TableParam("p_gas", "l_tax", "atm", "Pa", 101325.0, 0.0),
]
NAMES = [p.name for p in SPACE]
LINKS = {"T": ("degC", ["i0_ref_O2", "i0_ref_H2"])}
OUT_UNITS = {"W_mem": "m", "T": "degC", "eps_H2": None, "p_gas": "Pa",
             "i0_ref_O2": "A/m^2", "i0_ref_H2": "A/m^2"}

# Discrete temperature map of the linked parameters (fixed values, degC -> A/m^2)
LOOKUP_T = (30.0, 50.0, 60.0, 80.0)
LOOKUP = {"i0_ref_O2": (0.014, 0.027, 0.037, 0.035), "i0_ref_H2": (0.024, 0.037, 0.047, 0.045)}


def _space(spark, d):
    return space.scaled_levels(space.space_from_table(table(spark, d, "lineitem"), SPACE))


def _params(spark, d):
    return space.collect_params(_space(spark, d))


def _bounds(params):
    return {p.name: (p.lo, p.hi) for p in params}


def _ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("design_id"))


# ---------------------------------------------------------------- SQL pieces

def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _levels_sql() -> str:
    parts = []
    for i, p in enumerate(SPACE):
        parts.append(
            f"SELECT {i} AS pos, '{p.name}' AS name, v * {_f(p.scaling_factor)} + {_f(p.offset)} AS value "
            f"FROM (SELECT DISTINCT CASE WHEN {p.column} = 0 THEN 0.0 ELSE CAST({p.column} AS DOUBLE) END AS v "
            f"FROM lineitem)")
    return "lv AS (" + " UNION ALL ".join(parts) + ")"


LEVELS_SQL = _levels_sql()
BOUNDS_SQL = ("bd AS (SELECT " + ", ".join(
    f"min(value) FILTER (WHERE name = '{n}') AS lo_{n}, max(value) FILTER (WHERE name = '{n}') AS hi_{n}"
    for n in NAMES) + " FROM lv)")


def _hu(seed: str, dim: str, ident: str) -> str:
    return (f"CAST(('0x' || substr(md5('{seed}|{dim}|' || CAST({ident} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / {_f(4294967296.0)}")


def _rescale_sql(u: str, n: str) -> str:
    return f"({u}) * (hi_{n} - lo_{n}) + lo_{n}"


def _linked_sql(t: str, name: str) -> str:
    import math
    a, b, e = space.LINKED_CONSTANTS[("T", name)]
    return f"{_f(a * math.log(KOH) + b)} * exp({_f(-e)} / ({t} + {_f(273.15)}))"


# ---------------------------------------------------------------- queries

@register("space_levels", sql=f"""
WITH {LEVELS_SQL}
SELECT pos, name, CAST(row_number() OVER (PARTITION BY name ORDER BY value) - 1 AS INTEGER) AS level, value,
       CASE name {" ".join(f"WHEN '{p.name}' THEN {repr(p.convert_to or p.unit) if (p.convert_to or p.unit) else 'NULL'}" for p in SPACE)} END AS unit
FROM lv""", digits=12)
def space_levels(spark, d):
    """Parameter levels (distinct column values, scaled by factor and offset)."""
    lv = _space(spark, d)
    return lv.select("pos", "name", F.posexplode("levels").alias("level", "value"),
                     F.col("out_unit").alias("unit"))


@register("space_json", sql=f"""
WITH {LEVELS_SQL}
SELECT pos, name, CAST(row_number() OVER (PARTITION BY name ORDER BY value) - 1 AS INTEGER) AS level, value,
       CASE name {" ".join(f"WHEN '{p.name}' THEN {repr(p.convert_to or p.unit) if (p.convert_to or p.unit) else 'NULL'}" for p in SPACE)} END AS unit
FROM lv""", digits=12)
def space_json(spark, d):
    """The space written as a JSON space file, with a parameter without values beside it, and read back."""
    raw = space.space_from_table(table(spark, d, "lineitem"), SPACE)
    path = f"{checkpoint_dir(spark).rstrip('/')}/space-{uuid.uuid4().hex[:8]}"
    space.write_space(raw.unionByName(raw.where("pos = 0").withColumns({
        "pos": F.lit(len(SPACE)), "name": F.lit("derived"), "values": F.lit(None).cast("array<double>")})), path)
    lv = space.scaled_levels(space.read_space(spark, path))
    return lv.select("pos", "name", F.posexplode("levels").alias("level", "value"), F.col("out_unit").alias("unit"))


def _ff_sql(with_lookup: bool = False) -> str:
    idx = ", ".join(
        f"(SELECT value AS {n}, row_number() OVER (ORDER BY value) AS i{k} FROM lv WHERE name = '{n}') t{k}"
        for k, n in enumerate(NAMES))
    order = ", ".join(f"i{k}" for k in range(len(NAMES)))
    linked = []
    for name in ("i0_ref_O2", "i0_ref_H2"):
        f = _linked_sql("T", name)
        if with_lookup:
            cases = " ".join(f"WHEN abs(T - {_f(t)}) < {_f(1e-8)} THEN {_f(v)}" for t, v in zip(LOOKUP_T, LOOKUP[name]))
            f = f"CASE {cases} ELSE {f} END"
        linked.append(f"{f} AS {name}")
    return f"""WITH {LEVELS_SQL}
SELECT row_number() OVER (ORDER BY {order}) - 1 AS design_id, {", ".join(NAMES)}, {", ".join(linked)}
FROM {idx}"""


@register("full_factorial", sql=_ff_sql(), digits=12)
def full_factorial(spark, d):
    """Product of all levels (last parameter fastest) plus linked columns."""
    params = _params(spark, d)
    ff = design.full_factorial(spark, {p.name: p.levels for p in params})
    return space.with_linked(ff, LINKS, KOH)


@register("linked_lookup", sql=_ff_sql(with_lookup=True), digits=12)
def linked_lookup(spark, d):
    """Discrete temperature map within 1e-8 first, Arrhenius formula otherwise."""
    params = _params(spark, d)
    ff = design.full_factorial(spark, {p.name: p.levels for p in params})
    pairs = {n: list(zip(LOOKUP_T, vals)) for n, vals in LOOKUP.items()}
    return space.with_linked(ff, LINKS, KOH, lookup=pairs)


def _grid_sql() -> str:
    tabs = ", ".join(
        f"(SELECT i AS i{k}, CASE WHEN i = {GRID_K - 1} THEN hi_{n} ELSE lo_{n} + i * ((hi_{n} - lo_{n}) / {GRID_K - 1}) END AS {n} "
        f"FROM range({GRID_K}) r(i), bd) t{k}" for k, n in enumerate(NAMES))
    order = ", ".join(f"i{k}" for k in range(len(NAMES)))
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL}
SELECT row_number() OVER (ORDER BY {order}) - 1 AS design_id, {", ".join(NAMES)} FROM {tabs}"""


@register("grid_design", sql=_grid_sql(), digits=12)
def grid_design(spark, d):
    """B2: three evenly spaced points between each parameter's min and max, full product."""
    return design.grid(spark, _bounds(_params(spark, d)), GRID_K)


def _frac_sql() -> str:
    tokens, base = design.parse_generators(FRACTION)
    cols = []
    for tok, n in zip(tokens, NAMES):
        sign = " * ".join(f"(((id >> {base.index(ch)}) % 2) * 2 - 1)" for ch in tok)
        cols.append(f"(({sign}) + 1) / {_f(2.0)} * (hi_{n} - lo_{n}) + lo_{n} AS {n}")
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL}
SELECT id AS design_id, {", ".join(cols)} FROM range({2 ** len(base)}) r(id), bd"""


@register("fractional_factorial", sql=_frac_sql(), digits=12)
def fractional_factorial(spark, d):
    """Two-level fraction 'a b c abc' (generator abc) over min/max of each parameter."""
    return design.fractional_factorial(spark, FRACTION, _bounds(_params(spark, d)))


@register("random_design", sql=f"""
WITH {LEVELS_SQL}, {BOUNDS_SQL}
SELECT o_orderkey AS design_id, {", ".join(_rescale_sql(_hu(str(SEED), n, 'o_orderkey'), n) + f' AS {n}' for n in NAMES)}
FROM orders, bd""", digits=12)
def random_design(spark, d):
    """Seeded uniform point per order inside the parameter bounds."""
    return design.random_uniform(_ids(spark, d), _bounds(_params(spark, d)), SEED)


def _lhs_sql() -> str:
    per = []
    for n in NAMES:
        h = _hu(f"{SEED}:perm", n, "o_orderkey")
        j = _hu(f"{SEED}:jit", n, "o_orderkey")
        per.append(f"""{n}_r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY {h}, o_orderkey) - 1 + {j})
                         / count(*) OVER () AS u FROM orders)""")
    joins = " ".join(f"JOIN {n}_r USING (o_orderkey)" if k else f"{n}_r" for k, n in enumerate(NAMES))
    sel = ", ".join(f"{n}_r.u * (hi_{n} - lo_{n}) + lo_{n} AS {n}" for n in NAMES)
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL}, {", ".join(per)}
SELECT o_orderkey AS design_id, {sel} FROM {joins}, bd"""


@register("lhs_design", sql=_lhs_sql(), digits=12)
def lhs_design(spark, d):
    """Latin hypercube over all orders (distributed rank per parameter, one pivot)."""
    return design.lhs(_ids(spark, d), _bounds(_params(spark, d)), SEED)


def _maximin_sql() -> str:
    parts = []
    for n in NAMES:
        h = _hu(f"{SEED}:perm", n, "design_id")
        j = _hu(f"{SEED}:jit", n, "design_id")
        parts.append(f"((row_number() OVER (PARTITION BY it ORDER BY {h}, design_id) - 1 + {j}) / count(*) OVER (PARTITION BY it))"
                     f" * (hi_{n} - lo_{n}) + lo_{n} AS {n}")
    dist = " + ".join(f"(a.{n} - b.{n}) * (a.{n} - b.{n})" for n in NAMES)
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL},
ids AS (SELECT o_orderkey AS design_id, CAST(floor(o_orderkey / {SAMPLES}) AS BIGINT) AS it FROM orders),
c AS (SELECT it, design_id, {", ".join(parts)} FROM ids, bd),
s AS (SELECT a.it, min(sqrt({dist})) AS min_dist FROM c a JOIN c b ON a.it = b.it AND a.design_id < b.design_id GROUP BY a.it),
best AS (SELECT it, min_dist FROM s ORDER BY min_dist DESC, it LIMIT 1)
SELECT c.it, c.design_id, {", ".join(f"c.{n}" for n in NAMES)}, best.min_dist FROM c JOIN best USING (it)"""


@register("maximin_design", sql=_maximin_sql(), digits=9)
def maximin_design(spark, d):
    """Candidate hypercubes of 20 orders each; keep the one with the largest minimum distance."""
    ids = _ids(spark, d).withColumn("it", F.floor(F.col("design_id") / SAMPLES).cast("long"))
    return design.maximin_lhs(ids, _bounds(_params(spark, d)), "it", SEED)


def _sobol_sql() -> str:
    cols = []
    for k, n in enumerate(NAMES):
        terms = [f"CASE WHEN (g >> {b}) % 2 = 1 THEN {v} ELSE 0 END" for b, v in enumerate(design.sobol_directions(k))]
        acc = terms[0]
        for t in terms[1:]:
            acc = f"xor({acc}, {t})"
        acc = f"xor({acc}, {design.sobol_shift(SEED, k)})"
        cols.append(f"(CAST({acc} AS DOUBLE) / {_f(4294967296.0)}) * (hi_{n} - lo_{n}) + lo_{n} AS {n}")
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL},
ids AS (SELECT o_orderkey, xor(o_orderkey, o_orderkey >> 1) AS g FROM orders)
SELECT o_orderkey AS design_id, {", ".join(cols)} FROM ids, bd"""


@register("sobol_design", sql=_sobol_sql(), digits=12)
def sobol_design(spark, d):
    """Sobol point number o_orderkey (Gray code, Joe-Kuo directions) with a seeded digital shift."""
    return design.sobol(_ids(spark, d), _bounds(_params(spark, d)), SEED)


def _scrambled_sql() -> str:
    """The same points digit by digit: output bit r of a point is the parity of Gray-coded index bits b whose
    scrambled direction has bit r, added up as a weighted sum instead of XORs."""
    cols = []
    for k, n in enumerate(NAMES):
        v = design.scrambled_directions(k, SEED)
        shift = design.scrambled_shift(SEED, k)
        terms = []
        for r in range(52):
            mask = sum(((x >> r) & 1) << b for b, x in enumerate(v))
            terms.append(f"((bit_count(g & {mask}) + {(shift >> r) & 1}) % 2) * {1 << r}")
        cols.append(f"(CAST({' + '.join(terms)} AS DOUBLE) / {_f(float(1 << 52))}) * (hi_{n} - lo_{n}) + lo_{n} AS {n}")
    return f"""WITH {LEVELS_SQL}, {BOUNDS_SQL},
i AS (SELECT o_orderkey, o_orderkey + {1 << 40} AS x FROM orders),
ids AS (SELECT o_orderkey, xor(x, x >> 1) AS g FROM i)
SELECT o_orderkey AS design_id, {", ".join(cols)} FROM ids, bd"""


@register("sobol_scrambled", sql=_scrambled_sql(), digits=12)
def sobol_scrambled(spark, d):
    """Scrambled Sobol points from number 2^40 on."""
    ids = _ids(spark, d).withColumn("point", F.col("design_id") + (1 << 40))
    return design.sobol_scrambled(ids, _bounds(_params(spark, d)), SEED, index_col="point")


@register("linked_columns", sql=f"""
WITH {LEVELS_SQL}, {BOUNDS_SQL},
r AS (SELECT o_orderkey AS design_id, {_rescale_sql(_hu(str(SEED), 'T', 'o_orderkey'), 'T')} AS T FROM orders, bd)
SELECT design_id, T, {_linked_sql('T', 'i0_ref_O2')} AS i0_ref_O2, {_linked_sql('T', 'i0_ref_H2')} AS i0_ref_H2 FROM r""",
          digits=12)
def linked_columns(spark, d):
    """Arrhenius-linked exchange currents from the (degC) temperature of a random design."""
    rnd = design.random_uniform(_ids(spark, d), _bounds(_params(spark, d)), SEED)
    return space.with_linked(rnd, LINKS, KOH).select("design_id", "T", "i0_ref_O2", "i0_ref_H2")


def _sig6_sql(c: str) -> str:
    return f"printf('%.6g', CASE WHEN {c} = 0 THEN 0.0 ELSE {c} END)"


@register("unit_export", sql=f"""
WITH {LEVELS_SQL}, {BOUNDS_SQL},
r AS (SELECT o_orderkey AS design_id, {", ".join(_rescale_sql(_hu(str(SEED), n, 'o_orderkey'), n) + f' AS {n}' for n in NAMES)}
      FROM orders, bd)
SELECT design_id, {", ".join((f"{_sig6_sql(n)} || '[{OUT_UNITS[n]}]' AS {n}" if OUT_UNITS[n] else n) for n in NAMES)} FROM r""",
          digits=12)
def unit_export(spark, d):
    """Design as unit-tagged text (%.6g[unit]); unitless columns stay numeric."""
    rnd = design.random_uniform(_ids(spark, d), _bounds(_params(spark, d)), SEED)
    return files.design_text(rnd, OUT_UNITS)


@register("param_list_export", sql=f"""
WITH {LEVELS_SQL}, {BOUNDS_SQL},
r AS (SELECT o_orderkey AS design_id, {", ".join(_rescale_sql(_hu(str(SEED), n, 'o_orderkey'), n) + f' AS {n}' for n in NAMES)}
      FROM orders, bd),
s AS ({" UNION ALL ".join(f"SELECT {i} AS pos, '{n}' AS name, design_id, {n} AS v FROM r" for i, n in enumerate(NAMES))})
SELECT name AS param, CASE WHEN design_id = (SELECT min(design_id) FROM r) THEN name || ' "' ELSE '' END || {_sig6_sql('v')} ||
       CASE WHEN design_id = (SELECT max(design_id) FROM r)
            THEN '" [' || CASE name {" ".join(f"WHEN '{n}' THEN '{OUT_UNITS[n] or ''}'" for n in NAMES)} END || ']' ELSE '' END AS piece
FROM s""")
def param_list_export(spark, d):
    """Transposed list 'name "v1, v2, ..." [unit]' per parameter, written in pieces and read back."""
    rnd = design.random_uniform(_ids(spark, d), _bounds(_params(spark, d)), SEED)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/param-list-{uuid.uuid4().hex[:8]}"
    files.write_param_list(files.param_values(rnd, OUT_UNITS, NAMES), folder)
    return files.read_param_list(spark, folder)


@register("design_csv_roundtrip", sql=f"""
WITH {LEVELS_SQL}, {BOUNDS_SQL},
r AS (SELECT o_orderkey AS design_id, {", ".join(_rescale_sql(_hu(str(SEED), n, 'o_orderkey'), n) + f' AS {n}' for n in NAMES)}
      FROM orders, bd)
SELECT design_id, {", ".join((f'CAST({_sig6_sql(n)} AS DOUBLE) AS "{n} [{OUT_UNITS[n]}]"' if OUT_UNITS[n] else n) for n in NAMES)}
FROM r""", digits=12)
def design_csv_roundtrip(spark, d):
    """A6 then A4: the random design written as a unit-tagged CSV in the shared folder, read back with
    units moved from the cells to the headers (values keep 6 significant digits)."""
    rnd = design.random_uniform(_ids(spark, d), _bounds(_params(spark, d)), SEED)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/design-{uuid.uuid4().hex[:8]}"
    files.design_text(rnd, OUT_UNITS).write.mode("overwrite").option("header", True).csv(folder)
    back = files.read_unit_csv(spark, folder)
    return back.select(F.col("design_id").cast("long").alias("design_id"), *[c for c in back.columns if c != "design_id"])
