"""Parameter spaces: read, scale, bound, and derive linked columns.

A space is a small table (one row per parameter).  It is collected once to
build Columns (its size is the number of parameters); every design built from
it is a lazy, distributed plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAM_STRUCT = T.StructType([
    T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("unit", T.StringType()),
    T.StructField("convert_to", T.StringType()),
    T.StructField("scaling_factor", T.DoubleType()),
    T.StructField("offset", T.DoubleType()),
    T.StructField("linked", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
])
SPACE_SCHEMA = T.StructType([T.StructField("parameters", T.MapType(T.StringType(), PARAM_STRUCT))])


def read_space(spark: SparkSession, path: str) -> DataFrame:
    """A1: JSON space file -> one row per parameter in file key order; no ``parameters`` -> empty."""
    raw = spark.read.schema(SPACE_SCHEMA).option("multiLine", True).json(path)
    ent = raw.select(F.posexplode(F.map_entries(F.coalesce("parameters", F.create_map().cast(
        SPACE_SCHEMA["parameters"].dataType)))).alias("pos", "e"))
    return ent.select("pos", F.col("e.key").alias("name"), "e.value.*")


def write_space(space: DataFrame, path: str) -> None:
    """A1 sink: the space (one row per parameter) as a JSON space file; columns that are NULL are left out."""
    entry = F.struct(*[F.col(f.name) for f in PARAM_STRUCT.fields])
    rows = F.array_sort(F.collect_list(F.struct("pos", "name", entry.alias("e"))), lambda a, b: a["pos"] - b["pos"])
    pairs = F.transform(rows, lambda r: F.struct(r["name"].alias("key"), r["e"].alias("value")))
    space.coalesce(1).agg(F.map_from_entries(pairs).alias("parameters")).write.mode("overwrite").json(path)


def scaled_levels(space: DataFrame) -> DataFrame:
    """Levels v * scaling_factor + offset (defaults 1 and 0); parameters without values dropped."""
    scale = F.coalesce(F.col("scaling_factor"), F.lit(1.0))
    off = F.coalesce(F.col("offset"), F.lit(0.0))
    return (space.where(F.col("values").isNotNull())
            .withColumn("levels", F.transform("values", lambda v: v * scale + off))
            .withColumn("out_unit", F.coalesce(F.nullif(F.col("convert_to"), F.lit("")), F.col("unit"))))


@dataclass
class Param:
    name: str
    levels: list[float]
    unit: str | None = None
    linked: dict[str, list[float]] = field(default_factory=dict)

    @property
    def lo(self) -> float:
        return min(self.levels)

    @property
    def hi(self) -> float:
        return max(self.levels)


def collect_params(levels: DataFrame) -> list[Param]:
    """Bring the (parameter-sized) level table to the driver, in parameter order."""
    rows = levels.orderBy("pos").select("name", "levels", "out_unit", "linked").collect()
    return [Param(r["name"], list(r["levels"]), r["out_unit"], dict(r["linked"] or {})) for r in rows]


@dataclass
class TableParam:
    """A parameter whose levels are the distinct values of a table column."""
    name: str
    column: str
    unit: str | None = None
    convert_to: str | None = None
    scaling_factor: float = 1.0
    offset: float = 0.0
    linked: tuple[str, ...] = ()


def space_from_table(df: DataFrame, spec: Sequence[TableParam]) -> DataFrame:
    """Space table whose levels are the sorted distinct values of columns (one aggregate).

    Meant for level-like columns (a bounded domain); ``collect_set`` is merged
    map-side, so each task ships at most the domain size.
    """
    def norm(c):  # -0.0 and 0.0 are one level
        c = F.col(c).cast("double")
        return F.when(c == 0, F.lit(0.0)).otherwise(c)
    aggs = [F.sort_array(F.collect_set(norm(p.column))).alias(f"v{i}") for i, p in enumerate(spec)]
    wide = df.agg(*aggs)
    rows = []
    for i, p in enumerate(spec):
        linked = F.create_map(*[x for n in p.linked for x in (F.lit(n), F.lit(None).cast("array<double>"))]) \
            if p.linked else F.lit(None).cast("map<string,array<double>>")
        rows.append(F.struct(F.lit(i).alias("pos"), F.lit(p.name).alias("name"), F.col(f"v{i}").alias("values"),
                             F.lit(p.unit).cast("string").alias("unit"),
                             F.lit(p.convert_to).cast("string").alias("convert_to"),
                             F.lit(float(p.scaling_factor)).alias("scaling_factor"),
                             F.lit(float(p.offset)).alias("offset"), linked.alias("linked")))
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- linked columns

CELSIUS_UNITS = ("degc", "°c", "celsius")

# Exchange-current prefactors against ln(KOH molarity) and activation temperatures (fixed values)
LINKED_CONSTANTS = {
    ("T", "i0_ref_H2"): (1.182, 6.272, 1758.1),
    ("T", "i0_ref_O2"): (0.536, 3.353, 1458.2),
}

LinkedFormula = Callable[[Column, float], Column]
_FORMULAS: dict[tuple[str, str], LinkedFormula] = {}


def register_linked(base: str, linked: str, fn: LinkedFormula) -> None:
    """Register ``fn(base_in_kelvin_or_raw, koh_molarity) -> Column`` for (base, linked)."""
    _FORMULAS[(base, linked)] = fn


def _arrhenius(a: float, b: float, e: float) -> LinkedFormula:
    def f(temp_k: Column, koh: float) -> Column:
        return (F.lit(a * math.log(koh) + b)) * F.exp(F.lit(-e) / temp_k)
    return f


for (_b, _l), (_a, _c, _e) in LINKED_CONSTANTS.items():
    register_linked(_b, _l, _arrhenius(_a, _c, _e))


def linked_column(base: str, linked: str, base_col: Column, base_unit: str | None, koh: float | None) -> Column:
    """Value of ``linked`` from the base column; Celsius units are moved to Kelvin."""
    if (base, linked) not in _FORMULAS:
        raise NotImplementedError(f"{base} -> {linked}: unknown formula (see register_linked)")
    if koh is None:
        raise ValueError(f"{base} -> {linked}: this formula needs a molarity (koh)")
    t = base_col + F.lit(273.15) if (base_unit or "").lower() in CELSIUS_UNITS else base_col
    return _FORMULAS[(base, linked)](t, koh)


def with_linked(design: DataFrame, links: dict[str, tuple[str | None, Sequence[str]]],
                koh: float | None = 1.0, lookup: dict[str, Sequence[tuple[float, float]]] | None = None,
                tol: float = 1e-8) -> DataFrame:
    """Add every linked column; links = {base: (base unit, [linked names])}.

    A base absent from the design is skipped.  ``lookup`` optionally maps a
    linked name to its discrete (base level, linked value) pairs, one per base
    level (parameter-sized): a design value within ``tol`` of a level takes the
    first matching mapped value, any other value the formula.  The map becomes a
    CASE expression, so no join is needed.
    """
    out = design
    for base, (unit, names) in links.items():
        if base not in design.columns:
            continue
        for name in names:
            expr = linked_column(base, name, F.col(base), unit, koh)
            pairs = (lookup or {}).get(name)
            if pairs:
                case = None
                for bv, lv in pairs:
                    cond = F.abs(F.col(base) - F.lit(float(bv))) < F.lit(tol)
                    case = F.when(cond, F.lit(float(lv))) if case is None else case.when(cond, F.lit(float(lv)))
                expr = case.otherwise(expr)
            out = out.withColumn(name, expr)
    return out


def lookup_pairs(space_row_levels: Sequence[float], linked_values: Sequence[float] | None) -> list[tuple[float, float]]:
    """Pairs (level, mapped value) of a space entry's ``linked`` array (zip, shortest wins)."""
    if not linked_values:
        return []
    return list(zip(space_row_levels, linked_values))
