"""Cleaning and projections: unit tags, canonical keys, incomplete rows, finite pairs.

All column work is built-in expressions (codegen); the only driver round trip is
reading one small row of first-seen units to name the output columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from designlab.functions.numeric import is_finite, key6

UNIT_TAIL = r"^(.*?)(\[.*?\])$"   # value then a trailing [unit]
ANY_UNIT = r"\[.*?]"               # every [..] group
NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def strip_units(col) -> Column:
    """Remove every ``[..]`` and trim."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(c, ANY_UNIT, ""))


def strip_unit_headers(df: DataFrame) -> DataFrame:
    """C1 on the header: ``W_mem [m]`` -> ``W_mem``."""
    import re
    names = [re.sub(ANY_UNIT, "", c).strip() for c in df.columns]
    return df.toDF(*names)


def canonical(col) -> Column:
    """Numbers -> 6-significant-digit key text, other text unchanged (units stripped).

    Only decimal and exponent notation is a number: the cast alone would also take the type
    suffixes of Java literals (``1d``, ``2f``).
    """
    s = strip_units(col)
    return F.coalesce(F.when(s.rlike(NUMBER), key6(s.try_cast("double"))), s)


def joined_key(parts: Sequence[Column], sep: str = "|") -> Column:
    """Text key that is equal only for equal parts, position by position: a NULL part counts as an
    empty one, and the separator (and the escape sign) inside a part is escaped."""
    escaped = [F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")),
                         F.lit(sep), F.lit("\\" + sep)) for c in parts]
    return F.concat_ws(sep, *escaped)


def canonical_key(cols: Sequence[str], sep: str = "|") -> Column:
    """Composite text key of canonical values, compared by position."""
    return joined_key([canonical(F.col(c).cast("string")) for c in cols], sep)


def split_unit(col) -> tuple[Column, Column]:
    """(value text, unit text) of a cell like ``7.06e-05[m]``; no tag -> (cell, '')."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    has = c.rlike(UNIT_TAIL)
    value = F.when(has, F.regexp_extract(c, UNIT_TAIL, 1)).otherwise(c)
    unit = F.when(has, F.regexp_extract(c, UNIT_TAIL, 2)).otherwise(F.lit(""))
    return value, unit


def unit_profile(df: DataFrame, order_col: str | None = None, cast: str = "double",
                 keep: Sequence[str] = ()) -> DataFrame:
    """A4 report: one row per column (pos, column, unit, filled, unparsed): the first unit in file order, the
    filled cells, and those of them that are no ``cast``.  One aggregate over the cells."""
    cols = [c for c in df.columns if c not in keep and c != order_col]
    base = df if order_col else df.withColumn("_row", F.monotonically_increasing_id())
    aggs = []
    for i, c in enumerate(cols):
        v, u = split_unit(F.col(f"`{c}`").cast("string"))
        v = F.trim(v)
        aggs += [F.min_by(u, F.when(u != "", F.col(order_col or "_row"))).alias(f"u{i}"),
                 F.count(F.when(v != "", 1)).alias(f"f{i}"),
                 F.count(F.when((v != "") & v.try_cast(cast).isNull(), 1)).alias(f"b{i}")]
    wide = base.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), F.col(f"u{i}").alias("unit"),
                 F.col(f"f{i}").alias("filled"), F.col(f"b{i}").alias("unparsed")) for i, c in enumerate(cols)])))


def unit_split(df: DataFrame, order_col: str | None = None, cast: str | None = "double",
               keep: Sequence[str] = ()) -> DataFrame:
    """A4: strip trailing ``[unit]`` from cells; header gets the first unit seen in file order.

    A header that already holds ``[`` is left alone.  ``order_col`` gives file
    order (default: scan order via ``monotonically_increasing_id``).  Columns in
    ``keep`` pass through untouched.  A column in which any filled cell does not parse as
    ``cast`` stays text, so no cell is lost; ``unit_profile`` counts such cells.
    """
    text_cols = [c for c in df.columns if c not in keep and c != order_col]
    profile = unit_profile(df, order_col, cast or "string", keep).collect() if text_cols else []  # one row per column
    out_cols = [F.col(f"`{k}`") for k in keep]
    for row in profile:
        c, unit = row["column"], row["unit"]
        v = F.trim(split_unit(F.col(f"`{c}`").cast("string"))[0])
        v = F.when(v != "", v)
        name = c if ("[" in c or not unit) else f"{c} {unit}"
        out_cols.append((v.try_cast(cast) if cast and not row["unparsed"] else v).alias(name))
    if order_col:
        out_cols.insert(0, F.col(order_col))
    return df.select(*out_cols)


def is_complete(df: DataFrame) -> Column:
    """No NULL, empty string or NaN in any column of the row."""
    ok = F.lit(True)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        ok = ok & c.isNotNull()
        if isinstance(f.dataType, T.StringType):
            ok = ok & (c != "")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c)
    return ok


def drop_incomplete(df: DataFrame, observe: Observation | None = None) -> DataFrame:
    """Drop rows with any NULL, empty string or NaN (pandas ``dropna`` after '' -> NA).

    ``observe`` gets rows_in, rows_out and removed once the result is computed, in the same pass.
    """
    ok = is_complete(df)
    if observe is not None:
        df = df.observe(observe, *_row_counts(ok))
    return df.where(ok)


def _row_counts(ok: Column) -> list[Column]:
    n, kept = F.count(F.lit(1)), F.count(F.when(ok, 1))
    return [n.alias("rows_in"), kept.alias("rows_out"), (n - kept).alias("removed")]


def count_incomplete(df: DataFrame) -> DataFrame:
    """C3 report: rows in, kept and removed, in one scan."""
    return df.agg(*_row_counts(is_complete(df)))


def finite_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Keep rows where both columns are finite."""
    return df.where(is_finite(a) & is_finite(b))


def np_divide(a, b) -> Column:
    """Float division as numpy does it: x/0 -> +-inf, 0/0 -> NaN (Spark would raise or give NULL)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return (F.when(b != 0, F.try_divide(a, b))
            .when(a > 0, F.lit(float("inf")))
            .when(a < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))


def split_io(df: DataFrame, outputs: int | Sequence[str] = 1) -> tuple[list[str], list[str]]:
    """Input and output column names, by last-k position or by name."""
    cols = df.columns
    if isinstance(outputs, int):
        return cols[:-outputs], cols[-outputs:]
    outs = list(outputs)
    return [c for c in cols if c not in outs], outs


def first_n_columns(df: DataFrame, n: int = 12) -> DataFrame:
    """Positional projection of the first n columns."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def fixed_inputs(df: DataFrame, constants: dict, sweep_col: str, order: Sequence[str]) -> DataFrame:
    """Constant input columns beside one varying column, in a fixed column order."""
    cols = []
    for name in order:
        if name == sweep_col:
            cols.append(F.col(sweep_col))
        else:
            cols.append(F.lit(constants[name]).cast("double").alias(name))
    return df.select(*cols)
