"""Column builders for numbers: canonical text, seeded uniforms, NaN handling.

All of these are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_POW_32 = 4294967296.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN -> NULL (pandas treats NaN as missing; Spark's max/avg would return NaN)."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """Apply ``nan_to_null`` to every float/double column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def is_finite(col) -> Column:
    """True for non-null, non-NaN, non-infinite values."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def key6(col) -> Column:
    """Canonical 6-significant-digit key text (``%.5e``), -0.0 folded to 0.

    Used on *both* sides of every join, so equality is exact and consistent.
    """
    c = _c(col).cast("double")
    return F.when(c.isNotNull(), F.format_string("%.5e", F.when(c == 0, F.lit(0.0)).otherwise(c)))


def sig6(col) -> Column:
    """``%.6g`` text as a C printf writes it: 6 significant digits, trailing zeros removed,
    exponent form when the decimal exponent is below -4 or at least 6.  -0.0 is written as 0.

    Java's ``%g`` picks the same form but keeps trailing zeros, so one format call
    and one regex strip them.
    """
    c = _c(col).cast("double")
    t = F.format_string("%.6g", F.when(c == 0, F.lit(0.0)).otherwise(c))
    text = (F.when(F.instr(t, "e") > 0, F.regexp_replace(t, r"\.?0+e", "e"))
            .when(F.instr(t, ".") > 0, F.regexp_replace(t, r"\.?0+$", ""))
            .otherwise(t))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(c), F.lit("nan"))
            .when(c == float("inf"), F.lit("inf"))
            .when(c == float("-inf"), F.lit("-inf"))
            .otherwise(text))


def hash_uniform(seed, dim, ident) -> Column:
    """Seeded uniform in [0, 1): first 8 hex digits of md5('seed|dim|id') over 2^32.

    Same value in any engine with md5, independent of partitioning and retries.
    """
    txt = F.concat_ws("|", F.lit(str(seed)), _c(dim) if isinstance(dim, Column) else F.lit(str(dim)),
                      _c(ident).cast("string"))
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def hash_order_key(seed, ident) -> Column:
    """Seeded sort key (md5 hex text) for reproducible shuffles and samples."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), _c(ident).cast("string")))


def round_to(col, digits: int) -> Column:
    """round(x * 10^d) / 10^d, half away from zero on the binary value of x * 10^d.

    Computed this way (not on the decimal text of x), a value that sits on a
    decimal tie rounds the same way as in C-based engines; non-finite results
    return the input.
    """
    c = _c(col).cast("double")
    m = F.lit(float(10 ** digits))
    r = F.round(c * m, 0) / m
    return F.when(is_finite(r), r).otherwise(c)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (sums depend on partition order)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_to(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the key columns are the left side's."""
    names = {c: f"_right_{i}" for i, c in enumerate(on)}
    cond = None
    for c, r in names.items():
        same = F.col(f"`{c}`").eqNullSafe(F.col(r))
        cond = same if cond is None else cond & same
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def bind_stats(df: DataFrame, stats: DataFrame, name: str = "_st") -> DataFrame:
    """Attach a one-row statistics table to every row as one struct column.

    The statistics run once as a single scalar subquery (no join); refer to the
    fields as ``F.col(name).getField(...)``.  Bind once and reuse the column,
    rather than repeating ``.scalar()`` in many expressions.
    """
    return df.withColumn(name, stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns])).scalar())
