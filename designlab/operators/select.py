"""Exact order statistics by radix selection: k-th smallest values, quantiles and medians per group.

A value becomes a 64-bit key that sorts as the value does.  Each pass counts the rows per 16 bits of the key
(a hash aggregate, combined before the shuffle), finds in the running sums the bucket that holds each wanted
rank, and the next pass counts only the rows of those buckets.  After the last pass a bucket is one key.  A
bucket's counts are 65,536 numbers per pass at most; once no wanted bucket has more rows than that, a pass
takes all bits that are left under the same bound, so there are two to four passes.  No row is sorted or
shuffled, and a group or a value with a third of the rows is only a large count.

The slim (group, key) rows are read by every pass, so they are written once to the checkpoint folder and a
costly input is evaluated a single time.  Each pass is one job.  The wanted buckets reach the rows by an
equi-join: as a broadcast up to ``BROADCAST_ROWS`` of them, by a shuffle of the slim rows beyond (very many
groups, so that a group is a small part of the rows or, if it is a large one, Spark splits its join).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from designlab.functions.numeric import null_safe_join
from designlab.session import BROADCAST_ROWS, cut_lineage, measured

DIGIT_BITS = 16
KEY_BITS = 64
_MANTISSA = 1 << 52
_LEAST_NORMAL = 2.0 ** -1022
_INF = float("inf")


def with_sort_key(df: DataFrame, value: Column, name: str = "_k") -> DataFrame:
    """``df`` with a 64-bit integer that sorts as the double does: its IEEE bits, negated for negative numbers.

    Built from arithmetic, so it stays in generated code; the steps are columns of their own, so that the
    logarithm and the power are evaluated once a row.  -0.0 and 0.0 have one key; NULL and NaN give NULL.
    """
    x = F.col("_x")
    a = F.abs(x)
    normal = F.when((a >= _LEAST_NORMAL) & (a < _INF), a).otherwise(1.0)
    out = (df.withColumn("_x", value.cast("double"))
           .withColumn("_e", F.floor(F.log2(normal)))  # off by one at most
           .withColumn("_s", normal * _two_to(-F.col("_e"))))  # exact, in [1, 2) but for that
    e, s = F.col("_e"), F.col("_s")

    def bits(exponent: Column, one_to_two: Column) -> Column:
        return F.shiftleft((exponent + 1023).cast("long"), 52) + ((one_to_two - 1.0) * float(_MANTISSA)).cast("long")

    # 2^1074 is no double, hence two steps
    positive = (F.when(a == _INF, F.lit(0x7FF << 52))
                .when(a < _LEAST_NORMAL, (a * 2.0 ** 537 * 2.0 ** 537).cast("long"))
                .when(s >= 2, bits(e + 1, s * 0.5)).when(s < 1, bits(e - 1, s * 2.0)).otherwise(bits(e, s)))
    key = F.when(x.isNotNull() & ~F.isnan(x), F.when(x < 0, -positive).otherwise(positive))
    return out.withColumn(name, key).drop("_x", "_e", "_s")


def _two_to(exponent: Column) -> Column:
    """2^exponent, exact for every exponent that a double has (Java's pow is exact for integers)."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def key_value(key: Column) -> Column:
    """The double of a ``with_sort_key`` key."""
    bits = F.abs(key)
    e = F.shiftright(bits, 52)
    m = bits.bitwiseAND(_MANTISSA - 1)
    v = (F.when(e == 0x7FF, F.lit(_INF)).when(e == 0, m.cast("double") * 2.0 ** -1074)
         .otherwise((m + _MANTISSA).cast("double") * _two_to(e - 1075)))
    return F.when(key < 0, -v).otherwise(v)


def _narrowed(counts: DataFrame, group_cols: list[str], within: list[str]) -> DataFrame:
    """Buckets that hold a wanted rank, with the ranks counted from the bucket's first row."""
    w = Window.partitionBy(*group_cols, *within).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.sum("_c").over(w))
    before = F.col("_upto") - F.col("_c")
    held = F.filter("_want", lambda t: (t["rank"] >= before) & (t["rank"] < F.col("_upto")))
    rest = F.transform(held, lambda t: F.struct(t["pos"].alias("pos"), (t["rank"] - before).alias("rank")))
    return upto.select(*group_cols, "_n", "_c", "_p", rest.alias("_want")).where(F.size("_want") > 0)


def select_ranks(rows: DataFrame, group_cols: Sequence[str],
                 ranks: Callable[[Column], Sequence[Column]], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(group columns, n, key0, key1, ...): per group of (group columns, ``_k``) rows their number and the
    keys at the 0-based ranks that ``ranks`` makes from it.

    A rank that is NULL or outside the group gives NULL; a group without any rank inside it gives no row.
    ``rows`` is read once a pass: hand over written rows.
    """
    group_cols = list(group_cols)
    k = F.col("_k")
    counts = (rows.groupBy(*group_cols, F.shiftright(k, KEY_BITS - DIGIT_BITS).alias("_p"))
              .agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*group_cols))))
    wanted = [r.cast("long") for r in ranks(F.col("_n"))]
    counts = counts.withColumn("_want", F.array(*[F.struct(F.lit(i).alias("pos"), r.alias("rank"))
                                                  for i, r in enumerate(wanted)]))
    buckets = measured(_narrowed(counts, group_cols, []), broadcast_rows)
    shift = KEY_BITS - DIGIT_BITS
    while shift:
        here = null_safe_join(rows.withColumn("_p", F.shiftright(k, shift)), buckets.drop("_c"), [*group_cols, "_p"])
        largest = buckets.agg(F.max("_c")).first()[0] or 0
        shift = shift - DIGIT_BITS if largest > 1 << DIGIT_BITS else 0
        counts = (here.groupBy(*group_cols, "_n", "_want", F.col("_p").alias("_in"), F.shiftright(k, shift).alias("_p"))
                  .agg(F.count(F.lit(1)).alias("_c")))
        buckets = measured(_narrowed(counts, group_cols, ["_in"]), broadcast_rows)
    found = buckets.select(*group_cols, "_n", "_p", F.explode("_want.pos").alias("_pos"))
    return found.groupBy(*group_cols).agg(
        F.max("_n").alias("n"), *[F.max(F.when(F.col("_pos") == i, F.col("_p"))).alias(f"key{i}")
                                  for i in range(len(wanted))])


def quantiles_of_keys(rows: DataFrame, qs: Sequence[float], group_cols: Sequence[str],
                      names: Sequence[str]) -> DataFrame:
    """Linear-interpolated quantiles per group of written (group columns, ``_k``) rows."""
    def ranks(n: Column) -> list[Column]:
        at = [(n - 1) * F.lit(float(q)) for q in qs]
        return [r for h in at for r in (F.floor(h), F.ceil(h))]

    picked = select_ranks(rows, group_cols, ranks)
    out = []
    for i, (q, name) in enumerate(zip(qs, names, strict=True)):
        lo, hi = key_value(F.col(f"key{2 * i}")), key_value(F.col(f"key{2 * i + 1}"))
        h = (F.col("n") - 1) * F.lit(float(q))
        # equal neighbours need no interpolation (and infinite ones allow none)
        out.append(F.when(lo == hi, lo).otherwise(lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    return picked.select(*group_cols, *out)


def quantile_names(qs: Sequence[float]) -> list[str]:
    return [f"q{int(round(q * 100)):02d}" for q in qs]


def exact_quantiles(df: DataFrame, value_col: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                    names: Sequence[str] | None = None, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Linear-interpolated quantiles of ``value_col`` per group (NULL and NaN skipped), one column each.

    ``approx=True`` gives ``percentile_approx`` instead.
    """
    group_cols = list(group_cols)
    names = list(names) if names else quantile_names(qs)
    if approx:
        v = F.col(value_col).cast("double")
        arr = F.percentile_approx(v, list(qs), accuracy)
        res = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*group_cols).agg(arr.alias("_qs"))
        return res.select(*group_cols, *[F.col("_qs")[i].alias(nm) for i, nm in enumerate(names)])
    v = F.col("_v")
    # missing values go before the key is made: a filter on the key would evaluate it again
    data = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    return quantiles_of_keys(cut_lineage(with_sort_key(data, v).drop("_v")), qs, group_cols, names)


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                 name: str = "median", approx: bool = False) -> DataFrame:
    return exact_quantiles(df, value_col, [0.5], group_cols, [name], approx=approx)
