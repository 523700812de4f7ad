"""Splits and scaling.

Splits are exact and reproducible: rows (or groups) are ordered by a seeded md5
key, the hashes at the cut points are found by radix selection, and each row is
labelled by comparing its own hash with them, so rows are neither moved nor
joined.  Scaling statistics are one aggregate, attached to the rows as one bound
struct (no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from designlab.functions.numeric import bind_stats
from designlab.operators.clean import joined_key
from designlab.operators.select import select_ranks
from designlab.session import cut_lineage


def _key_text(cols: Sequence[str]) -> Column:
    return joined_key([F.col(c).cast("string") for c in cols])


HASH_DIGITS = 15  # hex digits of the order key: 60 bits


def _hash(seed: int, text: Column) -> Column:
    """Seeded order key: the first digits of an md5 as text."""
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), text)), 1, HASH_DIGITS)


def _cut_points(hashes: DataFrame, test_size: float, n_val) -> DataFrame:
    """One row (last_test, first_val, last_val): the hashes where the seeded order of ``_h`` rows is cut.

    Test = the first ceil(test_size * n) hashes; ``n_val`` gives (start, end) of validation from (n, n_test).
    """
    def ranks(n: Column) -> list[Column]:
        n_test = F.ceil(n * F.lit(float(test_size)))
        start, end = n_val(n, n_test)
        return [n_test - 1, F.when(start < end, start), F.when(start < end, end - 1)]

    keys = hashes.select(F.conv("_h", 16, 10).cast("long").alias("_k"))
    found = select_ranks(cut_lineage(keys), [], ranks)

    def text(key: str) -> Column:
        return F.lpad(F.lower(F.hex(F.max(key))), HASH_DIGITS, "0")

    # one row even where no rank is inside
    return found.agg(text("key0").alias("last_test"), text("key1").alias("first_val"), text("key2").alias("last_val"))


def _label(rows: DataFrame, cuts: DataFrame, split_col: str) -> DataFrame:
    """Rows labelled by comparing their ``_h`` with the cut points; ``_h`` is dropped."""
    out = bind_stats(rows, cuts, "_cut")
    h, cut = F.col("_h"), F.col("_cut")
    split = (F.when(h <= cut.getField("last_test"), F.lit("test"))
             .when((h >= cut.getField("first_val")) & (h <= cut.getField("last_val")), F.lit("val"))
             .otherwise(F.lit("train")))
    return out.withColumn(split_col, split).drop("_h", "_cut")


def row_split(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2, val_size: float = 0.1,
              seed: int = 42, split_col: str = "split") -> DataFrame:
    """L1 + L4: test = first ceil(test_size * n) rows in seeded hash order; of the remaining
    training rows (same order) the last ``val_size`` fraction is validation.

    The sizes are exact where ``key_cols`` name a row; rows that share a key stay on one side.
    """
    hashed = df.withColumn("_h", _hash(seed, _key_text(key_cols)))

    def val(n, n_test):
        return n_test + F.floor((n - n_test) * F.lit(1.0 - val_size)), n

    return _label(hashed, _cut_points(hashed.select("_h"), test_size, val), split_col)


def group_split(df: DataFrame, group_key: Column | str, test_size: float = 0.2, val_size: float = 0.1,
                seed: int = 42, split_col: str = "split") -> DataFrame:
    """L2 + L3: whole groups go to one side.  Test groups = first ceil(test_size * G) groups in
    seeded hash order; validation = the next ceil(val_size * G_train); the rest train.

    Rows with a NULL key form one group of their own.  Only the distinct hashes of the keys move.
    """
    key = F.col(group_key) if isinstance(group_key, str) else group_key
    hashed = df.withColumn("_h", _hash(seed, key.cast("string")))

    def val(n, n_test):
        return n_test, n_test + F.ceil((n - n_test) * F.lit(float(val_size)))

    return _label(hashed, _cut_points(hashed.select("_h").distinct(), test_size, val), split_col)


def fit_standard(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """L5 statistics: mean and population std per column (one aggregate row)."""
    return df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                  *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])


def apply_standard(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / std with std 0 -> 1 (scikit-learn's StandardScaler; Spark ML's uses sample std)."""
    b = bind_stats(df, stats, "_ss")
    s = F.col("_ss")
    for c in cols:
        sd = s.getField(f"s_{c}")
        b = b.withColumn(f"{c}{suffix}", (F.col(c).cast("double") - s.getField(f"m_{c}")) /
                         F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd))
    return b.drop("_ss")


def invert_standard(df: DataFrame, stats: DataFrame, col: str, pred_col: str, out_col: str) -> DataFrame:
    """P * std + mean (std 0 -> 1) for a standardised target."""
    b = bind_stats(df, stats, "_ss")
    s = F.col("_ss")
    sd = s.getField(f"s_{col}")
    sd = F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd)
    return b.withColumn(out_col, F.col(pred_col) * sd + s.getField(f"m_{col}")).drop("_ss")
