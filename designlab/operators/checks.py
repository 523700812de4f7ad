"""Completeness check of a design against its status and result tables (one plan).

Rows of all three tables are compared by a canonical key of their input values
(6 significant digits).  The report reads each table once, as a tagged union under
one aggregate by key.  Verdicts per design row join the design to the status and
result tables, which are first reduced to one row per key (hash aggregates with
map-side combine, so a hot key costs one row per map task); AQE splits a skewed
design key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.operators.clean import canonical_key

FAULT_KINDS = ("duplicate_design", "duplicate_status", "missing", "matched_twice",
               "no_results", "too_few", "too_many", "failed_with_results", "strays")


def keyed(df: DataFrame, key_cols: Sequence[str], row_col: str | None = None,
          extra: Sequence = ()) -> DataFrame:
    """(key, row_no, extra..) with the canonical key of ``key_cols``."""
    cols = [canonical_key(key_cols).alias("key")]
    if row_col:
        cols.append(F.col(row_col).alias("row_no"))
    return df.select(*cols, *extra)


def key_counts(keyed_df: DataFrame) -> DataFrame:
    """Rows per key."""
    return keyed_df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def first_repeat(keyed_df: DataFrame, table_name: str) -> DataFrame:
    """Duplicated keys of one table and the first row that repeats an earlier one.

    first repeat = min over rows of row_no where row_no > (first row_no of its key);
    found with one aggregate and one join, never a window over a key.
    """
    firsts = keyed_df.groupBy("key").agg(F.min("row_no").alias("_first"), F.count(F.lit(1)).alias("_n"))
    rep = keyed_df.join(firsts.where(F.col("_n") > 1), "key").where(F.col("row_no") > F.col("_first"))
    return rep.agg(
        F.lit(table_name).alias("table_name"),
        F.count(F.lit(1)).alias("repeat_rows"),
        F.countDistinct("key").alias("repeated_keys"),
        F.min("row_no").alias("first_repeat_row"),
    )


def status_by_key(status: DataFrame) -> DataFrame:
    """One row per status key: match count, first row, and the status of the first match."""
    return status.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_status"),
        F.min("row_no").alias("status_row"),
        F.min_by("success", "row_no").alias("success"),
    )


def verdicts(design: DataFrame, status: DataFrame, results: DataFrame, expected: int = 30) -> DataFrame:
    """Per design row its status match, result count and verdict.

    ``design``: (key, row_no); ``status``: (key, row_no, success 0/1);
    ``results``: (key).  Missing rows get verdict 'missing'.
    """
    st = status_by_key(status)
    rc = key_counts(results).withColumnRenamed("n", "n_results")
    j = design.join(st, "key", "left").join(rc, "key", "left")
    n = F.coalesce(F.col("n_results"), F.lit(0).cast("long"))
    verdict = _verdict(F.coalesce(F.col("n_status"), F.lit(0)), F.col("success"), n, expected)
    return j.select("row_no", "key", F.coalesce(F.col("n_status"), F.lit(0).cast("long")).alias("n_status"),
                    "success", n.alias("n_results"), verdict.alias("verdict"))


def missing(design: DataFrame, status: DataFrame) -> DataFrame:
    """Design rows with no status row."""
    return design.join(status.select("key"), "key", "left_anti")


def strays(design: DataFrame, results: DataFrame) -> DataFrame:
    """Result keys with no design row, with their row counts."""
    return key_counts(results).join(design.select("key"), "key", "left_anti").withColumnRenamed("n", "n_results")


def key_table(design: DataFrame, status: DataFrame, results: DataFrame) -> DataFrame:
    """E1 over all three tables at once: (key, n_design, n_status, success, n_results) per key.

    A tagged union and one hash aggregate: every table is read once, and a hot key is one row per map task.
    ``success`` is that of the key's first status row.
    """
    none = F.lit(None)
    rows = (design.select("key", F.lit(1).alias("d"), F.lit(0).alias("s"), F.lit(0).alias("r"),
                          none.cast("long").alias("row_no"), none.cast("int").alias("success"))
            .unionAll(status.select("key", F.lit(0), F.lit(1), F.lit(0), F.col("row_no").cast("long"), F.col("success").cast("int")))
            .unionAll(results.select("key", F.lit(0), F.lit(0), F.lit(1), none.cast("long"), none.cast("int"))))
    return rows.groupBy("key").agg(F.sum("d").alias("n_design"), F.sum("s").alias("n_status"),
                                   F.min_by("success", "row_no").alias("success"), F.sum("r").alias("n_results"))


def _verdict(n_status, success, n_results, expected: int):
    return (F.when(n_status == 0, F.lit("missing"))
            .when(success == 1,
                  F.when(n_results == expected, F.lit("ok"))
                  .when(n_results == 0, F.lit("no_results"))
                  .when(n_results < expected, F.lit("too_few"))
                  .otherwise(F.lit("too_many")))
            .when(n_results > 0, F.lit("failed_with_results"))
            .otherwise(F.lit("ok")))


def report(design: DataFrame, status: DataFrame, results: DataFrame, expected: int = 30) -> DataFrame:
    """Error count per fault kind plus 'total'; the check passes iff total == 0.

    A missing row counts once and nothing else; a duplicated table counts once;
    stray keys count once whatever their number.  The three tables are read once each.
    """
    keys = key_table(design, status, results).withColumn(
        "verdict", _verdict(F.col("n_status"), F.col("success"), F.col("n_results"), expected))

    def rows(condition):
        """Design rows of the keys where the condition holds."""
        return F.coalesce(F.sum(F.when(condition, F.col("n_design"))), F.lit(0).cast("long"))

    def any_key(condition):
        return F.coalesce(F.max(F.when(condition, 1)), F.lit(0)).cast("long")

    v = F.col("verdict")
    wide = keys.agg(
        any_key(F.col("n_design") > 1).alias("duplicate_design"), any_key(F.col("n_status") > 1).alias("duplicate_status"),
        rows(v == "missing").alias("missing"), rows((v != "missing") & (F.col("n_status") > 1)).alias("matched_twice"),
        *[rows(v == k).alias(k) for k in ("no_results", "too_few", "too_many", "failed_with_results")],
        any_key((F.col("n_design") == 0) & (F.col("n_results") > 0)).alias("strays"))
    wide = wide.withColumn("total", sum((F.col(k) for k in FAULT_KINDS), F.lit(0).cast("long")))
    kinds = list(FAULT_KINDS) + ["total"]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(k).alias("kind"), F.col(k).cast("long").alias("errors"))
        for i, k in enumerate(kinds)])))


def with_line_numbers(df: DataFrame, col: str = "row_no", first_line: int = 2) -> DataFrame:
    """File line of each row (header is line 1): exact position in scan order.

    Scan order is file order for a single file; the rank is distributed (no
    single-partition window).
    """
    from designlab.operators.rank import dist_rank
    tagged = df.withColumn("_scan", F.monotonically_increasing_id())
    ranked = dist_rank(tagged, [F.col("_scan")], rank_col="_line")
    return ranked.withColumn(col, F.col("_line") + (first_line - 1)).drop("_scan", "_line")


def duplicate_matches(design: DataFrame, status: DataFrame) -> DataFrame:
    """D3: every status row of each design key that more than one status row matches, long form
    (key, n_design, n_status, status_row): one row per key and status row, whatever their number.

    Design keys are reduced to one row each before the join, so duplicate design rows and duplicate
    status rows make no product; the design rows of a key are ``design`` joined on it.
    """
    designs = design.groupBy("key").agg(F.count(F.lit(1)).alias("n_design"))
    multi = status.groupBy("key").agg(F.count(F.lit(1)).alias("n_status")).where(F.col("n_status") > 1)
    return status.join(multi.join(designs, "key"), "key").select(
        "key", "n_design", "n_status", F.col("row_no").alias("status_row"))
