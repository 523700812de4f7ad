"""Consistency-check queries: design = orders (non-low priority), status = orders not 'P'
(success = status 'F'), results = lineitem, expected results per design row = 4."""

from __future__ import annotations

from pyspark.sql import functions as F

from designlab.operators import checks
from designlab.plans.registry import register
from designlab.plans.tables import table

EXPECTED = 4


def _design(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderpriority") != "5-LOW")
    return checks.keyed(o, ["o_orderkey"], "o_orderkey")


def _status(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    return checks.keyed(o, ["o_orderkey"], "o_orderkey",
                        [(F.col("o_orderstatus") == "F").cast("int").alias("success")])


def _results(spark, d):
    return checks.keyed(table(spark, d, "lineitem"), ["l_orderkey"])


K = "printf('%.5e', CAST({c} AS DOUBLE))"
SQL_BASE = f"""
WITH design AS (SELECT {K.format(c='o_orderkey')} AS key, o_orderkey AS row_no FROM orders WHERE o_orderpriority <> '5-LOW'),
status AS (SELECT {K.format(c='o_orderkey')} AS key, o_orderkey AS row_no, CAST(o_orderstatus = 'F' AS INTEGER) AS success
           FROM orders WHERE o_orderstatus <> 'P'),
results AS (SELECT {K.format(c='l_orderkey')} AS key FROM lineitem),
st AS (SELECT key, count(*) AS n_status, min(row_no) AS status_row, arg_min(success, row_no) AS success FROM status GROUP BY key),
rc AS (SELECT key, count(*) AS n_results FROM results GROUP BY key),
v AS (SELECT d.row_no, d.key, coalesce(st.n_status, 0) AS n_status, st.success, coalesce(rc.n_results, 0) AS n_results,
             CASE WHEN st.n_status IS NULL THEN 'missing'
                  WHEN st.success = 1 THEN CASE WHEN coalesce(rc.n_results, 0) = {EXPECTED} THEN 'ok'
                                                WHEN coalesce(rc.n_results, 0) = 0 THEN 'no_results'
                                                WHEN coalesce(rc.n_results, 0) < {EXPECTED} THEN 'too_few'
                                                ELSE 'too_many' END
                  WHEN coalesce(rc.n_results, 0) > 0 THEN 'failed_with_results' ELSE 'ok' END AS verdict
      FROM design d LEFT JOIN st USING (key) LEFT JOIN rc USING (key)),
strays AS (SELECT rc.key, rc.n_results FROM rc WHERE rc.key NOT IN (SELECT key FROM design))"""


@register("consistency_missing", sql=f"""{SQL_BASE}
SELECT key, row_no FROM design WHERE key NOT IN (SELECT key FROM status)""")
def consistency_missing(spark, d):
    """Design rows absent from the status table (left anti join)."""
    return checks.missing(_design(spark, d), _status(spark, d))


@register("consistency_verdict", sql=f"""{SQL_BASE}
SELECT row_no, key, n_status, success, n_results, verdict FROM v""")
def consistency_verdict(spark, d):
    """Status match, result count (absent = 0) and verdict per design row."""
    return checks.verdicts(_design(spark, d), _status(spark, d), _results(spark, d), EXPECTED)


@register("consistency_strays", sql=f"""{SQL_BASE}
SELECT key, n_results FROM strays""")
def consistency_strays(spark, d):
    """Result keys with no design row."""
    return checks.strays(_design(spark, d), _results(spark, d))


@register("consistency_report", sql=f"""{SQL_BASE},
dd AS (SELECT count(*) AS n FROM (SELECT key FROM design GROUP BY key HAVING count(*) > 1)),
ds AS (SELECT count(*) AS n FROM (SELECT key FROM status GROUP BY key HAVING count(*) > 1)),
w AS (SELECT CAST((SELECT n FROM dd) > 0 AS BIGINT) AS duplicate_design,
             CAST((SELECT n FROM ds) > 0 AS BIGINT) AS duplicate_status,
             count(*) FILTER (WHERE verdict = 'missing') AS missing,
             count(*) FILTER (WHERE verdict <> 'missing' AND n_status > 1) AS matched_twice,
             count(*) FILTER (WHERE verdict = 'no_results') AS no_results,
             count(*) FILTER (WHERE verdict = 'too_few') AS too_few,
             count(*) FILTER (WHERE verdict = 'too_many') AS too_many,
             count(*) FILTER (WHERE verdict = 'failed_with_results') AS failed_with_results,
             CAST((SELECT count(*) FROM strays) > 0 AS BIGINT) AS strays FROM v)
SELECT pos, kind, errors FROM (
  SELECT 0 AS pos, 'duplicate_design' AS kind, duplicate_design AS errors FROM w UNION ALL
  SELECT 1, 'duplicate_status', duplicate_status FROM w UNION ALL
  SELECT 2, 'missing', missing FROM w UNION ALL
  SELECT 3, 'matched_twice', matched_twice FROM w UNION ALL
  SELECT 4, 'no_results', no_results FROM w UNION ALL
  SELECT 5, 'too_few', too_few FROM w UNION ALL
  SELECT 6, 'too_many', too_many FROM w UNION ALL
  SELECT 7, 'failed_with_results', failed_with_results FROM w UNION ALL
  SELECT 8, 'strays', strays FROM w UNION ALL
  SELECT 9, 'total', duplicate_design + duplicate_status + missing + matched_twice + no_results + too_few
                     + too_many + failed_with_results + strays FROM w)""")
def consistency_report(spark, d):
    """Error count per fault kind and the total (passed iff total = 0)."""
    return checks.report(_design(spark, d), _status(spark, d), _results(spark, d), EXPECTED)


def _dup_sql(name: str, src: str, key: str, row: str) -> str:
    return f"""(WITH k AS (SELECT {key} AS key, {row} AS row_no FROM {src}),
      f AS (SELECT key, min(row_no) AS first FROM k GROUP BY key HAVING count(*) > 1)
 SELECT '{name}' AS table_name, count(*) AS repeat_rows, count(DISTINCT k.key) AS repeated_keys,
        min(row_no) AS first_repeat_row FROM k JOIN f USING (key) WHERE row_no > first)"""


@register("duplicates", sql=" UNION ALL ".join([
    _dup_sql("customer", "customer",
             f"{K.format(c='c_nationkey')} || '|' || c_mktsegment", "c_custkey"),
    _dup_sql("supplier", "supplier", K.format(c="s_nationkey"), "s_suppkey"),
    _dup_sql("orders", "orders", K.format(c="o_orderkey"), "o_orderkey"),
]))
def duplicates(spark, d):
    """Per table, rows repeating an earlier key and the first such row."""
    c = checks.keyed(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey")
    s = checks.keyed(table(spark, d, "supplier"), ["s_nationkey"], "s_suppkey")
    o = checks.keyed(table(spark, d, "orders"), ["o_orderkey"], "o_orderkey")
    return (checks.first_repeat(c, "customer").unionByName(checks.first_repeat(s, "supplier"))
            .unionByName(checks.first_repeat(o, "orders")))


@register("matched_twice", sql=f"""
WITH k AS (SELECT {K.format(c='c_nationkey')} || '|' || c_mktsegment AS key, c_custkey AS row_no FROM customer),
st AS (SELECT key, count(*) AS n FROM k GROUP BY key HAVING count(*) > 1)
SELECT key, n AS n_design, n AS n_status, row_no AS status_row FROM k JOIN st USING (key)""")
def matched_twice(spark, d):
    """D3: design keys (customers keyed by nation and segment) matched by several status rows,
    with the match count and every matching row."""
    c = checks.keyed(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey")
    return checks.duplicate_matches(c, c)
