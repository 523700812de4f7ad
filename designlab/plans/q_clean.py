"""Cleaning queries: unit-tagged text, canonical keys, incomplete rows, finite pairs, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from designlab.functions.numeric import sig6
from designlab.operators import clean
from designlab.plans.registry import register
from designlab.plans.tables import table

UNIT_RE = r"'^(.*?)(\[.*?\])$'"


def _part_text(spark, d):
    """Unit-tagged text table built from part: price carries [USD] on most rows, size [cm]."""
    p = table(spark, d, "part")
    price = F.concat(sig6("p_retailprice"), F.when(F.col("p_size") > 5, F.lit("[USD]")).otherwise(F.lit("")))
    size = F.concat(F.col("p_size").cast("string"), F.lit("[cm]"))
    return p.select("p_partkey", price.alias("price"), size.alias("size"))


def _sql_value(c: str) -> str:
    return (f"TRY_CAST(trim(CASE WHEN regexp_matches({c}, {UNIT_RE}) THEN regexp_extract({c}, {UNIT_RE}, 1) "
            f"ELSE {c} END) AS DOUBLE)")


@register("unit_split", sql=f"""
WITH t AS (SELECT p_partkey,
                  printf('%.6g', p_retailprice) || CASE WHEN p_size > 5 THEN '[USD]' ELSE '' END AS price,
                  CAST(p_size AS VARCHAR) || '[cm]' AS size FROM part)
SELECT p_partkey, {_sql_value('price')} AS "price [USD]", {_sql_value('size')} AS "size [cm]" FROM t""")
def unit_split(spark, d):
    """Strip trailing [unit] from cells, first unit seen (file order = p_partkey) joins the header."""
    return clean.unit_split(_part_text(spark, d), order_col="p_partkey")


MIXED_SQL = """
t AS (SELECT p_partkey, printf('%.6g', p_retailprice) || CASE WHEN p_size > 5 THEN '[USD]' ELSE '' END AS price,
             CASE WHEN p_size % 10 = 3 THEN p_type WHEN p_size % 10 = 4 THEN '' ELSE CAST(p_size AS VARCHAR) || '[cm]' END AS size FROM part),
v AS (SELECT p_partkey, 0 AS pos, 'price' AS "column", price AS cell FROM t UNION ALL SELECT p_partkey, 1, 'size', size FROM t)"""


def _mixed_text(spark, d):
    """As ``_part_text``, but some sizes are words and some are empty."""
    p = table(spark, d, "part")
    size = (F.when(F.col("p_size") % 10 == 3, F.col("p_type")).when(F.col("p_size") % 10 == 4, "")
            .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("[cm]"))))
    return _part_text(spark, d).drop("size").join(p.select("p_partkey", size.alias("size")), "p_partkey")


@register("unit_profile", sql=f"""
WITH {MIXED_SQL}
SELECT pos, "column", arg_min(regexp_extract(cell, {UNIT_RE}, 2), p_partkey) FILTER (WHERE regexp_matches(cell, {UNIT_RE})) AS unit,
       count(*) FILTER (WHERE cell <> '') AS filled,
       count(*) FILTER (WHERE cell <> '' AND {_sql_value('cell')} IS NULL) AS unparsed
FROM v GROUP BY pos, "column\"""")
def unit_profile(spark, d):
    """A4 report: first unit, filled cells and cells that are no numbers, per column of a mixed table."""
    return clean.unit_profile(_mixed_text(spark, d), order_col="p_partkey")


@register("unit_split_mixed", sql=f"""
WITH {MIXED_SQL}
SELECT p_partkey, {_sql_value('price')} AS "price [USD]",
       nullif(trim(CASE WHEN regexp_matches(size, {UNIT_RE}) THEN regexp_extract(size, {UNIT_RE}, 1) ELSE size END), '') AS "size [cm]" FROM t""")
def unit_split_mixed(spark, d):
    """A4: a column with words among its numbers stays text, none of its cells is lost."""
    return clean.unit_split(_mixed_text(spark, d), order_col="p_partkey")


def _k6(x: str) -> str:
    return f"printf('%.5e', CASE WHEN CAST({x} AS DOUBLE) = 0 THEN 0.0 ELSE CAST({x} AS DOUBLE) END)"


@register("canonical_key", sql=f"""
SELECT l_orderkey, l_linenumber,
       {_k6('l_quantity')} || '|' || {_k6('l_discount')} || '|' || {_k6('l_tax')} AS key,
       printf('%.6g', CASE WHEN l_quantity * l_tax = 0 THEN 0.0 ELSE l_quantity * l_tax END) AS text6
FROM lineitem""")
def canonical_key(spark, d):
    """Units stripped, values as 6-significant-digit text, joined by '|'; -0.0 -> 0."""
    li = table(spark, d, "lineitem")
    cells = li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_quantity").cast("string"), F.lit("[pcs]")).alias("q"),
        F.col("l_discount").cast("string").alias("disc"),
        F.concat(F.col("l_tax").cast("string"), F.lit(" [1]")).alias("tax"),
        (F.col("l_quantity") * F.col("l_tax")).alias("qt"))
    return cells.select("l_orderkey", "l_linenumber", clean.canonical_key(["q", "disc", "tax"]).alias("key"),
                        sig6("qt").alias("text6"))


def _incomplete_frame(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.try_divide(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
                     F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag")).alias("flag"))


@register("drop_incomplete", sql="""
SELECT l_orderkey, l_linenumber, round(l_discount / l_tax, 6) AS ratio, l_returnflag AS flag
FROM lineitem WHERE l_tax <> 0 AND l_returnflag <> 'N'""")
def drop_incomplete(spark, d):
    """Rows with any NULL, empty text or NaN removed."""
    return clean.drop_incomplete(_incomplete_frame(spark, d))


@register("drop_incomplete_count", sql="""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE l_tax <> 0 AND l_returnflag <> 'N') AS rows_out,
       count(*) FILTER (WHERE NOT (l_tax <> 0 AND l_returnflag <> 'N')) AS removed FROM lineitem""")
def drop_incomplete_count(spark, d):
    """C3 report: rows in, rows kept, rows removed."""
    return clean.count_incomplete(_incomplete_frame(spark, d))


@register("finite_pairs", sql="""
SELECT l_orderkey, l_linenumber, round(l_discount / l_tax, 6) AS ratio, l_quantity
FROM lineitem WHERE l_tax <> 0""")
def finite_pairs(spark, d):
    """Numpy-style ratio (x/0 -> inf, 0/0 -> NaN), then keep finite pairs."""
    li = table(spark, d, "lineitem")
    f = li.select("l_orderkey", "l_linenumber", clean.np_divide("l_discount", "l_tax").alias("ratio"), "l_quantity")
    return clean.finite_pairs(f, "ratio", "l_quantity")


@register("input_split", sql="""
SELECT l_quantity, l_discount, l_tax, l_extendedprice AS target FROM lineitem""")
def input_split(spark, d):
    """inputs = all columns but the last k, target = the last (positional)."""
    res = table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    ins, outs = clean.split_io(res, 1)
    return res.select(*ins, F.col(outs[0]).alias("target"))


@register("first_columns", sql="""
WITH j AS (SELECT l.*, o.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate, o_orderkey FROM j""")
def first_columns(spark, d):
    """The first 12 columns, by position, of a wider table (lineitem beside its order)."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return clean.first_n_columns(li.join(o, li.l_orderkey == o.o_orderkey), 12)
