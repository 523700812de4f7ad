"""Distribution and trial queries over lineitem, the stand-in predictions and the run log."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from designlab.functions.numeric import null_safe_join, round_to
from designlab.operators import board, dist
from designlab.plans.registry import register
from designlab.plans.standins import PREDICTIONS_SQL, RUNLOG_CTES, predictions, run_log
from designlab.plans.tables import table

NUM4 = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TRIAL_KEY = ("l_discount", "l_tax")
NTH = 7
BINS = 30
KDE_GRID = 200
KDE2_GRID = 50
VIOLIN_GRID = 50
HEX_GRID = 50
HEX_GRID_ERROR = 150
EDGES = (0.0, 4000.0, 40)      # right-closed bins on linspace(0, 4000, 40)
SAMPLES = 20


def _f(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


@register("corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in NUM4 for b in NUM4))
def corr_matrix(spark, d):
    """Pearson correlation matrix of four lineitem doubles (one aggregate, long form)."""
    return dist.corr_matrix(table(spark, d, "lineitem"), NUM4)


@register("histogram", sql=f"""
WITH st AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) * ({_f(BINS)} / (hi - lo))), {BINS - 1}) AS BIGINT) AS bin,
             count(*) AS count FROM lineitem, st GROUP BY 1)
SELECT r.bin, round(lo + r.bin * ((hi - lo) / {_f(BINS)}), 6) AS lo_edge,
       round(CASE WHEN r.bin = {BINS - 1} THEN hi ELSE lo + (r.bin + 1) * ((hi - lo) / {_f(BINS)}) END, 6) AS hi_edge,
       coalesce(c.count, 0) AS count
FROM range({BINS}) r(bin) CROSS JOIN st LEFT JOIN c ON c.bin = r.bin""")
def histogram(spark, d):
    """30 equal-width bins of l_extendedprice, last bin closed, empty bins kept."""
    return dist.histogram(table(spark, d, "lineitem"), "l_extendedprice", BINS)


def _units_sql() -> str:
    return "CAST(list_sum(CAST(layer_sizes AS INTEGER[])) AS BIGINT)"


@register("binned_median", sql=f"""{RUNLOG_CTES},
x AS (SELECT {_units_sql()} AS tu, mae FROM runlog),
b AS (SELECT CAST(ceil((tu - {_f(EDGES[0])}) / {_f((EDGES[1] - EDGES[0]) / (EDGES[2] - 1))}) AS BIGINT) AS bin, mae FROM x
      WHERE tu > {_f(EDGES[0])} AND tu <= {_f(EDGES[1])}),
m AS (SELECT bin, count(*) AS n, median(mae) AS median FROM b GROUP BY bin)
SELECT r.bin, round(({_f(EDGES[0])} + (r.bin - 1) * {_f((EDGES[1] - EDGES[0]) / (EDGES[2] - 1))}
                    + {_f(EDGES[0])} + r.bin * {_f((EDGES[1] - EDGES[0]) / (EDGES[2] - 1))}) / 2, 6) AS bin_center,
       coalesce(m.n, 0) AS n, round(m.median, 6) AS median
FROM range(1, {EDGES[2]}) r(bin) LEFT JOIN m ON m.bin = r.bin""")
def binned_median(spark, d):
    """Median MAE per right-closed total-units bin (39 bins on 0..4000), empty bins kept."""
    log = run_log(spark, d).withColumn("tu", board.total_units())
    return dist.right_closed_bins(log, "tu", "mae", EDGES[0], EDGES[1], EDGES[2])


QS = (0.1, 0.25, 0.5, 0.75, 0.9)


@register("quantile_bands", sql=f"""
WITH {PREDICTIONS_SQL}
SELECT time_s, {", ".join(f"round(quantile_cont(y_pred - y_true, {q}), 6) AS q{int(round(q * 100)):02d}" for q in QS)}
FROM predictions GROUP BY time_s""")
def quantile_bands(spark, d):
    """Signed-error quantiles 0.1 .25 .5 .75 .9 per sweep value (exact, distributed ranks)."""
    p = predictions(spark, d).withColumn("err", F.col("y_pred") - F.col("y_true"))
    return dist.quantile_bands(p, "time_s", "err", QS)


@register("box_stats", sql="""
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
j AS (SELECT l.l_returnflag, l_extendedprice AS v, q1, median, q3, q3 - q1 AS iqr FROM lineitem l JOIN q USING (l_returnflag))
SELECT l_returnflag, count(*) AS n, round(min(q1), 6) AS q1, round(min(median), 6) AS median, round(min(q3), 6) AS q3,
       round(min(iqr), 6) AS iqr,
       round(min(v) FILTER (WHERE v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr), 6) AS whisker_lo,
       round(max(v) FILTER (WHERE v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr)) AS n_outliers
FROM j GROUP BY l_returnflag""")
def box_stats(spark, d):
    """Quartiles, whiskers at 1.5 IQR clipped to the data, outlier count per return flag."""
    stats, _ = dist.box_stats(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    return stats


@register("box_outliers", sql="""
WITH q AS (SELECT l_returnflag, quantile_cont(l_discount * l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_discount * l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
f AS (SELECT l_returnflag, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT l_orderkey, l_linenumber, l_returnflag, round(l_discount * l_extendedprice, 6) AS discount_value, round(lo, 3) AS fence_lo,
       round(hi, 3) AS fence_hi
FROM lineitem JOIN f USING (l_returnflag) WHERE NOT (l_discount * l_extendedprice >= lo AND l_discount * l_extendedprice <= hi)""")
def box_outliers(spark, d):
    """The rows beyond the 1.5 IQR fences of their return flag, with the fences."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                            (F.col("l_discount") * F.col("l_extendedprice")).alias("discount_value"))
    _, outliers = dist.box_stats(li, "l_returnflag", "discount_value")
    return outliers.select("l_orderkey", "l_linenumber", "l_returnflag", "discount_value",
                           round_to("fence_lo", 3).alias("fence_lo"), round_to("fence_hi", 3).alias("fence_hi"))


LATTICE, LATTICE_2D, REACH = 256, 64, 9.0   # lattice steps per bandwidth, reach of a bin in bandwidths


def _kde_sql(source: str, value: str, grid: int, group: str | None = None) -> str:
    """CTEs ending in ``k`` (group, i, x, density): linear binning, then the sum over the bins in reach."""
    g, on = (f"{group}, ", f"USING ({group})") if group else ("", "ON true")
    by = f"GROUP BY {group}" if group else ""
    return f"""
st0 AS (SELECT {g}min({value}) AS lo, max({value}) AS hi, count(*) AS n,
               stddev_samp({value}) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw FROM {source} {by}),
st AS (SELECT {g}n, bw, lo - 3.0 * bw AS g0, ((hi + 3.0 * bw) - (lo - 3.0 * bw)) / {_f(grid - 1)} AS gstep FROM st0 WHERE bw > 0),
sf AS (SELECT *, ceil(gstep * {_f(LATTICE)} / bw) AS fine FROM st),
u AS (SELECT {g}({value} - g0) / gstep * fine AS u FROM {source} JOIN sf {on}),
w AS (SELECT {g}floor(u) AS j, 1.0 - (u - floor(u)) AS w FROM u UNION ALL SELECT {g}floor(u) + 1 AS j, u - floor(u) AS w FROM u),
b AS (SELECT {g}j, sum(w) AS w FROM w WHERE w > 0 GROUP BY {g}j),
k AS (SELECT {g}i, g0 + i * gstep AS x,
             coalesce(sum(w * exp(-0.5 * pow((i - j / fine) * (gstep / bw), 2)))
                      FILTER (WHERE abs(i - j / fine) <= {_f(REACH)} * bw / gstep), 0.0) / (n * bw * {_f(math.sqrt(2 * math.pi))}) AS density
      FROM range({grid}) r(i), sf JOIN b {on} GROUP BY {g}i, g0, gstep, n, bw)"""


@register("kde_1d", sql=f"""
WITH {_kde_sql("lineitem", "l_extendedprice", KDE_GRID)}
SELECT i, round(x, 4) AS x, round(density, 12) AS density FROM k""", digits=None)
def kde_1d(spark, d):
    """Gaussian KDE (Scott bandwidth, 200 points, cut 3) of l_extendedprice, binned."""
    k = dist.kde_1d(table(spark, d, "lineitem"), "l_extendedprice", KDE_GRID)
    return k.select("i", round_to("x", 4).alias("x"), round_to("density", 12).alias("density"))


@register("kde_2d", sql=f"""{RUNLOG_CTES},
x AS (SELECT CAST({_units_sql()} AS DOUBLE) AS x, mae AS y FROM runlog),
st AS (SELECT count(*) AS n, min(x) AS xlo, max(x) AS xhi, min(y) AS ylo, max(y) AS yhi,
              var_samp(x) * pow(CAST(count(*) AS DOUBLE), -1.0 / 3.0) AS a,
              covar_samp(x, y) * pow(CAST(count(*) AS DOUBLE), -1.0 / 3.0) AS b,
              var_samp(y) * pow(CAST(count(*) AS DOUBLE), -1.0 / 3.0) AS c FROM x),
p0 AS (SELECT *, a * c - b * b AS det, xlo - 3.0 * sqrt(a) AS x0, ylo - 3.0 * sqrt(c) AS y0,
              ((xhi + 3.0 * sqrt(a)) - (xlo - 3.0 * sqrt(a))) / {_f(KDE2_GRID - 1)} AS sx,
              ((yhi + 3.0 * sqrt(c)) - (ylo - 3.0 * sqrt(c))) / {_f(KDE2_GRID - 1)} AS sy FROM st),
p AS (SELECT n, det, x0, y0, sx, sy, a, c, c / det AS ia, -b / det AS ib, a / det AS ic,
             ceil(sx * {_f(LATTICE_2D)} * sqrt(c / det)) AS fx, ceil(sy * {_f(LATTICE_2D)} * sqrt(a / det)) AS fy FROM p0),
u AS (SELECT (x - x0) / sx * fx AS u, (y - y0) / sy * fy AS v FROM x, p),
w AS (SELECT floor(u) + dx AS jx, floor(v) + dy AS jy,
             (CASE WHEN dx = 1 THEN u - floor(u) ELSE 1.0 - (u - floor(u)) END)
             * (CASE WHEN dy = 1 THEN v - floor(v) ELSE 1.0 - (v - floor(v)) END) AS w
      FROM u, range(2) s(dx), range(2) t(dy)),
b AS (SELECT jx, jy, sum(w) AS w FROM w WHERE w > 0 GROUP BY jx, jy),
q AS (SELECT i, j, w, (i - jx / fx) * sx AS gx, (j - jy / fy) * sy AS gy, p.* FROM b, p, range({KDE2_GRID}) r(i), range({KDE2_GRID}) s(j))
SELECT i, j, round(x0 + i * sx, 6) AS x, round(y0 + j * sy, 6) AS y,
       round(coalesce(sum(w * exp(-0.5 * (ia * gx * gx + 2 * ib * gx * gy + ic * gy * gy)))
                      FILTER (WHERE abs(gx) <= {_f(REACH)} * sqrt(a) AND abs(gy) <= {_f(REACH)} * sqrt(c)), 0.0)
             / (n * {_f(2 * math.pi)} * sqrt(det)), 15) AS density
FROM q GROUP BY i, j, x0, y0, sx, sy, n, det""", digits=None)
def kde_2d(spark, d):
    """2-D Gaussian KDE of (total units, MAE) over the run log on a 50 x 50 grid, binned."""
    log = run_log(spark, d).withColumn("tu", board.total_units().cast("double"))
    k = dist.kde_2d(log, "tu", "mae", KDE2_GRID)
    return k.select("i", "j", round_to("x", 6).alias("x"), round_to("y", 6).alias("y"),
                    round_to("density", 15).alias("density"))


def _hex_sql(gridsize: int = HEX_GRID, y: str = "y_pred", log: bool = False) -> str:
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    log10 = ", round(log10(count(*)), 6) AS log10_count" if log else ""
    return f"""WITH {PREDICTIONS_SQL},
st0 AS (SELECT min(y_true) AS xmin0, max(y_true) AS xmax0, min({y}) AS ymin, max({y}) AS ymax FROM predictions),
st AS (SELECT xmin0 - 1e-9 * (xmax0 - xmin0) AS xmin, xmax0 + 1e-9 * (xmax0 - xmin0) AS xmax, ymin, ymax FROM st0),
s AS (SELECT xmin, ymin, (xmax - xmin) / {_f(nx)} AS sx, (ymax - ymin) / {_f(ny)} AS sy FROM st),
p AS (SELECT (y_true - xmin) / sx AS ix, ({y} - ymin) / sy AS iy, xmin, ymin, sx, sy FROM predictions, s),
q AS (SELECT *, round_even(ix, 0) AS ix1, round_even(iy, 0) AS iy1, floor(ix) AS ix2, floor(iy) AS iy2 FROM p),
c AS (SELECT CASE WHEN pow(ix - ix1, 2) + 3.0 * pow(iy - iy1, 2) < pow(ix - ix2 - 0.5, 2) + 3.0 * pow(iy - iy2 - 0.5, 2)
                  THEN 1 ELSE 2 END AS lattice, * FROM q)
SELECT lattice, CAST(CASE WHEN lattice = 1 THEN ix1 ELSE ix2 END AS BIGINT) AS i,
       CAST(CASE WHEN lattice = 1 THEN iy1 ELSE iy2 END AS BIGINT) AS j,
       round(min(xmin) + (CAST(CASE WHEN lattice = 1 THEN ix1 ELSE ix2 END AS BIGINT) + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * min(sx), 6) AS x_center,
       round(min(ymin) + (CAST(CASE WHEN lattice = 1 THEN iy1 ELSE iy2 END AS BIGINT) + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * min(sy), 6) AS y_center,
       count(*) AS count{log10}
FROM c GROUP BY 1, 2, 3"""


@register("hexbin", sql=_hex_sql())
def hexbin(spark, d):
    """Hexagonal bin counts of (y_true, y_pred), gridsize 50, empty cells dropped."""
    return dist.hexbin(predictions(spark, d), "y_true", "y_pred", HEX_GRID)


@register("hexbin_error_log", sql=_hex_sql(HEX_GRID_ERROR, "(y_pred - y_true)", log=True))
def hexbin_error_log(spark, d):
    """Hexagonal bins of (y_true, error) with the log10 of the count, gridsize 150."""
    p = predictions(spark, d).withColumn("err", F.col("y_pred") - F.col("y_true"))
    return dist.hexbin(p, "y_true", "err", HEX_GRID_ERROR, log=True)


@register("violin_stats", sql=f"""{RUNLOG_CTES},
q AS (SELECT activation, quantile_cont(mae, 0.25) AS q1, quantile_cont(mae, 0.5) AS median,
             quantile_cont(mae, 0.75) AS q3 FROM runlog GROUP BY activation),{_kde_sql("runlog", "mae", VIOLIN_GRID, "activation")}
SELECT k.activation, k.i, round(k.x, 6) AS x, round(k.density, 12) AS density,
       round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3
FROM k JOIN q ON k.activation IS NOT DISTINCT FROM q.activation""", digits=None)
def violin_stats(spark, d):
    """Per-activation quartiles of MAE and a 50-point KDE of it."""
    log = run_log(spark, d)
    k = dist.kde_1d(log, "mae", VIOLIN_GRID, group="activation")
    from designlab.operators.select import exact_quantiles
    q = exact_quantiles(log, "mae", [0.25, 0.5, 0.75], ["activation"], ["q1", "median", "q3"])
    out = null_safe_join(k, q, ["activation"])
    return out.select("activation", "i", round_to("x", 6).alias("x"), round_to("density", 12).alias("density"),
                      round_to("q1", 6).alias("q1"), round_to("median", 6).alias("median"), round_to("q3", 6).alias("q3"))


@register("trial_count", sql="""
SELECT count(*) AS n_trials FROM (SELECT DISTINCT l_discount, l_tax, l_linenumber FROM lineitem)""")
def trial_count(spark, d):
    """Number of distinct parameter sets."""
    return dist.distinct_sets(table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_linenumber"])


@register("trial_time_range", sql="""
SELECT l_discount, l_tax, min(l_quantity) AS t_min, max(l_quantity) AS t_max, count(*) AS n
FROM lineitem GROUP BY l_discount, l_tax""")
def trial_time_range(spark, d):
    """Min / max of the sweep variable (quantity) per trial (discount, tax)."""
    return dist.trial_ranges(table(spark, d, "lineitem"), TRIAL_KEY, "l_quantity")


@register("nth_trial", sql=f"""
WITH k AS (SELECT l_discount, l_tax, row_number() OVER (ORDER BY l_discount, l_tax) - 1 AS r
           FROM (SELECT DISTINCT l_discount, l_tax FROM lineitem WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL))
SELECT l_orderkey, l_linenumber, l.l_discount, l.l_tax, l_quantity, l_extendedprice
FROM lineitem l JOIN k ON l.l_discount = k.l_discount AND l.l_tax = k.l_tax WHERE k.r = {NTH}""")
def nth_trial(spark, d):
    """rows of the 8th trial (0-based 7) in sorted (discount, tax) order."""
    li = table(spark, d, "lineitem")
    return dist.nth_trial(li, TRIAL_KEY, NTH).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity", "l_extendedprice")


@register("dense_curve", sql="""
WITH t AS (SELECT l_discount, l_tax, min(l_quantity) AS t_min, max(l_quantity) AS t_max FROM lineitem GROUP BY 1, 2)
SELECT l_discount, l_tax, i, CASE WHEN i = 199 THEN t_max ELSE t_min + i * ((t_max - t_min) / 199.0) END AS t
FROM t, range(200) r(i)""")
def dense_curve(spark, d):
    """L11 (points): 200 evenly spaced sweep values between each trial's min and max."""
    tr = dist.trial_ranges(table(spark, d, "lineitem"), TRIAL_KEY, "l_quantity")
    return dist.dense_curves(tr, TRIAL_KEY, 200)


def _pair_sql() -> str:
    return f"""
WITH st AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1,
                   avg(CAST(o_custkey AS DOUBLE)) AS m2, stddev_pop(CAST(o_custkey AS DOUBLE)) AS s2 FROM orders),
z AS (SELECT CAST(floor(o_orderkey / {SAMPLES}) AS BIGINT) AS it, o_orderkey,
             (o_totalprice - m1) / CASE WHEN s1 = 0 THEN 1.0 ELSE s1 END AS z1,
             (CAST(o_custkey AS DOUBLE) - m2) / CASE WHEN s2 = 0 THEN 1.0 ELSE s2 END AS z2 FROM orders, st),
p AS (SELECT sqrt((a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)) AS dd
      FROM z a JOIN z b ON a.it = b.it AND a.o_orderkey < b.o_orderkey),
r AS (SELECT min(dd) AS lo, max(dd) AS hi FROM p),
c AS (SELECT CAST(least(floor((dd - lo) * ({_f(BINS)} / (hi - lo))), {BINS - 1}) AS BIGINT) AS bin, count(*) AS count
      FROM p, r GROUP BY 1)
SELECT g.bin, coalesce(c.count, 0) AS count FROM range({BINS}) g(bin) LEFT JOIN c ON c.bin = g.bin"""


@register("pair_distance_hist", sql=_pair_sql())
def pair_distance_hist(spark, d):
    """E15 (re-aimed): histogram of standardised pairwise distances within candidate designs of 20 orders."""
    o = table(spark, d, "orders").select(
        F.floor(F.col("o_orderkey") / SAMPLES).cast("long").alias("it"), "o_orderkey",
        F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("o_custkey").cast("double").alias("o_custkey"))
    # the multiset of distances inside a candidate does not depend on row order
    return dist.pair_distance_hist(o, "it", ["o_totalprice", "o_custkey"], BINS)


@register("all_pairs_hist", sql=f"""
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS p FROM embeddings),
st AS (SELECT p, avg(x) AS m, stddev_pop(x) AS s FROM e GROUP BY p),
z AS (SELECT vec_id, list((x - m) / CASE WHEN s = 0 THEN 1.0 ELSE s END ORDER BY p) AS z FROM e JOIN st USING (p) GROUP BY vec_id),
d AS (SELECT list_distance(a.z, b.z) AS d FROM z a JOIN z b ON a.vec_id < b.vec_id),
r AS (SELECT min(d) AS lo, max(d) AS hi FROM d),
c AS (SELECT CAST(least(greatest(floor((d - lo) * ({_f(BINS)} / (hi - lo))), 0), {BINS - 1}) AS BIGINT) AS bin, count(*) AS n FROM d, r GROUP BY 1)
SELECT b AS bin, round(lo + b * ((hi - lo) / {_f(BINS)}), 6) AS lo_edge, coalesce(n, 0) AS count
FROM r, range({BINS}) t(b) LEFT JOIN c ON c.bin = t.b""")
def all_pairs_hist(spark, d):
    """Histogram of the distances of all pairs of standardised embeddings."""
    return dist.all_pairs_hist(table(spark, d, "embeddings"), "embedding", BINS).select("bin", "lo_edge", "count")
