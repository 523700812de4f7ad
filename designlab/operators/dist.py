"""Distribution tables behind the report charts: correlation, histograms, densities, hex bins,
quantile bands, box and violin statistics, trial counts.

Column statistics (min, max, std, n) reach the rows through one bound scalar
subquery or, per group, a broadcast table of measured size; bin and grid tables
are parameter-sized.  Kernel densities bin the rows in one aggregate and convolve
the bins, so no row meets the grid.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from designlab.functions.numeric import bind_stats, is_finite, nan_to_null, null_safe_join
from designlab.operators.design import map_groups
from designlab.operators.rank import dist_rank
from designlab.operators.select import exact_quantiles
from designlab.session import cut_lineage, measured


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete, NaN counts as missing),
    long (a, b, corr); each unordered pair is aggregated once."""
    cols = list(cols)
    x = [nan_to_null(F.col(c).cast("double")) for c in cols]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = df.agg(*[F.corr(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{min(i, j)}_{max(i, j)}").alias("corr"))
        for i, a in enumerate(cols) for j, b in enumerate(cols)])))


def pca(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Principal components of the standardised columns (population std), from their correlations.

    Long form (pc, explained, column, loading): the share of variance of each component and its loadings, the
    largest of them positive.  Rows that lack a value are left out.  The correlations are one aggregate, and
    the decomposed matrix has one row per column.
    """
    x = [nan_to_null(F.col(c).cast("double")) for c in cols]
    rows = df.select(*[v.alias(f"_{i}") for i, v in enumerate(x)]).na.drop("any")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    found = rows.agg(*[F.covar_pop(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    sd = [math.sqrt(found[f"c{i}_{i}"] or 0.0) for i in range(len(cols))]
    corr = np.eye(len(cols))
    for i, j in pairs:
        if i < j and sd[i] and sd[j]:  # a constant column is a component of its own
            corr[i, j] = corr[j, i] = found[f"c{i}_{j}"] / (sd[i] * sd[j])
    values, vectors = np.linalg.eigh(corr)
    out = []
    for pc, at in enumerate(np.argsort(-values), 1):
        v = vectors[:, at]
        v = v if v[np.abs(v).argmax()] >= 0 else -v
        out += [(pc, float(values[at] / len(cols)), c, float(v[i])) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(out, "pc int, explained double, column string, loading double")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed; empty bins kept.

    Like numpy, a constant column uses the range (v - 0.5, v + 0.5).
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    data = df.select(x.alias("x")).where(is_finite("x"))
    st = data.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    st = st.select(F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                   F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    lo, hi = F.col("_st.lo"), F.col("_st.hi")
    data = bind_stats(data, st)
    idx = F.least(F.floor((F.col("x") - lo) * (F.lit(float(bins)) / (hi - lo))), F.lit(bins - 1)).cast("long")
    counts = data.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = bind_stats(spark.range(0, bins, 1, 1).withColumnRenamed("id", "bin"), st)
    step = (hi - lo) / F.lit(float(bins))
    out = edges.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * step).alias("lo_edge"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * step).alias("hi_edge"),
        F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count"))
    return out


def right_closed_bins(df: DataFrame, x_col: str, y_col: str, lo: float, hi: float, n_edges: int) -> DataFrame:
    """Bins (e_{k-1}, e_k] on ``n_edges`` evenly spaced edges; median of y per bin; empty bins kept."""
    spark = df.sparkSession
    nb = n_edges - 1
    w = (hi - lo) / nb
    x = F.col(x_col).cast("double")
    k = F.ceil((x - F.lit(lo)) / F.lit(w)).cast("long")
    inside = (x > F.lit(lo)) & (x <= F.lit(hi))
    data = df.select(F.when(inside, k).alias("bin"), F.col(y_col).cast("double").alias("y")).where(F.col("bin").isNotNull())
    med = exact_quantiles(data, "y", [0.5], ["bin"], ["median"])
    cnt = data.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    bins_t = spark.range(1, nb + 1, 1, 1).withColumnRenamed("id", "bin")
    out = bins_t.join(med, "bin", "left").join(cnt, "bin", "left")
    return out.select("bin", ((F.lit(lo) + (F.col("bin") - 1) * F.lit(w) + F.lit(lo) + F.col("bin") * F.lit(w)) / 2)
                      .alias("bin_center"), F.coalesce("n", F.lit(0).cast("long")).alias("n"), "median")


def quantile_bands(df: DataFrame, key: str, value: str, qs=(0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Quantiles of ``value`` per ``key`` (linear interpolation), one column per quantile."""
    return exact_quantiles(df, value, list(qs), [key])


def box_stats(df: DataFrame, group: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Quartiles, 1.5 IQR whiskers clipped to the data, and outlier rows per group.

    Returns (stats per group, outlier rows with all columns of ``df`` beside the fences).  Second pass =
    a join of the rows with the per-group table (one row per group, broadcast up to a measured size).
    """
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    q = measured(q.withColumn("iqr", F.col("q3") - F.col("q1")))
    v = F.col(value).cast("double")
    j = null_safe_join(df.withColumn("v", v).where(is_finite("v")), q, [group])
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col("v") >= lo_f) & (F.col("v") <= hi_f)
    w = j.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))
    stats = null_safe_join(q, w, [group]).select(group, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers")
    outliers = j.where(~inside).select(*df.columns, "v", lo_f.alias("fence_lo"), hi_f.alias("fence_hi"))
    return stats, outliers


#: bins per bandwidth of the kernel densities, and how many bandwidths a bin reaches
KDE_BINS = 256
KDE_BINS_2D = 64
KDE_REACH = 9.0


def _bin_weights(data: DataFrame, keep: Sequence[str], axes: Sequence[tuple[Column, str]]) -> DataFrame:
    """Linear binning: each row's unit weight shared by the lattice nodes around it, summed per node.

    ``axes`` has (position in lattice steps, node column) per dimension.  One hash aggregate, combined
    before the shuffle.
    """
    steps = data.select(*keep, *[u.alias(f"_u{i}") for i, (u, _) in enumerate(axes)])
    corners = [([], F.lit(1.0))]
    for i in range(len(axes)):
        at, part = F.floor(f"_u{i}"), F.col(f"_u{i}") - F.floor(f"_u{i}")
        corners = [(nodes + [node], w * share) for nodes, w in corners
                   for node, share in ((at, 1.0 - part), (at + 1, part))]
    corner = F.array(*[F.struct(*[n.alias(axes[i][1]) for i, n in enumerate(nodes)], w.alias("w")) for nodes, w in corners])
    shared = steps.select(*keep, F.explode(corner).alias("_c")).select(*keep, "_c.*").where("w > 0")
    return shared.groupBy(*keep, *[name for _, name in axes]).agg(F.sum("w").alias("w"))


def kde_1d(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0, group: str | None = None) -> DataFrame:
    """Gaussian KDE with Scott bandwidth (std * n^(-1/5)) on ``grid`` points from
    min - cut*bw to max + cut*bw; per group when ``group`` is given (NULL is a group).

    The rows are binned on a lattice of at least ``KDE_BINS`` steps per bandwidth that holds the grid points,
    and the bins are convolved with the kernel.  Linear binning changes a kernel value by at most
    1 / (8 * KDE_BINS^2) of its peak (2e-6); bins further than ``KDE_REACH`` bandwidths add less than 3e-18.
    """
    gcols = [group] if group else []
    x = F.col(col).cast("double")
    data = df.select(*gcols, x.alias("x")).where(is_finite("x"))
    st = data.groupBy(*gcols).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"),
                                  F.stddev_samp("x").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("bw") > 0)
    st = st.withColumn("g0", F.col("lo") - cut * F.col("bw")).withColumn(
        "gstep", ((F.col("hi") + cut * F.col("bw")) - (F.col("lo") - cut * F.col("bw"))) / F.lit(float(grid - 1)))
    st = st.withColumn("fine", F.ceil(F.col("gstep") * float(KDE_BINS) / F.col("bw")))
    st = measured(st.select(*gcols, "n", "bw", "g0", "gstep", "fine"))

    def attach(rows: DataFrame) -> DataFrame:
        return null_safe_join(rows, st, gcols) if gcols else bind_stats(rows, st).select("*", "_st.*").drop("_st")

    lattice = (F.col("x") - F.col("g0")) / F.col("gstep") * F.col("fine")
    bins = attach(_bin_weights(attach(data), gcols, [(lattice, "j")]))
    at = F.col("j") / F.col("fine")                        # in grid steps
    reach = KDE_REACH * F.col("bw") / F.col("gstep")
    lo, hi = F.greatest(F.ceil(at - reach), F.lit(0)), F.least(F.floor(at + reach), F.lit(grid - 1))
    near = bins.where(lo <= hi).select(*gcols, "w", at.alias("at"), (F.col("gstep") / F.col("bw")).alias("s"),
                                       F.explode(F.sequence(lo, hi)).alias("i"))
    u = (F.col("i") - F.col("at")) * F.col("s")
    sums = near.groupBy(*gcols, "i").agg(F.sum(F.col("w") * F.exp(-0.5 * u * u)).alias("k"))
    points = st.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("i"))
    out = null_safe_join(points, sums, [*gcols, "i"], "left")
    norm = F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return out.select(*gcols, "i", (F.col("g0") + F.col("i") * F.col("gstep")).alias("x"),
                      (F.coalesce("k", F.lit(0.0)) / norm).alias("density"))


def kde_2d(df: DataFrame, xcol: str, ycol: str, grid: int = 50, cut: float = 3.0) -> DataFrame:
    """2-D Gaussian KDE (Scott factor n^(-1/6) times the sample covariance) on a grid x grid lattice.

    Rows are binned as in ``kde_1d``, with ``KDE_BINS_2D`` steps per bandwidth that is left in one axis
    when the other is fixed: a kernel value changes by at most 1 / (4 * KDE_BINS_2D^2) of its peak (6e-5).
    """
    x, y = F.col(xcol).cast("double"), F.col(ycol).cast("double")
    data = df.select(x.alias("x"), y.alias("y")).where(is_finite("x") & is_finite("y"))
    raw = data.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("xlo"), F.max("x").alias("xhi"),
                   F.min("y").alias("ylo"), F.max("y").alias("yhi"), F.var_samp("x").alias("vx"),
                   F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("cxy"))
    f2 = F.pow(F.col("n").cast("double"), F.lit(-1.0 / 3.0))     # factor^2 = n^(-2/6)
    a, b, c = F.col("vx") * f2, F.col("cxy") * f2, F.col("vy") * f2   # bandwidth covariance [[a, b], [b, c]]
    p = raw.select("n", "xlo", "xhi", "ylo", "yhi", a.alias("a"), b.alias("b"), c.alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    det = a * c - b * b
    bx, by = F.sqrt(a), F.sqrt(c)
    x0, y0 = F.col("xlo") - cut * bx, F.col("ylo") - cut * by
    p = p.where(det > 0).select(
        "n", det.alias("det"), (c / det).alias("ia"), (-b / det).alias("ib"), (a / det).alias("ic"),
        bx.alias("bx"), by.alias("by"), x0.alias("x0"), y0.alias("y0"),
        (((F.col("xhi") + cut * bx) - x0) / F.lit(float(grid - 1))).alias("sx"),
        (((F.col("yhi") + cut * by) - y0) / F.lit(float(grid - 1))).alias("sy"))
    p = measured(p.select("*", F.ceil(F.col("sx") * float(KDE_BINS_2D) * F.sqrt("ia")).alias("fx"),
                          F.ceil(F.col("sy") * float(KDE_BINS_2D) * F.sqrt("ic")).alias("fy")))

    def attach(rows: DataFrame) -> DataFrame:
        return bind_stats(rows, p).select("*", "_st.*").drop("_st")

    bins = attach(_bin_weights(attach(data), [], [((F.col("x") - F.col("x0")) / F.col("sx") * F.col("fx"), "jx"),
                                                  ((F.col("y") - F.col("y0")) / F.col("sy") * F.col("fy"), "jy")]))

    def near(at: Column, reach: Column) -> Column:
        return F.sequence(F.greatest(F.ceil(at - reach), F.lit(0)), F.least(F.floor(at + reach), F.lit(grid - 1)))

    ax, ay = F.col("jx") / F.col("fx"), F.col("jy") / F.col("fy")
    rx, ry = KDE_REACH * F.col("bx") / F.col("sx"), KDE_REACH * F.col("by") / F.col("sy")
    spread = (bins.select("*", ax.alias("ax"), ay.alias("ay"), rx.alias("rx"), ry.alias("ry"))
              .select("*", F.explode(near(F.col("ax"), F.col("rx"))).alias("i"))
              .select("*", F.explode(near(F.col("ay"), F.col("ry"))).alias("j")))
    dx, dy = (F.col("i") - F.col("ax")) * F.col("sx"), (F.col("j") - F.col("ay")) * F.col("sy")
    form = F.col("ia") * dx * dx + 2 * F.col("ib") * dx * dy + F.col("ic") * dy * dy
    sums = spread.groupBy("i", "j").agg(F.sum(F.col("w") * F.exp(-0.5 * form)).alias("k"))
    steps = F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))
    points = p.select("*", F.explode(steps).alias("i")).select("*", F.explode(steps).alias("j"))
    out = points.join(sums, ["i", "j"], "left")
    norm = F.col("n") * F.lit(2 * math.pi) * F.sqrt("det")
    return out.select("i", "j", (F.col("x0") + F.col("i") * F.col("sx")).alias("x"),
                      (F.col("y0") + F.col("j") * F.col("sy")).alias("y"),
                      (F.coalesce("k", F.lit(0.0)) / norm).alias("density"))


def hexbin(df: DataFrame, xcol: str, ycol: str, gridsize: int = 50, log: bool = False) -> DataFrame:
    """Hexagonal bin counts as matplotlib's hexbin forms them (two offset lattices, nearest
    centre wins), empty cells dropped; ``log`` adds log10(count)."""
    x, y = F.col(xcol).cast("double"), F.col(ycol).cast("double")
    data = df.select(x.alias("x"), y.alias("y")).where(is_finite("x") & is_finite("y"))
    nx = gridsize
    ny = int(nx / math.sqrt(3))

    def nonsingular(lo, hi):
        same = lo == hi
        lo2 = F.when(same & (hi == 0), F.lit(-0.1)).when(same, lo - 0.1 * F.abs(lo)).otherwise(lo)
        hi2 = F.when(same & (hi == 0), F.lit(0.1)).when(same, hi + 0.1 * F.abs(hi)).otherwise(hi)
        return lo2, hi2
    raw = data.agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))
    xmin, xmax = nonsingular(F.col("xmin"), F.col("xmax"))
    ymin, ymax = nonsingular(F.col("ymin"), F.col("ymax"))
    pad = F.lit(1e-9) * (xmax - xmin)
    st = raw.select((xmin - pad).alias("xmin"), ymin.alias("ymin"),
                    (((xmax + pad) - (xmin - pad)) / F.lit(float(nx))).alias("sx"),
                    ((ymax - ymin) / F.lit(float(ny))).alias("sy"))
    b = bind_stats(data, st)
    s = F.col("_st")
    ix = (F.col("x") - s.xmin) / s.sx
    iy = (F.col("y") - s.ymin) / s.sy
    b = b.select("_st", ix.alias("ix"), iy.alias("iy"))
    ix, iy = F.col("ix"), F.col("iy")
    ix1, iy1 = F.bround(ix, 0), F.bround(iy, 0)
    ix2, iy2 = F.floor(ix), F.floor(iy)
    d1 = F.pow(ix - ix1, 2) + 3.0 * F.pow(iy - iy1, 2)
    d2 = F.pow(ix - ix2 - 0.5, 2) + 3.0 * F.pow(iy - iy2 - 0.5, 2)
    first = d1 < d2
    cell = b.select(
        F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("long").alias("i"),
        F.when(first, iy1).otherwise(iy2).cast("long").alias("j"))
    counts = cell.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("count"))
    off = F.when(F.col("lattice") == 2, F.lit(0.5)).otherwise(F.lit(0.0))
    counts = bind_stats(counts, st)
    out = counts.select("lattice", "i", "j", (s.xmin + (F.col("i") + off) * s.sx).alias("x_center"),
                        (s.ymin + (F.col("j") + off) * s.sy).alias("y_center"), "count")
    if log:
        out = out.withColumn("log10_count", F.log10(F.col("count").cast("double")))
    return out


def distinct_sets(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of distinct parameter sets (rows with a NULL key skipped)."""
    return df.agg(F.count_distinct(*[F.col(c) for c in cols]).alias("n_trials"))


def trial_ranges(df: DataFrame, key_cols: Sequence[str], time_col: str) -> DataFrame:
    """Min / max of the sweep variable per trial."""
    return df.groupBy(*key_cols).agg(F.min(time_col).alias("t_min"), F.max(time_col).alias("t_max"),
                                     F.count(F.lit(1)).alias("n"))


def nth_trial(df: DataFrame, key_cols: Sequence[str], n: int) -> DataFrame:
    """rows of the n-th trial (0-based) in sorted key order; NULL keys excluded.

    Keys are ranked with the distributed rank (no single-partition window);
    the one selected key is joined back (broadcast: one row).
    """
    keys = df.select(*key_cols).na.drop("any").distinct()
    ranked = dist_rank(keys, [F.col(c) for c in key_cols], rank_col="_r")
    pick = ranked.where(F.col("_r") == n + 1).drop("_r")
    return df.join(F.broadcast(pick), list(key_cols), "left_semi")


def dense_curves(trials: DataFrame, key_cols: Sequence[str], points: int = 200) -> DataFrame:
    """L11 (points): ``points`` evenly spaced sweep values between each trial's t_min and t_max."""
    step = (F.col("t_max") - F.col("t_min")) / F.lit(float(points - 1))
    out = trials.select(*key_cols, "t_min", "t_max", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    t = F.when(F.col("i") == points - 1, F.col("t_max")).otherwise(F.col("t_min") + F.col("i") * step)
    return out.select(*key_cols, F.col("i").cast("long").alias("i"), t.alias("t"))


def pair_distance_hist(df: DataFrame, group_col: str, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """E15, re-aimed: histogram of pairwise Euclidean distances of standardised rows *within* each
    group of bounded size (a candidate design).  Distances are formed inside the group with numpy;
    no pair rows are produced, and no pairs across groups are formed.
    """
    spark = df.sparkSession
    mu_sd = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    b = bind_stats(df, mu_sd)
    st = F.col("_st")
    z = b.select(group_col, *[((F.col(c) - st.getField(f"m{i}")) /
                               F.when(st.getField(f"s{i}") == 0, F.lit(1.0)).otherwise(st.getField(f"s{i}"))).alias(c)
                              for i, c in enumerate(cols)])
    names = list(cols)

    def dists(pdf: pd.DataFrame) -> np.ndarray:
        x = pdf[names].to_numpy(dtype=float)
        if len(x) < 2:
            return np.empty(0)
        i, j = np.triu_indices(len(x), 1)
        d = x[i] - x[j]
        return np.sqrt((d * d).sum(axis=1))

    def per_group(pdf: pd.DataFrame):
        for _, g in pdf.groupby(group_col, sort=False):
            yield g, dists(g)

    def rng(pdf: pd.DataFrame) -> pd.DataFrame:
        ds = [d for _, d in per_group(pdf) if len(d)]
        d = np.concatenate(ds) if ds else np.empty(0)
        return pd.DataFrame({"lo": [d.min() if len(d) else np.nan], "hi": [d.max() if len(d) else np.nan]})

    r = map_groups(z, group_col, rng, "lo double, hi double").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    z2 = bind_stats(z, r, "_r").select("*", "_r._lo", "_r._hi").drop("_r")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        ds = [d for _, d in per_group(pdf) if len(d)]
        if not ds:
            return pd.DataFrame({"bin": pd.Series([], dtype="int64"), "count": pd.Series([], dtype="int64")})
        d = np.concatenate(ds)
        lo, hi = float(pdf["_lo"].iloc[0]), float(pdf["_hi"].iloc[0])
        if hi == lo:
            lo, hi = lo - 0.5, hi + 0.5
        b = np.minimum(np.floor((d - lo) * (bins / (hi - lo))), bins - 1).astype("int64")
        u, c = np.unique(b, return_counts=True)
        return pd.DataFrame({"bin": u, "count": c.astype("int64")})

    counts = map_groups(z2, group_col, count, "bin long, count long").groupBy("bin").agg(F.sum("count").alias("count"))
    edges = spark.range(0, bins, 1, 1).withColumnRenamed("id", "bin")
    return edges.join(counts, "bin", "left").select("bin", F.coalesce("count", F.lit(0).cast("long")).alias("count"))


# ---------------------------------------------------------------- all pairs of a table

PAIR_BLOCK = 2048
#: parts of the blocks that meet in pairs (at least, as far as there are blocks for them), bytes of a part, blocks of a
#: part: starting a task takes as long as two or three cells
PAIR_PARTS, PAIR_PART, PAIR_HELD = 16, 64 << 20, 4
#: with all pairs: blocks of a table (about, as far as they have PAIR_BLOCK rows), and bytes of a block at most then
PAIR_BLOCKS, PAIR_BYTES = 64, 8 << 20
#: rows and columns of a tile of products; components of pairs whose distances are formed at a time
PAIR_TILE, PAIR_PIECE = (128, 2048), 1 << 17
#: levels of a squared distance (a level is a 16-bit number); error of single precision in levels, at most
PAIR_LEVELS, PAIR_EDGE = 1 << 16, 4


def standardised(df: DataFrame, vector: str) -> DataFrame:
    """(z): the vector column standardised per component (population std, 0 -> 1) as array<double>; rows with
    a NULL vector or a missing component are left out.  Two numbers per component are read back."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    rows = df.select(x.alias("x")).where(F.col("x").isNotNull() & F.forall("x", lambda e: is_finite(e)))
    st = rows.select(F.posexplode("x").alias("p", "e")).groupBy("p").agg(F.avg("e").alias("m"), F.stddev_pop("e").alias("s"))
    st = st.orderBy("p").collect()
    mean = F.array(*[F.lit(float(r["m"])) for r in st])
    sd = F.array(*[F.lit(float(r["s"]) or 1.0) for r in st])
    return rows.select(F.zip_with(F.zip_with("x", mean, lambda a, m: a - m), sd, lambda a, s: a / s).alias("z"))


def _pair_cells(rows: DataFrame, diagonal: bool, block_rows: int) -> DataFrame:
    """(i, j, n_i, z_i, n_j, z_j): the cells i <= j of the triangle of packed blocks of the ``z`` rows.

    The blocks are written once; a task of the product reads its two parts of them, so no block is shuffled for
    its cells.  Parts hold at most about PAIR_PART bytes.  A cell is sent to Python with both of its blocks, so
    blocks of a large table have more than ``block_rows`` rows (not with ``diagonal``, where they are the sample).
    """
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    size = rows.agg(F.count("*").alias("n"), F.sum(8 * F.size("z").cast("long")).alias("bytes")).first()
    if not diagonal:
        fit = PAIR_BYTES * size["n"] // max(1, size["bytes"] or 0)
        block_rows = max(block_rows, min(fit, -(-size["n"] // PAIR_BLOCKS)))
    count = max(1, -(-size["n"] // block_rows))
    parts = min(-(-count // PAIR_HELD), max(PAIR_PARTS, -(-(size["bytes"] or 0) // PAIR_PART)))

    def pack(table: pa.Table) -> pa.Table:
        z = table.column("z").combine_chunks()
        flat = z.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "n": pa.array([len(z)], pa.int32()),
                         "z": pa.array([flat.tobytes()], pa.binary())})

    blocks = cut_lineage(
        rows.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(count)).cast("int")).drop("_row")
        .repartition(parts, "block").groupBy("block").applyInArrow(pack, "block int, n int, z binary")).coalesce(parts)
    left, right = (blocks.select(F.col("block").alias(b), F.col("n").alias(f"n_{b}"), F.col("z").alias(f"z_{b}")) for b in "ij")
    if diagonal:
        return left.withColumns({"j": F.col("i"), "n_j": F.lit(None).cast("int"), "z_j": F.lit(None).cast("binary")})
    return left.join(right.hint("shuffle_replicate_nl"), F.col("i") <= F.col("j"))


def _cells(batches):
    """(i, first, second) of each cell: the rows of its blocks, None for the second of a block with itself."""
    for batch in batches:
        for r in range(batch.num_rows):
            cell = {c: batch.column(c)[r] for c in ("i", "j", "n_i", "z_i", "n_j", "z_j")}
            i, within = cell["i"].as_py(), cell["i"] == cell["j"]
            first = np.frombuffer(cell["z_i"].as_buffer(), "<f8").reshape(cell["n_i"].as_py(), -1)
            second = None if within else np.frombuffer(cell["z_j"].as_buffer(), "<f8").reshape(cell["n_j"].as_py(), -1)
            yield i, first, second


def _product_error(first: np.ndarray, second: np.ndarray | None, kind: type) -> float:
    """How far a squared distance of ``_product_tiles`` is from the square of ``_distances`` at most.

    Each of the k + 2 terms is rounded a few times and summed in any order; their magnitudes add up to (|x| + |y|)^2,
    and to as much again for ``base``, which is a squared distance of rows that are no longer than these.
    """
    longest = [float(np.sqrt(np.einsum("ij,ij->i", x, x).max())) for x in (first, first if second is None else second)]
    most, unit = sum(longest), np.finfo(kind).eps / 2 + 2 * np.finfo(float).eps
    if not np.isfinite(most):
        raise ValueError("a standardised component is not a finite number")
    return 2.5 * (first.shape[1] + 16) * unit * most * most + (1 + most) * (1e-36 if kind is np.float32 else 1e-290)


def _product_tiles(first: np.ndarray, second: np.ndarray | None, kind: type, scale: float = 1.0, base: float = 0.0):
    """(r, c, tile, hidden): scale * (d^2 - base) for the pairs of the rows r, r + 1, ... of the first block with the
    rows c, c + 1, ... of the second, by matrix products in ``kind``.  ``hidden`` marks what is no pair of its own in a
    block with itself (else None); every tile has a pair, and the next one overwrites it.
    """
    within, other = second is None, first if second is None else second
    x, y = first.astype(kind), other.astype(kind)
    x2, y2 = (np.einsum("ij,ij->i", z, z) for z in (x.astype(float), y.astype(float)))
    left = np.column_stack([x, x2, np.ones(len(x))]).astype(kind)
    right = np.column_stack([y * (-2.0 * scale), np.full(len(y), scale), scale * (y2 - base)]).astype(kind)
    (height, width), held = PAIR_TILE, np.empty(PAIR_TILE[0] * PAIR_TILE[1], kind)
    for begin in range(0, len(y), width):
        end = min(begin + width, len(y))
        for r in range(0, len(x), height):
            c, rows = max(begin, r + 1) if within else begin, min(height, len(x) - r)
            if c >= end:
                break
            tile = held[:rows * (end - c)].reshape(rows, end - c)
            np.matmul(left[r:r + rows], right[c:end].T, out=tile)
            yield r, c, tile, np.tri(rows, end - c, r - c, dtype=bool) if within and r + rows > c else None


def _distances(first: np.ndarray, second: np.ndarray | None, r: int, c: int, width: int, at: np.ndarray):
    """Distances of the pairs at the positions ``at`` of a tile (its first row, first column and width), in pieces."""
    other = first if second is None else second
    step = max(1, PAIR_PIECE // max(1, first.shape[1]))
    for k in range(0, len(at), step):
        row, column = np.divmod(at[k:k + step], width)
        d = other[c + column] - first[r + row]
        yield np.sqrt((d * d).sum(axis=1))


def _widened(first: np.ndarray, second: np.ndarray | None, lo: float, hi: float) -> tuple[float, float]:
    """The range (lo, hi) widened to the distances of a cell: products tell which pairs can lie beyond it, and only
    the distances of these are formed."""
    error = _product_error(first, second, np.float32)
    for r, c, tile, hidden in _product_tiles(first, second, np.float32):
        flat, at = tile.reshape(-1), (first, second, r, c, tile.shape[1])
        if hidden is not None:
            np.copyto(tile, np.inf, where=hidden)
        least = float(flat.min())
        if lo > 0 and least - error < lo * lo:
            lo = min(lo, *next(_distances(*at, flat.argmin(keepdims=True))))
            for d in _distances(*at, np.flatnonzero(flat <= min(least + 2 * error, lo * lo + error))):
                lo = min(lo, d.min())
                if lo == 0:
                    break
        if hidden is not None:
            np.copyto(tile, -np.inf, where=hidden)
        most = float(flat.max())
        if most + error > hi * hi:
            hi = max(hi, *next(_distances(*at, flat.argmax(keepdims=True))))
            for d in _distances(*at, np.flatnonzero(flat >= max(most - 2 * error, hi * hi - error))):
                hi = max(hi, d.max())
    return float(lo), float(hi)


def _levels(lo: float, hi: float, bins: int, error: float, scale: float, base: float) -> np.ndarray:
    """The bin of every level floor(scale * (d^2 - base)) of a squared distance known to ``error``; ``bins`` where the
    level holds an edge or is as near to one."""
    edges, slack = lo + np.arange(1, bins) * ((hi - lo) / bins), 1e-12 * max(abs(lo), abs(hi))
    low, high = ((e * np.abs(e) - base + way * error) * scale + way * 1e-6 for e, way in ((edges - slack, -1), (edges + slack, 1)))
    start, stop = (np.clip(np.floor(e) + more, 0, PAIR_LEVELS).astype(int) for e, more in ((low, 0), (high, 1)))
    bin_of = np.zeros(PAIR_LEVELS, np.uint8 if bins + 2 <= 256 else np.int64)
    for b, after in enumerate(stop, 1):
        bin_of[after:] = b
    for before, after in zip(start, stop, strict=True):
        bin_of[before:after] = bins
    return bin_of


def _counts(code: np.ndarray, most: int) -> np.ndarray:
    """How often each number below ``most`` comes; bytes are counted two at a time."""
    if code.itemsize > 1:
        return np.bincount(code, minlength=most)
    twice = np.bincount(code[:len(code) // 2 * 2].view(np.uint16), minlength=256 * most).reshape(most, 256)
    return twice.sum(axis=1) + twice.sum(axis=0)[:most] + np.bincount(code[len(code) // 2 * 2:], minlength=most)


def _positions(found: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of few hits: eight entries are looked at as one word."""
    whole = len(found) // 8 * 8
    word = np.flatnonzero(found[:whole].view(np.uint64))
    inside = (word[:, None] * 8 + np.arange(8))[found[:whole].reshape(-1, 8)[word]]
    return np.concatenate([inside, whole + np.flatnonzero(found[whole:])])


def _bin_counts(first: np.ndarray, second: np.ndarray | None, lo: float, hi: float, bins: int) -> np.ndarray:
    """Number of pairs of a cell in each bin of (lo, hi), which holds all distances.

    Products put a pair into one of PAIR_LEVELS levels of its squared distance, and a level lies in one bin; for
    levels at an edge the distances are formed.  Double precision where single leaves too many levels at the edges.
    """
    for kind in (np.float32, np.float64):
        error = _product_error(first, second, kind)
        base = max(lo, 0.0) ** 2 - 2 * error
        scale = (PAIR_LEVELS - 1) / (hi * hi + 2 * error - base)
        if scale * error <= PAIR_EDGE:
            break
    bin_of = _levels(lo, hi, bins, error, scale, base)
    total, most = np.zeros(bins + 2, np.int64), PAIR_TILE[0] * PAIR_TILE[1]
    levels, codes = np.empty(most, np.uint16), np.empty(most, bin_of.dtype)
    for r, c, tile, hidden in _product_tiles(first, second, kind, scale, base):
        if hidden is not None:
            np.copyto(tile, 0, where=hidden)
        flat = tile.reshape(-1)
        level, code = levels[:len(flat)], codes[:len(flat)]
        np.copyto(level, flat, casting="unsafe")
        bin_of.take(level, out=code, mode="clip")
        if hidden is not None:
            np.copyto(code, bins + 1, where=hidden.reshape(-1))
        total += _counts(code, bins + 2)
        for d in _distances(first, second, r, c, tile.shape[1], _positions(code == bins)):
            at = np.clip(np.floor((d - lo) * (bins / (hi - lo))), 0, bins - 1).astype(np.int64)
            total[:bins] += np.bincount(at, minlength=bins)
    return total[:bins]


def all_pairs_hist(df: DataFrame, vector: str, bins: int = 30, diagonal: bool = False,
                   block_rows: int = PAIR_BLOCK) -> DataFrame:
    """E15 over a whole table: histogram of the Euclidean distances of all pairs of standardised rows.

    The rows lie in blocks; a task reads two parts of the blocks, and a cell of their triangle gives bin counts
    only, so neither pairs nor blocks are shuffled for the cells: what is written grows with the rows, the work
    with their square.  The range of the bins is found by a first pass over the cells (min and max per task).  Both
    passes take matrix products of blocks with a bound of their rounding, and form the distances of the pairs that
    the bound leaves open, so minimum, maximum and counts are those of the distances.
    Output: (bin, lo_edge, hi_edge, count, share, se).

    ``diagonal`` measures only the pairs inside the blocks, which rows are dealt to at random: an estimate
    whose work grows with the rows instead of their square.  ``se`` is then the standard error of the share
    from the spread over blocks (NULL with one block); with all pairs it is 0.
    """
    cells = _pair_cells(standardised(df, vector), diagonal, block_rows)

    def extremes(batches):
        lo, hi = np.inf, 0.0
        for _, first, second in _cells(batches):
            lo, hi = _widened(first, second, lo, hi)
        if lo <= hi:
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([hi])], names=["lo", "hi"])

    edge = cells.mapInArrow(extremes, "lo double, hi double").agg(F.min("lo"), F.max("hi")).first()
    lo, hi = (0.0, 0.0) if edge[0] is None else (float(edge[0]), float(edge[1]))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def count(batches):
        for i, first, second in _cells(batches):
            total = _bin_counts(first, second, lo, hi, bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * bins, pa.int32()), pa.array(np.arange(bins, dtype=np.int64)), pa.array(total),
                 pa.array([int(total.sum())] * bins, pa.int64())], names=["i", "bin", "count", "pairs"])

    per_cell = cells.mapInArrow(count, "i int, bin long, count long, pairs long")
    share = F.col("count") / F.col("pairs")
    found = per_cell.groupBy("bin").agg(
        F.sum("count").alias("count"), F.sum("pairs").alias("pairs"),
        (F.stddev_samp(F.when(F.col("pairs") > 0, share)) / F.sqrt(F.count(F.when(F.col("pairs") > 0, 1)))).alias("se"))
    at = F.col("bin")
    return found.where(F.col("pairs") > 0).select(
        "bin", (F.lit(lo) + at * step).alias("lo_edge"),
        F.when(at == bins - 1, F.lit(hi)).otherwise(F.lit(lo) + (at + 1) * step).alias("hi_edge"), "count",
        (F.col("count") / F.col("pairs")).alias("share"), (F.col("se") if diagonal else F.lit(0.0)).alias("se"))
