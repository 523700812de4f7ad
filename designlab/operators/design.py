"""Design-table generators.

Every generator is seeded and reproducible: uniforms come from ``hash_uniform``
(md5 of seed, dimension and row id), so a row's values never depend on
partitioning, task order or retries.  Row sources are ``spark.range`` or an id
column of an existing table; nothing is built on the driver but Columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from designlab.functions.numeric import hash_uniform
from designlab.operators.rank import dist_rank


def _rescale(u: Column, lo: float, hi: float) -> Column:
    """Unit-cube value to [lo, hi]."""
    return u * F.lit(float(hi - lo)) + F.lit(float(lo))


def _digits(total_parts: int | None, spark: SparkSession) -> int:
    return total_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- factorials

def full_factorial(spark: SparkSession, levels: dict[str, Sequence[float]],
                   num_partitions: int | None = None) -> DataFrame:
    """B1: Cartesian product of the levels, last parameter varying fastest.

    Row ``design_id`` is decoded in mixed radix from ``spark.range`` (no joins).
    """
    names = list(levels)
    radices = [len(levels[n]) for n in names]
    total = math.prod(radices)
    strides = [math.prod(radices[i + 1:]) for i in range(len(names))]
    ids = spark.range(0, total, 1, _digits(num_partitions, spark)).withColumnRenamed("id", "design_id")
    cols = [F.col("design_id")]
    for n, r, s in zip(names, radices, strides):
        idx = (F.floor(F.col("design_id") / F.lit(s)) % F.lit(r)).cast("int")
        arr = F.array(*[F.lit(float(v)) for v in levels[n]])
        cols.append(F.element_at(arr, idx + 1).alias(n))
    return ids.select(*cols)


def linspace_levels(lo: float, hi: float, k: int) -> list[float]:
    """k evenly spaced points from lo to hi (numpy linspace: start + i*step, last = hi)."""
    if k == 1:
        return [float(lo)]
    step = (hi - lo) / (k - 1)
    out = [lo + i * step for i in range(k)]
    out[-1] = float(hi)
    return out


def grid(spark: SparkSession, bounds: dict[str, tuple[float, float]], k: int = 3,
         num_partitions: int | None = None) -> DataFrame:
    """B2: k evenly spaced levels between min and max per parameter, then the full product."""
    return full_factorial(spark, {n: linspace_levels(lo, hi, k) for n, (lo, hi) in bounds.items()},
                          num_partitions)


def parse_generators(design: str) -> tuple[list[str], list[str]]:
    """Tokens of a two-level design string and its base letters (first-seen order, at most 7)."""
    tokens = design.split()
    base: list[str] = []
    for t in tokens:
        for ch in t:
            if ch.isalpha() and ch not in base:
                base.append(ch)
    if len(base) > 7:
        raise ValueError(f"a two-level design has at most 7 base factors, found {len(base)}")
    return tokens, base


def fractional_factorial(spark: SparkSession, design: str, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Two-level fractional factorial; one column per token, -1/+1 mapped to low/high.

    Base factor i has sign +1 when bit i of the run id is set (first factor
    fastest); a token like ``ab`` is the product of its letters' signs, a
    leading ``-`` flips it.
    """
    tokens, base = parse_generators(design)
    names = list(bounds)
    if len(names) < len(tokens):
        raise ValueError(f"the design has {len(tokens)} columns for {len(names)} parameters")
    names = names[:len(tokens)]
    runs = spark.range(0, 2 ** len(base), 1, 1).withColumnRenamed("id", "design_id")
    cols = [F.col("design_id")]
    for tok, n in zip(tokens, names):
        sign = F.lit(-1 if tok.startswith("-") else 1)
        for ch in tok.lstrip("+-"):
            bit = (F.shiftright(F.col("design_id"), base.index(ch)) % 2).cast("int")
            sign = sign * (bit * 2 - 1)
        lo, hi = bounds[n]
        cols.append(((sign + F.lit(1)) / F.lit(2.0) * F.lit(float(hi - lo)) + F.lit(float(lo))).alias(n))
    return runs.select(*cols)


# ---------------------------------------------------------------- random, LHS, Sobol

def random_uniform(ids: DataFrame, bounds: dict[str, tuple[float, float]], seed: int = 42,
                   id_col: str = "design_id") -> DataFrame:
    """Uniform in [lo, hi) per parameter, seeded by (seed, parameter, id)."""
    return ids.select(F.col(id_col), *[_rescale(hash_uniform(seed, n, F.col(id_col)), lo, hi).alias(n)
                                       for n, (lo, hi) in bounds.items()])


def lhs(ids: DataFrame, bounds: dict[str, tuple[float, float]], seed: int = 42,
        id_col: str = "design_id", num_partitions: int | None = None) -> DataFrame:
    """Latin hypercube over all ids: per parameter, stratum = rank of a seeded hash, plus jitter.

    One wide pass: rows are stacked as (id, parameter, hash), ranked inside each
    parameter with the distributed rank (a parameter holds all n rows, so it is
    spread over range partitions), and pivoted back on id.
    """
    names = list(bounds)
    idc = F.col(id_col)
    stacked = ids.select(idc.alias("_id"), F.explode(F.array(*[F.lit(n) for n in names])).alias("_p"))
    stacked = stacked.withColumn("_h", hash_uniform(f"{seed}:perm", F.col("_p"), F.col("_id")))
    ranked = dist_rank(stacked, [F.col("_h"), F.col("_id")], ["_p"], rank_col="_r", count_col="_n",
                       num_partitions=num_partitions)
    u = (F.col("_r") - 1 + hash_uniform(f"{seed}:jit", F.col("_p"), F.col("_id"))) / F.col("_n")
    lo = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.lit(float(bounds[n][0])))]), F.col("_p"))
    width = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.lit(float(bounds[n][1] - bounds[n][0])))]),
                         F.col("_p"))
    ranked = ranked.withColumn("_v", u * width + lo)
    wide = ranked.groupBy("_id").pivot("_p", names).agg(F.first("_v"))
    return wide.withColumnRenamed("_id", id_col).select(id_col, *names)


def _feistel_permute(x, n: int, key: int):
    """Keyed bijection of [0, n) (numpy, vectorised): a 4-round Feistel network on the smallest
    even-bit domain >= n, with cycle walking until every value lands below n."""
    import numpy as np
    bits = max(2, int(n - 1).bit_length())
    bits += bits % 2
    half = bits // 2
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF) for r in range(4)]

    def enc(v):
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right * np.uint64(0xD6E8FEB86659FD93) + k) & np.uint64(0xFFFFFFFFFFFFFFFF)
            f = (f ^ (f >> np.uint64(29))) & mask
            left, right = right, left ^ f
        return (left << np.uint64(half)) | right

    with np.errstate(over="ignore"):
        y = enc(x.astype(np.uint64))
        out_of_range = y >= np.uint64(n)
        while out_of_range.any():
            y[out_of_range] = enc(y[out_of_range])
            out_of_range = y >= np.uint64(n)
    return y.astype(np.int64)


def lhs_permuted(ids: DataFrame, bounds: dict[str, tuple[float, float]], n: int, seed: int = 42,
                 id_col: str = "design_id") -> DataFrame:
    """B4 without any shuffle, for dense ids 0..n-1 (as from ``spark.range(n)``): the stratum of
    row i in each parameter is a keyed permutation of i (Feistel, cycle-walked into [0, n)),
    computed per Arrow batch; the jitter is the same seeded md5 uniform as ``lhs``."""
    import hashlib
    names = list(bounds)
    keys = [int(hashlib.md5(f"{seed}|lhs|{nm}".encode()).hexdigest()[:15], 16) for nm in names]
    with_jit = ids.select(F.col(id_col), *[hash_uniform(f"{seed}:jit", nm, F.col(id_col)).alias(f"_j{k}")
                                           for k, nm in enumerate(names)])
    schema = ", ".join([f"{id_col} long"] + [f"`{nm}` double" for nm in names])

    def fn(batches):
        for pdf in batches:
            i = pdf[id_col].to_numpy()
            out = {id_col: i}
            for k, nm in enumerate(names):
                lo, hi = bounds[nm]
                u = (_feistel_permute(i, n, keys[k]) + pdf[f"_j{k}"].to_numpy()) / n
                out[nm] = u * (hi - lo) + lo
            yield pd.DataFrame(out)
    return with_jit.mapInPandas(fn, schema)


def lhs_in_groups(ids: DataFrame, bounds: dict[str, tuple[float, float]], group_col: str, seed: int = 42,
                  id_col: str = "design_id") -> DataFrame:
    """Many small Latin hypercubes at once, one per ``group_col`` value.

    Groups are candidate designs of a bounded sample count, so a window per
    group is bounded; all parameters share one shuffle (partition by group).
    """
    out = ids
    w_n = Window.partitionBy(group_col)
    out = out.withColumn("_n", F.count(F.lit(1)).over(w_n))
    for n, (lo, hi) in bounds.items():
        h = hash_uniform(f"{seed}:perm", F.lit(n), F.col(id_col))
        r = F.row_number().over(Window.partitionBy(group_col).orderBy(h, F.col(id_col)))
        u = (r - 1 + hash_uniform(f"{seed}:jit", F.lit(n), F.col(id_col))) / F.col("_n")
        out = out.withColumn(n, _rescale(u, lo, hi))
    return out.drop("_n")


def map_groups(df: DataFrame, group_col: str, fn, schema: str) -> DataFrame:
    """Run ``fn(pandas frame of whole groups) -> pandas frame`` over groups of bounded size.

    Rows are hash-partitioned and sorted by the group, then streamed through
    ``mapInPandas`` in Arrow batches; a group cut by a batch boundary is carried
    into the next batch, so memory holds one batch plus one group.
    """
    ordered = df.repartition(group_col).sortWithinPartitions(group_col)

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                continue
            last = pdf[group_col].iloc[-1]
            tail = pdf[group_col] == last
            carry = pdf[tail]
            done = pdf[~tail]
            if len(done):
                yield fn(done)
        if carry is not None and len(carry):
            yield fn(carry)
    return ordered.mapInPandas(run, schema)


def closest_pair(x: np.ndarray, floor: float = -1.0) -> float:
    """Least Euclidean distance between two rows (infinite below two rows), without an n x n array.

    Rows are ordered by their widest column, and neighbours at rank distance 1, 2, ... are compared until that
    column alone keeps all of them further apart than the least distance so far.  Once that is at most
    ``floor`` the search is given up: the result is then some distance that is at most ``floor``.
    """
    if len(x) < 2:
        return np.inf
    x = x[np.argsort(x[:, np.argmax(np.ptp(x, axis=0))], kind="stable")]
    wide = x[:, np.argmax(np.ptp(x, axis=0))]
    best = np.inf
    for k in range(1, len(x)):
        near = np.flatnonzero(wide[k:] - wide[:-k] < best)
        if not len(near):
            break
        d = x[near + k] - x[near]
        best = min(best, float(np.sqrt((d * d).sum(axis=1).min())))
        if best <= floor:
            break
    return best


def _min_pair_distances(names: Sequence[str], group_col: str):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, dists = [], []
        for key, g in pdf.groupby(group_col, sort=False):
            keys.append(key)
            dists.append(closest_pair(g[list(names)].to_numpy(dtype=float)))
        return pd.DataFrame({group_col: keys, "min_dist": dists})
    return fn


def maximin_lhs(ids: DataFrame, bounds: dict[str, tuple[float, float]], group_col: str, seed: int = 42,
                id_col: str = "design_id", scale: str = "physical") -> DataFrame:
    """Among candidate Latin hypercubes (one per ``group_col``), keep the one with the largest
    minimum pairwise Euclidean distance; the earliest candidate wins ties.

    ``scale='physical'`` measures in scaled units (large-valued parameters
    dominate, as in the original); ``'unit'`` in the unit cube.  Each candidate
    has a bounded sample count, so its distances are computed inside its own
    group with numpy and no pair rows are produced.
    """
    cands = lhs_in_groups(ids, bounds, group_col, seed, id_col)
    names = list(bounds)
    feats = cands
    if scale == "unit":
        feats = cands.select(group_col, id_col, *[((F.col(n) - lo) / F.lit(float(hi - lo) or 1.0)).alias(n)
                                                  for n, (lo, hi) in bounds.items()])
    scores = map_groups(feats.select(group_col, *names), group_col, _min_pair_distances(names, group_col),
                        f"{group_col} long, min_dist double")
    # the winner is one row; bringing it back as a literal lets the filter reach the id source,
    # so only the winning candidate's hypercube is rebuilt (not every candidate a second time)
    best = scores.orderBy(F.desc("min_dist"), F.asc(group_col)).limit(1).first()
    if best is None:
        return cands.select(group_col, id_col, *names).withColumn("min_dist", F.lit(None).cast("double")).limit(0)
    win = ids.where(F.col(group_col) == F.lit(best[group_col]))
    out = lhs_in_groups(win, bounds, group_col, seed, id_col)
    return out.select(group_col, id_col, *names).withColumn("min_dist", F.lit(float(best["min_dist"])))


# Sobol direction-number parameters (Joe & Kuo 2008), dimensions 2..10 (fixed values):
# (s, a, m_1..m_s); dimension 1 is the binary radical inverse.
SOBOL_PARAMS = [
    (1, 0, (1,)),
    (2, 1, (1, 3)),
    (3, 1, (1, 3, 1)),
    (3, 2, (1, 1, 1)),
    (4, 1, (1, 1, 3, 3)),
    (4, 4, (1, 3, 5, 13)),
    (5, 2, (1, 1, 5, 5, 17)),
    (5, 4, (1, 1, 5, 5, 5)),
    (5, 7, (1, 1, 7, 11, 19)),
]
SOBOL_BITS = 32


def sobol_directions(dim: int, bits: int = SOBOL_BITS) -> list[int]:
    """Direction integers v_1..v_bits of a dimension (0-based), scaled to ``bits`` bits."""
    if dim == 0:
        return [1 << (bits - k) for k in range(1, bits + 1)]
    if dim - 1 >= len(SOBOL_PARAMS):
        raise ValueError(f"Sobol: at most {len(SOBOL_PARAMS) + 1} dimensions")
    s, a, m = SOBOL_PARAMS[dim - 1]
    v = [0] * (bits + 1)
    for k in range(1, bits + 1):
        if k <= s:
            v[k] = m[k - 1] << (bits - k)
        else:
            x = v[k - s] ^ (v[k - s] >> s)
            for j in range(1, s):
                if (a >> (s - 1 - j)) & 1:
                    x ^= v[k - j]
            v[k] = x
    return v[1:]


def sobol_shift(seed: int, dim: int) -> int:
    """Seeded 32-bit digital shift of a dimension (md5, so any engine can reproduce it)."""
    import hashlib
    return int(hashlib.md5(f"{seed}|sobol|{dim}".encode()).hexdigest()[:8], 16)


SCRAMBLED_BITS = 52


def scrambled_directions(dim: int, seed: int, bits: int = SCRAMBLED_BITS) -> list[int]:
    """Direction integers after a seeded linear matrix scrambling: every output bit is the input bit plus a
    random choice of the bits above it (a lower-triangular matrix with ones on the diagonal)."""
    import hashlib
    rows = []
    for bit in range(bits):  # 0 = most significant
        digest = int(hashlib.md5(f"{seed}|scramble|{dim}|{bit}".encode()).hexdigest(), 16)
        above = digest & ((1 << bit) - 1)
        rows.append((1 << (bits - 1 - bit)) | (above << (bits - bit)))
    return [sum(((v & row).bit_count() & 1) << (bits - 1 - bit) for bit, row in enumerate(rows))
            for v in sobol_directions(dim, bits)]


def scrambled_shift(seed: int, dim: int, bits: int = SCRAMBLED_BITS) -> int:
    """Seeded digital shift of a dimension."""
    import hashlib
    return int(hashlib.md5(f"{seed}|shift|{dim}".encode()).hexdigest(), 16) >> (128 - bits)


def sobol_scrambled(ids: DataFrame, bounds: dict[str, tuple[float, float]], seed: int = 42,
                    id_col: str = "design_id", index_col: str | None = None) -> DataFrame:
    """B6 with scrambling: Sobol points of 52 bits, linear matrix scrambling and a digital shift, both seeded.

    Point numbers run to 2^52 - 1.  The scrambled directions are constants, so a point is per-row bit
    arithmetic as in ``sobol``: no shuffle.
    """
    return _sobol_points(ids, bounds, id_col, index_col, SCRAMBLED_BITS,
                         lambda d: (scrambled_directions(d, seed), scrambled_shift(seed, d)))


def sobol(ids: DataFrame, bounds: dict[str, tuple[float, float]], seed: int | None = 42,
          id_col: str = "design_id", index_col: str | None = None) -> DataFrame:
    """Sobol point number ``index_col`` (default the id) per row, Gray-code order, with a seeded
    digital shift (XOR) when ``seed`` is given.  Pure per-row bit arithmetic: no shuffle.
    """
    return _sobol_points(ids, bounds, id_col, index_col, SOBOL_BITS,
                         lambda d: (sobol_directions(d), 0 if seed is None else sobol_shift(seed, d)))


def _sobol_points(ids: DataFrame, bounds: dict[str, tuple[float, float]], id_col: str, index_col: str | None, bits: int,
                  numbers) -> DataFrame:
    """Points from ``numbers(dimension)`` = (direction integers, shift) of ``bits`` bits."""
    raw = F.col(index_col or id_col).cast("long")
    # beyond the direction numbers' bits points would repeat silently
    idx = F.when(raw.isNull() | raw.between(0, (1 << bits) - 1), raw).otherwise(
        F.raise_error(F.concat(F.lit(f"Sobol index outside 0 to 2^{bits} - 1: "), raw.cast("string"))))
    gray = idx.bitwiseXOR(F.shiftright(idx, 1))
    cols = [F.col(id_col)]
    for d, (n, (lo, hi)) in enumerate(bounds.items()):
        directions, shift = numbers(d)
        acc = F.lit(shift).cast("long")
        for b, v in enumerate(directions):
            acc = acc.bitwiseXOR(F.when(F.shiftright(gray, b) % 2 == 1, F.lit(v)).otherwise(F.lit(0)).cast("long"))
        value = _rescale(acc.cast("double") / F.lit(float(1 << bits)), lo, hi)
        cols.append(F.when(idx.isNotNull(), value).alias(n))
    return ids.select(*cols)


def _candidate_lhs(it: int, seed: int, samples: int, lows, widths):
    """One candidate hypercube, reproducible from (seed, candidate number) alone."""
    rng = np.random.default_rng(np.random.SeedSequence([int(seed), int(it)]))
    d = len(lows)
    strata = np.stack([rng.permutation(samples) for _ in range(d)], axis=1)
    u = (strata + rng.random((samples, d))) / samples
    return u * widths + lows


def maximin_lhs_generated(spark: SparkSession, bounds: dict[str, tuple[float, float]], samples: int = 20,
                          iterations: int = 50, seed: int = 42, num_partitions: int | None = None,
                          scale: str = "physical") -> DataFrame:
    """B5 for generated candidates: one row per candidate from ``spark.range(iterations)``; each
    task builds its candidates' hypercubes (numpy, seeded by candidate number) and scores them,
    so there is no shuffle; the best candidate (largest minimum distance, earliest on ties) is then
    rebuilt as ``samples`` rows.

    A task gives a candidate up as soon as two of its points are no further apart than the closest pair of
    its best candidate so far.  ``scale`` only chooses the distance (physical units or the unit cube): one
    seed gives the same candidates.
    """
    names = list(bounds)
    lows = np.array([bounds[n][0] for n in names], dtype=float)
    widths = np.array([bounds[n][1] - bounds[n][0] for n in names], dtype=float)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    unit = np.where(widths == 0, 1.0, widths) if scale == "unit" else np.ones(len(widths))

    def score(batches):
        best = None
        for pdf in batches:
            for it in pdf["id"].to_numpy():
                x = _candidate_lhs(it, seed, samples, lows, widths) / unit
                d = closest_pair(x, -1.0 if best is None else best[1])
                if best is None or d > best[1]:
                    best = int(it), d
        if best is not None:
            yield pd.DataFrame({"iteration": [best[0]], "min_dist": [best[1]]})

    scores = spark.range(0, iterations, 1, parts).mapInPandas(score, "iteration long, min_dist double")
    best = scores.orderBy(F.desc("min_dist"), F.asc("iteration")).limit(1).first()   # one row
    it, md = int(best["iteration"]), float(best["min_dist"])
    x = _candidate_lhs(it, seed, samples, lows, widths)
    rows = [(i, *map(float, x[i])) for i in range(samples)]                          # `samples` rows
    schema = ", ".join(["design_id long"] + [f"`{n}` double" for n in names])
    return spark.createDataFrame(rows, schema).withColumn("iteration", F.lit(it).cast("long")) \
        .withColumn("min_dist", F.lit(md))
