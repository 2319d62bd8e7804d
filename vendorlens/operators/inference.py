"""Resampling inference as distributed jobs.

Every (row, replicate) pair has one integer below 2**31 - 1, mixed from two independent
30-bit lanes of ``md5(seed|key)`` and the replicate's number. The lanes are computed once
a row; Spark, numpy and DuckDB mix them with the same exact integer arithmetic, so the
oracle checks values.

Bootstrap: the integer gives a Poisson(1) weight. A task adds up ``sum w`` and ``sum w*x``
of its rows for all replicates and emits these partial sums, one row per replicate and
group; rows are never multiplied by replicates.

Permutation: a replicate puts the ``n_a`` rows with the smallest integers into group a.
Tasks first count and sum their rows in a few value ranges around the expected cut;
the totals name each replicate's boundary range. Where that holds more than about ``sqrt(n)`` rows (the cut
lies outside the expected window), only this range is cut and counted again. A last pass sends on the
rows of the boundary ranges only, of which the smallest complete the sum. The
path is the same at any size, and no task holds the pool.

Bootstrap draws are Poisson rather than the reference's exact-size resamples
(numpy streams are not reproducible across engines); intervals agree in distribution.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorlens.functions.frames import attach
from vendorlens.functions.ranking import exact_quantiles, grouped_quantiles, qcut
from vendorlens.session import stored

M31 = 2147483647
PERM_RTOL = 1e-12
GOLDEN = 2654435761
LANE = (1 << 30) - 1


def _poisson_cdf() -> list[float]:
    """P(X <= k) of Poisson(1) up to the k beyond which no draw of 31 bits can fall."""
    out, term, total = [], math.exp(-1.0), 0.0
    while not out or 1.0 - out[-1] >= 1.0 / M31:
        total += term
        out.append(total)
        term /= len(out)
    return out


POISSON_CDF = _poisson_cdf()


def _thresholds() -> np.ndarray:
    """The least integers whose share of M31 reaches each step of the distribution."""
    out = []
    for c in POISSON_CDF:
        t = int(c * M31)
        while t / float(M31) >= c:
            t -= 1
        while t / float(M31) < c:
            t += 1
        out.append(t)
    return np.array(out)


POISSON_STEPS = _thresholds()
#: Integers that a step of a task mixes: rows times replicates.
CELLS = 1 << 15


def blocks(reps, rows: int):
    """``reps`` in slices that make about ``CELLS`` integers with ``rows`` rows each."""
    step = max(1, CELLS // max(1, rows))
    for i in range(0, len(reps), step):
        yield slice(i, min(i + step, len(reps)))


def dealt(d: DataFrame) -> DataFrame:
    """A small table dealt to all cores: a row costs a step for each replicate, however few its bytes."""
    cores = d.sparkSession.sparkContext.defaultParallelism
    return d if d.rdd.getNumPartitions() >= cores else d.repartition(cores)


def reached(x: np.ndarray, steps) -> np.ndarray:
    """How many of ``steps`` (numbers, or a column for each) each integer of ``x`` reaches."""
    out = np.zeros(x.shape, np.int64)
    for s in steps:
        out += x >= s
    return out


def _key_text(seed: int, keys):
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def lanes(df: DataFrame, seed: int, keys) -> DataFrame:
    """``df`` with the two hash lanes ``_h1`` and ``_h2`` of each row."""
    d = df.withColumn("_md5", _key_text(seed, keys))
    lane = [F.conv(F.substring("_md5", at, 8), 16, 10).cast("bigint").bitwiseAND(LANE) for at in (1, 9)]
    return d.withColumn("_h1", lane[0]).withColumn("_h2", lane[1]).drop("_md5")


def _mod31(x: np.ndarray) -> np.ndarray:
    """``x`` modulo M31 = 2**31 - 1 for 0 <= x < 2**61, without a division."""
    y = x >> 31
    y += x & M31
    less = y - M31
    return np.minimum(y.view(np.uint64), less.view(np.uint64)).view(np.int64)  # a negative number is the larger one


def _fold(a, by: int):
    """``a`` times ``by``, modulo M31; ``a`` is overwritten."""
    a *= by
    return _mod31(a)


def _stir(a, rep):
    a = _fold(a ^ ((rep * GOLDEN) % 4294967296), 48271)
    a ^= a >> 15
    a = _fold(a, 69621)
    a ^= a >> 13
    return _fold(a, 48271)


def mixed(h1: np.ndarray, h2: np.ndarray, rep) -> np.ndarray:
    """The integer of each row in replicate ``rep`` (a column of replicates: a line for each); products stay below 2**48."""
    return _stir(_stir(h1, rep) ^ h2, rep)


def lanes_sql(seed: int, keys) -> list[str]:
    parts = ", ".join([f"'{seed}'"] + [f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys])
    return [f"(CAST(('0x' || substr(md5(concat_ws('|', {parts})), {at}, 8)) AS BIGINT) & {LANE})" for at in (1, 9)]


def _stir_sql(a: str, rep: str) -> str:
    a = f"xor({a}, ({rep} * {GOLDEN}) % 4294967296)"
    a = f"(({a}) * 48271) % {M31}"
    a = f"xor({a}, ({a}) >> 15)"
    a = f"(({a}) * 69621) % {M31}"
    a = f"xor({a}, ({a}) >> 13)"
    return f"((({a}) * 48271) % {M31})"


def mixed_ctes(src: str, rep: str, out: str, columns: str = "*") -> str:
    """CTEs (from ``src`` with h1, h2 and ``rep``) ending in ``out`` with the integer ``mixed``."""
    return (f"{out}_1 AS (SELECT {columns}, {_stir_sql('h1', rep)} AS m1 FROM {src}),\n"
            f"{out} AS (SELECT *, {_stir_sql('xor(m1, h2)', rep)} AS mixed FROM {out}_1)")


def poisson_weight_sql(x: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {x} / {float(M31)!r} >= {c!r} THEN 1 ELSE 0 END" for c in POISSON_CDF) + ")"


# --------------------------------------------------------------------------- groups


def groups_unit_price_terciles(brand_pricing: DataFrame) -> DataFrame:
    """H1: Small/Large sales-quantity terciles; value = purchase dollars / sales qty."""
    b = brand_pricing.filter((F.col("TotalSalesQuantity") > 0) & (F.col("TotalPurchaseDollars") > 0))
    b = b.withColumn("value", F.col("TotalPurchaseDollars") / F.col("TotalSalesQuantity"))
    b = qcut(b, "TotalSalesQuantity", "group")
    return b.select("VendorNumber", "VendorName", "Brand", "group", "value")


def groups_unit_cost_terciles(vss: DataFrame) -> DataFrame:
    """H2: sales-quantity terciles; value = purchase dollars / purchase qty."""
    b = vss.filter((F.col("TotalPurchaseQuantity") > 0) & (F.col("TotalPurchaseDollars") > 0))
    b = b.withColumn("value", F.col("TotalPurchaseDollars") / F.col("TotalPurchaseQuantity"))
    b = qcut(b, "TotalSalesQuantity", "group")
    return b.select("VendorNumber", "VendorName", "Brand", "group", "value")


def groups_purchase_qty_median(brand: DataFrame) -> DataFrame:
    """H3: purchase quantity <= median -> 'small', above -> 'large'; value = unit price."""
    b = brand.filter((F.col("TotalPurchaseQuantity") > 0) & (F.col("TotalPurchaseDollars") > 0))
    b = stored(b.withColumn("value", F.col("TotalPurchaseDollars") / F.col("TotalPurchaseQuantity")))
    med = exact_quantiles(b, "TotalPurchaseQuantity", [0.5], ["_med"])
    return (attach(b, med)
             .withColumn("group", F.when(F.col("TotalPurchaseQuantity") <= F.col("_med"), F.lit("small"))
                                   .otherwise(F.lit("large")))
             .select("VendorNumber", "VendorName", "Brand", "group", "value"))


def groups_purchase_share(vendor_summary: DataFrame, low_q: float | None = None, high_q: float = 0.75) -> DataFrame:
    """H4: purchase share >= Q(high_q) -> 'top'; below -> 'rest' (or <= Q(low_q) -> 'low'
    when ``low_q`` is given). value = vendor margin (percent); NULL margins dropped."""
    v = vendor_summary.select("VendorNumber", "VendorName", F.col("TotalPurchaseDol").alias("_tp"),
                              F.col("ProfitMargin").alias("value"))
    tot = v.agg(F.sum("_tp").alias("_t"))
    v = stored(attach(v, tot).withColumn("share", F.col("_tp") / F.col("_t")))
    probs, names = [high_q], ["_hi"]
    if low_q is not None:
        probs, names = [high_q, low_q], ["_hi", "_lo"]
    q = exact_quantiles(v, "share", probs, names)
    v = attach(v, q)
    if low_q is None:
        g = F.when(F.col("share") >= F.col("_hi"), F.lit("top")).when(F.col("share") < F.col("_hi"), F.lit("rest"))
    else:
        g = F.when(F.col("share") >= F.col("_hi"), F.lit("top")).when(F.col("share") <= F.col("_lo"), F.lit("low"))
    return (v.withColumn("group", g).filter(F.col("group").isNotNull() & F.col("value").isNotNull())
             .select("VendorNumber", "VendorName", "group", "value"))


# --------------------------------------------------------------------------- bootstrap


def _replicate_means(df: DataFrame, keys, reps: int, seed: int, group: str = "group") -> DataFrame:
    """Weighted means of ``value``: (``group``, _rep, _mean)."""
    numbers = np.arange(reps)

    def run(batches):
        total = {}
        for batch in batches:
            h1, h2, x = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_h1", "_h2", "value"))
            names = np.array(batch.column("grp").to_pylist(), dtype=object)
            for g in set(names.tolist()):
                own = names == g
                a, b, v = h1[own], h2[own], x[own]
                w_sum, wx_sum = total.setdefault(g, (np.zeros(reps), np.zeros(reps)))
                for part in blocks(numbers, len(v)):
                    w = reached(mixed(a, b, numbers[part, None]), POISSON_STEPS)
                    w_sum[part] += w.sum(1)
                    wx_sum[part] += w @ v
        for g, (w, wx) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * reps, pa.string()), pa.array(np.arange(reps)), pa.array(w), pa.array(wx)],
                names=["grp", "_rep", "_w", "_wx"])

    rows = lanes(df, seed, keys).select(F.col(group).cast("string").alias("grp"), "_h1", "_h2", F.col("value").cast("double").alias("value"))
    part = dealt(rows).mapInArrow(run, "grp string, _rep long, _w double, _wx double")
    return part.groupBy(F.col("grp").alias(group), "_rep").agg(F.sum("_w").alias("_w"), F.sum("_wx").alias("_wx")).select(
        group, "_rep", F.when(F.col("_w") > 0, F.col("_wx") / F.col("_w")).alias("_mean"))


def bootstrap_mean_ci(df: DataFrame, keys, B: int = 2000, confidence: float = 0.95, seed: int = 42,
                      by=("group",)) -> DataFrame:
    """H5: mean with a percentile bootstrap interval per group -> (group, n, mean, lo, hi).

    ``B`` replicates for every group; NULLs when n < 5.
    """
    (group,), a = by, (1 - confidence) / 2
    d = stored(df.filter(F.col("value").isNotNull() & F.col(group).isNotNull()))
    n = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
    ci = _replicate_means(d, keys, B, seed, group).groupBy(group).agg(  # B values a group
        F.percentile("_mean", a).alias("lo"), F.percentile("_mean", 1 - a).alias("hi"))
    enough = F.col("n") >= 5
    return n.join(ci, group, "left").select(group, "n", *[F.when(enough, F.col(c)).alias(c) for c in ("mean", "lo", "hi")])


def _observed(d: DataFrame, group_a: str, group_b: str) -> DataFrame:
    is_a, is_b = F.col("group") == group_a, F.col("group") == group_b
    return d.agg(F.count_if(is_a).alias("n_a"), F.count_if(is_b).alias("n_b"), F.sum("value").alias("_tot"),
                 (F.avg(F.when(is_a, F.col("value"))) - F.avg(F.when(is_b, F.col("value")))).alias("observed_diff"))


def bootstrap_diff_ci(df: DataFrame, keys, group_a: str, group_b: str, B: int = 5000,
                      confidence: float = 0.95, seed: int = 0) -> DataFrame:
    """H6: difference of group means (a - b) with a percentile bootstrap interval.

    -> one row: n_a, n_b, observed_diff, boot_mean_diff, lo, hi.
    """
    a = (1 - confidence) / 2
    d = stored(df.filter(F.col("group").isin(group_a, group_b) & F.col("value").isNotNull()))
    ci = _diffs(d, keys, group_a, group_b, B, seed).agg(
        F.avg("diff").alias("boot_mean_diff"), F.percentile("diff", a).alias("lo"), F.percentile("diff", 1 - a).alias("hi"))
    return attach(_observed(d, group_a, group_b).drop("_tot"), ci)


def bootstrap_diffs(df: DataFrame, keys, group_a: str, group_b: str, B: int = 5000, seed: int = 0) -> DataFrame:
    """The bootstrap differences of group means (a - b) themselves: (rep, diff)."""
    return _diffs(stored(df.filter(F.col("group").isin(group_a, group_b) & F.col("value").isNotNull())), keys, group_a, group_b, B, seed)


def _diffs(d: DataFrame, keys, group_a: str, group_b: str, B: int, seed: int) -> DataFrame:
    mean = [F.max(F.when(F.col("group") == g, F.col("_mean"))) for g in (group_a, group_b)]
    return _replicate_means(d, keys, B, seed).groupBy(F.col("_rep").alias("rep")).agg((mean[0] - mean[1]).alias("diff"))


# --------------------------------------------------------------------------- permutation

#: Edges of the ranges in which rows are counted, and how many deviations they reach to either side of the expected cut.
CUTS = 17
REACH = 4.0
#: Boundary rows that a task sends on together.
SENT = 1 << 16


def _cut_edges(n_a: int, n: int) -> np.ndarray:
    """The values between ranges; CUTS edges make CUTS + 1 ranges."""
    p = n_a / n
    reach = REACH * math.sqrt(p * (1 - p) / n)
    return np.clip(np.floor((p + np.linspace(-reach, reach, CUTS)) * M31), 0, M31).astype(np.int64)


def _columns(batch):
    return (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_h1", "_h2", "value"))


def _range_counts(rows: DataFrame, reps: np.ndarray, low: np.ndarray, high: np.ndarray, edges: np.ndarray) -> DataFrame:
    """(at, range, n, s): rows and their sum in each range of replicate ``reps[at]``, between ``low`` and ``high`` only."""
    width, whole = edges.shape[1] + 1, not low.any() and (high == M31).all()

    def count(batches):
        n, s = np.zeros((len(reps), width), np.int64), np.zeros((len(reps), width))
        for batch in batches:
            h1, h2, v = _columns(batch)
            finite = np.isfinite(v).all()
            for part in blocks(reps, len(v)):
                x = mixed(h1, h2, reps[part, None])
                e = edges[part]
                lower, mid = x < e[:, :1], x < e[:, -1:]  # all but a few are in the first or the last range
                if not whole:
                    above, inside = x >= low[part, None], x < high[part, None]
                    lower, mid, inside = lower & above, mid & above & inside, above & inside
                upper = x >= e[:, -1:] if whole else inside & ~mid
                mid ^= lower
                ends = [(np.count_nonzero(m, axis=1), np.einsum("ij,j->i", m, v) if finite else np.where(m, v, 0.0).sum(1)) for m in (lower, upper)]
                line, at = np.nonzero(mid)
                place, size = line * width + reached(x[line, at], e[line].T), len(x) * width
                n_in, s_in = (np.bincount(place, weights=w, minlength=size).reshape(-1, width) for w in (None, v[at]))
                for total, inner, below, beyond in zip((n, s), (n_in, s_in), *ends):
                    inner[:, 0], inner[:, -1] = below, beyond
                    total[part] += inner
        at, ranges = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ranges), pa.array(n[at, ranges]), pa.array(s[at, ranges])],
                                         names=["at", "range", "n", "s"])

    return rows.mapInArrow(count, "at long, range long, n long, s double").groupBy("at", "range").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"))


def _boundaries(rows: DataFrame, n_a: int, n: int, B: int):
    """For each replicate the range [low, high) that its ``n_a``-th smallest integer lies in, how
    many of the range's rows belong to group a, and the sum of the rows below it.

    Ranges that hold more rows than about sqrt(n), which happens where the cut escapes the
    expected window, are cut again until they don't (or are a single integer)."""
    low, high = np.zeros(B, np.int64), np.full(B, M31, np.int64)
    rest, below = np.full(B, n_a, np.int64), np.zeros(B)
    todo, edges = np.arange(B), np.broadcast_to(_cut_edges(n_a, n), (B, CUTS))
    few = math.isqrt(n) + 64
    upto = Window.partitionBy("at").orderBy("range")  # CUTS + 1 rows each
    while len(todo):
        want = rows.sparkSession.createDataFrame(pa.table([pa.array(np.arange(len(todo))), pa.array(rest[todo])], names=["at", "rest"]))
        counts = (_range_counts(rows, todo, low[todo], high[todo], edges)
                  .withColumn("_n", F.sum("n").over(upto)).withColumn("_s", F.sum("s").over(upto)).join(want, "at")
                  .where((F.col("_n") >= F.col("rest")) & (F.col("_n") - F.col("n") < F.col("rest")))
                  .select("at", "range", "n", (F.col("rest") - F.col("_n") + F.col("n")).alias("rest"), (F.col("_s") - F.col("s")).alias("s")))
        found = counts.toPandas().sort_values("at")
        at, j = found["at"].to_numpy(), found["range"].to_numpy()
        reps = todo[at]
        ends = np.concatenate((low[todo, None], edges, high[todo, None]), axis=1)
        rest[reps], below[reps] = found["rest"].to_numpy(), below[reps] + found["s"].to_numpy()
        low[reps], high[reps] = np.maximum(ends[at, j], low[reps]), np.minimum(ends[at, j + 1], high[reps])
        todo = reps[(found["n"].to_numpy() > few) & (high[reps] - low[reps] > 1)]
        wide = high[todo] - low[todo]
        edges = low[todo, None] + np.arange(1, CUTS + 1) * wide[:, None] // (CUTS + 1)
    return low, high, rest, below


def permutation_test(df: DataFrame, keys, group_a: str, group_b: str, B: int = 10000, seed: int = 42,
                     plus_one: bool = False) -> DataFrame:
    """H7 / H8: one-sided permutation test of mean(a) - mean(b) >= observed.

    Replicate r puts the n_a pooled rows with the smallest integers (then lanes) into
    group a. p = mean(perm >= obs) (H7) or (count + 1) / (B + 1) (H8, ``plus_one=True``).
    -> one row: n_a, n_b, observed_diff, p_value. What reaches the driver is one row of
    observed statistics and a range for each of the ``B`` replicates.
    """
    d = stored(lanes(df.filter(F.col("group").isin(group_a, group_b) & F.col("value").isNotNull()), seed, keys)
                    .select("group", F.col("value").cast("double").alias("value"), "_h1", "_h2"))
    obs = _observed(d, group_a, group_b)
    seen = obs.first()
    n_a, n = seen["n_a"], seen["n_a"] + seen["n_b"]
    if not n_a or n_a == n:  # no two groups to compare
        return obs.select("n_a", "n_b", "observed_diff", F.lit(None).cast("double").alias("p_value"))
    spread = dealt(d.select("_h1", "_h2", "value"))
    low, high, rest, below = _boundaries(spread, n_a, n, B)
    numbers = np.arange(B)

    def boundary(batches):
        held, size = [], 0  # a block of replicates has but a few rows

        def out():
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["rep", "key", "_h1", "_h2", "value"])
                held.clear()

        for batch in batches:
            h1, h2, v = _columns(batch)
            for part in blocks(numbers, len(v)):
                x = mixed(h1, h2, numbers[part, None])
                rep, at = np.nonzero((x >= low[part, None]) & (x < high[part, None]))
                if len(rep):
                    held.append((numbers[part][rep], x[rep, at], h1[at], h2[at], v[at]))
                    size += len(rep)
                    if size >= SENT:
                        yield from out()
                        size = 0
        yield from out()

    near = spread.mapInArrow(boundary, "rep long, key long, _h1 long, _h2 long, value double")
    run = d.sparkSession.createDataFrame(pa.table([pa.array(numbers), pa.array(rest), pa.array(below)], names=["rep", "rest", "sum_below"]))
    order = Window.partitionBy("rep").orderBy("key", "_h1", "_h2", "value")
    near = near.withColumn("_rn", F.row_number().over(order)).join(run, "rep").where(F.col("_rn") <= F.col("rest"))
    total = near.groupBy("rep", "sum_below").agg(F.sum("value").alias("_v"))
    s = attach(total.select((F.col("sum_below") + F.col("_v")).alias("_sa")), obs)
    diff = F.col("_sa") / F.col("n_a") - (F.col("_tot") - F.col("_sa")) / F.col("n_b")
    # a permutation that reproduces the observed split equals it up to summation order:
    # count it as ">=" with a relative tolerance (as scipy's permutation_test does)
    least = F.col("observed_diff") - F.abs(F.col("observed_diff")) * PERM_RTOL
    agg = s.agg(F.count_if(diff >= least).alias("_k"), F.count(F.lit(1)).alias("_b"))
    p = (F.col("_k") + 1) / (F.col("_b") + 1) if plus_one else F.col("_k") / F.col("_b")
    return attach(obs, agg).select("n_a", "n_b", "observed_diff", p.cast("double").alias("p_value"))


# --------------------------------------------------------------------------- assumptions


def assumption_report(df: DataFrame, group_a: str, group_b: str, alpha: float = 0.05) -> DataFrame:
    """H9: sample sizes, adequacy (>= 30 each), normality per group (Jarque-Bera from
    skewness and kurtosis, replacing Shapiro-Wilk; only if both groups have 8 rows),
    the spread statistic (Levene, median centred = Brown-Forsythe) and IQR outlier
    counts (> 10 % warns). One row."""
    d = stored(df.filter(F.col("group").isin(group_a, group_b) & F.col("value").isNotNull()))
    qs = grouped_quantiles(d, ["group"], "value", [0.5, 0.25, 0.75], ["med", "_q1", "_q3"])
    g = (d.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("skew"),
                                F.kurtosis("value").alias("kurt"))
          .join(qs, "group").withColumn("q", F.array("_q1", "_q3")))
    g = g.withColumn("jb", F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4.0)) \
         .withColumn("jb_p", F.exp(-F.col("jb") / 2.0))
    j = d.join(g.select("group", "med", "q"), "group")
    iqr = F.col("q")[1] - F.col("q")[0]
    out_flag = (F.col("value") < F.col("q")[0] - 1.5 * iqr) | (F.col("value") > F.col("q")[1] + 1.5 * iqr)
    z = j.withColumn("_z", F.abs(F.col("value") - F.col("med"))).withColumn("_o", out_flag)
    zg = z.groupBy("group").agg(F.avg("_z").alias("zbar"), F.count_if("_o").alias("outliers"))
    zz = z.join(zg, "group").withColumn("_dev2", (F.col("_z") - F.col("zbar")) ** 2)
    within = zz.agg(F.sum("_dev2").alias("_within"), F.avg("_z").alias("_zall"), F.count(F.lit(1)).alias("_N"))
    gg = g.join(zg, "group")

    def pick(name, col):
        return F.max(F.when(F.col("group") == name, F.col(col)))

    row = gg.agg(pick(group_a, "n").alias("n1"), pick(group_b, "n").alias("n2"),
                 pick(group_a, "jb_p").alias("normality_p1"), pick(group_b, "jb_p").alias("normality_p2"),
                 pick(group_a, "outliers").alias("outliers1"), pick(group_b, "outliers").alias("outliers2"),
                 pick(group_a, "zbar").alias("_z1"), pick(group_b, "zbar").alias("_z2"))
    row = attach(row, within)
    between = (F.col("n1") * (F.col("_z1") - F.col("_zall")) ** 2 + F.col("n2") * (F.col("_z2") - F.col("_zall")) ** 2)
    lev = F.when(F.col("_within") > 0, (F.col("_N") - 2) * between / F.col("_within"))
    row = row.withColumn("levene_W", lev)
    tested = (F.col("n1") >= 8) & (F.col("n2") >= 8)
    p1, p2 = F.when(tested, F.col("normality_p1")), F.when(tested, F.col("normality_p2"))
    return row.select("n1", "n2", ((F.col("n1") >= 30) & (F.col("n2") >= 30)).alias("adequate_n"),
                      p1.alias("normality_p1"), p2.alias("normality_p2"), ((p1 > alpha) & (p2 > alpha)).alias("normal"),
                      "levene_W", "outliers1", "outliers2",
                      ((F.col("outliers1") > F.col("n1") * 0.1) | (F.col("outliers2") > F.col("n2") * 0.1))
                      .alias("high_outlier_share"))


def verdict(ci: DataFrame, lo: str = "lo", hi: str = "hi", diff: str = "observed_diff") -> DataFrame:
    """H10: 'significant positive' / 'significant negative' / 'not significant' from a CI,
    plus the direction of the observed difference."""
    return ci.withColumn("verdict", F.when(F.col(lo) > 0, F.lit("significant positive"))
                                     .when(F.col(hi) < 0, F.lit("significant negative"))
                                     .otherwise(F.lit("not significant"))) \
             .withColumn("direction", F.when(F.col(diff) > 0, F.lit("higher")).otherwise(F.lit("lower")))


def top_vs_low_report(vendor_summary: DataFrame, B_each: int = 2000, B_diff: int = 2000) -> DataFrame:
    """Top-quartile vs bottom-quartile purchase-share vendors: assumptions, per-group
    bootstrap means, the bootstrap difference and its verdict (one row)."""
    g = stored(groups_purchase_share(vendor_summary, low_q=0.25, high_q=0.75))
    keys = ("VendorNumber", "VendorName")
    a = assumption_report(g, "top", "low")
    m = bootstrap_mean_ci(g, keys, B=B_each, seed=42, by=("group",))
    piv = m.agg(*[F.max(F.when(F.col("group") == k, F.col(c))).alias(f"{k}_{c}")
                  for k in ("top", "low") for c in ("mean", "lo", "hi")])
    d = verdict(bootstrap_diff_ci(g, keys, "top", "low", B=B_diff, seed=42))
    return attach(attach(a, piv), d.drop("n_a", "n_b"))
