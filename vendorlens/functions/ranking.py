"""Global order statistics without a single-partition window.

An unpartitioned ``Window.orderBy`` pulls every row into one task. Here rows are first
partitioned by range over their whole order key, tie-breakers included, so a value that
many rows share spreads over partitions too. The partition number is fixed in a
written table; running sums are taken inside each partition, and offsets (a row per
group and partition) are added. Every result is exact; the sampled range bounds only
balance the work. Average-tie ranks are taken in place with a carry of the ties at the ranges'
edges; quantiles are found by counting (``selection``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorlens.functions.frames import attach
from vendorlens.functions.selection import Selection
from vendorlens.session import stored


def range_partitions(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(df: DataFrame, order) -> DataFrame:
    """``df`` with ``_bkt``, the number of its range in the total order ``order`` (written once)."""
    return stored(df.repartitionByRange(range_partitions(df), *order).withColumn("_bkt", F.spark_partition_id()))


def global_cumsum(df: DataFrame, value: str, weight, out, ascending: bool = True, tiebreak=(), by=()) -> DataFrame:
    """Running sum of ``weight``, the row's own included, over the order (``value``, then
    ``tiebreak``) within each ``by`` group (globally when ``by`` is empty).

    ``weight`` / ``out`` may be lists to carry several running sums in the same pass.
    Returns ``df`` with the ``out`` column(s).
    """
    weights = [weight] if isinstance(weight, str) else list(weight)
    outs = [out] if isinstance(out, str) else list(out)
    by, k = list(by), range(len(weights))
    order = [F.col(value).asc() if ascending else F.col(value).desc(), *[F.col(t).asc() for t in tiebreak]]
    x = in_ranges(df, [F.col(c).asc() for c in by] + order)
    w = Window.partitionBy(*by, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = x.withColumns({f"_run{i}": F.sum(weights[i]).over(w) for i in k})
    tot = x.groupBy(*by, "_bkt").agg(*[F.sum(weights[i]).alias(f"_bt{i}") for i in k])
    # a row per group and range: this window is bounded
    before = Window.partitionBy(*by).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*by, "_bkt", *[F.coalesce(F.sum(f"_bt{i}").over(before), F.lit(0)).alias(f"_off{i}") for i in k])
    run = run.join(off, by + ["_bkt"]).withColumns({outs[i]: F.col(f"_off{i}") + F.coalesce(F.col(f"_run{i}"), F.lit(0)) for i in k})
    return run.drop("_bkt", *[f"_run{i}" for i in k], *[f"_off{i}" for i in k])


def dense_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based dense rank of ``col`` in ascending string order, NULL last (``dense_rank() - 1``).

    Distinct values are numbered by a running count over ranges of the whole strings.
    """
    vals = df.select(col).distinct().filter(F.col(col).isNotNull()).withColumn("_one", F.lit(1))
    cum = global_cumsum(vals, col, "_one", "_c")
    codes = cum.select(F.col(col).alias("_cv"), (F.col("_c") - 1).alias(out))
    n = cum.agg(F.count(F.lit(1)).alias("_nn"))
    j = df.join(codes, F.col(col) == F.col("_cv"), "left").drop("_cv")
    return attach(j, n).withColumn(out, F.coalesce(F.col(out), F.col("_nn")).cast("int")).drop("_nn")


def literal(values):
    """An array literal of doubles in one expression, whatever its length."""
    text = ",".join("NaN" if x != x else repr(float(x)).replace("inf", "Infinity") for x in values)
    return F.split(F.lit(text), ",").cast("array<double>") if len(values) else F.array().cast("array<double>")


def below(bounds: list[float], x, inclusive: bool):
    """How many of the ascending ``bounds`` are below ``x`` (or equal to it), by binary search."""
    steps = [1 << j for j in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0)
    at = literal(bounds + [float("inf")] * (2 * steps[0] - 1 - len(bounds)))
    under = (lambda b: b <= x) if inclusive else (lambda b: b < x)
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda i, s: F.when(under(F.element_at(at, i + s)), i + s).otherwise(i))
    return F.least(found, F.lit(len(bounds)))


def with_avg_rank_pct(df: DataFrame, cols, outs) -> DataFrame:
    """Add pandas ``rank(pct=True, method='average')`` of each column in ``cols`` as ``outs``.

    Ranked in place: per column the rows are dealt to ranges (bounds of all columns from one
    aggregate; a value that fills several ranges is spread over them by the row's content), and two windows
    inside a range give the rank and the number of equals there. Each range then tells its
    count, its first and its last value and how often they occur, a row per range; from these come the ranges'
    offsets and the ranks of tie groups that reach over an edge. No join and no second frame: a row keeps its
    place. The bounds only balance the work. ``df`` is read twice and should be a table. NULL values get NULL ranks.
    """
    cols, outs = list(cols), list(outs)
    parts = range_partitions(df)
    xs = [F.col(c).cast("double") for c in cols]
    probs = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(x, probs, 10 * parts).alias(f"b{i}") for i, x in enumerate(xs)]).first() if probs else [None] * len(cols)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranked = df
    for i, x in enumerate(xs):
        bounds = list(found[i] or [])
        low, high = below(bounds, x, False), below(bounds, x, True)
        spread = F.when(x.isNull(), F.pmod(content, F.lit(parts))).otherwise(low + F.pmod(content, high - low + 1)).cast("int")
        ranked = ranked.withColumn(f"_b{i}", spread)
        inside = Window.partitionBy(f"_b{i}").orderBy(x.asc_nulls_last())
        ranked = ranked.withColumn(f"_r{i}", F.rank().over(inside)).withColumn(
            f"_k{i}", F.count(x).over(inside.rangeBetween(Window.currentRow, Window.currentRow)))
    ranked = stored(ranked, "ranked")
    each = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_b{i}").alias("b"), x.alias("x"), F.col(f"_k{i}").alias("k"))
                     for i, x in enumerate(xs)])
    edges = (ranked.select(F.inline(each)).where("x IS NOT NULL").groupBy("c", "b")
             .agg(F.count("x"), F.min("x"), F.max("x"), F.min_by("k", "x"), F.max_by("k", "x")).collect())
    out = ranked
    for i, x in enumerate(xs):
        n, offset, first, last = 0, [0.0] * parts, [0.0] * parts, [0.0] * parts
        ties: dict = {}  # value at an edge: the rows below it, its own rows
        mine = sorted(e[1:] for e in edges if e[0] == i)
        same = lambda v: "NaN" if v != v else v
        for b, count, lo, hi, n_lo, n_hi in mine:
            offset[b] = n
            ends = [(lo, n, n_lo)] if same(lo) == same(hi) else [(lo, n, n_lo), (hi, n + count - n_hi, n_hi)]
            for v, start, k in ends:
                seen = ties.setdefault(same(v), [start, 0])
                seen[1] += k
            n += count
        for b, _, lo, hi, *_ in mine:
            first[b], last[b] = (ties[same(v)][0] + (ties[same(v)][1] + 1) / 2 for v in (lo, hi))
        at = F.col(f"_b{i}") + 1
        lows, highs = [0.0] * parts, [0.0] * parts
        for b, _, lo, hi, *_ in mine:
            lows[b], highs[b] = lo, hi
        rank = (F.when(x == F.element_at(literal(lows), at), F.element_at(literal(first), at))
                .when(x == F.element_at(literal(highs), at), F.element_at(literal(last), at))
                .otherwise(F.element_at(literal(offset), at) + F.col(f"_r{i}") + (F.col(f"_k{i}") - 1) / 2))
        out = out.withColumn(outs[i], F.when(x.isNotNull(), rank / F.lit(float(n or 1))))
    return out.drop(*[f"_{t}{i}" for t in "brk" for i in range(len(cols))])


def avg_rank_pct(df: DataFrame, value: str, out: str) -> DataFrame:
    """pandas ``rank(pct=True, method='average')`` of one column (see ``with_avg_rank_pct``)."""
    return with_avg_rank_pct(df, [value], [out])


def exact_quantiles(df: DataFrame, value: str, probs, names=None, reread: bool = False) -> DataFrame:
    """One row of exact, linearly interpolated quantiles of ``value`` (missing values ignored).

    Position pos = (n - 1) * p; result = lo + (hi - lo) * (pos - floor(pos)) with lo/hi
    the order statistics at floor/ceil(pos) (exactly ``lo`` when they coincide). The order statistics
    are found by counting (``Selection``), without a sort. ``reread``: ``df`` is a table already.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    _, found = Selection(df, [value], reread=reread).quantiles(probs).get(0, (0, [None] * len(probs)))
    return df.sparkSession.createDataFrame(pa.table([pa.array([q], pa.float64()) for q in found], names=list(names)))


def grouped_quantiles(df: DataFrame, by, value: str, probs, names=None, reread: bool = False) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per ``by`` group -> (by..., names...).

    Same rule as ``exact_quantiles``. Up to ``selection.MOST_GROUPS`` groups are counted all at once; with more,
    which are small on average, running counts over each group's distinct values in range partitions
    give the same values. Groups without a value have no row.
    """
    by = list(by)
    names = names or [f"q{i}" for i in range(len(probs))]
    chosen = Selection(df, [value], by, reread=reread)
    if chosen.countable:
        return chosen.frame({t: q for t, (_, q) in chosen.quantiles(probs).items()}, [(n, pa.float64()) for n in names]).drop("column")
    back = chosen.rows.select(*[F.col(f"_by{i}").alias(b) for i, b in enumerate(by)], F.col("_c0").alias(value))
    return quantiles_by_ranges(back.where(~F.isnan(value)), by, value, probs, names)


def quantiles_by_ranges(df: DataFrame, by: list[str], value: str, probs, names) -> DataFrame:
    """``grouped_quantiles`` for any number of groups: a large group is spread over ranges."""
    vals = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_k"))
    cum = global_cumsum(vals, value, "_k", "_c", by=by)
    n = cum.groupBy(*by).agg(F.max("_c").alias("_n"))
    x = cum.join(n, by)
    v = F.col(value).cast("double")
    aggs, outs = [], []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        start, end = F.col("_c") - F.col("_k"), F.col("_c")
        aggs += [F.max(F.when((start <= lo_i) & (lo_i < end), v)).alias(f"_lo{i}"),
                 F.max(F.when((start <= hi_i) & (hi_i < end), v)).alias(f"_hi{i}"),
                 F.max(pos).alias(f"_pos{i}")]
        d = F.col(f"_pos{i}") - F.floor(F.col(f"_pos{i}"))
        outs.append(F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}"))
                     .otherwise(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * d).alias(names[i]))
    return x.groupBy(*by).agg(*aggs).select(*by, *outs)


def qcut(df: DataFrame, value: str, out: str, labels=("Small", "Medium", "Large")) -> DataFrame:
    """pandas ``qcut``: equal-frequency bins with linearly interpolated edges.

    Bins are right-closed with the lowest edge included. Repeated edges raise, as in
    pandas. Edges come from one exact quantile aggregate broadcast to every task.
    """
    df = stored(df)
    q = len(labels)
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, value, probs, reread=True).select(F.array(*[f"q{i}" for i in range(q + 1)]).alias("_edges"))
    x = attach(df, edges)
    e = F.col("_edges")
    dup = F.exists(F.sequence(F.lit(1), F.lit(q)), lambda i: F.element_at(e, i) >= F.element_at(e, i + 1))
    v = F.col(value)
    lab = F.when(v.isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(labels):
        lab = lab.when(v <= F.element_at(e, i + 2), F.lit(name))
    lab = F.when(dup, F.raise_error(F.lit("qcut: bin edges must be unique"))).otherwise(lab)
    return x.withColumn(out, lab.cast("string")).drop("_edges")
