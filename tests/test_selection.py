"""Order statistics, ranks, co-moments and histograms by counting, against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest

from vendorlens.functions import ranking, selection
from vendorlens.operators import distribution as D
from vendorlens.operators import inference as H


def sample(n=4000, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1e6, n)
    a[rng.random(n) < 0.35] = 7.25  # one value holds a third of the rows
    b = np.round(rng.exponential(3, n), 1) * rng.choice([-1, 1], n)
    b[:6] = [np.inf, -np.inf, -0.0, 0.0, 5e-324, -1.7e308]
    c = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 4, n).astype(float))
    return pd.DataFrame({"k": np.arange(n), "g": rng.choice(["x", "y", None], n), "a": a, "b": b, "c": c})


@pytest.fixture(scope="module")
def table(spark):
    p = sample()
    rows = [tuple(None if x is None or (isinstance(x, float) and math.isnan(x)) else x for x in r) for r in p.itertuples(index=False)]
    return p, spark.createDataFrame(rows, "k long, g string, a double, b double, c double").repartition(5)


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_quantiles_of_columns_and_groups(table, monkeypatch, few):
    """``few`` = 0: the ranges are narrowed 16 bits at a time to the end."""
    monkeypatch.setattr(selection, "FEW", few)
    p, df = table
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = selection.Selection(df, ["a", "b", "c"]).quantiles(probs)
    for i, c in enumerate("abc"):
        x = p[c].dropna().to_numpy()
        if c == "b":  # interpolation beside an infinity is undefined in numpy
            x = np.sort(x)
            want = [x[0], None, np.median(x), None, x[-1]]
        else:
            want = np.quantile(x, probs)
        n, got = found[i]
        assert n == len(x) and all(w is None or g == pytest.approx(w, rel=1e-12) for g, w in zip(got, want))
    rows = ranking.grouped_quantiles(df, ["g"], "a", [0.25, 0.5], ["lo", "mid"]).collect()
    assert len(rows) == 3
    for r in rows:
        x = p[p.g.isna() if r["g"] is None else p.g == r["g"]].a
        assert (r["lo"], r["mid"]) == pytest.approx(tuple(np.quantile(x, [0.25, 0.5])), rel=1e-12)


def test_many_groups_take_the_other_way(table, monkeypatch):
    p, df = table
    keys = df.selectExpr("k % 50 AS m", "a", "c")
    one = sorted(map(tuple, ranking.grouped_quantiles(keys, ["m"], "c", [0.3, 0.5]).collect()))
    monkeypatch.setattr(selection, "MOST_GROUPS", 10)
    assert sorted(map(tuple, ranking.grouped_quantiles(keys, ["m"], "c", [0.3, 0.5]).collect())) == one and len(one) == 50


def test_empty_and_missing_columns(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, None)], "x double, y double")
    assert selection.Selection(df, ["x", "y"]).quantiles([0.5]) == {}
    assert ranking.exact_quantiles(df, "x", [0.5]).collect()[0][0] is None
    assert ranking.exact_quantiles(df.limit(0), "y", [0.1, 0.5], ["a", "b"]).collect()[0].asDict() == {"a": None, "b": None}


def test_values_between_fences(table):
    p, df = table
    chosen = selection.Selection(df, ["a", "c"], ["g"])
    fences = {t: (-1e5, 7.25) if t % 2 == 0 else (1.0, 1.0) for t in range(6)}
    got = chosen.frame(chosen.between(fences), [("n", selection.pa.int64()), ("lo", selection.pa.float64()), ("hi", selection.pa.float64())])
    rows = got.collect()
    assert len(rows) == 6
    for r in rows:
        lo, hi = (-1e5, 7.25) if r["column"] == "a" else (1.0, 1.0)
        x = p[p.g.isna() if r["g"] is None else p.g == r["g"]][r["column"]]
        x = x[(x >= lo) & (x <= hi)]
        assert (r["n"], r["lo"], r["hi"]) == (len(x), x.min(), x.max())


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_average_ranks_in_place(spark, table, monkeypatch, parts):
    """Ties that fill several ranges, ranges without rows, nulls."""
    monkeypatch.setattr(ranking, "range_partitions", lambda df: parts)
    p, df = table
    got = ranking.with_avg_rank_pct(df, ["a", "b", "c"], ["ra", "rb", "rc"]).toPandas().sort_values("k")
    for c in "abc":
        want = p[c].rank(pct=True, method="average").to_numpy()
        np.testing.assert_allclose(got["r" + c].to_numpy(dtype=float), want, rtol=1e-12)


def test_comoments_and_spearman(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e9, 1, (3000, 4))
    x[:, 3] = 2.5
    x[:, 1] += x[:, 0] - 1e9
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd"))).repartition(7)
    got = {(r["i"], r["j"]): r for r in D.comoments(df, list("abcd")).collect()}
    want = np.cov(x.T) * (len(x) - 1)
    assert len(got) == 10 and all(r["n"] == 3000 for r in got.values())
    assert all(r["c"] == pytest.approx(want[i, j], rel=1e-6, abs=1e-3) for (i, j), r in got.items())
    rho = {(r["col_a"], r["col_b"]): r["rho"] for r in D.spearman(df, list("abcd")).collect()}
    assert rho["b", "a"] == pytest.approx(pd.DataFrame(x).corr("spearman")[0][1], rel=1e-9)
    assert rho["d", "a"] is None and rho["d", "d"] is None and rho["a", "a"] == pytest.approx(1.0)


def test_histograms_with_shared_edges(table):
    p, df = table
    rows = D.histogram(df, ["a", "c"], 9, group="g", density=True).collect()
    p = p[p.g.notna()]
    for c in ("a", "c"):
        edges = np.linspace(p[c].min(), p[c].max(), 10)
        for g in "xy":
            mine = sorted((r for r in rows if r["column"] == c and r["g"] == g), key=lambda r: r["bin"])
            count, _ = np.histogram(p[p.g == g][c].dropna(), edges)
            assert [r["count"] for r in mine] == count.tolist()
            assert sum(r["density"] * (r["hi"] - r["lo"]) for r in mine) == pytest.approx(1.0)
    assert len(rows) == 36


def test_boundary_outside_the_window_is_cut_again(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n, n_a, B = 30_000, 9_000, 40
    rows = [(int(i), "a" if i < n_a else "b", float(v)) for i, v in enumerate(rng.normal(0, 1, n))]
    df = spark.createDataFrame(rows, "k long, group string, value double").repartition(6)
    wide = H.permutation_test(df, ("k",), "a", "b", B=B, seed=1).collect()
    monkeypatch.setattr(H, "REACH", 0.01)  # nearly every cut escapes
    spread = H.lanes(df, 1, ("k",)).select("_h1", "_h2", "value")
    low, high, rest, _ = H._boundaries(spread, n_a, n, B)
    h = spread.toPandas()
    for r in range(B):
        x = H.mixed(h["_h1"].to_numpy(), h["_h2"].to_numpy(), r)
        assert ((x >= low[r]) & (x < high[r])).sum() <= math.isqrt(n) + 64
        assert (x < low[r]).sum() + rest[r] == n_a and (x < high[r]).sum() >= n_a
    assert H.permutation_test(df, ("k",), "a", "b", B=B, seed=1).collect() == wide
