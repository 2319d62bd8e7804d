"""Golden invariants and metamorphic checks on the driver tables."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vendorlens.operators import inference as H
from vendorlens.operators import kpi as A
from vendorlens.operators import summary as T
from vendorlens.plans import tables as tb


def test_preaggregated_fanout_equals_naive_join(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    k = ["VendorNumber", "VendorName", "Brand"]
    a = T.fanout_sales(b.sales, b.purchases, method="naive").alias("a")
    p = T.fanout_sales(b.sales, b.purchases, method="preaggregate").alias("p")
    j = a.join(p, k, "full")
    bad = j.filter(F.col("a.TotalSalesQuantity").isNull() | F.col("p.TotalSalesQuantity").isNull()
                   | (F.col("a.TotalSalesQuantity") != F.col("p.TotalSalesQuantity"))
                   | (F.abs(F.col("a.TotalSalesDollars") - F.col("p.TotalSalesDollars"))
                      > 1e-9 * F.abs(F.col("a.TotalSalesDollars")))).count()
    assert bad == 0 and a.count() == p.count()


def test_gross_profit_and_margin_identities(spark, sf_dir):
    v = tb.vsv(spark, sf_dir)
    r = v.agg(F.max(F.abs(F.col("GrossProfit") - (F.col("TotalSalesDol_in_summary") - F.col("TotalPurchaseDol")
                                                 - F.col("FreightCost")))).alias("gp"),
              F.max(F.when(F.col("TotalSalesDol_in_summary") > 0,
                           F.abs(F.col("ProfitMargin") - 100 * F.col("GrossProfit")
                                 / F.col("TotalSalesDol_in_summary")))).alias("m")).first()
    assert r["gp"] < 1e-3 and r["m"] < 1e-9


def test_allocated_freight_never_exceeds_vendor_freight(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    alloc = tb.vss(spark, sf_dir).groupBy("VendorNumber").agg(F.sum("FreightCost").alias("a"))
    fr = T.invoice_by_vendor(b.vendor_invoice).select("VendorNumber", "Freight")
    over = alloc.join(fr, "VendorNumber").filter(F.col("a") > F.col("Freight") * (1 + 1e-9) + 1e-9).count()
    assert over == 0


def test_final_all_is_vendor_plus_brand_rows(spark, sf_dir):
    assert tb.final_all(spark, sf_dir).count() == tb.final_vendor(spark, sf_dir).count() + \
        tb.final_brand(spark, sf_dir).count()


def test_action_score_range_and_pareto_end(spark, sf_dir):
    s = A.action_scorecard(tb.final_brand(spark, sf_dir), tb.vsv(spark, sf_dir))
    r = s.agg(F.min("ActionScore").alias("lo"), F.max("ActionScore").alias("hi")).first()
    assert 0 < r["lo"] and r["hi"] <= 1.0 + 1e-12
    p = A.pareto(tb.final_vendor(spark, sf_dir), "VendorName", "TotalPurchaseDollars", top=None)
    assert p.agg(F.max("cum_pct")).first()[0] == pytest.approx(1.0)
    assert p.agg(F.max("rank")).first()[0] == p.count()


def test_resampling_independent_of_partitioning(spark, sf_dir):
    g = H.groups_purchase_share(tb.vsv(spark, sf_dir))
    keys = ("VendorNumber", "VendorName")
    a = H.bootstrap_diff_ci(g, keys, "top", "rest", B=200, seed=3).first()
    b = H.bootstrap_diff_ci(g.repartition(7), keys, "top", "rest", B=200, seed=3).first()
    assert a["lo"] == pytest.approx(b["lo"], rel=1e-12) and a["hi"] == pytest.approx(b["hi"], rel=1e-12)
    p1 = H.permutation_test(g, keys, "top", "rest", B=300, seed=5).first()["p_value"]
    p2 = H.permutation_test(g.repartition(3), keys, "top", "rest", B=300, seed=5).first()["p_value"]
    assert p1 == p2


def test_permutations_against_sorting_all_rows(spark):
    import numpy as np
    rows = [(i, "a" if i % 3 == 0 else "b", float((i * 7919) % 101)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, group string, value double").repartition(6)
    got = H.permutation_test(df, ("k",), "a", "b", B=40, seed=9).first()
    lanes = H.lanes(df, 9, ("k",)).select("value", "group", "_h1", "_h2").toPandas()
    h1, h2, v = lanes["_h1"].to_numpy(), lanes["_h2"].to_numpy(), lanes["value"].to_numpy()
    n_a = int((lanes["group"] == "a").sum())
    seen = v[lanes["group"] == "a"].mean() - v[lanes["group"] == "b"].mean()
    over = 0
    for r in range(40):
        first = np.lexsort((v, h2, h1, H.mixed(h1, h2, r)))[:n_a]
        rest = v.sum() - v[first].sum()
        over += v[first].mean() - rest / (len(v) - n_a) >= seen - abs(seen) * 1e-12
    assert got["n_a"] == n_a and got["p_value"] == over / 40


def test_range_counts_against_all_comparisons(spark, monkeypatch):
    """Rows and sums per range, and only rows near the cut are placed edge by edge."""
    import numpy as np

    from vendorlens.operators import inference as inf
    rng = np.random.default_rng(2)
    n, reps = 4000, np.arange(12)
    h1, h2 = rng.integers(0, 1 << 30, (2, n))
    v = rng.normal(5, 2, n)
    placed = []
    reached = inf.reached
    monkeypatch.setattr(inf, "reached", lambda x, steps: placed.append(x.size) or reached(x, steps))
    x = inf.mixed(h1, h2, reps[:, None])
    edges = np.broadcast_to(inf._cut_edges(1500, n), (12, inf.CUTS))
    inner = edges[:, 3:4] + np.arange(1, inf.CUTS + 1) * (edges[:, 9:10] - edges[:, 3:4]) // (inf.CUTS + 1)
    batch = pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(v)], names=["_h1", "_h2", "value"])

    class Rows:  # runs the function of a task here
        def mapInArrow(self, run, schema):
            (out,) = run([batch])
            return spark.createDataFrame(out.to_pandas(), schema)

    for low, high, e in ((np.zeros(12, np.int64), np.full(12, inf.M31), edges), (edges[:, 3], edges[:, 9], inner)):
        got = {(r["at"], r["range"]): (r["n"], r["s"]) for r in inf._range_counts(Rows(), reps, low, high, e).collect()}
        for i in reps.tolist():
            own = (x[i] >= low[i]) & (x[i] < high[i])
            place = np.searchsorted(e[i], x[i], "right")
            for k in range(inf.CUTS + 1):
                mine = own & (place == k)
                assert got.get((i, k), (0, 0.0))[0] == mine.sum() and np.isclose(got.get((i, k), (0, 0.0))[1], v[mine].sum(), rtol=1e-12)
    assert sum(placed) < 2 * x.size / 5
