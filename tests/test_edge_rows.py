"""Hand-written edge rows (FIXTURES.md section 4) and expression guards."""

import pytest
from pyspark.sql import functions as F

from vendorlens.functions.expr import canon, least_null, sqlite_real
from vendorlens.functions.ranking import avg_rank_pct, exact_quantiles, qcut
from vendorlens.operators import kpi as A
from vendorlens.operators import summary as T

SALES = "InventoryId string, Brand bigint, VendorNo bigint, SalesQuantity bigint, SalesDollars double, " \
        "SalesPrice double, ExciseTax double"
PURCH = "InventoryId string, VendorNumber bigint, VendorName string, Brand bigint, Description string, " \
        "PurchasePrice double, Quantity bigint, Dollars double, PONumber bigint"
INV = "VendorNumber bigint, PONumber bigint, Quantity bigint, Dollars double, Freight double"


def _frames(spark, sales, purch, inv):
    return (spark.createDataFrame(sales, SALES), spark.createDataFrame(purch, PURCH),
            spark.createDataFrame(inv, INV))


def test_unmatched_sale_dropped_and_fanout_kept(spark):
    s, p, i = _frames(spark,
                      [("A", 1, 10, 2, 20.0, 10.0, 0.0), ("A", 1, 10, 3, 30.0, 10.0, 0.0),
                       ("ZZ", 1, 10, 99, 990.0, 10.0, 0.0)],
                      [("A", 10, "V", 1, "d", 5.0, 1, 5.0, 1), ("A", 10, "V", 1, "d", 5.0, 1, 5.0, 2),
                       ("A", 10, "V", 1, "d", 5.0, 1, 5.0, 3)],
                      [(10, 1, 3, 15.0, 3.0)])
    for method in ("naive", "preaggregate"):
        r = T.vendor_sales_summary(s, p, i, method=method).collect()
        assert len(r) == 1
        assert r[0]["TotalSalesQuantity"] == 15          # (2 + 3) x 3 purchase lines
        assert r[0]["TotalSalesDollars"] == pytest.approx(150.0)
        assert r[0]["FreightCost"] == pytest.approx(3.0)  # one brand takes all vendor freight


def test_two_vendor_names_give_two_rows_and_four_final_brand_rows(spark):
    s, p, i = _frames(spark, [("A", 1, 10, 1, 10.0, 10.0, 0.0)],
                      [("A", 10, "V1", 1, "d", 5.0, 1, 5.0, 1), ("A", 10, "V2", 1, "d", 5.0, 1, 5.0, 2)],
                      [(10, 1, 2, 10.0, 0.0)])
    vss = T.vendor_sales_summary(s, p, i)
    assert vss.count() == 2
    opps = T.brand_pricing_opportunities(T.brand_pricing(vss))
    assert T.final_brand(vss, opps).count() == 4


def test_pricing_guards(spark):
    bp = spark.createDataFrame(
        [(1, "V", 1, 0, 100.0, 50.0, 0.0),      # qty 0 with sales: AvgSalesPrice NULL
         (1, "V", 2, 5, 100.0, -10.0, 0.0)],    # cost <= 0: RequiredSalesDollars 0
        "VendorNumber bigint, VendorName string, Brand bigint, TotalSalesQuantity bigint, "
        "TotalSalesDollars double, TotalPurchaseDollars double, FreightCost double")
    r = {x["Brand"]: x for x in T.brand_pricing_opportunities(bp, 0.35).collect()}
    assert r[1]["AvgSalesPrice"] is None and r[1]["NeededPriceDeltaPerUnit"] is None
    assert r[2]["RequiredSalesDollars"] == 0.0
    r1 = T.brand_pricing_opportunities(bp, 1.0).collect()
    assert {x["Brand"]: x["RequiredSalesDollars"] for x in r1}[1] is None


def test_sqlite_real_cast(spark):
    df = spark.createDataFrame([("Unknown",), ("750mL",), (None,), (" 1.5e2x",)], "v string")
    got = [r[0] for r in df.select(sqlite_real("v")).collect()]
    assert got == [0.0, 750.0, None, 150.0]


def test_null_vendor_name_text_rules(spark):
    s, p, i = _frames(spark, [("A", 1, 10, 1, 10.0, 10.0, 0.0)],
                      [("A", 10, None, 1, "d", 5.0, 1, 5.0, 1)], [(10, 1, 1, 5.0, 0.0)])
    pp = spark.createDataFrame([(10, 10, 1, 5.0, 6.5, "750")],
                               "VendorNumber bigint, VendorNo bigint, Brand bigint, PurchasePrice double, "
                               "Price double, Volume string")
    assert T.premerge_summary(s, p, i, pp).collect()[0]["VendorName"] == "None"
    assert T.vendor_sales_summary_replicated(s, p, i, pp).collect()[0]["VendorName"] == ""


def test_least_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(least_null("a", "b")).collect()] == [None, 1.0]


def test_average_tie_percent_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 0.0, 0.0, 0.0, 0.0, 3.0, 1.0, None])],
                               "k int, v double")
    got = {r["k"]: r["r"] for r in avg_rank_pct(df, "v", "r").collect()}
    # pandas: ranks of five zeros average 3, then 1.0 -> 6, 3.0 -> 7, over 7 values
    assert got[0] == pytest.approx(3 / 7) and got[6] == pytest.approx(6 / 7) and got[5] == pytest.approx(1.0)
    assert got[7] is None


def test_exact_quantiles_match_linear_interpolation(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, 4.0, 9.0]], "x double")
    q = exact_quantiles(df, "x", [0.25, 0.75, 0.5]).collect()[0]
    assert (q["q0"], q["q1"], q["q2"]) == (1.75, 5.25, 3.0)


def test_qcut_repeated_edges_raise(spark):
    df = spark.createDataFrame([(5.0,)] * 6, "x double")
    with pytest.raises(Exception, match="bin edges must be unique"):
        qcut(df, "x", "b").collect()


def test_all_null_group_sums_to_zero(spark):
    fb = spark.createDataFrame(
        [(1, "V", 1, 10.0, 5, 5.0, 5, 1.0, 4.0, 40.0, None, None, None, None)],
        "VendorNumber bigint, VendorName string, Brand bigint, TotalSalesDollars double, TotalSalesQuantity bigint, "
        "TotalPurchaseDollars double, TotalPurchaseQuantity bigint, FreightCost double, GrossProfit double, "
        "CurrentMargin double, TargetMargin double, RequiredSalesDollars double, UpsideDollars double, "
        "NeededPriceDeltaPerUnit double")
    vs = spark.createDataFrame([(1, "V", 10.0, 5, 5.0, 5, 1.0, 4.0, 40.0, 1)],
                               "VendorNumber bigint, VendorName string, TotalSalesDol_in_summary double, "
                               "TotalSalesQty bigint, TotalPurchaseDol double, TotalPurchaseQty bigint, "
                               "FreightCost double, GrossProfit double, ProfitMargin double, BrandCount bigint")
    r = A.action_scorecard(fb, vs).collect()[0]
    assert r["UpsideTotal"] == 0.0 and r["BrandsNeedingAction"] == 0


def test_canon_is_deterministic_and_tie_safe(spark):
    import duckdb
    from vendorlens.functions.expr import canon_sql
    vals = [1004511.26050, 0.1 + 0.2, -123.456789012345, 7.0, 1e-12, 98765432109.87]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(canon("x")).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT {canon_sql('x')} FROM (SELECT {v!r}::DOUBLE AS x)").fetchone()[0] for v in vals]
    assert got == exp
    assert got[0] == pytest.approx(1004511.26050, rel=1e-9)


def test_dense_codes_follow_binary_string_order(spark):
    from vendorlens.functions.ranking import dense_codes
    names = ["b", "a", None, "ab", "a", "Zz", "é", "abcdefgh", "abcdefg"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["c"] for r in dense_codes(df, "n", "c").collect()}
    distinct = sorted({n for n in names if n is not None}, key=lambda x: x.encode("utf-8"))
    assert {k: v for k, v in got.items() if k is not None} == {n: i for i, n in enumerate(distinct)}
    assert got[None] == len(distinct)


def test_scorecard_join_on_vendor_number_keeps_other_spellings(spark):
    vs = spark.createDataFrame([(1, "V", 10.0, 5, 5.0, 5, 1.0, 4.0, 40.0, 2)],
                               "VendorNumber bigint, VendorName string, TotalSalesDol_in_summary double, "
                               "TotalSalesQty bigint, TotalPurchaseDol double, TotalPurchaseQty bigint, "
                               "FreightCost double, GrossProfit double, ProfitMargin double, BrandCount bigint")
    opps = spark.createDataFrame([(1, "V", 1, 3.0), (1, "V ", 2, 4.0)],
                                 "VendorNumber bigint, VendorName string, Brand bigint, UpsideDollars double")
    both = A.scorecard_v1(vs, opps).first()
    one = A.scorecard_v1(vs, opps, join_on=("VendorNumber",)).first()
    assert (both["UpsideTotal"], both["BrandsNeedingAction"]) == (3.0, 1)
    assert (one["UpsideTotal"], one["BrandsNeedingAction"]) == (7.0, 2)
