"""KPIs, rankings, Pareto, concentration and the action scorecard.

Global orderings (Pareto cumulative shares, percent ranks) go through
``vendorlens.functions.ranking`` so no single task sees all rows; global scalars
(totals, maxima, medians) are one-row aggregates broadcast back. Top-k reports are
``orderBy(..).limit(k)`` with a key tie-breaker, which Spark plans as a per-partition
top-k plus a final merge (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.functions.frames import attach

from vendorlens.functions.expr import fmt_amount, safe_div
from vendorlens.session import stored
from vendorlens.functions.ranking import (dense_codes, exact_quantiles, global_cumsum, grouped_quantiles, qcut,
                                          with_avg_rank_pct)

def S():
    return F.col("TotalSalesDollars")


def P():
    return F.col("TotalPurchaseDollars")


def FR():
    return F.col("FreightCost")


def SQ():
    return F.col("TotalSalesQuantity")


def PQ():
    return F.col("TotalPurchaseQuantity")


def UP():
    return F.col("UpsideDollars")


def snapshot(vendor: DataFrame) -> DataFrame:
    """A1: distinct vendors, total sales, units and mean margin of the vendor frame."""
    return vendor.agg(F.countDistinct("VendorNumber").alias("vendors_total"),
                      F.sum(S()).alias("total_sales_dollars"), F.sum(SQ()).alias("total_units_sold"),
                      F.avg("CurrentMargin").alias("avg_margin"))


def weighted_margin(vendor: DataFrame) -> DataFrame:
    """A2: sum of gross profit over sum of sales, in percent, and rows used."""
    v = vendor.filter(S() > 0)
    return v.agg((F.sum("GrossProfit") / F.sum(S()) * 100).alias("weighted_margin"),
                 F.count(F.lit(1)).alias("rows_used"))


def totals_reconciliation(vendor: DataFrame) -> DataFrame:
    """A3: long (metric, value): 4 totals, recomputed GP, overall margin, GP < 0 and sales <= 0 rows."""
    a = vendor.agg(F.sum(S()).alias("s"), F.sum(P()).alias("p"), F.sum(FR()).alias("f"), F.sum("GrossProfit").alias("g"),
                   F.count_if(F.col("GrossProfit") < 0).alias("neg"), F.count_if(S() <= 0).alias("nonpos"))
    items = [("TotalSalesDollars", F.col("s")), ("TotalPurchaseDollars", F.col("p")), ("FreightCost", F.col("f")),
             ("GrossProfit", F.col("g")), ("calc_gp", F.col("s") - F.col("p") - F.col("f")),
             ("overall_margin_pct", safe_div(F.col("g"), F.col("s")) * 100),
             ("rows_gp_negative", F.col("neg").cast("double")), ("rows_sales_nonpositive", F.col("nonpos").cast("double"))]
    return a.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
                                       for k, v in items])))


def top_brands_by_upside(final_brand: DataFrame, n: int = 15) -> DataFrame:
    """A4: brands with upside, sales and quantity, highest upside first, with a 'vendor • brand' label."""
    f = final_brand.filter((UP() > 0) & (S() > 0) & (SQ() > 0))
    return (f.orderBy(UP().desc(), "VendorNumber", "Brand", "VendorName").limit(n)
             .select("VendorNumber", "VendorName", "Brand", "CurrentMargin", "UpsideDollars",
                     "NeededPriceDeltaPerUnit", "TotalSalesDollars", "TotalSalesQuantity",
                     F.concat(F.col("VendorName"), F.lit(" • "), F.col("Brand").cast("string")).alias("label")))


def vendor_upside(final_brand: DataFrame, n: int = 15) -> DataFrame:
    """A5: upside summed per (VendorNumber, VendorName) over qualifying brands, top n."""
    f = final_brand.filter((UP() > 0) & (S() > 0) & (SQ() > 0))
    return (f.groupBy("VendorNumber", "VendorName").agg(F.sum(UP()).alias("UpsideDollars"))
             .orderBy(F.col("UpsideDollars").desc(), "VendorNumber", "VendorName").limit(n))


def pricing_fix_points(final_brand: DataFrame) -> DataFrame:
    """Scatter frame of brands needing a price fix."""
    return (final_brand.filter((SQ() > 0) & (UP() > 0))
            .select("VendorNumber", "VendorName", "Brand", "CurrentMargin", "NeededPriceDeltaPerUnit",
                    "UpsideDollars"))


def _coalesced_brand(final_brand: DataFrame) -> DataFrame:
    return final_brand.select(
        "VendorName", "Brand", F.coalesce(UP(), F.lit(0.0)).alias("UpsideDollars"),
        F.coalesce(S(), F.lit(0.0)).alias("TotalSalesDollars"),
        F.coalesce("CurrentMargin", F.lit(0.0)).alias("CurrentMargin"),
        F.coalesce("NeededPriceDeltaPerUnit", F.lit(0.0)).alias("NeededPriceDeltaPerUnit"))


def top_brands_in_top_vendors(final_brand: DataFrame, vendors: int = 10, brands: int = 5) -> DataFrame:
    """The ``brands`` highest-upside brands inside each of the ``vendors`` vendor names
    with most summed upside. Semi join to the top vendors, then a per-vendor top-k window
    (partitioned by vendor name, so no task sees more than one vendor's brands)."""
    from pyspark.sql import Window
    b = _coalesced_brand(final_brand)
    top = (b.groupBy("VendorName").agg(F.sum(UP()).alias("_vu"))
            .orderBy(F.col("_vu").desc(), "VendorName").limit(vendors).select("VendorName"))
    t = b.join(F.broadcast(top), "VendorName", "left_semi")
    w = Window.partitionBy("VendorName").orderBy(UP().desc(), F.col("Brand").asc())
    return t.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= brands).drop("_rn")


def brand_bubbles(final_brand: DataFrame) -> DataFrame:
    """Brand bubble frame: size = sqrt(max(upside, 0) + 1), vendor code = index of the
    vendor name in name order (the reference numbers by first appearance, which depends on
    row order; codes are labels only)."""
    b = _coalesced_brand(final_brand)
    return dense_codes(b, "VendorName", "vendor_code").withColumn("size", F.sqrt(F.greatest(UP(), F.lit(0.0)) + 1))


def vendor_bubbles(final_vendor: DataFrame, opps: DataFrame, eps: float = 1e-9) -> DataFrame:
    """final_vendor left-joined to brand opportunities on VendorNumber, upside summed
    per vendor, sales > 0, size = 300 * upside / (max + eps) + 30."""
    o = opps.groupBy("VendorNumber").agg(F.sum(UP()).alias("_u"))
    v = (final_vendor.join(o, "VendorNumber", "left")
         .groupBy("VendorNumber", "VendorName", "TotalSalesDollars", "CurrentMargin")
         .agg(F.coalesce(F.sum("_u"), F.lit(0.0)).alias("UpsideDollars"))
         .filter(S() > 0))
    mx = v.agg(F.max(UP()).alias("_mx"))
    return (attach(v, mx)
             .withColumn("size", F.lit(300.0) * (UP() / (F.col("_mx") + eps)) + 30).drop("_mx"))


def top_vendors_by_sales(final_vendor: DataFrame, n: int = 10) -> DataFrame:
    """A10 (+A12 label): sales summed by vendor name, top n."""
    return (final_vendor.groupBy("VendorName").agg(F.sum(S()).alias("Sales"))
            .orderBy(F.col("Sales").desc(), "VendorName").limit(n)
            .withColumn("label", fmt_amount("Sales")))


def top_brands_by_sales(final_brand: DataFrame, n: int = 10) -> DataFrame:
    """A11 (+A12 label): sales summed by brand over all vendors, top n."""
    return (final_brand.groupBy("Brand").agg(F.sum(S()).alias("Sales"))
            .orderBy(F.col("Sales").desc(), "Brand").limit(n)
            .withColumn("label", fmt_amount("Sales")))


def pareto(df: DataFrame, key: str, value: str, top: int | None = 20) -> DataFrame:
    """Value summed per key, share, cumulative share in descending order,
    rank and a 'x.x%' label. The cumulative sum is a bucketed global prefix sum."""
    g = stored(df.groupBy(key).agg(F.sum(value).alias(value)).filter(F.col(value).isNotNull()))
    tot = g.agg(F.sum(value).alias("_tot"))
    c = global_cumsum(g.withColumn("_one", F.lit(1)), value, [value, "_one"], ["_cum", "rank"], ascending=False,
                      tiebreak=(key,))
    out = (attach(c, tot)
            .select(key, value, (F.col(value) / F.col("_tot")).alias("pct"),
                    (F.col("_cum") / F.col("_tot")).alias("cum_pct"), F.col("rank").cast("bigint").alias("rank")))
    out = out.withColumn("pct_lbl", F.concat(F.format_number(F.col("pct") * 100, 1), F.lit("%")))
    return out.filter(F.col("rank") <= top) if top else out


def order_sizes(brand_pricing: DataFrame) -> DataFrame:
    """Rows with sales: unit cost (purchase + freight) / sales qty and its sales-quantity tercile (qcut)."""
    b = brand_pricing.filter(SQ() > 0).withColumn("UnitPurchasePrice", (P() + FR()) / SQ())
    return qcut(b, "TotalSalesQuantity", "OrderSize")


def size_terciles(brand_pricing: DataFrame) -> DataFrame:
    """Mean unit cost by sales-quantity tercile."""
    b = order_sizes(brand_pricing)
    return b.groupBy("OrderSize").agg(F.round(F.avg("UnitPurchasePrice"), 2).alias("UnitPurchasePrice"))


def lowest_turnover_vendors(vss: DataFrame, vendor_invoice: DataFrame, n: int = 15) -> DataFrame:
    """Summary sales qty / invoice qty per vendor, lowest first; label falls back to the number."""
    s = vss.groupBy("VendorNumber").agg(F.sum(SQ()).alias("SalesQty"))
    p = vendor_invoice.groupBy("VendorNumber").agg(F.sum("Quantity").alias("PurchQty"))
    nm = vss.groupBy("VendorNumber").agg(F.max("VendorName").alias("VendorName"))
    t = (s.join(p, "VendorNumber").join(nm, "VendorNumber", "left")
          .filter((F.col("PurchQty") > 0) & (F.col("SalesQty") >= 0))
          .withColumn("StockTurnover", F.col("SalesQty") / F.col("PurchQty")))
    return (t.orderBy("StockTurnover", "VendorNumber").limit(n)
             .select(F.coalesce("VendorName", F.col("VendorNumber").cast("string")).alias("Vendor"),
                     "SalesQty", "PurchQty", F.round("StockTurnover", 3).alias("StockTurnover")))


def concentration(final_vendor: DataFrame) -> DataFrame:
    """Purchase-share concentration: top-5 share, top-10 share and HHI (one row)."""
    from pyspark.sql import Window
    v = final_vendor.filter(P() > 0)
    tot = v.agg(F.sum(P()).alias("_tot"))
    sh = attach(v, tot).withColumn("share", P() / F.col("_tot"))
    # top-10 by share: per-partition top-k then a merge of at most 10 rows per task
    top10 = sh.orderBy(F.col("share").desc(), "VendorNumber").limit(10)
    r = top10.withColumn("_rn", F.row_number().over(Window.orderBy(F.col("share").desc(), "VendorNumber")))
    t = r.agg(F.sum(F.when(F.col("_rn") <= 5, F.col("share"))).alias("top5_share"),
              F.sum("share").alias("top10_share"))
    h = sh.agg(F.sum(F.col("share") * F.col("share")).alias("hhi"), F.count(F.lit(1)).alias("vendors"))
    return attach(t, h)


def concentration_top10(final_vendor: DataFrame) -> DataFrame:
    """A17 list: the 10 vendors with the largest purchase share."""
    v = final_vendor.filter(P() > 0)
    tot = v.agg(F.sum(P()).alias("_tot"))
    return (attach(v, tot).select("VendorName", "TotalPurchaseDollars",
                                                 (P() / F.col("_tot")).alias("share"), "VendorNumber")
             .orderBy(F.col("share").desc(), "VendorNumber").limit(10))


def canonical_vendor_columns(vsum: DataFrame) -> DataFrame:
    """Q17: map older vendor-summary names to canonical ones; add missing columns."""
    ren = {"TotalSalesDol_in_summary": "TotalSalesDollars", "TotalSalesDol": "TotalSalesDollars",
           "TotalPurchaseDol": "TotalPurchaseDollars", "ProfitMargin": "CurrentMargin"}
    vsum = vsum.withColumnsRenamed({k: v for k, v in ren.items() if k in vsum.columns and v not in vsum.columns})
    for must in ["TotalSalesDollars", "TotalPurchaseDollars", "TotalSalesQty"]:
        if must not in vsum.columns:
            vsum = vsum.withColumn(must, F.lit(0.0))
    if "TotalPurchaseQty" not in vsum.columns:
        vsum = vsum.withColumn("TotalPurchaseQty", F.lit(None).cast("double"))
    return vsum


def scorecard_v1(vendor_summary: DataFrame, opps: DataFrame, join_on=("VendorNumber", "VendorName")) -> DataFrame:
    """Vendor frame with purchase share, turnover (units, dollars if no units) and the
    upside rollup of brand opportunities joined on ``join_on`` (the reference uses both keys,
    so brands filed under another spelling of the vendor name drop out). In descending
    order of upside, numbered by ``rank``."""
    v = canonical_vendor_columns(vendor_summary)
    tot = v.agg(F.sum("TotalPurchaseDollars").alias("_tp"))
    has_units = v.agg(F.count("TotalPurchaseQty").alias("_hu"))
    v = attach(attach(v, tot), has_units)
    share = F.when(F.col("_tp") != 0, F.col("TotalPurchaseDollars") / F.col("_tp")).otherwise(F.lit(0.0))
    st = F.when(F.col("_hu") > 0, safe_div(F.col("TotalSalesQty"), F.col("TotalPurchaseQty"))) \
          .otherwise(safe_div(F.col("TotalSalesDollars"), F.col("TotalPurchaseDollars")))
    v = v.withColumn("PurchaseShare", share).withColumn("StockTurnover", st.cast("double"))
    roll = opps.groupBy(*join_on).agg(
        F.coalesce(F.sum(UP()), F.lit(0.0)).alias("UpsideTotal"),
        F.count_if(UP() > 0).alias("BrandsNeedingAction"))
    s = (v.join(roll, list(join_on), "left")
          .na.fill({"UpsideTotal": 0.0, "BrandsNeedingAction": 0}))
    s = global_cumsum(s.withColumn("_one", F.lit(1)), "UpsideTotal", "_one", "rank", ascending=False,
                      tiebreak=("VendorNumber", "VendorName"))
    return s.select("VendorNumber", "VendorName", "UpsideTotal", "BrandsNeedingAction", "CurrentMargin",
                    "StockTurnover", "PurchaseShare", "TotalSalesDollars", "TotalPurchaseDollars",
                    F.col("rank").cast("bigint").alias("rank")).orderBy("rank")


# ActionScore weights.
ACTION_WEIGHTS = {"upside": 0.50, "share": 0.20, "brands": 0.15, "low_mgn": 0.10, "low_tn": 0.05}

SCORECARD_COLUMNS = ["VendorNumber", "VendorName", "UpsideTotal", "BrandsNeedingAction", "BrandCount",
                     "TotalSalesDollars", "TotalPurchaseDollars", "PurchaseShare", "CurrentMargin",
                     "StockTurnover", "BrandTurnoverMedian", "ActionScore"]


def action_scorecard(final_brand: DataFrame, vendor_summary: DataFrame, weights=ACTION_WEIGHTS,
                     join_on=("VendorNumber", "VendorName")) -> DataFrame:
    """Composite ActionScore per vendor.

    Brand needs (upside, NeedsAction, turnover) are rolled up per (VendorNumber,
    VendorName) - sum, count and exact median - and joined to the vendor rollup on
    ``join_on`` (the reference joins on both keys, so other name spellings drop out;
    pass ``join_on=('VendorNumber',)`` to keep them). Five average-tie percent ranks
    are combined with ``weights``. Sorted by ActionScore descending.
    """
    b = final_brand.withColumn("_st", F.when(PQ() > 0, SQ() / PQ())) \
                   .withColumn("_need", F.when(UP() > 0, 1).otherwise(0))
    b = stored(b)
    agg = b.groupBy("VendorNumber", "VendorName").agg(
        F.coalesce(F.sum(UP()), F.lit(0.0)).alias("UpsideTotal"),
        F.sum("_need").cast("bigint").alias("BrandsNeedingAction"),
        F.count("Brand").alias("BrandCount"))
    med = grouped_quantiles(b, ["VendorNumber", "VendorName"], "_st", [0.5], ["BrandTurnoverMedian"])
    agg = agg.join(med, ["VendorNumber", "VendorName"], "left")
    v = vendor_summary.select(
        "VendorNumber", "VendorName",
        F.col("TotalSalesDol_in_summary").alias("TotalSalesDollars"),
        F.col("TotalSalesQty").alias("TotalSalesQuantity"),
        F.col("TotalPurchaseDol").alias("TotalPurchaseDollars"),
        F.col("TotalPurchaseQty").alias("TotalPurchaseQuantity"),
        "FreightCost", F.col("ProfitMargin").alias("CurrentMargin"))
    v = v.withColumn("StockTurnover", F.when(PQ() > 0, SQ() / PQ()))
    tot = v.agg(F.sum("TotalPurchaseDollars").alias("_tp"))
    v = attach(v, tot).withColumn("PurchaseShare", safe_div(F.col("TotalPurchaseDollars"), F.col("_tp")))
    if tuple(join_on) == ("VendorNumber",):
        agg = agg.drop("VendorName")
    s = (v.join(agg, list(join_on), "left")
          .na.fill({"UpsideTotal": 0.0, "BrandsNeedingAction": 0, "BrandCount": 0})
          .withColumn("_m0", F.coalesce("CurrentMargin", F.lit(0.0)))
          .withColumn("_t0", F.coalesce("StockTurnover", F.lit(0.0))))
    s = stored(s)
    s = with_avg_rank_pct(s, ["UpsideTotal", "PurchaseShare", "BrandsNeedingAction", "_m0", "_t0"],
                          ["_r_upside", "_r_share", "_r_brands", "_r_mgn", "_r_tn"])
    score = (F.lit(weights["upside"]) * F.col("_r_upside") + F.lit(weights["share"]) * F.col("_r_share")
             + F.lit(weights["brands"]) * F.col("_r_brands") + F.lit(weights["low_mgn"]) * (1.0 - F.col("_r_mgn"))
             + F.lit(weights["low_tn"]) * (1.0 - F.col("_r_tn")))
    return (s.withColumn("ActionScore", score).select(*SCORECARD_COLUMNS)
             .orderBy(F.col("ActionScore").desc(), "VendorNumber"))


def scorecard_bubbles(scorecard: DataFrame, n: int = 15) -> DataFrame:
    """Top-n scorecard rows with bubble size clip(50 + 20 * brands needing action, 40, 400)."""
    return (scorecard.orderBy(F.col("ActionScore").desc(), "VendorNumber").limit(n)
            .withColumn("size", F.least(F.greatest(F.lit(50) + 20 * F.col("BrandsNeedingAction"), F.lit(40)),
                                        F.lit(400)).cast("double")))


def executive_blurb(scorecard: DataFrame, n: int = 5) -> DataFrame:
    """One formatted sentence per top-n scorecard vendor."""
    top = scorecard.orderBy(F.col("ActionScore").desc(), "VendorNumber").limit(n)
    # upside with thousands separators; share and margin plain with one decimal
    text = F.format_string("- %s: upside $%s, %d brands to fix, purchase share %.1f%%, margin %.1f%%.",
                           F.col("VendorName"), F.format_number(F.col("UpsideTotal"), 0),
                           F.col("BrandsNeedingAction").cast("int"),
                           F.col("PurchaseShare") * 100, F.col("CurrentMargin"))
    return top.select("VendorNumber", "ActionScore", text.alias("blurb"))


def brand_portfolio(brand: DataFrame) -> DataFrame:
    """Brand bubble size clip(40 + upside / median(upside, or 1 if 0) * 15, 40, 500)."""
    u = F.coalesce(UP(), F.lit(0.0))
    med = exact_quantiles(brand.select(u.alias("_u")), "_u", [0.5], ["_med"])
    m = F.when((F.col("_med") == 0) | F.col("_med").isNull(), F.lit(1.0)).otherwise(F.col("_med"))
    return (attach(brand, med)
                 .withColumn("size", F.least(F.greatest(F.lit(40.0) + u / m * 15, F.lit(40.0)), F.lit(500.0)))
                 .drop("_med"))


def top_brands_by_total_upside(brand: DataFrame, n: int = 20) -> DataFrame:
    """Upside summed per brand over vendors, top n (pandas sum: all-NULL -> 0)."""
    return (brand.groupBy("Brand").agg(F.coalesce(F.sum(UP()), F.lit(0.0)).alias("UpsideDollars"))
            .orderBy(F.col("UpsideDollars").desc(), "Brand").limit(n))


def bottom_decile_turnover(brand: DataFrame, n: int = 30) -> DataFrame:
    """Brands with 0 < turnover <= 10th percentile, slowest first."""
    q = exact_quantiles(brand, "StockTurnover", [0.1], ["_q10"])
    st = F.col("StockTurnover")
    return (attach(brand, q).filter((st > 0) & (st <= F.col("_q10")))
                 .orderBy(st, "VendorNumber", "Brand").limit(n)
                 .select("VendorName", "Brand", "StockTurnover", "TotalSalesQuantity", "TotalPurchaseQuantity"))


def unsold_inventory(vss: DataFrame, n: int = 15) -> DataFrame:
    """On-hand units max(purchased - sold, 0) valued at average unit cost, per vendor."""
    cost = F.when(PQ() > 0, P() / PQ())
    units = F.greatest(PQ() - SQ(), F.lit(0))
    b = vss.select("VendorNumber", "VendorName", units.alias("OnHandUnits"), (units * cost).alias("OnHandValue"))
    return (b.groupBy("VendorNumber", "VendorName")
             .agg(F.sum("OnHandUnits").alias("OnHandUnits"), F.coalesce(F.sum("OnHandValue"), F.lit(0.0)).alias("OnHandValue"))
             .orderBy(F.col("OnHandValue").desc(), "VendorNumber", "VendorName").limit(n))


def dashboard_kpis(vss: DataFrame, vendor_summary: DataFrame, diag: DataFrame, underperf: DataFrame,
                   risk_summary: DataFrame, vendor_summary_c: DataFrame) -> DataFrame:
    """One row of dashboard cards. The dashboard's measures are not in the reference;
    ours: totals from T1, underperforming share = T8 brands / T7b brands, vendors at risk =
    T9 vendors / T4c vendors, average spend = purchases / distinct vendors."""
    t = vss.agg(F.sum(S()).alias("total_sales"), F.sum(P()).alias("total_purchases"),
                F.sum("GrossProfit").alias("gross_profit"),
                F.countDistinct("VendorNumber").alias("distinct_vendors"),
                F.countDistinct("Brand").alias("distinct_brands"))
    t = t.withColumn("profit_margin", safe_div(F.col("gross_profit"), F.col("total_sales"))) \
         .withColumn("avg_spend_per_vendor", safe_div(F.col("total_purchases"), F.col("distinct_vendors")))
    ub = underperf.agg(F.count(F.lit(1)).alias("_ub"))
    db = diag.agg(F.count(F.lit(1)).alias("_db"))
    rv = risk_summary.agg(F.count(F.lit(1)).alias("_rv"))
    cv = vendor_summary_c.agg(F.count(F.lit(1)).alias("_cv"))
    return (attach(attach(attach(attach(t, ub), db), rv), cv)
             .withColumn("underperforming_brand_share", safe_div(F.col("_ub"), F.col("_db")))
             .withColumn("vendors_at_risk_share", safe_div(F.col("_rv"), F.col("_cv")))
             .drop("_ub", "_db", "_rv", "_cv"))


def sales_share_by_brand(final_brand: DataFrame) -> DataFrame:
    """Donut frame - each brand's share of total sales."""
    g = final_brand.groupBy("Brand").agg(F.sum(S()).alias("Sales"))
    tot = g.agg(F.sum("Sales").alias("_t"))
    return attach(g, tot).select("Brand", "Sales", (F.col("Sales") / F.col("_t")).alias("share"))
