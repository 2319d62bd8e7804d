"""Core summary tables.

Two families share table names in the reference:

* the build family (T1, T4a, T5a, T6a, T7a, T10a, T11a, T12a, T13a): brand rows carry
  brand-level purchases and an allocated share of vendor freight;
* the notebook family (T2, T4b/c, T5b, T6b, T7b, T8, T9, T10b/c, T11b, T12b, T13b):
  brand rows repeat vendor-level purchases and freight (the reference's own choice,
  kept on purpose).

Scale notes
-----------
The reference joins sales lines to purchase lines on InventoryId, line by line. That
fan-out is the specification (sales are counted once per matching purchase line), but
materialising it is quadratic in the lines per InventoryId. We aggregate both sides to
InventoryId first and multiply by the matching purchase-line count, which gives the
same sums while the join only sees one row per (InventoryId, Brand) and per
(InventoryId, vendor). Partial (map-side) aggregation absorbs hot keys before the
shuffle, so one InventoryId holding a third of the lines costs one row after the
combine. Vendor-grain sides are small; AQE turns those joins into broadcasts at
runtime from their measured size (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
otherwise they stay sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.functions.expr import (div_if_positive, least_null, safe_div,
                                       sqlite_real, trim_or_empty, typed_null)
from vendorlens.session import stored


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


def _margin_pct(sales, gp):
    """``CASE WHEN sales > 0 THEN 100.0 * gp / sales ELSE 0 END``."""
    return F.when(sales > 0, F.lit(100.0) * gp / sales).otherwise(F.lit(0.0))


# --------------------------------------------------------------------------- T1


def purchase_lots(purchases: DataFrame) -> DataFrame:
    """Purchases once over: lines ``_n``, units ``_q`` and dollars ``_d`` per InventoryId, vendor and brand.

    All that T1 and T2 need of the purchase lines follows from these sums.
    """
    return purchases.groupBy("InventoryId", "VendorNumber", "VendorName", "Brand").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("Quantity").alias("_q"),
        F.sum(F.col("PurchasePrice") * F.col("Quantity")).alias("_d"))


def fanout_sales(sales: DataFrame, purchases: DataFrame, vendor_keys=("VendorNumber", "VendorName"),
                 with_avg_price: bool = False, method: str = "preaggregate", lots: DataFrame | None = None) -> DataFrame:
    """Sales summed per (vendor keys, Brand) over the InventoryId fan-out join.

    ``method='naive'`` joins line to line like the reference (kept for tests);
    ``'preaggregate'`` produces the same sums without materialising the pairs.
    """
    keys = list(vendor_keys) + ["Brand"]
    if method == "naive":
        s = sales.alias("s")
        p = purchases.alias("p")
        j = s.join(p, F.col("s.InventoryId") == F.col("p.InventoryId"))
        aggs = [F.sum("s.SalesQuantity").alias("TotalSalesQuantity"),
                F.sum("s.SalesDollars").alias("TotalSalesDollars")]
        if with_avg_price:
            aggs.append(F.avg("s.SalesPrice").alias("AvgSalesPrice"))
        return j.groupBy(*[F.col(f"p.{k}") for k in vendor_keys], F.col("s.Brand")).agg(*aggs)

    s_aggs = [F.sum("SalesQuantity").alias("_q"), F.sum("SalesDollars").alias("_d")]
    if with_avg_price:
        s_aggs += [F.sum("SalesPrice").alias("_ps"), F.count("SalesPrice").alias("_pc")]
    s = sales.groupBy("InventoryId", "Brand").agg(*s_aggs)
    p = (purchases.groupBy("InventoryId", *vendor_keys).agg(F.count(F.lit(1)).alias("_n")) if lots is None
         else lots.groupBy("InventoryId", *vendor_keys).agg(F.sum("_n").alias("_n")))
    j = s.join(p, "InventoryId")
    n = F.col("_n")
    aggs = [F.sum(F.col("_q") * n).alias("TotalSalesQuantity"),
            F.sum(F.col("_d") * n).alias("TotalSalesDollars")]
    if with_avg_price:
        aggs.append((F.sum(F.col("_ps") * n) / F.sum(F.col("_pc") * n)).alias("AvgSalesPrice"))
    return j.groupBy(*keys).agg(*aggs)


def brand_purchases(purchases: DataFrame) -> DataFrame:
    """Purchase quantity and PurchasePrice*Quantity per (VendorNumber, Brand)."""
    return purchases.groupBy("VendorNumber", "Brand").agg(
        F.sum("Quantity").alias("BrandPurchaseQuantity"),
        F.sum(F.col("PurchasePrice") * F.col("Quantity")).alias("BrandPurchaseDollars"))


def vendor_brand_purchase_totals(brand_purch: DataFrame) -> DataFrame:
    """Vendor total of T1b."""
    return brand_purch.groupBy("VendorNumber").agg(
        F.sum("BrandPurchaseDollars").alias("VendorBrandPurchDollars"))


def invoice_by_vendor(vendor_invoice: DataFrame) -> DataFrame:
    """T1d: invoice quantity, dollars and freight per vendor."""
    return vendor_invoice.groupBy("VendorNumber").agg(
        F.sum("Quantity").alias("InvoicePurchaseQuantity"),
        F.sum("Dollars").alias("InvoicePurchaseDollars"),
        F.sum("Freight").alias("Freight"))


def allocated_freight(freight, brand_dollars, vendor_dollars):
    """T1f: vendor freight split by the brand's share of vendor purchase dollars."""
    fr, vd = F.coalesce(freight, F.lit(0.0)), F.coalesce(vendor_dollars, F.lit(0.0))
    return (F.when((fr > 0) & (vd > 0),
                   freight * F.coalesce(brand_dollars, F.lit(0.0)) * 1.0 / vendor_dollars)
             .otherwise(F.lit(0.0)))


def vendor_sales_summary(sales: DataFrame, purchases: DataFrame, vendor_invoice: DataFrame,
                         method: str = "preaggregate") -> DataFrame:
    """Brand-level summary with freight allocation (build variant).

    -> VendorNumber, VendorName, Brand, TotalSalesQuantity, TotalSalesDollars,
       TotalPurchaseQuantity, TotalPurchaseDollars, FreightCost, GrossProfit, ProfitMargin(%)
    """
    lots = stored(purchase_lots(purchases))
    sa = fanout_sales(sales, purchases, method=method, lots=lots)
    bp = lots.groupBy("VendorNumber", "Brand").agg(F.sum("_q").alias("BrandPurchaseQuantity"),
                                                   F.sum("_d").alias("BrandPurchaseDollars"))
    t = vendor_brand_purchase_totals(bp)
    vi = invoice_by_vendor(vendor_invoice).select("VendorNumber", "Freight")
    j = (sa.join(bp, ["VendorNumber", "Brand"], "left")
           .join(t, "VendorNumber", "left")
           .join(vi, "VendorNumber", "left"))
    out = j.select(
        "VendorNumber", "VendorName", "Brand",
        F.coalesce("TotalSalesQuantity", F.lit(0)).alias("TotalSalesQuantity"),
        F.coalesce("TotalSalesDollars", F.lit(0.0)).alias("TotalSalesDollars"),
        F.coalesce("BrandPurchaseQuantity", F.lit(0)).alias("TotalPurchaseQuantity"),
        F.coalesce("BrandPurchaseDollars", F.lit(0.0)).alias("TotalPurchaseDollars"),
        allocated_freight(F.col("Freight"), F.col("BrandPurchaseDollars"),
                          F.col("VendorBrandPurchDollars")).alias("FreightCost"))
    gp = S() - P() - FR()
    return out.withColumn("GrossProfit", gp).withColumn("ProfitMargin", _margin_pct(S(), gp))


# --------------------------------------------------------------------------- T2 / T3


def purchase_price_summary(purchases: DataFrame, purchase_prices: DataFrame, lots: DataFrame | None = None) -> DataFrame:
    """Average list prices and max volume per (VendorNumber, VendorName, Brand).

    The reference left-joins every purchase line to the price list and averages over
    the lines. Averages weighted by the line count give the same value, so purchases
    are counted per key first and the join sees one row per key.
    """
    p = (purchases if lots is None else lots).groupBy("VendorNumber", "VendorName", "Brand").agg(
        (F.count(F.lit(1)) if lots is None else F.sum("_n")).alias("_n"))
    pp = purchase_prices.select("VendorNumber", "Brand", F.col("PurchasePrice").alias("_pp"),
                                F.col("Price").alias("_pr"), sqlite_real("Volume").alias("_vol"))
    j = p.join(pp, ["VendorNumber", "Brand"], "left")
    n = F.col("_n")

    def wavg(c):
        return F.sum(F.col(c) * n) / F.sum(F.when(F.col(c).isNotNull(), n))

    return j.groupBy("VendorNumber", "VendorName", "Brand").agg(
        wavg("_pp").alias("AvgPurchasePrice"), wavg("_pr").alias("AvgActualPrice"),
        F.max("_vol").alias("Volume"))


def invoice_totals_by_vendor(vendor_invoice: DataFrame) -> DataFrame:
    """T2c / T3a-like: invoice quantity, dollars and freight per vendor."""
    return vendor_invoice.groupBy("VendorNumber").agg(
        F.sum("Quantity").alias("TotalPurchaseQuantity"),
        F.sum("Dollars").alias("TotalPurchaseDollars"),
        F.sum("Freight").alias("FreightCost"))


def vendor_sales_summary_replicated(sales: DataFrame, purchases: DataFrame, vendor_invoice: DataFrame,
                                    purchase_prices: DataFrame, method: str = "preaggregate") -> DataFrame:
    """Brand rows with vendor-level purchases and freight repeated on each brand row."""
    lots = stored(purchase_lots(purchases))
    sa = fanout_sales(sales, purchases, vendor_keys=("VendorNumber",), with_avg_price=True, method=method, lots=lots)
    pa = purchase_price_summary(purchases, purchase_prices, lots)
    vi = invoice_totals_by_vendor(vendor_invoice)
    j = (sa.join(pa, ["VendorNumber", "Brand"], "left")
           .join(vi, "VendorNumber", "left"))
    s = F.coalesce("TotalSalesDollars", F.lit(0.0))
    p = F.coalesce(vi["TotalPurchaseDollars"], F.lit(0.0))
    fr = F.coalesce(vi["FreightCost"], F.lit(0.0))
    sq = F.coalesce("TotalSalesQuantity", F.lit(0))
    pq = F.coalesce(vi["TotalPurchaseQuantity"], F.lit(0))
    gp = s - p - fr
    return j.select(
        "VendorNumber",
        trim_or_empty("VendorName").alias("VendorName"),
        trim_or_empty("Brand").alias("Brand"),
        F.coalesce("AvgPurchasePrice", F.lit(0.0)).alias("AvgPurchasePrice"),
        F.coalesce("AvgActualPrice", F.lit(0.0)).alias("AvgActualPrice"),
        F.coalesce("Volume", F.lit(0.0)).alias("Volume"),
        sq.alias("TotalSalesQuantity"), s.alias("TotalSalesDollars"),
        F.coalesce("AvgSalesPrice", F.lit(0.0)).alias("AvgSalesPrice"),
        pq.alias("TotalPurchaseQuantity"), p.alias("TotalPurchaseDollars"), fr.alias("FreightCost"),
        gp.alias("GrossProfit"), _margin_pct(s, gp).alias("ProfitMargin"),
        div_if_positive(sq, pq).alias("StockTurnover"),
        div_if_positive(s, p).alias("SalesToPurchaseRatio"))


def _py_str(c):
    """pandas ``astype(str).str.strip()``: NULL -> 'None', all surrounding whitespace removed."""
    return F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("None")), r"^\s+|\s+$", "")


def premerge_summary(sales: DataFrame, purchases: DataFrame, vendor_invoice: DataFrame,
                     purchase_prices: DataFrame) -> DataFrame:
    """The notebook's pre-merge summary (T3a-T3e).

    Purchases with a positive price are summed by 7 keys (5 purchase keys plus list
    price and volume from ``purchase_prices``, inner join on vendor and brand), sales by
    (VendorNo, Brand); both are left-merged with vendor freight. Text is stripped,
    numbers coerced, NaN/inf and missing values become 0.
    """
    fr = vendor_invoice.groupBy("VendorNumber").agg(F.sum("Freight").alias("FreightCost"))
    keys5 = ["VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice"]
    pa = (purchases.filter(F.col("PurchasePrice") > 0)
          .groupBy(*keys5).agg(F.sum("Quantity").alias("_q"), F.sum("Dollars").alias("_d")))
    pp = purchase_prices.select(F.col("VendorNo").alias("VendorNumber"), "Brand",
                                F.col("Price").alias("ActualPrice"), "Volume")
    purch = (pa.join(pp, ["VendorNumber", "Brand"])
               .groupBy(*keys5, "ActualPrice", "Volume")
               .agg(F.sum("_q").alias("TotalPurchaseQuantity"), F.sum("_d").alias("TotalPurchaseDollars")))
    sa = (sales.groupBy(F.col("VendorNo").alias("VendorNumber"), "Brand")
               .agg(F.sum("SalesQuantity").alias("TotalSalesQuantity"),
                    F.sum("SalesDollars").alias("TotalSalesDollars"),
                    F.sum("SalesPrice").alias("TotalSalesPrice"),
                    F.sum("ExciseTax").alias("TotalExciseTax")))
    m = purch.join(sa, ["VendorNumber", "Brand"], "left").join(fr, "VendorNumber", "left")
    num = ["PurchasePrice", "ActualPrice", "Volume", "TotalPurchaseQuantity", "TotalPurchaseDollars",
           "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax", "FreightCost"]

    def clean(c):
        v = F.trim(F.col(c).cast("string")).try_cast("double") if c == "Volume" else F.col(c).cast("double")
        return F.coalesce(F.when(~(F.isnan(v) | (F.abs(v) == float("inf"))), v), F.lit(0.0)).alias(c)

    return m.select("VendorNumber", _py_str("VendorName").alias("VendorName"),
                    _py_str("Brand").alias("Brand"), _py_str("Description").alias("Description"),
                    *[clean(c) for c in num])


# --------------------------------------------------------------------------- T4


def vendor_rollup(vss: DataFrame) -> DataFrame:
    """One row per vendor from T1 (build variant)."""
    gp_sum = F.sum(S() - P() - FR())
    agg = vss.groupBy("VendorNumber").agg(
        F.max("VendorName").alias("VendorName"),
        F.sum(S()).alias("TotalSalesDol_in_summary"),
        F.sum(SQ()).alias("TotalSalesQty"),
        F.sum(P()).alias("TotalPurchaseDol"),
        F.sum(PQ()).alias("TotalPurchaseQty"),
        F.sum(FR()).alias("FreightCost"),
        gp_sum.alias("GrossProfit"),
        F.when(F.sum(S()) > 0, F.lit(100.0) * (F.sum(S()) - F.sum(P()) - F.sum(FR())) / F.sum(S()))
         .otherwise(F.lit(0.0)).alias("ProfitMargin"),
        F.countDistinct("Brand").alias("BrandCount"))
    return agg


def vendor_rollup_trimmed(vss2: DataFrame) -> DataFrame:
    """Vendor rollup of T2 with MIN(TRIM(name)), summed brand GP, turnover, ratio."""
    return vss2.groupBy("VendorNumber").agg(
        F.min(F.trim("VendorName")).alias("VendorName"),
        F.countDistinct("Brand").alias("BrandCount"),
        F.sum(SQ()).alias("TotalSalesQty"), F.sum(S()).alias("TotalSalesDol"),
        F.sum(PQ()).alias("TotalPurchaseQty"), F.sum(P()).alias("TotalPurchaseDol"),
        F.sum(FR()).alias("FreightCost"), F.sum("GrossProfit").alias("GrossProfit"),
        F.when(F.sum(S()) > 0, F.lit(100.0) * F.sum("GrossProfit") / F.sum(S())).otherwise(F.lit(0.0))
         .alias("ProfitMargin"),
        div_if_positive(F.sum(SQ()), F.sum(PQ())).alias("StockTurnover"),
        div_if_positive(F.sum(S()), F.sum(P())).alias("SalesToPurchaseRatio"))


def vendor_rollup_avgs(vss2: DataFrame) -> DataFrame:
    """Vendor rollup of T2 with GP recomputed from totals and unweighted price averages."""
    gp = F.sum(S() - P() - FR())
    return vss2.groupBy("VendorNumber").agg(
        F.max("VendorName").alias("VendorName"),
        F.countDistinct("Brand").alias("BrandCount"),
        F.sum(S()).alias("TotalSalesDol"), F.sum(P()).alias("TotalPurchaseDol"),
        F.sum(FR()).alias("FreightCost"), F.sum(SQ()).alias("TotalSalesQty"),
        F.sum(PQ()).alias("TotalPurchaseQty"), gp.alias("GrossProfit"),
        F.when(F.sum(S()) > 0, F.lit(100.0) * gp / F.sum(S())).otherwise(F.lit(0.0)).alias("ProfitMargin"),
        F.avg("AvgSalesPrice").alias("AvgSalesPrice"),
        F.avg("AvgPurchasePrice").alias("AvgPurchasePrice"))


# --------------------------------------------------------------------------- T5 / T6


def spend_by_vendor(vendor_invoice: DataFrame, vss: DataFrame) -> DataFrame:
    """Invoice dollars per vendor with the vendor's summary sales (0 if none).

    The reference's correlated scalar subquery becomes aggregate + left join.
    """
    inv = vendor_invoice.groupBy("VendorNumber").agg(F.sum("Dollars").alias("TotalPurchaseDollars"))
    sold = vss.groupBy("VendorNumber").agg(F.sum(S()).alias("_s"))
    return (inv.join(sold, "VendorNumber", "left")
               .select("VendorNumber", "TotalPurchaseDollars",
                       F.coalesce("_s", F.lit(0.0)).alias("TotalSalesDollars")))


def spend_by_vendor_named(vss2: DataFrame) -> DataFrame:
    """Spend per (VendorNumber, VendorName) with brand count, GP, margin fraction, ratio."""
    ss, ps, fs = F.sum(S()), F.sum(P()), F.sum(FR())
    return (vss2.groupBy("VendorNumber", "VendorName").agg(
                F.sum(SQ()).alias("TotalSalesQuantity"), ss.alias("TotalSalesDollars"),
                ps.alias("TotalPurchaseDollars"), fs.alias("FreightCost"),
                F.countDistinct("Brand").alias("BrandCount"),
                F.when(ss > 0, (ss - ps - fs) * 1.0).otherwise(F.lit(0.0)).alias("GrossProfit"),
                F.when(ss > 0, (ss - ps - fs) * 1.0 / ss).otherwise(F.lit(0.0)).alias("ProfitMargin"),
                div_if_positive(ss, ps).alias("SalesToPurchaseRatio"))
            .orderBy(F.col("GrossProfit").desc(), "VendorNumber", "VendorName"))


def top_spend(purchases: DataFrame, n: int = 20) -> DataFrame:
    """Top-n vendors by purchase dollars -> vendor_id, vendor_name, spend."""
    return (purchases.groupBy("VendorNumber", "VendorName")
            .agg(F.sum("Dollars").alias("spend"))
            .select(F.col("VendorNumber").alias("vendor_id"), F.col("VendorName").alias("vendor_name"), "spend")
            .orderBy(F.col("spend").desc(), "vendor_id", "vendor_name").limit(n))


def vendor_risk_flags(vss: DataFrame) -> DataFrame:
    """Per vendor, number of brand rows with negative totals."""
    def neg(c):
        return F.sum(F.when(F.col(c) < 0, 1).otherwise(0)).cast("bigint")
    return vss.groupBy("VendorNumber").agg(
        neg("TotalSalesQuantity").alias("neg_SalesQty"), neg("TotalSalesDollars").alias("neg_SalesDol"),
        neg("TotalPurchaseQuantity").alias("neg_PurchQty"), neg("TotalPurchaseDollars").alias("neg_PurchDol"),
        neg("FreightCost").alias("neg_Freight"))


def vendor_kpi_flags(vss2: DataFrame, low_margin: float = 0.20, high_freight_share: float = 0.08,
                     low_stock_turn: float = 0.50, min_sales_dollars: float = 1000) -> DataFrame:
    """Vendor KPI flags (fractions), sales >= ``min_sales_dollars``, ordered by margin.

    Purchase quantity comes from all of the vendor's rows (any name), like the
    reference's correlated subquery; flags use unrounded values.
    """
    base = vss2.groupBy("VendorNumber", "VendorName").agg(
        F.sum(S()).alias("TotalSalesDollars"), F.sum(SQ()).alias("TotalSalesQuantity"),
        F.sum(P()).alias("TotalPurchaseDollars"), F.sum(FR()).alias("FreightCost"))
    pq = vss2.groupBy("VendorNumber").agg(F.sum(PQ()).alias("_pq"))
    k = (base.join(pq, "VendorNumber", "left")
             .withColumn("TotalPurchaseQuantity", F.coalesce("_pq", F.lit(0)))
             .withColumn("_pm", div_if_positive(S() - P() - FR(), S()))
             .withColumn("_sp", div_if_positive(S(), P()))
             .withColumn("_fs", div_if_positive(FR(), S()))
             .withColumn("_st", div_if_positive(SQ(), PQ())))
    return (k.filter(S() >= min_sales_dollars)
             .orderBy(F.col("_pm").asc(), F.col("_fs").desc(), "VendorNumber", "VendorName")
             .select("VendorNumber", "VendorName", "TotalSalesDollars", "TotalSalesQuantity",
                     "TotalPurchaseDollars", "FreightCost",
                     F.round(F.col("_pm") * 100, 2).alias("ProfitMarginPct"),
                     F.round(F.col("_fs") * 100, 2).alias("FreightSharePct"),
                     F.round("_sp", 2).alias("SalesToPurchaseRatio"),
                     F.round("_st", 2).alias("StockTurnover"),
                     F.when(F.col("_pm") < low_margin, 1).otherwise(0).alias("LowMarginVendor"),
                     F.when(F.col("_fs") > high_freight_share, 1).otherwise(0).alias("HighFreightShare"),
                     F.when(S() - P() - FR() < 0, 1).otherwise(0).alias("NegativeGrossProfit"),
                     F.when(F.col("_st") < low_stock_turn, 1).otherwise(0).alias("LowStockTurnover")))


# --------------------------------------------------------------------------- T7 / T8 / T9


def brand_pricing(vss: DataFrame) -> DataFrame:
    """T1 re-aggregated by (VendorNumber, VendorName, Brand)."""
    return vss.groupBy("VendorNumber", "VendorName", "Brand").agg(
        F.sum(SQ()).alias("TotalSalesQuantity"), F.sum(S()).alias("TotalSalesDollars"),
        F.sum(P()).alias("TotalPurchaseDollars"), F.sum(FR()).alias("FreightCost"))


def brand_pricing_diagnostics(vss2: DataFrame, low_margin_pct: float = 10.0,
                              high_freight: float = 0.08, low_turnover: float = 0.5) -> DataFrame:
    """Per-brand unit economics and flags on T2."""
    up = safe_div(S() * 1.0, SQ())
    uc = safe_div(P() * 1.0, PQ())
    both = (SQ() > 0) & (PQ() > 0)
    st = F.col("StockTurnover")
    return vss2.select(
        "VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
        "TotalPurchaseQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit", "ProfitMargin",
        "SalesToPurchaseRatio", "StockTurnover",
        div_if_positive(FR(), S()).alias("FreightPct"),
        F.when(PQ() > 0, uc).alias("AvgUnitCost"),
        F.when(SQ() > 0, up).alias("AvgUnitPrice"),
        F.when(both, up - uc).alias("UnitMargin"),
        F.when(both, safe_div(up - uc, up)).alias("UnitMarginPct"),
        F.when(F.col("ProfitMargin") < low_margin_pct, 1).otherwise(0).alias("LowMarginFlag"),
        F.when((FR() > 0) & (S() > 0) & (FR() * 1.0 / S() > high_freight), 1).otherwise(0).alias("HighFreightFlag"),
        F.when(st.isNotNull() & (st < low_turnover), 1).otherwise(0).alias("LowTurnoverFlag"))


def underperforming_brands(diag: DataFrame, min_sales_dollars: float = 10_000, min_sales_qty: int = 10,
                           low_margin_pct: float = 10.0, high_freight_pct: float = 0.08,
                           low_turnover: float = 0.5) -> DataFrame:
    """Brands above a size floor failing any of margin / freight / turnover tests."""
    st = F.col("StockTurnover")
    low_m = F.col("ProfitMargin") < low_margin_pct
    high_f = F.col("FreightPct") > high_freight_pct
    low_t = st.isNotNull() & (st < low_turnover)
    return (diag.filter((S() >= min_sales_dollars) & (SQ() >= min_sales_qty) & (low_m | high_f | low_t))
                .select("VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
                        "TotalPurchaseQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit",
                        "ProfitMargin", "StockTurnover", "SalesToPurchaseRatio", "FreightPct",
                        "AvgUnitCost", "AvgUnitPrice", "UnitMargin", "UnitMarginPct",
                        F.when(low_m, 1).otherwise(0).alias("Reason_LowMargin"),
                        F.when(high_f, 1).otherwise(0).alias("Reason_HighFreight"),
                        F.when(low_t, 1).otherwise(0).alias("Reason_LowTurnover"))
                .orderBy("VendorNumber", F.col("ProfitMargin").asc(), F.col("FreightPct").desc(), "Brand"))


def vendor_risk_summary(bad: DataFrame, vendor_summary: DataFrame) -> DataFrame:
    """Underperforming brands rolled up per vendor, with the share of sales at risk."""
    def cnt(c):
        return F.sum(F.when(F.col(c) == 1, 1).otherwise(0)).cast("bigint")
    g = bad.groupBy("VendorNumber").agg(
        F.min("VendorName").alias("VendorName"),
        F.count(F.lit(1)).alias("UnderperformingBrandCount"),
        F.sum(S()).alias("SalesAtRisk"), F.sum("GrossProfit").alias("GrossProfit_FromBadBrands"),
        F.sum(FR()).alias("Freight_FromBadBrands"), F.avg("ProfitMargin").alias("AvgMargin_BadBrands"),
        F.min("ProfitMargin").alias("MinMargin_BadBrands"),
        cnt("Reason_LowMargin").alias("LowMarginBrands"), cnt("Reason_HighFreight").alias("HighFreightBrands"),
        cnt("Reason_LowTurnover").alias("LowTurnoverBrands"))
    v = vendor_summary.select("VendorNumber", F.col("TotalSalesDol").alias("VendorTotalSales"))
    vts = F.col("VendorTotalSales")
    return (g.join(v, "VendorNumber", "left")
             .withColumn("SalesAtRiskPct", F.when(vts > 0, F.col("SalesAtRisk") * 1.0 / vts).otherwise(F.lit(0.0)))
             .orderBy(F.col("SalesAtRisk").desc(), "VendorNumber"))


# --------------------------------------------------------------------------- T10


def brand_pricing_opportunities(bp: DataFrame, target: float = 0.35) -> DataFrame:
    """Sales needed to reach ``target`` margin per brand (all brands kept).

    target = 1 gives NULL RequiredSalesDollars (SQLite division by zero), not an error.
    """
    cost = P() + FR()
    req = F.when(cost <= 0, F.lit(0.0)).otherwise(safe_div(cost * 1.0, F.lit(1.0 - target)))
    b = bp.withColumn("AvgSalesPrice", F.when(S() > 0, safe_div(S(), SQ() * 1.0)))
    b = b.withColumn("RequiredSalesDollars", req)
    r = F.col("RequiredSalesDollars")
    gap = F.when(r > S(), r - S()).otherwise(F.lit(0.0))
    return b.select(
        "VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
        "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice",
        F.lit(float(target)).alias("TargetMargin"), "RequiredSalesDollars",
        gap.alias("UpsideDollars"),
        F.when(SQ() > 0, gap / (SQ() * 1.0)).alias("NeededPriceDeltaPerUnit"))


def _current_margin():
    return div_if_positive(S() - P() - FR(), S())


def pricing_opportunities_filtered(vss2: DataFrame, target: float = 0.35, max_lift: float = 0.15,
                                   min_qty: int = 10) -> DataFrame:
    """Brands below target with a capped suggested price lift, ordered by upside."""
    f = (vss2.select("VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
                     "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice",
                     _current_margin().alias("CurrentMargin"))
             .filter((SQ() >= min_qty) & (S() > 0) & ((S() - P() - FR()) < F.lit(target) * S())))
    req = F.when(F.lit(1.0 - target) > 0, (P() + FR()) * 1.0 / F.lit(1.0 - target))
    f = f.withColumn("RequiredSalesDollars", req)
    r = F.col("RequiredSalesDollars")
    up = F.when(r > S(), r - S()).otherwise(F.lit(0.0))
    f = (f.withColumn("UpsideDollars", up)
          .withColumn("NeededPriceDeltaPerUnit",
                      F.when(SQ() > 0, up * 1.0 / SQ()).otherwise(F.lit(0.0))))
    asp = F.col("AvgSalesPrice")
    lift = least_null(F.lit(max_lift), F.col("NeededPriceDeltaPerUnit") / asp)
    return (f.filter(F.col("UpsideDollars") > 0)
             .select("VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
                     "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice", "CurrentMargin",
                     F.lit(float(target)).alias("TargetMargin"), "UpsideDollars", "NeededPriceDeltaPerUnit",
                     F.when(asp > 0, lift).otherwise(F.lit(0.0)).alias("SuggestedPriceLiftPct"),
                     F.when(asp > 0, asp * (1.0 + lift)).otherwise(asp).alias("SuggestedNewAvgPrice"))
             .orderBy(F.col("UpsideDollars").desc(), F.col("CurrentMargin").asc(), "VendorNumber", "Brand"))


def pricing_opportunities_all(vss2: DataFrame, target: float = 0.35) -> DataFrame:
    """Every brand; Required/Upside/Delta NULL when already at or above target."""
    below = (S() > 0) & ((S() - P() - FR()) * 1.0 / S() < target)
    req = (P() + FR()) * 1.0 / F.lit(1.0 - target)
    return vss2.select(
        "VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
        "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice",
        _current_margin().alias("CurrentMargin"),
        F.lit(float(target)).alias("TargetMargin"),
        F.when(below, req).alias("RequiredSalesDollars"),
        F.when(below, req - S()).alias("UpsideDollars"),
        F.when((SQ() > 0) & below, (req - S()) * 1.0 / SQ()).alias("NeededPriceDeltaPerUnit"))


# --------------------------------------------------------------------------- T11-T13


def final_vendor(vendor_summary: DataFrame) -> DataFrame:
    """T4a renamed, with four typed NULL opportunity columns."""
    return vendor_summary.select(
        "VendorNumber", "VendorName",
        F.col("TotalSalesDol_in_summary").alias("TotalSalesDollars"),
        F.col("TotalSalesQty").alias("TotalSalesQuantity"),
        F.col("TotalPurchaseDol").alias("TotalPurchaseDollars"),
        F.col("TotalPurchaseQty").alias("TotalPurchaseQuantity"),
        "FreightCost", "GrossProfit", F.col("ProfitMargin").alias("CurrentMargin"),
        typed_null("double").alias("TargetMargin"), typed_null("double").alias("RequiredSalesDollars"),
        typed_null("double").alias("UpsideDollars"), typed_null("double").alias("NeededPriceDeltaPerUnit"))


def final_brand(vss: DataFrame, opps: DataFrame) -> DataFrame:
    """T1 left-joined to T10a on (VendorNumber, Brand) - two keys, like the reference."""
    o = opps.select("VendorNumber", "Brand", "TargetMargin", "RequiredSalesDollars", "UpsideDollars",
                    "NeededPriceDeltaPerUnit")
    return (vss.join(o, ["VendorNumber", "Brand"], "left")
               .select("VendorNumber", "VendorName", "Brand", "TotalSalesDollars", "TotalSalesQuantity",
                       "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost", "GrossProfit",
                       F.col("ProfitMargin").alias("CurrentMargin"), "TargetMargin", "RequiredSalesDollars",
                       "UpsideDollars", "NeededPriceDeltaPerUnit"))


FINAL_ALL_COLUMNS = ["Level", "VendorNumber", "VendorName", "Brand", "TotalSalesDollars",
                     "TotalSalesQuantity", "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost",
                     "GrossProfit", "CurrentMargin", "BrandCount", "TargetMargin", "RequiredSalesDollars",
                     "UpsideDollars", "NeededPriceDeltaPerUnit"]


def final_all(fv: DataFrame, fb: DataFrame) -> DataFrame:
    """Vendor rows and brand rows in one table with a ``Level`` discriminator."""
    v = fv.select(F.lit("vendor").alias("Level"), "*", typed_null("bigint").alias("Brand"),
                  typed_null("bigint").alias("BrandCount"))
    b = fb.select(F.lit("brand").alias("Level"), "*", typed_null("bigint").alias("BrandCount"))
    return v.select(*FINAL_ALL_COLUMNS).unionByName(b.select(*FINAL_ALL_COLUMNS))


def final_vendor_enriched(vendor_summary: DataFrame, vss2: DataFrame, spend_named: DataFrame,
                          risk_flags: DataFrame) -> DataFrame:
    """T4c joined to T2 vendor totals, T5b brand count and T6a flags (COALESCE 0)."""
    t = vss2.groupBy("VendorNumber").agg(
        F.sum(SQ()).alias("TotalSalesQuantity"), F.sum(S()).alias("TotalSalesDollars"),
        F.sum(P()).alias("TotalPurchaseDollars"), F.sum(FR()).alias("FreightCost"))
    s = spend_named.select("VendorNumber", F.col("BrandCount").alias("_bc"))
    r = risk_flags
    neg = ["neg_SalesQty", "neg_SalesDol", "neg_PurchQty", "neg_PurchDol", "neg_Freight"]
    j = (vendor_summary.select("VendorNumber", "VendorName", "GrossProfit", "ProfitMargin", "TotalSalesDol")
         .join(t, "VendorNumber", "left").join(s, "VendorNumber", "left").join(r, "VendorNumber", "left"))
    return j.select("VendorNumber", "VendorName", "TotalSalesDollars", "TotalSalesQuantity",
                    "TotalPurchaseDollars", "FreightCost", "GrossProfit", "ProfitMargin",
                    F.coalesce("TotalSalesDol", F.lit(0.0)).alias("TotalSalesDol_in_summary"),
                    F.coalesce("_bc", F.lit(0)).alias("BrandCount"),
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in neg])


def final_brand_replicated(vss2: DataFrame, opps_all: DataFrame) -> DataFrame:
    """T2 left-joined to T10c (no purchase quantity)."""
    o = opps_all.select("VendorNumber", "Brand", "TargetMargin", "RequiredSalesDollars", "UpsideDollars",
                        "NeededPriceDeltaPerUnit")
    return (vss2.join(o, ["VendorNumber", "Brand"], "left")
                .select("VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
                        "TotalPurchaseDollars", "FreightCost", "GrossProfit",
                        F.col("ProfitMargin").alias("CurrentMargin"), "TargetMargin", "RequiredSalesDollars",
                        "UpsideDollars", "NeededPriceDeltaPerUnit"))


FINAL_ALL_B_COLUMNS = ["Level", "VendorNumber", "VendorName", "Brand", "TotalSalesDollars",
                       "TotalSalesQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit",
                       "ProfitMargin", "BrandCount", "TargetMargin", "RequiredSalesDollars", "UpsideDollars",
                       "NeededPriceDeltaPerUnit"]


def final_all_replicated(fv2: DataFrame, fb2: DataFrame) -> DataFrame:
    """Union keeping ProfitMargin and the vendor BrandCount."""
    v = fv2.select(F.lit("vendor").alias("Level"), "VendorNumber", "VendorName",
                   typed_null("string").alias("Brand"), "TotalSalesDollars", "TotalSalesQuantity",
                   "TotalPurchaseDollars", "FreightCost", "GrossProfit", "ProfitMargin", "BrandCount",
                   typed_null("double").alias("TargetMargin"), typed_null("double").alias("RequiredSalesDollars"),
                   typed_null("double").alias("UpsideDollars"),
                   typed_null("double").alias("NeededPriceDeltaPerUnit"))
    b = fb2.select(F.lit("brand").alias("Level"), "VendorNumber", "VendorName", "Brand", "TotalSalesDollars",
                   "TotalSalesQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit",
                   F.col("CurrentMargin").alias("ProfitMargin"), typed_null("bigint").alias("BrandCount"),
                   "TargetMargin", "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit")
    return v.unionByName(b)


# --------------------------------------------------------------------------- T14 / T15


def top_n(df: DataFrame, by: str, n: int = 10, ascending: bool = False, tiebreak=("VendorNumber",),
          columns=None, nulls_last: bool = True) -> DataFrame:
    """Ordered top-n with an explicit key tie-breaker (Spark plans TakeOrderedAndProject)."""
    c = F.col(by)
    if ascending:
        o = c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    else:
        o = c.desc_nulls_last() if nulls_last else c.desc_nulls_first()
    out = df.orderBy(o, *[F.col(t).asc() for t in tiebreak]).limit(n)
    return out.select(*columns) if columns else out
