"""Registered queries for the summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorlens.operators import summary as T
from vendorlens.plans import tables as tb
from vendorlens.plans.oracle import opps_sql, with_ctes
from vendorlens.plans.registry import register

MONEY = ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "GrossProfit")
T1F = MONEY + ("ProfitMargin",)
T2F = ("AvgPurchasePrice", "AvgActualPrice", "Volume", "AvgSalesPrice") + T1F + (
    "StockTurnover", "SalesToPurchaseRatio")
OPPF = ("TargetMargin", "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit")


def _sel(view, columns="*"):
    return with_ctes([view], f"SELECT {columns} FROM {view}")


_SOLD = "CAST(sum(SalesQuantity) AS BIGINT) AS TotalSalesQuantity, sum(SalesDollars) AS TotalSalesDollars"


# ---- T1 and its parts
register("T1_vendor_sales_summary", tb.vss, _sel("vss"), T1F,
         "brand summary with freight allocation (build variant)")
register("T1a_fanout_sales",
         lambda s, d: T.fanout_sales(tb.base(s, d).sales, tb.base(s, d).purchases),
         with_ctes(["lots"], f"SELECT VendorNumber, VendorName, Brand, {_SOLD} FROM lots GROUP BY ALL"), ("TotalSalesDollars",), "sales over the InventoryId fan-out join")
register("T1b_brand_purchases", lambda s, d: T.brand_purchases(tb.base(s, d).purchases),
         _sel("bought", "VendorNumber, Brand, CAST(units AS BIGINT) AS BrandPurchaseQuantity, paid AS BrandPurchaseDollars"),
         ("BrandPurchaseDollars",))
register("T1c_vendor_purchase_totals",
         lambda s, d: T.vendor_brand_purchase_totals(T.brand_purchases(tb.base(s, d).purchases)),
         _sel("bought", "DISTINCT VendorNumber, vendor_paid AS VendorBrandPurchDollars"), ("VendorBrandPurchDollars",))
register("T1d_invoice_by_vendor",
         lambda s, d: T.invoice_by_vendor(tb.base(s, d).vendor_invoice).select("VendorNumber", "Freight"),
         _sel("billed", "VendorNumber, freight AS Freight"), ("Freight",))

# ---- T2 family
register("T2_vendor_sales_summary_replicated", tb.vss2, _sel("vss2"), T2F,
         "brand rows with vendor purchases and freight repeated")
register("T2a_fanout_sales_avg",
         lambda s, d: T.fanout_sales(tb.base(s, d).sales, tb.base(s, d).purchases,
                                     vendor_keys=("VendorNumber",), with_avg_price=True),
         with_ctes(["lots"], f"SELECT VendorNumber, Brand, {_SOLD}, avg(SalesPrice) AS AvgSalesPrice FROM lots GROUP BY ALL"), ("TotalSalesDollars", "AvgSalesPrice"))
register("T2b_purchase_price_summary",
         lambda s, d: T.purchase_price_summary(tb.base(s, d).purchases, tb.base(s, d).purchase_prices),
         _sel("listed", "VendorNumber, VendorName, Brand, bid AS AvgPurchasePrice, ask AS AvgActualPrice, volume AS Volume"), ("AvgPurchasePrice", "AvgActualPrice", "Volume"))
register("T2c_invoice_totals",
         lambda s, d: T.invoice_totals_by_vendor(tb.base(s, d).vendor_invoice),
         _sel("billed", "VendorNumber, CAST(units AS BIGINT) AS TotalPurchaseQuantity, dollars AS TotalPurchaseDollars, "
              "freight AS FreightCost"), ("TotalPurchaseDollars", "FreightCost"))
register("T3_premerge_summary",
         lambda s, d: T.premerge_summary(*[getattr(tb.base(s, d), n) for n in
                                           ("sales", "purchases", "vendor_invoice", "purchase_prices")]),
         _sel("premerge"),
         ("PurchasePrice", "ActualPrice", "Volume", "TotalPurchaseQuantity", "TotalPurchaseDollars",
          "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax", "FreightCost"))

# ---- T4
register("T4a_vendor_rollup", tb.vsv, _sel("vsv"),
         ("TotalSalesDol_in_summary", "TotalPurchaseDol", "FreightCost", "GrossProfit", "ProfitMargin"))
register("T4b_vendor_rollup_trimmed", tb.vsv_b, _sel("vsv_b"),
         ("TotalSalesDol", "TotalPurchaseDol", "FreightCost", "GrossProfit", "ProfitMargin", "StockTurnover",
          "SalesToPurchaseRatio"))
register("T4c_vendor_rollup_avgs", tb.vsv_c, _sel("vsv_c"),
         ("TotalSalesDol", "TotalPurchaseDol", "FreightCost", "GrossProfit", "ProfitMargin", "AvgSalesPrice",
          "AvgPurchasePrice"))

# ---- T5 / T6
register("T5a_spend_by_vendor",
         lambda s, d: T.spend_by_vendor(tb.base(s, d).vendor_invoice, tb.vss(s, d)),
         _sel("spend"), ("TotalPurchaseDollars", "TotalSalesDollars"))
register("T5b_spend_by_vendor_named", lambda s, d: T.spend_by_vendor_named(tb.vss2(s, d)),
         _sel("spend_named"), MONEY + ("ProfitMargin", "SalesToPurchaseRatio"))
register("T5c_top_spend", lambda s, d: T.top_spend(tb.base(s, d).purchases, 20),
         with_ctes([], """SELECT VendorNumber AS vendor_id, VendorName AS vendor_name, SUM(Dollars) AS spend
FROM purchases GROUP BY VendorNumber, VendorName ORDER BY spend DESC, vendor_id, vendor_name LIMIT 20"""),
         ("spend",))
register("T6a_vendor_risk_flags", lambda s, d: T.vendor_risk_flags(tb.vss(s, d)), _sel("risk"))
register("T6b_vendor_kpi_flags", lambda s, d: T.vendor_kpi_flags(tb.vss2(s, d)), _sel("kpi_flags"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "ProfitMarginPct", "FreightSharePct",
          "SalesToPurchaseRatio", "StockTurnover"))

# ---- T7 / T8 / T9
register("T7a_brand_pricing", lambda s, d: T.brand_pricing(tb.vss(s, d)), _sel("bp"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost"))
DIAGF = T1F + ("SalesToPurchaseRatio", "StockTurnover", "FreightPct", "AvgUnitCost", "AvgUnitPrice",
               "UnitMargin", "UnitMarginPct")
register("T7b_brand_pricing_diagnostics", tb.diag, _sel("diag"), DIAGF)
register("T7c_lowest_margin_preview",
         lambda s, d: T.top_n(tb.diag(s, d), "ProfitMargin", 20, ascending=True,
                              tiebreak=("VendorNumber", "Brand", "VendorName")),
         with_ctes(["diag"], "SELECT * FROM diag ORDER BY ProfitMargin ASC NULLS LAST, VendorNumber, Brand, "
                             "VendorName LIMIT 20"), DIAGF)
register("T8_underperforming_brands", tb.underperf, _sel("underperf"), DIAGF)
register("T9_vendor_risk_summary", tb.risk_summary, _sel("risk_summary"),
         ("SalesAtRisk", "GrossProfit_FromBadBrands", "Freight_FromBadBrands", "AvgMargin_BadBrands",
          "MinMargin_BadBrands", "VendorTotalSales", "SalesAtRiskPct"))

# ---- T10
register("T10a_brand_pricing_opportunities", tb.opps, _sel("opps"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice") + OPPF)
register("T10a_target_050",
         lambda s, d: tb.opps(s, d, target=0.5),
         with_ctes(["bp"], f"SELECT * FROM ({opps_sql(0.5)}) o"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice") + OPPF)
register("T10b_pricing_opportunities_filtered",
         lambda s, d: T.pricing_opportunities_filtered(tb.vss2(s, d)), _sel("opps_b"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice", "CurrentMargin",
          "TargetMargin", "UpsideDollars", "NeededPriceDeltaPerUnit", "SuggestedPriceLiftPct",
          "SuggestedNewAvgPrice"))
register("T10c_pricing_opportunities_all",
         lambda s, d: T.pricing_opportunities_all(tb.vss2(s, d)), _sel("opps_c"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice", "CurrentMargin") + OPPF)

# ---- T11-T13
FINALF = MONEY + ("CurrentMargin",) + OPPF
register("T11a_final_vendor", tb.final_vendor, _sel("final_vendor"), FINALF)
register("T11b_final_vendor_enriched", tb.final_vendor_b, _sel("final_vendor_b"),
         MONEY + ("ProfitMargin", "TotalSalesDol_in_summary"))
register("T12a_final_brand", tb.final_brand, _sel("final_brand"), FINALF)
register("T12b_final_brand_replicated", tb.final_brand_b, _sel("final_brand_b"), FINALF)
register("T13a_final_all", tb.final_all, _sel("final_all"), FINALF)
register("T13b_final_all_replicated", tb.final_all_b, _sel("final_all_b"),
         MONEY + ("ProfitMargin",) + OPPF)

# ---- T14 / T15
TOPCOLS = ["VendorNumber", "VendorName", "GrossProfit", "ProfitMargin", "TotalSalesDol"]
BOTCOLS = ["VendorNumber", "VendorName", "ProfitMargin", "TotalSalesDol", "GrossProfit"]
register("T14a_top_vendors_by_grossprofit",
         lambda s, d: T.top_n(tb.vsv_c(s, d), "GrossProfit", 10, columns=TOPCOLS),
         with_ctes(["vsv_c"], f"SELECT {', '.join(TOPCOLS)} FROM vsv_c "
                              "ORDER BY GrossProfit DESC NULLS LAST, VendorNumber LIMIT 10"),
         ("GrossProfit", "ProfitMargin", "TotalSalesDol"))
register("T14b_bottom_vendors_by_margin",
         lambda s, d: T.top_n(tb.vsv_c(s, d), "ProfitMargin", 10, ascending=True, columns=BOTCOLS),
         with_ctes(["vsv_c"], f"SELECT {', '.join(BOTCOLS)} FROM vsv_c "
                              "ORDER BY ProfitMargin ASC NULLS LAST, VendorNumber LIMIT 10"),
         ("GrossProfit", "ProfitMargin", "TotalSalesDol"))
register("T14a_build_top_vendors",
         lambda s, d: T.top_n(tb.vsv(s, d), "GrossProfit", 10,
                              columns=["VendorNumber", "VendorName", "GrossProfit", "ProfitMargin",
                                       "TotalSalesDol_in_summary"]),
         with_ctes(["vsv"], "SELECT VendorNumber, VendorName, GrossProfit, ProfitMargin, TotalSalesDol_in_summary "
                            "FROM vsv ORDER BY GrossProfit DESC NULLS LAST, VendorNumber LIMIT 10"),
         ("GrossProfit", "ProfitMargin", "TotalSalesDol_in_summary"))
register("T15a_final_vendor_preview",
         lambda s, d: T.top_n(tb.final_vendor(s, d), "GrossProfit", 10),
         with_ctes(["final_vendor"], "SELECT * FROM final_vendor ORDER BY GrossProfit DESC NULLS LAST, "
                                     "VendorNumber LIMIT 10"), FINALF)
register("T15b_final_brand_upside_preview",
         lambda s, d: (tb.final_brand(s, d).withColumn("_u", F.coalesce("UpsideDollars", F.lit(0.0)))
                       .transform(lambda x: T.top_n(x, "_u", 10, tiebreak=("VendorNumber", "Brand", "VendorName")))
                       .drop("_u")),
         with_ctes(["final_brand"], "SELECT * FROM final_brand ORDER BY coalesce(UpsideDollars, 0) DESC, "
                                    "VendorNumber, Brand, VendorName LIMIT 10"), FINALF)
register("T15c_risk_summary_preview",
         lambda s, d: T.top_n(tb.risk_summary(s, d), "SalesAtRisk", 15),
         with_ctes(["risk_summary"], "SELECT * FROM risk_summary ORDER BY SalesAtRisk DESC NULLS LAST, "
                                     "VendorNumber LIMIT 15"),
         ("SalesAtRisk", "GrossProfit_FromBadBrands", "Freight_FromBadBrands", "AvgMargin_BadBrands",
          "MinMargin_BadBrands", "VendorTotalSales", "SalesAtRiskPct"))


def _preview(name, frame, view, order, n, floats):
    """The first ``n`` rows of a table in its order (SQL order terms), keys breaking ties."""
    terms = [t.rsplit(" ", 1) if t.endswith((" DESC", " ASC")) else (t, "ASC") for t in order]

    def first(spark, sf_dir):
        cols = [F.col(c).desc_nulls_last() if d == "DESC" else F.col(c).asc_nulls_last() for c, d in terms]
        return frame(spark, sf_dir).orderBy(*cols).limit(n)

    register(name, first, with_ctes([view], f"SELECT * FROM {view} ORDER BY " + ", ".join(
        f"{c} {d} NULLS LAST" for c, d in terms) + f" LIMIT {n}"), floats)


_KEYS = ["VendorNumber", "Brand", "VendorName"]
_preview("T15d_underperforming_preview", tb.underperf, "underperf",
         ["VendorNumber", "ProfitMargin ASC", "FreightPct DESC", "Brand", "VendorName"], 20, DIAGF)
_preview("T15e_opportunities_preview", lambda s, d: T.pricing_opportunities_filtered(tb.vss2(s, d)), "opps_b",
         ["UpsideDollars DESC", "CurrentMargin ASC", *_KEYS], 20,
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "AvgSalesPrice", "CurrentMargin", "TargetMargin",
          "UpsideDollars", "NeededPriceDeltaPerUnit", "SuggestedPriceLiftPct", "SuggestedNewAvgPrice"))
_preview("T15f_kpi_flags_preview", lambda s, d: T.vendor_kpi_flags(tb.vss2(s, d)), "kpi_flags",
         ["ProfitMarginPct ASC", "FreightSharePct DESC", "VendorNumber", "VendorName"], 20,
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "ProfitMarginPct", "FreightSharePct",
          "SalesToPurchaseRatio", "StockTurnover"))
_preview("T15g_spend_preview", lambda s, d: T.spend_by_vendor_named(tb.vss2(s, d)), "spend_named",
         ["GrossProfit DESC", "VendorNumber", "VendorName"], 15, MONEY + ("ProfitMargin", "SalesToPurchaseRatio"))
