"""End-to-end table builds: the reference's batch build (E1) and notebook chain.

``build_final_tables`` writes T1 once (it has five consumers), then derives the rest
from the written copy, so every later step reads Parquet instead of re-running the
fan-out join, and an executor loss only re-runs the step in flight. Output goes to
``out_dir`` (a shared folder on a cluster); CSV exports are optional.

Dependency order: {sales, purchases, vendor_invoice} -> T1 -> {T4a, T5a, T6a, T7a};
T7a -> T10a; T4a -> T11a; T1 + T10a -> T12a; T11a + T12a -> T13a.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendorlens.operators import summary as T
from vendorlens.sources.files import export_csvs, ingest
from vendorlens.sources.tpch import BaseTables

# The build's export list, in the reference's order.
BUILD_TABLES = ["vendor_sales_summary", "vendor_summary_by_vendor", "spend_by_vendor", "vendor_risk_flags",
                "brand_pricing", "brand_pricing_opportunities", "final_vendor", "final_brand", "final_all"]


#: The keys that order the rows of an exported table.
EXPORT_ORDER = {n: ["VendorNumber", "VendorName", "Brand"] for n in
                ("vendor_sales_summary", "brand_pricing", "brand_pricing_opportunities", "final_brand")}
EXPORT_ORDER |= {n: ["VendorNumber", "VendorName"] for n in ("vendor_summary_by_vendor", "final_vendor")}
EXPORT_ORDER |= {n: ["VendorNumber"] for n in ("spend_by_vendor", "vendor_risk_flags")}
EXPORT_ORDER["final_all"] = ["Level", "VendorNumber", "VendorName", "Brand"]


def build_final_tables(spark: SparkSession, base: BaseTables, out_dir: str, target: float = 0.35,
                       csv_dir: str | None = None) -> dict[str, DataFrame]:
    """The nine build tables, each written under ``out_dir`` and registered as a view."""
    root = out_dir.rstrip("/")
    t = {}

    def put(name, df):
        t[name] = ingest(df, name, f"{root}/{name}")

    put("vendor_sales_summary", T.vendor_sales_summary(base.sales, base.purchases, base.vendor_invoice))
    vss = t["vendor_sales_summary"]
    put("vendor_summary_by_vendor", T.vendor_rollup(vss))
    put("spend_by_vendor", T.spend_by_vendor(base.vendor_invoice, vss))
    put("vendor_risk_flags", T.vendor_risk_flags(vss))
    put("brand_pricing", T.brand_pricing(vss))
    put("brand_pricing_opportunities", T.brand_pricing_opportunities(t["brand_pricing"], target))
    put("final_vendor", T.final_vendor(t["vendor_summary_by_vendor"]))
    put("final_brand", T.final_brand(vss, t["brand_pricing_opportunities"]))
    put("final_all", T.final_all(t["final_vendor"], t["final_brand"]))
    if csv_dir:
        export_csvs({n: t[n] for n in BUILD_TABLES}, csv_dir, EXPORT_ORDER)
    return t


def build_notebook_tables(spark: SparkSession, base: BaseTables, out_dir: str,
                          target: float = 0.35) -> dict[str, DataFrame]:
    """The notebook chain (replicated variant T2 and its dependants), written like E1."""
    root = out_dir.rstrip("/") + "/notebook"
    t = {}

    def put(name, df):
        t[name] = ingest(df, f"nb_{name}", f"{root}/{name}")

    put("premerge_summary", T.premerge_summary(base.sales, base.purchases, base.vendor_invoice, base.purchase_prices))
    put("vendor_sales_summary", T.vendor_sales_summary_replicated(base.sales, base.purchases, base.vendor_invoice,
                                                                  base.purchase_prices))
    v2 = t["vendor_sales_summary"]
    put("vendor_summary_by_vendor", T.vendor_rollup_avgs(v2))
    put("top_vendors_by_grossprofit", T.top_n(t["vendor_summary_by_vendor"], "GrossProfit", 10,
                                              columns=["VendorNumber", "VendorName", "GrossProfit", "ProfitMargin",
                                                       "TotalSalesDol"]))
    put("bottom_vendors_by_margin", T.top_n(t["vendor_summary_by_vendor"], "ProfitMargin", 10, ascending=True,
                                            columns=["VendorNumber", "VendorName", "ProfitMargin", "TotalSalesDol",
                                                     "GrossProfit"]))
    put("brand_pricing", T.brand_pricing_diagnostics(v2))
    put("underperforming_brands", T.underperforming_brands(t["brand_pricing"]))
    put("vendor_risk_summary", T.vendor_risk_summary(t["underperforming_brands"], t["vendor_summary_by_vendor"]))
    put("pricing_opportunities_filtered", T.pricing_opportunities_filtered(v2, target))
    put("vendor_kpi_flags", T.vendor_kpi_flags(v2))
    put("spend_by_vendor", T.spend_by_vendor_named(v2))
    put("vendor_risk_flags", T.vendor_risk_flags(v2))
    put("brand_pricing_opportunities", T.pricing_opportunities_all(v2, target))
    put("final_vendor", T.final_vendor_enriched(t["vendor_summary_by_vendor"], v2, t["spend_by_vendor"],
                                                t["vendor_risk_flags"]))
    put("final_brand", T.final_brand_replicated(v2, t["brand_pricing_opportunities"]))
    put("final_all", T.final_all_replicated(t["final_vendor"], t["final_brand"]))
    return t
