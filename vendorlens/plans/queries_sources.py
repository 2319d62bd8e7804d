"""Registered queries for sources, sinks and catalog helpers.

File round trips write under a fresh folder of the session's checkpoint location
(a shared folder on a cluster), derived from the driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vendorlens.operators import summary as T
from vendorlens.plans import tables as tb
from vendorlens.plans.build import BUILD_TABLES, EXPORT_ORDER, build_final_tables
from vendorlens.plans.oracle import with_ctes
from vendorlens.plans.registry import register
from vendorlens.session import checkpoint_dir, stored
from vendorlens.sources import files as S
from vendorlens.sources.versions import read_table
from vendorlens.streaming.ingest import run_ingest


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex[:12]}"


BASE_COLS = {n: [c.split()[0] for c in s.split(", ")] for n, s in S.BASE_SCHEMAS.items()}


def _s1(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    root = _scratch(spark)
    S.export_csvs({"purchases": b.purchases, "sales": b.sales, "vendor_invoice": b.vendor_invoice,
                   "purchase_prices": b.purchase_prices}, f"{root}/raw")
    return S.load_raw_data(spark, f"{root}/raw", f"{root}/tables")


register("S1_load_raw_data", _s1, with_ctes([], "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows, {len(BASE_COLS[n])} AS columns, 'ok' AS status, "
    f"CAST(NULL AS VARCHAR) AS error FROM {n}" for n in ["purchases", "sales", "vendor_invoice", "purchase_prices"])))


def _s1b(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    root = _scratch(spark)
    S.export_csvs({"purchases": b.purchases}, f"{root}/drop")
    return run_ingest(spark, f"{root}/drop/purchases.csv", "purchases", f"{root}/purchases")


register("S1b_stream_ingest", _s1b, with_ctes([], "SELECT * FROM purchases"), ("PurchasePrice", "Dollars"))

# The columns of the nine build tables, in order.
_T1 = ["VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars", "TotalPurchaseQuantity",
       "TotalPurchaseDollars", "FreightCost", "GrossProfit", "ProfitMargin"]
BUILD_COLUMNS = {
    "vendor_sales_summary": ("vss", _T1),
    "vendor_summary_by_vendor": ("vsv", ["VendorNumber", "VendorName", "TotalSalesDol_in_summary", "TotalSalesQty",
                                         "TotalPurchaseDol", "TotalPurchaseQty", "FreightCost", "GrossProfit",
                                         "ProfitMargin", "BrandCount"]),
    "spend_by_vendor": ("spend", ["VendorNumber", "TotalPurchaseDollars", "TotalSalesDollars"]),
    "vendor_risk_flags": ("risk", ["VendorNumber", "neg_SalesQty", "neg_SalesDol", "neg_PurchQty", "neg_PurchDol",
                                   "neg_Freight"]),
    "brand_pricing": ("bp", ["VendorNumber", "VendorName", "Brand", "TotalSalesQuantity", "TotalSalesDollars",
                             "TotalPurchaseDollars", "FreightCost"]),
    "brand_pricing_opportunities": ("opps", ["VendorNumber", "VendorName", "Brand", "TotalSalesQuantity",
                                             "TotalSalesDollars", "TotalPurchaseDollars", "FreightCost",
                                             "AvgSalesPrice", "TargetMargin", "RequiredSalesDollars",
                                             "UpsideDollars", "NeededPriceDeltaPerUnit"]),
    "final_vendor": ("final_vendor", ["VendorNumber", "VendorName", "TotalSalesDollars", "TotalSalesQuantity",
                                      "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost", "GrossProfit",
                                      "CurrentMargin", "TargetMargin", "RequiredSalesDollars", "UpsideDollars",
                                      "NeededPriceDeltaPerUnit"]),
    "final_brand": ("final_brand", ["VendorNumber", "VendorName", "Brand", "TotalSalesDollars",
                                    "TotalSalesQuantity", "TotalPurchaseDollars", "TotalPurchaseQuantity",
                                    "FreightCost", "GrossProfit", "CurrentMargin", "TargetMargin",
                                    "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]),
    "final_all": ("final_all", ["Level", "VendorNumber", "VendorName", "Brand", "TotalSalesDollars",
                                "TotalSalesQuantity", "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost",
                                "GrossProfit", "CurrentMargin", "BrandCount", "TargetMargin",
                                "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]),
}


def _s13(spark, sf_dir):
    root = _scratch(spark)
    build_final_tables(spark, tb.base(spark, sf_dir), out_dir=f"{root}/tables", csv_dir=f"{root}/csv")
    return S.validate_exports(spark, f"{root}/csv")


register("S13_export_validation", _s13, with_ctes([v for v, _ in BUILD_COLUMNS.values()], "\nUNION ALL\n".join(
    f"SELECT '{n}' AS file, '{c}' AS \"column\", count(*) AS rows, {len(cols)} AS columns, "
    f"count_if({c} IS NULL) AS nulls, 'ok' AS status FROM {v}"
    for n, (v, cols) in BUILD_COLUMNS.items() for c in cols)))


def _s13b(spark, sf_dir):
    root = _scratch(spark)
    build_final_tables(spark, tb.base(spark, sf_dir), out_dir=f"{root}/tables", csv_dir=f"{root}/csv")
    rows = S.first_rows(spark, f"{root}/csv")
    text = F.col("column").isin(*SAMPLE_TEXT)  # numbers are compared as numbers, not by how an engine prints them
    return rows.select("file", "row", "column", F.when(text, F.col("value")).alias("text"),
                       F.when(~text, F.col("value").try_cast("double")).alias("number"))


SAMPLE_TEXT = ("VendorName", "Level")
_SAMPLES = []
for _n, (_v, _cols) in BUILD_COLUMNS.items():
    _keys = ", ".join(f"{k} NULLS FIRST" for k in EXPORT_ORDER[_n])
    _SAMPLES += [f"""SELECT '{_n}' AS file, CAST(r AS INTEGER) AS "row", '{c}' AS "column", {f'CAST({c} AS VARCHAR)' if c in SAMPLE_TEXT else 'NULL'} AS text,
       {'NULL' if c in SAMPLE_TEXT else f'CAST({c} AS DOUBLE)'} AS number FROM (SELECT *, row_number() OVER (ORDER BY {_keys}) AS r FROM {_v}) WHERE r <= 3"""
                 for c in _cols]
register("S13b_export_sample_rows", _s13b, with_ctes([v for v, _ in BUILD_COLUMNS.values()], "\nUNION ALL\n".join(_SAMPLES)), ("number",))


def _s12(spark, sf_dir):
    """The insight tables are written and read again by their path, as another session would."""
    root = _scratch(spark)
    rollup = stored(tb.vsv_c(spark, sf_dir), "rollup")
    cols = ["VendorNumber", "VendorName", "GrossProfit", "ProfitMargin", "TotalSalesDol"]
    S.ingest(T.top_n(rollup, "GrossProfit", 10, columns=cols), "top_vendors_by_grossprofit", f"{root}/top_vendors_by_grossprofit")
    S.ingest(T.top_n(rollup, "ProfitMargin", 10, ascending=True, columns=cols), "bottom_vendors_by_margin",
             f"{root}/bottom_vendors_by_margin")
    parts = [read_table(spark, f"{root}/{n}").select(F.lit(n).alias("table"), *cols)
             for n in ("top_vendors_by_grossprofit", "bottom_vendors_by_margin")]
    return parts[0].unionByName(parts[1])


register("S12_persisted_insights", _s12, with_ctes(["vsv_c"], """
SELECT * FROM (SELECT 'top_vendors_by_grossprofit' AS "table", VendorNumber, VendorName, GrossProfit, ProfitMargin, TotalSalesDol
               FROM vsv_c ORDER BY GrossProfit DESC, VendorNumber LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'bottom_vendors_by_margin', VendorNumber, VendorName, GrossProfit, ProfitMargin, TotalSalesDol
               FROM vsv_c ORDER BY ProfitMargin, VendorNumber LIMIT 10)"""), ("GrossProfit", "ProfitMargin", "TotalSalesDol"))


def _s7(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    return S.table_counts({"purchases": b.purchases, "sales": b.sales, "vendor_invoice": b.vendor_invoice,
                           "purchase_prices": b.purchase_prices, "vendor_sales_summary": tb.vss(spark, sf_dir)})


register("S7_table_counts", _s7, with_ctes(["vss"], "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {v}" for n, v in
    [("purchases", "purchases"), ("sales", "sales"), ("vendor_invoice", "vendor_invoice"),
     ("purchase_prices", "purchase_prices"), ("vendor_sales_summary", "vss")])))


_INVOICE = "VendorNumber, PONumber, Quantity, Dollars, Freight"
register("S7b_invoice_preview", lambda s, d: S.preview(tb.base(s, d).vendor_invoice, ["VendorNumber", "PONumber"]),
         with_ctes([], f"SELECT {_INVOICE} FROM vendor_invoice ORDER BY {_INVOICE} LIMIT 5"), ("Dollars", "Freight"))


def _s8(spark, sf_dir):
    root = f"{_scratch(spark)}/tables"
    build_final_tables(spark, tb.base(spark, sf_dir), out_dir=root)
    return S.written_counts(spark, {n: f"{root}/{n}" for n in BUILD_TABLES})


register("S8_row_count_audit", _s8, with_ctes([v for v, _ in BUILD_COLUMNS.values()], "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {v}" for n, (v, _) in BUILD_COLUMNS.items())))
register("S11_analysis_scan", tb.analysis_frame, with_ctes(["s11"], "SELECT * FROM s11 ORDER BY TotalSalesDollars DESC"),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "GrossProfit", "CurrentMargin", "TargetMargin",
          "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"))
register("S14_key_coverage", lambda s, d: S.key_coverage(tb.vss(s, d), tb.final_vendor(s, d), tb.final_brand(s, d)),
         with_ctes(["vss", "final_vendor", "final_brand"], """
SELECT (SELECT count(DISTINCT VendorNumber) FROM vss) AS summary_vendors,
       (SELECT count(DISTINCT Brand) FROM vss) AS summary_brands,
       (SELECT count(DISTINCT VendorNumber) FROM final_vendor) AS final_vendors,
       (SELECT count(DISTINCT Brand) FROM final_brand) AS final_brands"""))
register("S15_sample_rows", lambda s, d: S.sample_rows(tb.final_all(s, d), 5000, 0, ("Level", "VendorNumber", "Brand")),
         with_ctes(["final_all"], """
SELECT * FROM final_all ORDER BY md5(concat_ws('|', '0', coalesce(CAST(Level AS VARCHAR), ''),
                                               coalesce(CAST(VendorNumber AS VARCHAR), ''),
                                               coalesce(CAST(Brand AS VARCHAR), ''))) LIMIT 5000"""),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "GrossProfit", "CurrentMargin", "TargetMargin",
          "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"))
