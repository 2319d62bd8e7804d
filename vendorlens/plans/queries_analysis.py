"""Registered queries for data quality, KPIs, distributions and inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorlens.operators import distribution as D
from vendorlens.operators import inference as H
from vendorlens.operators import kpi as A
from vendorlens.operators import quality as Q
from vendorlens.operators import summary as T
from vendorlens.plans import tables as tb
from vendorlens.plans.oracle import avg_rank_pct_sql, cte, exact_quantile_sql, with_ctes
from vendorlens.functions.expr import canon, canon_sql
from vendorlens.plans.registry import register


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# =============================================================================== Q: quality
Q2_COLS = {"nn_VendorNumber": "VendorNumber", "nn_VendorName": "VendorName", "nn_Brand": "Brand",
           "nn_TotalSalesDol": "TotalSalesDollars", "nn_TotalPurchaseDol": "TotalPurchaseDollars",
           "nn_TotalSalesQty": "TotalSalesQuantity", "nn_TotalPurchaseQty": "TotalPurchaseQuantity",
           "nn_Freight": "FreightCost"}
register("Q2_null_counts", lambda s, d: Q.null_counts(tb.vss2(s, d), Q2_COLS),
         with_ctes(["vss2"], "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {n}" for n, c in Q2_COLS.items())
                   + " FROM vss2"))
Q3_COLS = {"neg_SalesQty": "TotalSalesQuantity", "neg_SalesDol": "TotalSalesDollars",
           "neg_PurchQty": "TotalPurchaseQuantity", "neg_PurchDol": "TotalPurchaseDollars", "neg_Freight": "FreightCost"}
register("Q3_negative_counts", lambda s, d: Q.negative_counts(tb.vss2(s, d), Q3_COLS),
         with_ctes(["vss2"], "SELECT " + ", ".join(f"count_if({c} < 0) AS {n}" for n, c in Q3_COLS.items())
                   + " FROM vss2"))
Q3B_COLS = {f"neg_{c}": c for c in ["TotalSalesQuantity", "TotalSalesDollars", "TotalPurchaseDollars",
                                    "FreightCost", "GrossProfit"]}
register("Q3b_negative_counts_analysis", lambda s, d: Q.negative_counts(tb.sold_frame(s, d), Q3B_COLS),
         with_ctes(["s11"], "SELECT " + ", ".join(f"count_if({c} < 0) AS {n}" for n, c in Q3B_COLS.items())
                   + " FROM s11"))
from vendorlens.operators.summary import FINAL_ALL_COLUMNS as _FA  # noqa: E402

register("Q4_null_report", lambda s, d: Q.null_report(tb.sold_frame(s, d)), with_ctes(["s11"], f"""
SELECT "column", na_cnt FROM (
  {_union([f"SELECT '{c}' AS \"column\", {i} AS position, count_if({c} IS NULL) AS na_cnt FROM s11"
           for i, c in enumerate(_FA)])}) x
ORDER BY na_cnt DESC, position LIMIT 20"""))
_NUM_FA = ["VendorNumber", "Brand", "TotalSalesDollars", "TotalSalesQuantity", "TotalPurchaseDollars",
           "TotalPurchaseQuantity", "FreightCost", "GrossProfit", "CurrentMargin", "BrandCount", "TargetMargin",
           "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]
_DESC_F = ("mean", "std", "min", "p25", "p50", "p75", "max")
register("Q5_describe", lambda s, d: Q.describe(tb.sold_frame(s, d)), with_ctes(["s11"], _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg(CAST({c} AS DOUBLE)) AS mean,
       stddev_samp(CAST({c} AS DOUBLE)) AS std, min(CAST({c} AS DOUBLE)) AS min,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
       quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, max(CAST({c} AS DOUBLE)) AS max FROM s11"""
    for c in _NUM_FA])), _DESC_F)
register("Q6_shape", lambda s, d: Q.shape(tb.vss2(s, d)),
         with_ctes(["vss2"], "SELECT count(*) AS rows, CAST(16 AS BIGINT) AS cols FROM vss2"))
register("Q7_duplicate_keys_by_level", lambda s, d: Q.duplicate_keys_by_level(tb.final_all(s, d)),
         with_ctes(["final_all"], """
SELECT (SELECT coalesce(CAST(SUM(c - 1) AS BIGINT), 0) FROM (SELECT count(*) AS c FROM final_all
         WHERE Level = 'vendor' GROUP BY VendorNumber) v) AS dup_vendor_rows,
       (SELECT coalesce(CAST(SUM(c - 1) AS BIGINT), 0) FROM (SELECT count(*) AS c FROM final_all
         WHERE Level = 'brand' GROUP BY VendorNumber, Brand) b) AS dup_brand_rows"""))
register("Q8_duplicate_keys", lambda s, d: Q.duplicate_keys(tb.vss2(s, d)), with_ctes(["vss2"], """
SELECT VendorNumber, Brand, count(*) AS rows_per_key FROM vss2 GROUP BY 1, 2 HAVING count(*) > 1
ORDER BY rows_per_key DESC, VendorNumber, Brand"""))
register("Q9_validate_data_quality", lambda s, d: Q.validate_data_quality(tb.sold_frame(s, d)),
         with_ctes(["s11"], _union(
             ["SELECT 'shape_rows' AS \"check\", '' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM s11",
              f"SELECT 'shape_cols', '', {float(len(_FA))!r}"]
             + [f"SELECT 'missing', '{c}', CAST(count_if({c} IS NULL) AS DOUBLE) FROM s11" for c in _FA]
             + [f"SELECT 'negative', '{c}', CAST(count_if({c} < 0) AS DOUBLE) FROM s11" for c in Q.FINANCIAL]
             + ["""SELECT 'extreme_unit_price', 'unit_price', CAST(count_if(u > 1000.0) AS DOUBLE) FROM
                   (SELECT CASE WHEN TotalSalesQuantity > 0 THEN TotalPurchaseDollars / TotalSalesQuantity END AS u
                    FROM s11) x""",
                """SELECT 'unit_price_q99', 'unit_price', quantile_cont(u, 0.99) FROM
                   (SELECT CASE WHEN TotalSalesQuantity > 0 THEN TotalPurchaseDollars / TotalSalesQuantity END AS u
                    FROM s11) x"""])), ("value",))
_FB_F = ("totalsalesdollars", "totalpurchasedollars", "freightcost", "grossprofit", "currentmargin", "targetmargin",
         "requiredsalesdollars", "upsidedollars", "neededpricedeltaperunit")
register("Q10_clean_brand_df", lambda s, d: Q.clean_brand_df(tb.final_brand(s, d)), with_ctes(["final_brand"], """
SELECT VendorNumber AS vendornumber, VendorName AS vendorname, coalesce(CAST(Brand AS VARCHAR), 'UNKNOWN') AS brand,
       TotalSalesDollars AS totalsalesdollars, TotalSalesQuantity AS totalsalesquantity,
       TotalPurchaseDollars AS totalpurchasedollars, TotalPurchaseQuantity AS totalpurchasequantity,
       FreightCost AS freightcost, GrossProfit AS grossprofit, CurrentMargin AS currentmargin,
       TargetMargin AS targetmargin, RequiredSalesDollars AS requiredsalesdollars, UpsideDollars AS upsidedollars,
       NeededPriceDeltaPerUnit AS neededpricedeltaperunit
FROM final_brand
WHERE TotalSalesDollars > 0 AND TotalSalesQuantity > 0 AND TargetMargin IS NOT NULL
  AND RequiredSalesDollars IS NOT NULL AND UpsideDollars IS NOT NULL AND NeededPriceDeltaPerUnit IS NOT NULL
  AND NOT isinf(TargetMargin) AND NOT isinf(RequiredSalesDollars) AND NOT isinf(UpsideDollars)
  AND NOT isinf(NeededPriceDeltaPerUnit)"""), _FB_F)
_FA_F = ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "GrossProfit", "CurrentMargin", "TargetMargin",
         "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit")
register("Q11_prepare_vendor_data", tb.vendor_frame, with_ctes(["vframe"], "SELECT * FROM vframe"), _FA_F)
_B12_F = ("TotalSalesDollars", "TotalSalesQuantity", "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost",
          "GrossProfit", "CurrentMargin", "TargetMargin", "RequiredSalesDollars", "UpsideDollars",
          "NeededPriceDeltaPerUnit", "StockTurnover")
register("Q12_load_brand_df", tb.brand_frame, with_ctes(["brand12"], "SELECT * FROM brand12"), _B12_F)
register("Q13_plotting_base", tb.plot_frame, with_ctes(["q13"], "SELECT * FROM q13"), _FA_F)
register("Q14_purchase_reconciliation",
         lambda s, d: Q.purchase_reconciliation(tb.base(s, d).vendor_invoice, tb.brand_pricing(s, d)),
         with_ctes(["bp"], """
SELECT any_value(x) FILTER (k = 'vi') AS vi_purch, any_value(x) FILTER (k = 'bp') AS bp_purch, bp_purch / nullif(vi_purch, 0) AS ratio
FROM (SELECT 'vi' AS k, sum(Dollars) AS x FROM vendor_invoice UNION ALL SELECT 'bp', sum(TotalPurchaseDollars) FROM bp)
"""), ("vi_purch", "bp_purch", "ratio"))
register("Q15_vendor_inflation",
         lambda s, d: Q.vendor_inflation(tb.base(s, d).vendor_invoice, tb.brand_pricing(s, d)),
         with_ctes(["bp"], """
SELECT b.VendorNumber, b.bp_purch, coalesce(v.vi, 0.0) AS vi_purch, b.brand_count,
       CASE WHEN v.vi > 0 THEN round(b.bp_purch * 1.0 / v.vi, 2) END AS ratio
FROM (SELECT VendorNumber, SUM(TotalPurchaseDollars) AS bp_purch, COUNT(DISTINCT Brand) AS brand_count
      FROM bp GROUP BY VendorNumber) b
LEFT JOIN (SELECT VendorNumber, SUM(Dollars) AS vi FROM vendor_invoice GROUP BY VendorNumber) v
  ON v.VendorNumber = b.VendorNumber
ORDER BY ratio DESC NULLS LAST, VendorNumber LIMIT 15"""), ("bp_purch", "vi_purch", "ratio"))
register("Q16_brand_purchase_preview",
         lambda s, d: T.brand_purchases(tb.base(s, d).purchases).select("VendorNumber", "Brand", "BrandPurchaseDollars")
         .orderBy("VendorNumber", "Brand").limit(20),
         with_ctes(["bought"], "SELECT VendorNumber, Brand, paid AS BrandPurchaseDollars FROM bought "
                              "ORDER BY VendorNumber, Brand LIMIT 20"), ("BrandPurchaseDollars",))
register("Q17_canonical_vendor_columns", lambda s, d: A.canonical_vendor_columns(tb.vsv(s, d)), with_ctes(["vsv"], """
SELECT VendorNumber, VendorName, TotalSalesDol_in_summary AS TotalSalesDollars, TotalSalesQty,
       TotalPurchaseDol AS TotalPurchaseDollars, TotalPurchaseQty, FreightCost, GrossProfit,
       ProfitMargin AS CurrentMargin, BrandCount FROM vsv"""),
         ("TotalSalesDollars", "TotalPurchaseDollars", "FreightCost", "GrossProfit", "CurrentMargin"))
register("Q18_health_check", lambda s, d: Q.health_check(s, {"final_all": tb.final_all(s, d)}),
         with_ctes(["final_all"], "SELECT 'final_all' AS \"table\", count(*) AS rows, count(*) > 0 AS healthy "
                                  "FROM final_all"))

# =============================================================================== A: KPIs
register("A1_snapshot", lambda s, d: A.snapshot(tb.vendor_frame(s, d)), with_ctes(["vframe"], """
SELECT count(DISTINCT VendorNumber) AS vendors_total, SUM(TotalSalesDollars) AS total_sales_dollars,
       CAST(SUM(TotalSalesQuantity) AS BIGINT) AS total_units_sold, avg(CurrentMargin) AS avg_margin FROM vframe"""),
         ("total_sales_dollars", "avg_margin"))
register("A2_weighted_margin", lambda s, d: A.weighted_margin(tb.vendor_frame(s, d)), with_ctes(["vframe"], """
SELECT SUM(GrossProfit) / SUM(TotalSalesDollars) * 100 AS weighted_margin, count(*) AS rows_used
FROM vframe WHERE TotalSalesDollars > 0"""), ("weighted_margin",))
register("A3_totals_reconciliation", lambda s, d: A.totals_reconciliation(tb.vendor_frame(s, d)),
         with_ctes(["vframe"], """
, t AS (SELECT SUM(TotalSalesDollars) AS s, SUM(TotalPurchaseDollars) AS p, SUM(FreightCost) AS f,
                  SUM(GrossProfit) AS g, count_if(GrossProfit < 0) AS neg, count_if(TotalSalesDollars <= 0) AS nonpos
           FROM vframe)
SELECT 'TotalSalesDollars' AS metric, s AS value FROM t UNION ALL SELECT 'TotalPurchaseDollars', p FROM t
UNION ALL SELECT 'FreightCost', f FROM t UNION ALL SELECT 'GrossProfit', g FROM t
UNION ALL SELECT 'calc_gp', s - p - f FROM t
UNION ALL SELECT 'overall_margin_pct', CASE WHEN s <> 0 THEN g / s END * 100 FROM t
UNION ALL SELECT 'rows_gp_negative', CAST(neg AS DOUBLE) FROM t
UNION ALL SELECT 'rows_sales_nonpositive', CAST(nonpos AS DOUBLE) FROM t"""),
         ("value",))
register("A4_top_brands_by_upside", lambda s, d: A.top_brands_by_upside(tb.final_brand(s, d)),
         with_ctes(["final_brand"], """
SELECT VendorNumber, VendorName, Brand, CurrentMargin, UpsideDollars, NeededPriceDeltaPerUnit, TotalSalesDollars,
       TotalSalesQuantity, VendorName || ' • ' || CAST(Brand AS VARCHAR) AS label
FROM final_brand WHERE UpsideDollars > 0 AND TotalSalesDollars > 0 AND TotalSalesQuantity > 0
ORDER BY UpsideDollars DESC, VendorNumber, Brand, VendorName LIMIT 15"""),
         ("CurrentMargin", "UpsideDollars", "NeededPriceDeltaPerUnit", "TotalSalesDollars"))
register("A5_vendor_upside", lambda s, d: A.vendor_upside(tb.final_brand(s, d)), with_ctes(["final_brand"], """
SELECT VendorNumber, VendorName, SUM(UpsideDollars) AS UpsideDollars FROM final_brand
WHERE UpsideDollars > 0 AND TotalSalesDollars > 0 AND TotalSalesQuantity > 0
GROUP BY VendorNumber, VendorName ORDER BY UpsideDollars DESC, VendorNumber, VendorName LIMIT 15"""),
         ("UpsideDollars",))
register("A6_pricing_fix_points", lambda s, d: A.pricing_fix_points(tb.final_brand(s, d)),
         with_ctes(["final_brand"], """
SELECT VendorNumber, VendorName, Brand, CurrentMargin, NeededPriceDeltaPerUnit, UpsideDollars FROM final_brand
WHERE TotalSalesQuantity > 0 AND UpsideDollars > 0"""), ("CurrentMargin", "NeededPriceDeltaPerUnit", "UpsideDollars"))
_CB_F = ("UpsideDollars", "TotalSalesDollars", "CurrentMargin", "NeededPriceDeltaPerUnit")
register("A7_top_brands_in_top_vendors", lambda s, d: A.top_brands_in_top_vendors(tb.final_brand(s, d)),
         with_ctes(["cbrand"], """
SELECT VendorName, Brand, UpsideDollars, TotalSalesDollars, CurrentMargin, NeededPriceDeltaPerUnit FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c.VendorName ORDER BY c.UpsideDollars DESC, c.Brand) AS rn
  FROM cbrand c SEMI JOIN (SELECT VendorName FROM cbrand GROUP BY VendorName
                           ORDER BY SUM(UpsideDollars) DESC, VendorName LIMIT 10) t ON t.VendorName = c.VendorName
) x WHERE rn <= 5"""), _CB_F)
register("A8_brand_bubbles", lambda s, d: A.brand_bubbles(tb.final_brand(s, d)), with_ctes(["cbrand"], """
SELECT c.*, k.vendor_code, sqrt(greatest(c.UpsideDollars, 0.0) + 1) AS size
FROM cbrand c LEFT JOIN (SELECT VendorName, CAST(dense_rank() OVER (ORDER BY VendorName NULLS LAST) - 1 AS INTEGER)
                                AS vendor_code FROM (SELECT DISTINCT VendorName FROM cbrand) n) k
  ON k.VendorName IS NOT DISTINCT FROM c.VendorName"""), _CB_F + ("size",))
def _a9(s, d):
    v = tb.vss_once(s, d)
    return A.vendor_bubbles(T.final_vendor(T.vendor_rollup(v)), T.brand_pricing_opportunities(T.brand_pricing(v), 0.35))


register("A9_vendor_bubbles", _a9,
         with_ctes(["final_vendor", "opps"], """
SELECT *, 300.0 * (UpsideDollars / (max(UpsideDollars) OVER () + 1e-9)) + 30 AS size FROM (
  SELECT v.VendorNumber, v.VendorName, v.TotalSalesDollars, v.CurrentMargin,
         coalesce(SUM(o.UpsideDollars), 0.0) AS UpsideDollars
  FROM final_vendor v LEFT JOIN opps o ON o.VendorNumber = v.VendorNumber
  GROUP BY v.VendorNumber, v.VendorName, v.TotalSalesDollars, v.CurrentMargin) x
WHERE TotalSalesDollars > 0"""), ("TotalSalesDollars", "CurrentMargin", "UpsideDollars", "size"))
_FMT = ("CASE WHEN Sales >= 1e6 THEN printf('%.2fM', Sales / 1e6) WHEN Sales >= 1e3 THEN printf('%.2fK', Sales / 1e3) "
        "ELSE printf('%.0f', Sales) END")
register("A10_top_vendors_by_sales", lambda s, d: A.top_vendors_by_sales(tb.final_vendor(s, d)),
         with_ctes(["final_vendor"], f"""
SELECT *, {_FMT} AS label FROM (SELECT VendorName, SUM(TotalSalesDollars) AS Sales FROM final_vendor
GROUP BY VendorName ORDER BY Sales DESC, VendorName LIMIT 10) x"""), ("Sales",))
register("A11_top_brands_by_sales", lambda s, d: A.top_brands_by_sales(tb.final_brand(s, d)),
         with_ctes(["final_brand"], f"""
SELECT *, {_FMT} AS label FROM (SELECT Brand, SUM(TotalSalesDollars) AS Sales FROM final_brand
GROUP BY Brand ORDER BY Sales DESC, Brand LIMIT 10) x"""), ("Sales",))


def _pareto_sql(frm: str, key: str, value: str, top: int | None) -> str:
    lim = f"WHERE rank <= {top}" if top else ""
    return f"""
SELECT {key}, {value}, pct, cum_pct, rank, printf('%.1f', pct * 100) || '%' AS pct_lbl FROM (
  SELECT {key}, {value}, {value} / sum({value}) OVER () AS pct,
         sum({value}) OVER (ORDER BY {value} DESC, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           / sum({value}) OVER () AS cum_pct,
         row_number() OVER (ORDER BY {value} DESC, {key}) AS rank
  FROM (SELECT {key}, SUM({value}) AS {value} FROM {frm} GROUP BY {key}) g WHERE {value} IS NOT NULL) x {lim}"""


register("A13_purchase_pareto",
         lambda s, d: A.pareto(tb.final_vendor(s, d), "VendorName", "TotalPurchaseDollars", top=None),
         with_ctes(["final_vendor"], _pareto_sql("final_vendor", "VendorName", "TotalPurchaseDollars", None)),
         ("TotalPurchaseDollars", "pct", "cum_pct"))
register("A13b_purchase_pareto_top20",
         lambda s, d: A.pareto(tb.final_vendor(s, d), "VendorName", "TotalPurchaseDollars", top=20),
         with_ctes(["final_vendor"], _pareto_sql("final_vendor", "VendorName", "TotalPurchaseDollars", 20)),
         ("TotalPurchaseDollars", "pct", "cum_pct"))
register("A14_brand_sales_pareto", lambda s, d: A.pareto(tb.final_brand(s, d), "Brand", "TotalSalesDollars", top=None),
         with_ctes(["final_brand"], _pareto_sql("final_brand", "Brand", "TotalSalesDollars", None)),
         ("TotalSalesDollars", "pct", "cum_pct"))
register("A15_size_terciles", lambda s, d: A.size_terciles(tb.brand_pricing(s, d)), with_ctes(["bp"], """
SELECT OrderSize, round(avg(u), 2) AS UnitPurchasePrice FROM (
  SELECT (TotalPurchaseDollars + FreightCost) / TotalSalesQuantity AS u,
         CASE WHEN TotalSalesQuantity <= e1 THEN 'Small' WHEN TotalSalesQuantity <= e2 THEN 'Medium'
              ELSE 'Large' END AS OrderSize
  FROM bp, (SELECT quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 1.0 / 3) AS e1,
                   quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 2.0 / 3) AS e2
            FROM bp WHERE TotalSalesQuantity > 0) e
  WHERE TotalSalesQuantity > 0) x GROUP BY OrderSize"""), ("UnitPurchasePrice",))
register("A16_lowest_turnover_vendors",
         lambda s, d: A.lowest_turnover_vendors(tb.vss(s, d), tb.base(s, d).vendor_invoice),
         with_ctes(["vss"], """
SELECT coalesce(n.VendorName, CAST(s.VendorNumber AS VARCHAR)) AS Vendor, s.SalesQty, p.PurchQty,
       round(s.SalesQty / p.PurchQty, 3) AS StockTurnover
FROM (SELECT VendorNumber, CAST(SUM(TotalSalesQuantity) AS BIGINT) AS SalesQty FROM vss GROUP BY VendorNumber) s
JOIN (SELECT VendorNumber, CAST(SUM(Quantity) AS BIGINT) AS PurchQty FROM vendor_invoice GROUP BY VendorNumber) p
  ON p.VendorNumber = s.VendorNumber
LEFT JOIN (SELECT VendorNumber, max(VendorName) AS VendorName FROM vss GROUP BY VendorNumber) n
  ON n.VendorNumber = s.VendorNumber
WHERE p.PurchQty > 0 AND s.SalesQty >= 0
ORDER BY s.SalesQty / p.PurchQty, s.VendorNumber LIMIT 15"""), ("StockTurnover",))
register("A17_concentration", lambda s, d: A.concentration(tb.final_vendor(s, d)), with_ctes(["final_vendor"], """
, sh AS (SELECT VendorNumber, TotalPurchaseDollars / sum(TotalPurchaseDollars) OVER () AS share
        FROM final_vendor WHERE TotalPurchaseDollars > 0)
SELECT (SELECT SUM(share) FROM (SELECT share FROM sh ORDER BY share DESC, VendorNumber LIMIT 5) a) AS top5_share,
       (SELECT SUM(share) FROM (SELECT share FROM sh ORDER BY share DESC, VendorNumber LIMIT 10) b) AS top10_share,
       (SELECT SUM(share * share) FROM sh) AS hhi, (SELECT count(*) FROM sh) AS vendors"""),
         ("top5_share", "top10_share", "hhi"))
register("A17b_concentration_top10", lambda s, d: A.concentration_top10(tb.final_vendor(s, d)),
         with_ctes(["final_vendor"], """
SELECT VendorName, TotalPurchaseDollars, TotalPurchaseDollars / sum(TotalPurchaseDollars) OVER () AS share, VendorNumber
FROM final_vendor WHERE TotalPurchaseDollars > 0 ORDER BY share DESC, VendorNumber LIMIT 10"""),
         ("TotalPurchaseDollars", "share"))
register("A18_scorecard_v1", lambda s, d: A.scorecard_v1(tb.vsv(s, d), tb.opps(s, d)), with_ctes(["vsv", "opps"], """
SELECT v.VendorNumber, v.VendorName, coalesce(r.UpsideTotal, 0.0) AS UpsideTotal,
       coalesce(r.BrandsNeedingAction, 0) AS BrandsNeedingAction, v.ProfitMargin AS CurrentMargin,
       CASE WHEN v.TotalPurchaseQty <> 0 THEN v.TotalSalesQty / v.TotalPurchaseQty END AS StockTurnover,
       v.TotalPurchaseDol / sum(v.TotalPurchaseDol) OVER () AS PurchaseShare,
       v.TotalSalesDol_in_summary AS TotalSalesDollars, v.TotalPurchaseDol AS TotalPurchaseDollars,
       row_number() OVER (ORDER BY coalesce(r.UpsideTotal, 0.0) DESC, v.VendorNumber, v.VendorName) AS "rank"
FROM vsv v LEFT JOIN (SELECT VendorNumber, VendorName, coalesce(SUM(UpsideDollars), 0.0) AS UpsideTotal,
                             count_if(UpsideDollars > 0) AS BrandsNeedingAction
                      FROM opps GROUP BY VendorNumber, VendorName) r
  ON r.VendorNumber = v.VendorNumber AND r.VendorName = v.VendorName"""),
         ("UpsideTotal", "CurrentMargin", "StockTurnover", "PurchaseShare", "TotalSalesDollars", "TotalPurchaseDollars"))

cte("scorecard", ("vsv", "final_brand"), f"""
  SELECT VendorNumber, VendorName, UpsideTotal, BrandsNeedingAction, BrandCount, TotalSalesDollars,
         TotalPurchaseDollars, PurchaseShare, CurrentMargin, StockTurnover, BrandTurnoverMedian,
         0.5 * r1 + 0.2 * r2 + 0.15 * r3 + 0.1 * (1.0 - r4) + 0.05 * (1.0 - r5) AS ActionScore
  FROM (SELECT *, {avg_rank_pct_sql('UpsideTotal')} AS r1, {avg_rank_pct_sql('PurchaseShare')} AS r2,
               {avg_rank_pct_sql('BrandsNeedingAction')} AS r3, {avg_rank_pct_sql('m0')} AS r4,
               {avg_rank_pct_sql('t0')} AS r5
        FROM (SELECT *, coalesce(CurrentMargin, 0.0) AS m0, coalesce(StockTurnover, 0.0) AS t0 FROM (
          SELECT v.VendorNumber, v.VendorName, coalesce(a.UpsideTotal, 0.0) AS UpsideTotal,
                 coalesce(a.BrandsNeedingAction, 0) AS BrandsNeedingAction, coalesce(a.BrandCount, 0) AS BrandCount,
                 v.TotalSalesDol_in_summary AS TotalSalesDollars, v.TotalPurchaseDol AS TotalPurchaseDollars,
                 CASE WHEN sum(v.TotalPurchaseDol) OVER () <> 0
                      THEN v.TotalPurchaseDol / sum(v.TotalPurchaseDol) OVER () END AS PurchaseShare,
                 v.ProfitMargin AS CurrentMargin,
                 CASE WHEN v.TotalPurchaseQty > 0 THEN v.TotalSalesQty / v.TotalPurchaseQty END AS StockTurnover,
                 a.BrandTurnoverMedian
          FROM vsv v LEFT JOIN (
            SELECT VendorNumber, VendorName, coalesce(SUM(UpsideDollars), 0.0) AS UpsideTotal,
                   CAST(SUM(CASE WHEN UpsideDollars > 0 THEN 1 ELSE 0 END) AS BIGINT) AS BrandsNeedingAction,
                   count(Brand) AS BrandCount,
                   median(CASE WHEN TotalPurchaseQuantity > 0 THEN TotalSalesQuantity / TotalPurchaseQuantity END)
                     AS BrandTurnoverMedian
            FROM final_brand GROUP BY VendorNumber, VendorName) a
          ON a.VendorNumber = v.VendorNumber AND a.VendorName = v.VendorName) sc) r) x""")
_SCORE_F = ("UpsideTotal", "TotalSalesDollars", "TotalPurchaseDollars", "PurchaseShare", "CurrentMargin",
            "StockTurnover", "BrandTurnoverMedian", "ActionScore")
register("A19_action_scorecard", lambda s, d: A.action_scorecard(*tb.scorecard_inputs(s, d)),
         with_ctes(["scorecard"], "SELECT * FROM scorecard"), _SCORE_F)
register("A20_scorecard_bubbles", lambda s, d: A.scorecard_bubbles(A.action_scorecard(*tb.scorecard_inputs(s, d))),
         with_ctes(["scorecard"], """
SELECT *, CAST(least(greatest(50 + 20 * BrandsNeedingAction, 40), 400) AS DOUBLE) AS size FROM scorecard
ORDER BY ActionScore DESC, VendorNumber LIMIT 15"""), _SCORE_F)
register("A21_executive_blurb",
         lambda s, d: A.executive_blurb(A.action_scorecard(*tb.scorecard_inputs(s, d))),
         with_ctes(["scorecard"], """
SELECT VendorNumber, ActionScore,
       '- ' || VendorName || ': upside $' || format('{:,.0f}', UpsideTotal) || ', '
       || CAST(CAST(BrandsNeedingAction AS INTEGER) AS VARCHAR) || ' brands to fix, purchase share '
       || format('{:.1f}', PurchaseShare * 100) || '%, margin ' || format('{:.1f}', CurrentMargin) || '%.' AS blurb
FROM scorecard ORDER BY ActionScore DESC, VendorNumber LIMIT 5"""), ("ActionScore",))
register("A22_brand_portfolio", lambda s, d: A.brand_portfolio(tb.brand_frame(s, d)), with_ctes(["brand12"], """
, m AS (SELECT median(coalesce(UpsideDollars, 0.0)) AS med FROM brand12)
SELECT b.*, least(greatest(40.0 + coalesce(b.UpsideDollars, 0.0) / (CASE WHEN m.med = 0 OR m.med IS NULL THEN 1.0
                                                                          ELSE m.med END) * 15, 40.0), 500.0) AS size
FROM brand12 b, m"""), _B12_F + ("size",))
register("A23_top_brands_by_total_upside", lambda s, d: A.top_brands_by_total_upside(tb.brand_frame(s, d)),
         with_ctes(["brand12"], """
SELECT Brand, coalesce(SUM(UpsideDollars), 0.0) AS UpsideDollars FROM brand12 GROUP BY Brand
ORDER BY UpsideDollars DESC, Brand LIMIT 20"""), ("UpsideDollars",))
register("A24_bottom_decile_turnover", lambda s, d: A.bottom_decile_turnover(tb.brand_frame(s, d)),
         with_ctes(["brand12"], f"""
SELECT VendorName, Brand, StockTurnover, TotalSalesQuantity, TotalPurchaseQuantity FROM brand12
WHERE StockTurnover > 0 AND StockTurnover <= {exact_quantile_sql('StockTurnover', 'brand12', 0.1)}
ORDER BY StockTurnover, VendorNumber, Brand LIMIT 30"""), ("StockTurnover", "TotalSalesQuantity", "TotalPurchaseQuantity"))
register("A25_unsold_inventory", lambda s, d: A.unsold_inventory(tb.vss(s, d)), with_ctes(["vss"], """
SELECT VendorNumber, VendorName, CAST(SUM(u) AS BIGINT) AS OnHandUnits, coalesce(SUM(u * c), 0.0) AS OnHandValue
FROM (SELECT VendorNumber, VendorName, greatest(TotalPurchaseQuantity - TotalSalesQuantity, 0) AS u,
             CASE WHEN TotalPurchaseQuantity > 0 THEN TotalPurchaseDollars / TotalPurchaseQuantity END AS c
      FROM vss) x
GROUP BY VendorNumber, VendorName ORDER BY OnHandValue DESC, VendorNumber, VendorName LIMIT 15"""), ("OnHandValue",))
def _a26(s, d):
    v, v2 = tb.vss_once(s, d), tb.vss2_once(s, d)
    diag, rollup = T.brand_pricing_diagnostics(v2), T.vendor_rollup_avgs(v2)
    under = T.underperforming_brands(diag)
    return A.dashboard_kpis(v, T.vendor_rollup(v), diag, under, T.vendor_risk_summary(under, rollup), rollup)


register("A26_dashboard_kpis", _a26,
         with_ctes(["vss", "diag", "underperf", "risk_summary", "vsv_c"], """
SELECT t.*, CASE WHEN total_sales <> 0 THEN gross_profit / total_sales END AS profit_margin,
       CASE WHEN distinct_vendors <> 0 THEN total_purchases / distinct_vendors END AS avg_spend_per_vendor,
       (SELECT count(*) FROM underperf) / (SELECT count(*) FROM diag) AS underperforming_brand_share,
       (SELECT count(*) FROM risk_summary) / (SELECT count(*) FROM vsv_c) AS vendors_at_risk_share
FROM (SELECT SUM(TotalSalesDollars) AS total_sales, SUM(TotalPurchaseDollars) AS total_purchases,
             SUM(GrossProfit) AS gross_profit, count(DISTINCT VendorNumber) AS distinct_vendors,
             count(DISTINCT Brand) AS distinct_brands FROM vss) t"""),
         ("total_sales", "total_purchases", "gross_profit", "profit_margin", "avg_spend_per_vendor",
          "underperforming_brand_share", "vendors_at_risk_share"))
register("A27_sales_share_by_brand", lambda s, d: A.sales_share_by_brand(tb.final_brand(s, d)),
         with_ctes(["final_brand"], """
SELECT Brand, Sales, Sales / sum(Sales) OVER () AS share FROM
  (SELECT Brand, SUM(TotalSalesDollars) AS Sales FROM final_brand GROUP BY Brand) g"""), ("Sales", "share"))

# =============================================================================== D: distributions
PLOT_COLS = ["TotalSalesDollars", "TotalSalesQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit",
             "CurrentMargin", "UpsideDollars", "NeededPriceDeltaPerUnit"]


def _long_sql(frm: str, cols, keep=()) -> str:
    k = "".join(f"{c}, " for c in keep)
    return _union([f"SELECT {k}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM {frm}" for c in cols])


def _hist_sql(bins: int, keep: str = "", density: bool = False) -> str:
    """From ``lng`` (``keep``, "column", x): the histogram with edges per column, shared by the groups in ``keep``."""
    k, on = (f"{keep}, ", f"AND c.{keep} = g.{keep}") if keep else ("", "")
    groups = f"SELECT DISTINCT \"column\", {keep} FROM lng" if keep else "SELECT \"column\" FROM rng"
    dens = f", coalesce(c.count, 0) / (sum(coalesce(c.count, 0)) OVER (PARTITION BY r.\"column\"{', g.' + keep if keep else ''}) * ((r.hi - r.lo) / {bins})) AS density" if density else ""
    return f"""
rng AS (SELECT "column", CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM lng GROUP BY "column"),
cnt AS (SELECT {k}l."column", CAST(least(floor((l.x - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) AS INTEGER) AS bin,
               count(*) AS count FROM lng l JOIN rng r USING ("column") GROUP BY ALL)
SELECT {'g.' + k if keep else ''}r."column", CAST(b.bin AS INTEGER) AS bin, r.lo + b.bin * ((r.hi - r.lo) / {bins}) AS lo,
       r.lo + (b.bin + 1) * ((r.hi - r.lo) / {bins}) AS hi, coalesce(c.count, 0) AS count{dens}
FROM rng r JOIN ({groups}) g USING ("column") CROSS JOIN (SELECT range AS bin FROM range(0, {bins})) b
LEFT JOIN cnt c ON c."column" = r."column" AND c.bin = b.bin {on}"""


def _present(frm: str, cols, keep=()) -> str:
    return f', lng AS (SELECT * FROM ({_long_sql(frm, cols, keep)}) u WHERE x IS NOT NULL AND NOT isnan(x)), '


def _box_sql(keep: str = "") -> str:
    k, lk = (f"{keep}, ", f"f.{keep}, ") if keep else ("", "")
    both = f'USING ({k}"column")'
    return f"""
q AS (SELECT {k}"column", count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM lng GROUP BY {k}"column"),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT {lk}f."column", f.n, f.q1, f.median, f.q3,
       min(CASE WHEN l.x >= f.lo_f AND l.x <= f.hi_f THEN l.x END) AS whisker_lo,
       max(CASE WHEN l.x >= f.lo_f AND l.x <= f.hi_f THEN l.x END) AS whisker_hi,
       count_if(NOT (l.x >= f.lo_f AND l.x <= f.hi_f)) AS outliers
FROM lng l JOIN f {both} GROUP BY {lk}f."column", f.n, f.q1, f.median, f.q3"""


_BOX_F = ("q1", "median", "q3", "whisker_lo", "whisker_hi")
register("D1_histogram", lambda s, d: D.histogram(tb.plot_frame(s, d), PLOT_COLS, 40),
         with_ctes(["q13"], _present("q13", PLOT_COLS) + _hist_sql(40)), ("lo", "hi"))
register("D1b_turnover_histogram", lambda s, d: D.histogram(tb.brand_frame(s, d), ["StockTurnover"], 40),
         with_ctes(["brand12"], _present("brand12", ["StockTurnover"]) + _hist_sql(40)), ("lo", "hi"))


def _dashboard(s, d, draw):
    """The outlier dashboard's first profit or margin column."""
    df = tb.final_all(s, d)
    return draw(df, D.profit_columns(df)[:1])


register("D1c_first_margin_histogram", lambda s, d: _dashboard(s, d, lambda df, c: D.histogram(df, c, 50)),
         with_ctes(["final_all"], _present("final_all", ["GrossProfit"]) + _hist_sql(50)), ("lo", "hi"))
register("D2_box_summary", lambda s, d: D.box_summary(tb.plot_frame(s, d), PLOT_COLS),
         with_ctes(["q13"], _present("q13", PLOT_COLS) + _box_sql()), _BOX_F)
register("D2b_box_by_order_size",
         lambda s, d: D.box_summary(A.order_sizes(tb.brand_pricing(s, d)), ["UnitPurchasePrice"], group="OrderSize"),
         with_ctes(["bp"], """
, sized AS (
  SELECT (TotalPurchaseDollars + FreightCost) / TotalSalesQuantity AS UnitPurchasePrice,
         CASE WHEN TotalSalesQuantity <= e1 THEN 'Small' WHEN TotalSalesQuantity <= e2 THEN 'Medium' ELSE 'Large' END AS OrderSize
  FROM bp, (SELECT quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 1.0 / 3) AS e1,
                   quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 2.0 / 3) AS e2 FROM bp WHERE TotalSalesQuantity > 0) e
  WHERE TotalSalesQuantity > 0)""" + _present("sized", ["UnitPurchasePrice"], ("OrderSize",)) + _box_sql("OrderSize")), _BOX_F)
register("D2c_first_margin_box", lambda s, d: _dashboard(s, d, D.box_summary),
         with_ctes(["final_all"], _present("final_all", ["GrossProfit"]) + _box_sql()), _BOX_F)
BRAND_CORR = ["TotalSalesDollars", "TotalSalesQuantity", "TotalPurchaseDollars", "FreightCost", "GrossProfit",
              "CurrentMargin", "TargetMargin", "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]
VENDOR_CORR = BRAND_CORR[:6]


def _spearman_sql(frm: str, where: str, cols) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    ranks = ", ".join(f"{avg_rank_pct_sql(c)} AS r{i}" for i, c in enumerate(cols))
    pairs = []
    for i in range(len(cols)):
        for j in range(i + 1):
            pairs.append(f"SELECT '{cols[i]}' AS col_a, '{cols[j]}' AS col_b, "
                         f"covar_samp(r{i}, r{j}) / NULLIF(stddev_samp(r{i}) * stddev_samp(r{j}), 0) AS rho, "
                         f"count(*) AS n FROM rk")
    return (f", cc AS (SELECT {casts} FROM {frm} WHERE {where}), "
            f"cc2 AS (SELECT * FROM cc WHERE {notnull}), rk AS (SELECT {ranks} FROM cc2)\n" + _union(pairs))


register("D3_spearman_brand",
         lambda s, d: D.spearman(tb.final_brand(s, d).filter((F.col("TotalSalesDollars") > 0)
                                                             & (F.col("TotalSalesQuantity") > 0)), BRAND_CORR),
         with_ctes(["final_brand"], _spearman_sql("final_brand", "TotalSalesDollars > 0 AND TotalSalesQuantity > 0",
                                                  BRAND_CORR)), ("rho",))
register("D3b_spearman_vendor",
         lambda s, d: D.spearman(tb.final_vendor(s, d).filter((F.col("TotalSalesDollars") > 0)
                                                              & (F.col("TotalSalesQuantity") > 0)), VENDOR_CORR),
         with_ctes(["final_vendor"], _spearman_sql("final_vendor", "TotalSalesDollars > 0 AND TotalSalesQuantity > 0",
                                                   VENDOR_CORR)), ("rho",))
# every column of final_all that names a sales, profit, margin, cost or price figure
OUTLIER_METRICS = ["TotalSalesDollars", "TotalSalesQuantity", "FreightCost", "GrossProfit", "CurrentMargin", "TargetMargin",
                   "RequiredSalesDollars", "NeededPriceDeltaPerUnit"]


def _iqr_sql(frm: str, cols, k: float, keep=()) -> str:
    kk = "".join(f"{c}, " for c in keep)
    key = ", ".join(list(keep) + ['"column"'])
    tot = (f"(SELECT {kk}count(*) AS rws FROM {frm} GROUP BY {', '.join(keep)})" if keep
           else f"(SELECT count(*) AS rws FROM {frm})")
    join_tot = f"JOIN {tot} t USING ({', '.join(keep)})" if keep else f"CROSS JOIN {tot} t"
    return f"""
, lng AS (SELECT * FROM ({_long_sql(frm, cols, keep)}) u WHERE x IS NOT NULL AND NOT isnan(x)),
q AS (SELECT {key}, min(x) AS min, max(x) AS max, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
      FROM lng GROUP BY {key} HAVING count(*) > 10),
b AS (SELECT *, q1 - {k!r} * (q3 - q1) AS lower, q3 + {k!r} * (q3 - q1) AS upper FROM q)
SELECT {', '.join(f'b.{c}' for c in keep)}{',' if keep else ''} b."column", count_if(l.x < b.lower OR l.x > b.upper) AS count,
       count_if(l.x < b.lower OR l.x > b.upper) / max(t.rws) * 100 AS percentage,
       b.q1, b.q3, b.lower, b.upper, b.min, b.max
FROM lng l JOIN b USING ({key}) {join_tot}
GROUP BY {', '.join(f'b.{c}' for c in keep)}{',' if keep else ''} b."column", b.q1, b.q3, b.lower, b.upper, b.min, b.max"""


_IQR_F = ("percentage", "q1", "q3", "lower", "upper", "min", "max")
register("D4_iqr_outliers", lambda s, d: D.iqr_outliers(tb.final_all(s, d), OUTLIER_METRICS, 3.0),
         with_ctes(["final_all"], _iqr_sql("final_all", OUTLIER_METRICS, 3.0)), _IQR_F)


def _h1(s, d):
    return H.groups_unit_price_terciles(tb.brand_pricing(s, d))


_H1_SQL = """
, h1 AS (
  SELECT VendorNumber, VendorName, Brand, TotalPurchaseDollars / TotalSalesQuantity AS value,
         CASE WHEN TotalSalesQuantity <= e1 THEN 'Small' WHEN TotalSalesQuantity <= e2 THEN 'Medium'
              ELSE 'Large' END AS "group"
  FROM bp, (SELECT quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 1.0 / 3) AS e1,
                   quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 2.0 / 3) AS e2
            FROM bp WHERE TotalSalesQuantity > 0 AND TotalPurchaseDollars > 0) e
  WHERE TotalSalesQuantity > 0 AND TotalPurchaseDollars > 0)"""
register("D5_iqr_outliers_by_group", lambda s, d: D.iqr_outliers(_h1(s, d), ["value"], 1.5, group="group"),
         with_ctes(["bp"], _H1_SQL + _iqr_sql("h1", ["value"], 1.5, keep=('"group"',))), _IQR_F)
_ROLES = D.REPORT_COLUMNS
register("D7_negative_summary", lambda s, d: D.negative_summary(tb.final_all(s, d)), with_ctes(["final_all"], f"""
SELECT 'Negative Profit' AS "check", '{_ROLES['profit']}' AS "column", count_if({_ROLES['profit']} < 0) AS count,
       count_if({_ROLES['profit']} < 0) / count(*) * 100 AS pct FROM final_all
UNION ALL
SELECT 'Negative Margin', '{_ROLES['margin']}', count_if({_ROLES['margin']} < 0),
       count_if({_ROLES['margin']} < 0) / count(*) * 100 FROM final_all"""), ("pct",))
_WORST_COLS = ("VendorNumber", "Brand", "GrossProfit", "FreightCost", "NeededPriceDeltaPerUnit")
register("D7b_worst_profit_rows",
         lambda s, d: D.worst_rows(tb.final_all(s, d), "GrossProfit", 10,
                                   cols=("VendorNumber", "Brand", "FreightCost", "NeededPriceDeltaPerUnit")),
         with_ctes(["final_all"], """
SELECT VendorNumber, Brand, FreightCost, NeededPriceDeltaPerUnit, GrossProfit FROM final_all WHERE GrossProfit < 0
ORDER BY GrossProfit, VendorNumber, Brand NULLS FIRST, Level LIMIT 10"""),
         ("GrossProfit", "FreightCost", "NeededPriceDeltaPerUnit"))
register("D7c_vendors_by_negative_profit", lambda s, d: D.vendors_by_negative_count(tb.final_all(s, d), "GrossProfit", 5),
         with_ctes(["final_all"], """
SELECT VendorNumber, count(*) AS count FROM final_all WHERE GrossProfit < 0 GROUP BY VendorNumber
ORDER BY count DESC, VendorNumber LIMIT 5"""))
register("D8_suspicious_patterns", lambda s, d: D.suspicious_patterns(tb.final_all(s, d)), with_ctes(["final_all"], f"""
SELECT *, CASE WHEN negative_count > total_records * 0.05 THEN 'HIGH' WHEN negative_count > 0 THEN 'MEDIUM'
               ELSE 'NONE' END AS priority
FROM (SELECT count(*) AS total_records, count_if({_ROLES['price']} <= 0) AS zero_or_negative_prices,
             count_if({_ROLES['cost']} <= 0) AS zero_or_negative_costs,
             count_if(abs({_ROLES['margin']}) > 500.0) AS extreme_margins,
             count_if({_ROLES['profit']} < 0) + count_if({_ROLES['margin']} < 0) AS negative_count
      FROM final_all) x"""))
register("D9_problem_records", lambda s, d: D.problem_records(tb.final_all(s, d)), with_ctes(["final_all"], """
SELECT count_if(GrossProfit < 0) AS negative_count, count_if(GrossProfit < 0) / count(*) * 100 AS negative_pct,
       SUM(CASE WHEN GrossProfit < 0 THEN GrossProfit END) AS total_loss FROM final_all"""),
         ("negative_pct", "total_loss"))
register("D10_loss_by_vendor", lambda s, d: D.loss_by_vendor(tb.final_all(s, d)), with_ctes(["final_all"], """
SELECT VendorNumber, count(*) AS Negative_Records, round(SUM(GrossProfit), 2) AS Total_Loss,
       round(avg(GrossProfit), 2) AS Avg_Loss, count(DISTINCT Brand) AS Brands_Affected
FROM final_all WHERE GrossProfit < 0 GROUP BY VendorNumber ORDER BY Total_Loss, VendorNumber LIMIT 10"""),
         ("Total_Loss", "Avg_Loss"))
register("D11_loss_advice", lambda s, d: D.loss_advice(tb.final_all(s, d)), with_ctes(["final_all"], """
, neg AS (SELECT * FROM final_all WHERE GrossProfit < 0)
SELECT p.*, g.extreme_losses, g.high_freight_losses,
       coalesce(p.avg_freight > abs(p.avg_loss) * 0.5, false) AS freight_advice,
       coalesce(p.avg_price_delta > 0, false) AS price_advice
FROM (SELECT VendorNumber, SUM(GrossProfit) AS total_loss, avg(GrossProfit) AS avg_loss,
             avg(FreightCost) AS avg_freight, avg(NeededPriceDeltaPerUnit) AS avg_price_delta
      FROM neg GROUP BY VendorNumber ORDER BY total_loss, VendorNumber LIMIT 5) p,
     (SELECT count_if(GrossProfit < -10000.0) AS extreme_losses, count_if(FreightCost > 1000.0) AS high_freight_losses
      FROM neg) g"""), ("total_loss", "avg_loss", "avg_freight", "avg_price_delta"))
register("D12_vendors_by_negative_rows", lambda s, d: D.vendors_by_negative_count(tb.final_all(s, d), "GrossProfit", 10),
         with_ctes(["final_all"], """
SELECT VendorNumber, count(*) AS count FROM final_all WHERE GrossProfit < 0 GROUP BY VendorNumber
ORDER BY count DESC, VendorNumber LIMIT 10"""))
register("D12b_cost_price_sample",
         lambda s, d: D.cost_price_sample(tb.final_all(s, d), "FreightCost", "NeededPriceDeltaPerUnit"),
         with_ctes(["final_all"], """
SELECT Level, VendorNumber, Brand, FreightCost, NeededPriceDeltaPerUnit,
       coalesce(FreightCost > NeededPriceDeltaPerUnit, false) AS negative_margin
FROM final_all ORDER BY md5(concat_ws('|', '0', coalesce(CAST(Level AS VARCHAR), ''),
                                     coalesce(CAST(VendorNumber AS VARCHAR), ''),
                                     coalesce(CAST(Brand AS VARCHAR), ''))) LIMIT 5000"""),
         ("FreightCost", "NeededPriceDeltaPerUnit"))

# =============================================================================== H: inference


def _h3(s, d):
    return H.groups_purchase_qty_median(tb.brand_frame(s, d))


def _h4(s, d, low_q=None):
    return H.groups_purchase_share(tb.vsv(s, d), low_q=low_q)


_H3_SQL = """
, h3 AS (
  SELECT VendorNumber, VendorName, Brand, TotalPurchaseDollars / TotalPurchaseQuantity AS value,
         CASE WHEN TotalPurchaseQuantity <= (SELECT quantile_cont(TotalPurchaseQuantity, 0.5) FROM brand12
                                             WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0)
              THEN 'small' ELSE 'large' END AS "group"
  FROM brand12 WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0)"""


def _h4_sql(low_q):
    grp = ("CASE WHEN share >= hi THEN 'top' WHEN share < hi THEN 'rest' END" if low_q is None else
           "CASE WHEN share >= hi THEN 'top' WHEN share <= lo THEN 'low' END")
    lo = f", quantile_cont(share, {low_q!r}) AS lo" if low_q is not None else ""
    return f"""
, sh AS (SELECT VendorNumber, VendorName, ProfitMargin AS value,
                TotalPurchaseDol / sum(TotalPurchaseDol) OVER () AS share FROM vsv),
h4 AS (SELECT VendorNumber, VendorName, value, {grp} AS "group"
       FROM sh, (SELECT quantile_cont(share, 0.75) AS hi{lo} FROM sh) q)"""


register("H1_groups_unit_price_terciles", _h1, with_ctes(["bp"], _H1_SQL + "\nSELECT * FROM h1"), ("value",))
register("H2_groups_unit_cost_terciles", lambda s, d: H.groups_unit_cost_terciles(tb.vss(s, d)), with_ctes(["vss"], """
SELECT VendorNumber, VendorName, Brand, TotalPurchaseDollars / TotalPurchaseQuantity AS value,
       CASE WHEN TotalSalesQuantity <= e1 THEN 'Small' WHEN TotalSalesQuantity <= e2 THEN 'Medium'
            ELSE 'Large' END AS "group"
FROM vss, (SELECT quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 1.0 / 3) AS e1,
                  quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 2.0 / 3) AS e2
           FROM vss WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0) e
WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0"""), ("value",))
register("H3_groups_purchase_qty_median", _h3, with_ctes(["brand12"], _H3_SQL + "\nSELECT * FROM h3"), ("value",))
register("H4_groups_purchase_share", _h4, with_ctes(["vsv"], _h4_sql(None) + "\nSELECT * FROM h4 WHERE \"group\" IS NOT NULL AND value IS NOT NULL"),
         ("value",))


def _mixed_sql(src: str, keys, B: int, seed: int) -> str:
    """CTE ``x`` with the integer ``mixed`` of every row of ``src`` in every replicate ``rep``."""
    h1, h2 = H.lanes_sql(seed, keys)
    return (f"hashed AS (SELECT *, {h1} AS h1, {h2} AS h2 FROM {src}),\n"
            f"paired AS (SELECT * FROM hashed, range(0, {B}) t(rep)),\n" + H.mixed_ctes("paired", "rep", "x"))


def _boot_mean_ctes(src: str, keys, B: int, seed: int, conf: float = 0.95) -> str:
    a = (1 - conf) / 2
    return f"""
, d AS (SELECT * FROM {src} WHERE value IS NOT NULL),
{_mixed_sql('d', keys, B, seed)},
w AS (SELECT "group", rep, {H.poisson_weight_sql('mixed')} AS wt, value FROM x),
m AS (SELECT "group", rep, sum(wt * value) / nullif(sum(wt), 0) AS mean FROM w GROUP BY ALL),
ci AS (SELECT "group", quantile_cont(mean, {a!r}) AS lo, quantile_cont(mean, {1 - a!r}) AS hi FROM m GROUP BY ALL),
boot AS (SELECT "group", count(*) AS n, CASE WHEN count(*) >= 5 THEN avg(value) END AS mean,
                CASE WHEN count(*) >= 5 THEN any_value(ci.lo) END AS lo, CASE WHEN count(*) >= 5 THEN any_value(ci.hi) END AS hi
         FROM d LEFT JOIN ci USING ("group") GROUP BY "group")"""


def _boot_diff_ctes(src: str, keys, a_name: str, b_name: str, B: int, seed: int, conf: float = 0.95, tag: str = "") -> str:
    a = (1 - conf) / 2
    body = f"""
, d AS (SELECT * FROM {src} WHERE "group" IN ('{a_name}', '{b_name}') AND value IS NOT NULL),
{_mixed_sql('d', keys, B, seed)},
w AS (SELECT "group", rep, {H.poisson_weight_sql('mixed')} AS wt, value FROM x),
m AS (SELECT "group", rep, sum(wt * value) / nullif(sum(wt), 0) AS mean FROM w GROUP BY ALL),
diffs AS (SELECT rep, any_value(mean) FILTER ("group" = '{a_name}') - any_value(mean) FILTER ("group" = '{b_name}') AS diff
          FROM m GROUP BY rep),
fin AS (SELECT (SELECT count(*) FROM d WHERE "group" = '{a_name}') AS n_a, (SELECT count(*) FROM d WHERE "group" = '{b_name}') AS n_b,
               (SELECT avg(value) FROM d WHERE "group" = '{a_name}') - (SELECT avg(value) FROM d WHERE "group" = '{b_name}') AS observed_diff,
               avg(diff) AS boot_mean_diff, quantile_cont(diff, {a!r}) AS lo, quantile_cont(diff, {1 - a!r}) AS hi FROM diffs)"""
    if tag:  # a second set of resamples in one statement
        import re
        body = re.sub(r"\b(d|hashed|paired|x|x_1|w|m|diffs|fin)\b(?= AS \()|(?<=FROM )\b(d|hashed|paired|x|x_1|w|m|diffs)\b", lambda k: k.group() + tag, body)
    return body


def _perm_sql(src: str, keys, a_name: str, b_name: str, B: int, seed: int, plus_one: bool) -> str:
    p = "(k + 1) / (b + 1)" if plus_one else "k / b"
    return f"""
, d AS (SELECT * FROM {src} WHERE "group" IN ('{a_name}', '{b_name}') AND value IS NOT NULL),
o AS (SELECT count(*) FILTER ("group" = '{a_name}') AS n_a, count(*) AS n, sum(value) AS tot,
             avg(value) FILTER ("group" = '{a_name}') - avg(value) FILTER ("group" = '{b_name}') AS observed_diff FROM d),
{_mixed_sql('d', keys, B, seed)},
r AS (SELECT rep, value, row_number() OVER (PARTITION BY rep ORDER BY mixed, h1, h2, value) AS rn FROM x),
s AS (SELECT rep, sum(value) AS sa FROM r WHERE rn <= (SELECT n_a FROM o) GROUP BY rep),
g AS (SELECT count_if(sa / o.n_a - (o.tot - sa) / (o.n - o.n_a) >= o.observed_diff - abs(o.observed_diff) * 1e-12)
             AS k, count(*) AS b FROM s, o)
SELECT o.n_a, o.n - o.n_a AS n_b, o.observed_diff, CAST({p} AS DOUBLE) AS p_value FROM o, g"""


_K3 = ("VendorNumber", "VendorName", "Brand")
_K2 = ("VendorNumber", "VendorName")
_CI = ("observed_diff", "boot_mean_diff", "lo", "hi")
_H2_SQL = """
, h2 AS (SELECT VendorNumber, VendorName, Brand, TotalPurchaseDollars / TotalPurchaseQuantity AS value,
       CASE WHEN TotalSalesQuantity <= e1 THEN 'Small' WHEN TotalSalesQuantity <= e2 THEN 'Medium' ELSE 'Large' END AS "group"
FROM vss, (SELECT quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 1.0 / 3) AS e1, quantile_cont(CAST(TotalSalesQuantity AS DOUBLE), 2.0 / 3) AS e2
           FROM vss WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0) e
WHERE TotalPurchaseQuantity > 0 AND TotalPurchaseDollars > 0)"""


def _h2(s, d):
    return H.groups_unit_cost_terciles(tb.vss(s, d))


register("H5_bootstrap_mean_ci",
         lambda s, d: H.bootstrap_mean_ci(_h4(s, d), _K2, B=2000, seed=42, by=("group",)),
         with_ctes(["vsv"], _h4_sql(None) + ", h4b AS (SELECT * FROM h4 WHERE \"group\" IS NOT NULL)"
                   + _boot_mean_ctes("h4b", _K2, 2000, 42) + "\nSELECT * FROM boot"), ("mean", "lo", "hi"))
register("H6_bootstrap_diff_ci",
         lambda s, d: H.bootstrap_diff_ci(_h4(s, d), _K2, "top", "rest", B=5000, seed=0),
         with_ctes(["vsv"], _h4_sql(None) + _boot_diff_ctes("h4", _K2, "top", "rest", 5000, 0) + "\nSELECT * FROM fin"), _CI)
register("H6b_bootstrap_diff_terciles",
         lambda s, d: H.bootstrap_diff_ci(_h1(s, d), _K3, "Small", "Large", B=10000, seed=42),
         with_ctes(["bp"], _H1_SQL + _boot_diff_ctes("h1", _K3, "Small", "Large", 10000, 42) + "\nSELECT * FROM fin"), _CI)
register("H6c_bootstrap_diff_unit_cost",
         lambda s, d: H.bootstrap_diff_ci(_h2(s, d), _K3, "Small", "Large", B=5000, seed=0),
         with_ctes(["vss"], _H2_SQL + _boot_diff_ctes("h2", _K3, "Small", "Large", 5000, 0) + "\nSELECT * FROM fin"), _CI)
register("H7_permutation_test",
         lambda s, d: H.permutation_test(_h1(s, d), _K3, "Small", "Large", B=10000, seed=42),
         with_ctes(["bp"], _H1_SQL + _perm_sql("h1", _K3, "Small", "Large", 10000, 42, False)),
         ("observed_diff", "p_value"))
register("H7b_permutation_unit_cost",
         lambda s, d: H.permutation_test(_h2(s, d), _K3, "Small", "Large", B=5000, seed=0),
         with_ctes(["vss"], _H2_SQL + _perm_sql("h2", _K3, "Small", "Large", 5000, 0, False)), ("observed_diff", "p_value"))
register("H8_permutation_test_plus_one",
         lambda s, d: H.permutation_test(_h3(s, d), _K3, "small", "large", B=5000, seed=1, plus_one=True),
         with_ctes(["brand12"], _H3_SQL + _perm_sql("h3", _K3, "small", "large", 5000, 1, True)),
         ("observed_diff", "p_value"))
_VERDICT_SQL = """CASE WHEN lo > 0 THEN 'significant positive' WHEN hi < 0 THEN 'significant negative' ELSE 'not significant' END AS verdict,
       CASE WHEN observed_diff > 0 THEN 'higher' ELSE 'lower' END AS direction"""
register("H10_verdict",
         lambda s, d: H.verdict(H.bootstrap_diff_ci(_h4(s, d), _K2, "top", "rest", B=5000, seed=0)),
         with_ctes(["vsv"], _h4_sql(None) + _boot_diff_ctes("h4", _K2, "top", "rest", 5000, 0)
                   + f"\nSELECT *, {_VERDICT_SQL} FROM fin"), _CI)


def _h9_stats_ctes() -> str:
    return """
, d9 AS (SELECT * FROM h4 WHERE "group" IN ('top', 'low') AND value IS NOT NULL),
m9 AS (SELECT "group", count(*) AS n, avg(value) AS mu, median(value) AS med,
             quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM d9 GROUP BY "group"),
mo AS (SELECT d9."group", avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3,
              avg(power(value - mu, 4)) AS m4,
              count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers,
              avg(abs(value - med)) AS zbar
       FROM d9 JOIN m9 USING ("group") GROUP BY d9."group"),
g9 AS (SELECT m9."group", n, outliers, zbar,
             exp(-(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / power(m2, 2) - 3, 2) / 4.0)) / 2.0) AS jb_p
      FROM m9 JOIN mo USING ("group")),
z9 AS (SELECT abs(d9.value - m9.med) AS z, d9."group" FROM d9 JOIN m9 USING ("group")),
w9 AS (SELECT SUM(power(z9.z - g9.zbar, 2)) AS within, avg(z9.z) AS zall, count(*) AS nn FROM z9 JOIN g9 USING ("group")),
p9 AS (SELECT max(CASE WHEN "group" = 'top' THEN n END) AS n1, max(CASE WHEN "group" = 'low' THEN n END) AS n2,
             max(CASE WHEN "group" = 'top' THEN jb_p END) AS normality_p1,
             max(CASE WHEN "group" = 'low' THEN jb_p END) AS normality_p2,
             max(CASE WHEN "group" = 'top' THEN outliers END) AS outliers1,
             max(CASE WHEN "group" = 'low' THEN outliers END) AS outliers2,
             max(CASE WHEN "group" = 'top' THEN zbar END) AS z1, max(CASE WHEN "group" = 'low' THEN zbar END) AS z2
      FROM g9),
h9 AS (SELECT n1, n2, n1 >= 30 AND n2 >= 30 AS adequate_n,
       CASE WHEN n1 >= 8 AND n2 >= 8 THEN normality_p1 END AS normality_p1, CASE WHEN n1 >= 8 AND n2 >= 8 THEN normality_p2 END AS normality_p2,
       CASE WHEN n1 >= 8 AND n2 >= 8 THEN normality_p1 > 0.05 AND normality_p2 > 0.05 END AS normal,
       CASE WHEN within > 0 THEN (nn - 2) * (n1 * power(z1 - zall, 2) + n2 * power(z2 - zall, 2)) / within END
         AS levene_W,
       outliers1, outliers2, outliers1 > n1 * 0.1 OR outliers2 > n2 * 0.1 AS high_outlier_share
FROM p9, w9)"""


_H9_F = ("normality_p1", "normality_p2", "levene_W")
register("H9_assumption_report",
         lambda s, d: H.assumption_report(_h4(s, d, 0.25), "top", "low"),
         with_ctes(["vsv"], _h4_sql(0.25) + _h9_stats_ctes() + "\nSELECT * FROM h9"), _H9_F)
_H11_SQL = (_h4_sql(0.25) + _h9_stats_ctes() + ", h4b AS (SELECT * FROM h4 WHERE \"group\" IN ('top', 'low'))"
            + _boot_mean_ctes("h4b", _K2, 2000, 42) + _boot_diff_ctes("h4", _K2, "top", "low", 2000, 42, tag="_2") + f"""
SELECT h9.*, {", ".join(f"(SELECT {c} FROM boot WHERE \"group\" = '{g}') AS {g}_{c}" for g in ("top", "low") for c in ("mean", "lo", "hi"))},
       observed_diff, boot_mean_diff, lo, hi, {_VERDICT_SQL}
FROM h9, fin_2""")
register("H11_top_vs_low_report", lambda s, d: H.top_vs_low_report(tb.vsv(s, d)), with_ctes(["vsv"], _H11_SQL),
         _H9_F + _CI + tuple(f"{g}_{c}" for g in ("top", "low") for c in ("mean", "lo", "hi")))

# =============================================================================== D1: histograms of the top / low comparison
register("D1d_top_low_histogram", lambda s, d: D.histogram(_h4(s, d, 0.25), ["value"], 24, group="group", density=True),
         with_ctes(["vsv"], _h4_sql(0.25) + ", both_groups AS (SELECT * FROM h4 WHERE \"group\" IN ('top', 'low'))"
                   + _present("both_groups", ["value"], ('"group"',)) + _hist_sql(24, '"group"', True)), ("lo", "hi", "density"))
# few vendors have few different resamples, some of them on an edge: rounded, so that the order of a sum doesn't choose the bin
register("D1e_bootstrap_diff_histogram",
         lambda s, d: D.histogram(H.bootstrap_diffs(_h4(s, d, 0.25), _K2, "top", "low", B=2000, seed=42).select(canon("diff").alias("diff")),
                                  ["diff"], 30, density=True),
         with_ctes(["vsv"], _h4_sql(0.25) + _boot_diff_ctes("h4", _K2, "top", "low", 2000, 42)
                   + f", rounded AS (SELECT {canon_sql('diff')} AS diff FROM diffs)" + _present("rounded", ["diff"])
                   + _hist_sql(30, density=True)), ("lo", "hi", "density"))
