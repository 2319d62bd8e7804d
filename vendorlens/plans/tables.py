"""Named table builders: (spark, sf_dir) -> DataFrame for every derived table.

These wire the operators together over the base tables derived from the driver data,
the way the reference's scripts chain their tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.operators import summary as T
from vendorlens.session import stored
from vendorlens.sources import tpch


def base(spark: SparkSession, sf_dir: str) -> tpch.BaseTables:
    return tpch.base_tables(spark, sf_dir)


def vss(spark, sf_dir) -> DataFrame:
    b = base(spark, sf_dir)
    return T.vendor_sales_summary(b.sales, b.purchases, b.vendor_invoice)


def vss2(spark, sf_dir) -> DataFrame:
    b = base(spark, sf_dir)
    return T.vendor_sales_summary_replicated(b.sales, b.purchases, b.vendor_invoice, b.purchase_prices)


def vss_once(spark, sf_dir) -> DataFrame:
    """T1 computed once, for chains that read it several times."""
    return stored(vss(spark, sf_dir))


def vss2_once(spark, sf_dir) -> DataFrame:
    """T2 computed once, for chains that read it several times."""
    return stored(vss2(spark, sf_dir))


def vsv(spark, sf_dir) -> DataFrame:
    return T.vendor_rollup(vss(spark, sf_dir))


def vsv_b(spark, sf_dir) -> DataFrame:
    return T.vendor_rollup_trimmed(vss2(spark, sf_dir))


def vsv_c(spark, sf_dir) -> DataFrame:
    return T.vendor_rollup_avgs(vss2(spark, sf_dir))


def opps(spark, sf_dir, target: float = 0.35) -> DataFrame:
    return T.brand_pricing_opportunities(T.brand_pricing(vss(spark, sf_dir)), target)


def final_vendor(spark, sf_dir) -> DataFrame:
    return T.final_vendor(vsv(spark, sf_dir))


def final_brand(spark, sf_dir, target: float = 0.35) -> DataFrame:
    v = vss_once(spark, sf_dir)
    return T.final_brand(v, T.brand_pricing_opportunities(T.brand_pricing(v), target))


def scorecard_inputs(spark, sf_dir, target: float = 0.35):
    """The brand table and the vendor rollup of one T1."""
    v = vss_once(spark, sf_dir)
    return T.final_brand(v, T.brand_pricing_opportunities(T.brand_pricing(v), target)), T.vendor_rollup(v)


def final_all(spark, sf_dir, target: float = 0.35) -> DataFrame:
    v = vss_once(spark, sf_dir)
    fv = T.final_vendor(T.vendor_rollup(v))
    fb = T.final_brand(v, T.brand_pricing_opportunities(T.brand_pricing(v), target))
    return T.final_all(fv, fb)


def diag(spark, sf_dir) -> DataFrame:
    return T.brand_pricing_diagnostics(vss2(spark, sf_dir))


def underperf(spark, sf_dir) -> DataFrame:
    return T.underperforming_brands(diag(spark, sf_dir))


def risk_summary(spark, sf_dir) -> DataFrame:
    v2 = vss2_once(spark, sf_dir)
    return T.vendor_risk_summary(T.underperforming_brands(T.brand_pricing_diagnostics(v2)),
                                 T.vendor_rollup_avgs(v2))


def final_vendor_b(spark, sf_dir) -> DataFrame:
    v2 = vss2_once(spark, sf_dir)
    return T.final_vendor_enriched(T.vendor_rollup_avgs(v2), v2, T.spend_by_vendor_named(v2),
                                   T.vendor_risk_flags(v2))


def final_brand_b(spark, sf_dir) -> DataFrame:
    v2 = vss2_once(spark, sf_dir)
    return T.final_brand_replicated(v2, T.pricing_opportunities_all(v2))


def final_all_b(spark, sf_dir) -> DataFrame:
    v2 = vss2_once(spark, sf_dir)
    fv = T.final_vendor_enriched(T.vendor_rollup_avgs(v2), v2, T.spend_by_vendor_named(v2),
                                 T.vendor_risk_flags(v2))
    fb = T.final_brand_replicated(v2, T.pricing_opportunities_all(v2))
    return T.final_all_replicated(fv, fb)


def brand_pricing(spark, sf_dir) -> DataFrame:
    return T.brand_pricing(vss(spark, sf_dir))


def analysis_frame(spark, sf_dir) -> DataFrame:
    """final_all rows with sales, largest first (the analysis notebook's input)."""
    return sold_frame(spark, sf_dir).orderBy(F.col("TotalSalesDollars").desc(), "Level", "VendorNumber", "Brand")


def sold_frame(spark, sf_dir) -> DataFrame:
    """final_all rows with sales, in no order."""
    return final_all(spark, sf_dir).filter(F.col("TotalSalesDollars") > 0)


def vendor_frame(spark, sf_dir) -> DataFrame:
    from vendorlens.operators.quality import prepare_vendor_data
    return prepare_vendor_data(final_all(spark, sf_dir))


def brand_frame(spark, sf_dir) -> DataFrame:
    from vendorlens.operators.quality import load_brand_df
    return load_brand_df(final_brand(spark, sf_dir))


def plot_frame(spark, sf_dir) -> DataFrame:
    from vendorlens.operators.quality import plotting_base
    return plotting_base(final_brand(spark, sf_dir))
