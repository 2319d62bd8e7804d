"""Data-quality checks and cleaning.

Every check is a single aggregate pass over its input (NULL / negative / duplicate
counts are conditional sums in one ``agg``), then reshaped into a small long report.
Reports are DataFrames, never driver-side prints.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorlens.functions.expr import finite_or_null
from vendorlens.functions.frames import attach
from vendorlens.functions.selection import Selection

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def null_counts(df: DataFrame, cols: dict) -> DataFrame:
    """Q2: one row of NULL counts, ``{output_name: column}``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for n, c in cols.items()])


def negative_counts(df: DataFrame, cols: dict) -> DataFrame:
    """Q3: one row of ``count(c < 0)``, ``{output_name: column}``."""
    return df.agg(*[F.count_if(F.col(c) < 0).alias(n) for n, c in cols.items()])


def _long(agg_row: DataFrame, items: list, key_schema: list[str], value: str) -> DataFrame:
    """Reshape a one-row aggregate into rows: items = [(key values..., value column)]."""
    structs = [F.struct(*[F.lit(k).alias(n) for k, n in zip(keys, key_schema)], F.col(v).alias(value))
               for *keys, v in items]
    return agg_row.select(F.inline(F.array(*structs)))


def null_report(df: DataFrame, top: int = 20) -> DataFrame:
    """Q4: NULL count of every column, descending, first ``top`` (ties by column position)."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = _long(agg, [(c, i, f"_n{i}") for i, c in enumerate(cols)], ["column", "position"], "na_cnt")
    return rows.orderBy(F.col("na_cnt").desc(), "position").limit(top).drop("position")


def describe(df: DataFrame, cols=None) -> DataFrame:
    """Q5: pandas ``describe().T`` of numeric columns: count, mean, std (n-1), min, quartiles, max.

    Moments of all columns in one aggregate; quartiles are exact, linearly interpolated (like
    pandas) and found for all columns at once by counting (``Selection``).
    """
    cols = cols or numeric_columns(df)
    chosen = Selection(df, cols)
    stats = [(F.count, "count"), (F.avg, "mean"), (F.stddev_samp, "std"), (F.min, "min"), (F.max, "max")]
    row = chosen.rows.agg(*[f(f"_c{i}").alias(f"_{name}{i}") for i in range(len(cols)) for f, name in stats]).first()
    quartiles = chosen.quantiles([0.25, 0.5, 0.75])
    rows = {}
    for i in range(len(cols)):
        count, mean, std, low, high = (row[f"_{name}{i}"] for _, name in stats)
        rows[i] = (count, mean, std, low, *quartiles.get(i, (0, [None] * 3))[1], high)
    real = pa.float64()
    return chosen.frame(rows, [("count", pa.int64()), *[(f, real) for f in ("mean", "std", "min", "p25", "p50", "p75", "max")]])


def shape(df: DataFrame) -> DataFrame:
    """Q6: rows and columns of a frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("cols", F.lit(len(df.columns)).cast("bigint"))


def duplicate_keys_by_level(final_all: DataFrame) -> DataFrame:
    """Q7: surplus rows per key (pandas ``duplicated().sum()``) at vendor and brand level.

    ``groupBy`` keeps NULL keys as one group, like pandas ``duplicated``.
    """
    v = (final_all.filter(F.col("Level") == "vendor").groupBy("VendorNumber").count()
         .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dup_vendor_rows")))
    b = (final_all.filter(F.col("Level") == "brand").groupBy("VendorNumber", "Brand").count()
         .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dup_brand_rows")))
    return attach(v, b)


def duplicate_keys(df: DataFrame, keys=("VendorNumber", "Brand")) -> DataFrame:
    """Q8: keys occurring more than once, most repeated first."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key"))
              .filter(F.col("rows_per_key") > 1)
              .orderBy(F.col("rows_per_key").desc(), *keys))


FINANCIAL = ["TotalSalesDollars", "TotalPurchaseDollars", "GrossProfit", "FreightCost"]


def validate_data_quality(df: DataFrame, extreme_price: float = 1000.0, exact: bool = True) -> DataFrame:
    """Q9: long report (check, column, value): shape, NULLs per column, negatives in the
    financial columns, unit price (purchase dollars / sales qty, qty > 0) above
    ``extreme_price`` and its 99th percentile."""
    cols = df.columns
    from vendorlens.functions.ranking import exact_quantiles
    up = F.when(F.col("TotalSalesQuantity") > 0, F.col("TotalPurchaseDollars") / F.col("TotalSalesQuantity"))
    q99 = exact_quantiles(df.select(up.alias("_u")), "_u", [0.99], ["_q"]).select("_q").scalar()
    aggs = [F.count(F.lit(1)).cast("double").alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).cast("double").alias(f"_n{i}") for i, c in enumerate(cols)]
    fin = [c for c in FINANCIAL if c in cols]
    aggs += [F.count_if(F.col(c) < 0).cast("double").alias(f"_neg{i}") for i, c in enumerate(fin)]
    aggs += [F.count_if(up > extreme_price).cast("double").alias("_ext"), q99.alias("_q99")]
    row = df.agg(*aggs)
    items = [("shape_rows", "", "_rows")]
    items += [("missing", c, f"_n{i}") for i, c in enumerate(cols)]
    items += [("negative", c, f"_neg{i}") for i, c in enumerate(fin)]
    items += [("extreme_unit_price", "unit_price", "_ext"), ("unit_price_q99", "unit_price", "_q99")]
    out = _long(row, items, ["check", "column"], "value")
    cols_row = row.select(F.lit("shape_cols").alias("check"), F.lit("").alias("column"),
                          F.lit(float(len(cols))).alias("value"))
    return out.unionByName(cols_row)


OPPORTUNITY = ["TargetMargin", "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]


def clean_brand_df(df: DataFrame) -> DataFrame:
    """Q10: drop the CSV index column, fill missing brand with 'UNKNOWN', keep rows with
    sales and quantity, drop rows whose opportunity columns are NULL / NaN / infinite,
    then lower-case column names (the intended order of the reference's steps)."""
    if "Unnamed: 0" in df.columns:
        df = df.drop("Unnamed: 0")
    if "Brand" in df.columns:
        df = df.withColumn("Brand", F.coalesce(F.col("Brand").cast("string"), F.lit("UNKNOWN")))
    df = df.filter((F.col("TotalSalesDollars") > 0) & (F.col("TotalSalesQuantity") > 0))
    need = [c for c in OPPORTUNITY if c in df.columns]
    for c in need:
        df = df.withColumn(c, finite_or_null(c))
    df = df.na.drop(subset=need) if need else df
    return df.toDF(*[c.lower() for c in df.columns])


VENDOR_REQUIRED = ["TotalSalesDollars", "TotalSalesQuantity", "TotalPurchaseDollars", "FreightCost",
                   "GrossProfit", "CurrentMargin"]


def prepare_vendor_data(final_all: DataFrame) -> DataFrame:
    """Q11: vendor rows with sales and quantity; infinities -> NULL; drop NULLs in 6 columns."""
    v = final_all.filter((F.col("Level") == "vendor") & (F.col("TotalSalesDollars") > 0)
                         & (F.col("TotalSalesQuantity") > 0))
    for c, t in v.dtypes:
        if t in ("double", "float"):
            v = v.withColumn(c, finite_or_null(c))
    return v.na.drop(subset=[c for c in VENDOR_REQUIRED if c in v.columns])


BRAND_COLUMNS = ["VendorNumber", "VendorName", "Brand", "TotalSalesDollars", "TotalSalesQuantity",
                 "TotalPurchaseDollars", "TotalPurchaseQuantity", "FreightCost", "GrossProfit", "CurrentMargin",
                 "TargetMargin", "RequiredSalesDollars", "UpsideDollars", "NeededPriceDeltaPerUnit"]


def load_brand_df(final_brand: DataFrame) -> DataFrame:
    """Q12: 14-column projection, numbers coerced (bad -> NULL), StockTurnover NULL unless
    purchase quantity > 0."""
    num = BRAND_COLUMNS[3:]
    b = final_brand.select(*[F.col(c).cast("double").alias(c) if c in num else F.col(c) for c in BRAND_COLUMNS])
    pq, sq = F.col("TotalPurchaseQuantity"), F.col("TotalSalesQuantity")
    return b.withColumn("StockTurnover", F.when(pq > 0, sq / pq))


def plotting_base(final_brand: DataFrame) -> DataFrame:
    """Q13: brands with sales and quantity whose 4 opportunity columns are finite."""
    b = final_brand.filter((F.col("TotalSalesDollars") > 0) & (F.col("TotalSalesQuantity") > 0))
    cond = F.lit(True)
    for c in OPPORTUNITY:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return b.filter(cond)


def purchase_reconciliation(vendor_invoice: DataFrame, brand_pricing: DataFrame) -> DataFrame:
    """Q14: invoice purchase total against brand-pricing purchase total (1 x 1 join)."""
    vi = vendor_invoice.agg(F.sum("Dollars").alias("vi_purch"))
    bp = brand_pricing.agg(F.sum("TotalPurchaseDollars").alias("bp_purch"))
    vv = F.col("vi_purch")
    return attach(vi, bp).withColumn("ratio", F.when(vv.isNotNull() & (vv != 0), F.col("bp_purch") / vv))


def vendor_inflation(vendor_invoice: DataFrame, brand_pricing: DataFrame, top: int = 15) -> DataFrame:
    """Q15: per vendor, brand-pricing purchases over invoice purchases, highest first."""
    vi = vendor_invoice.groupBy("VendorNumber").agg(F.sum("Dollars").alias("_vi"))
    bp = brand_pricing.groupBy("VendorNumber").agg(F.sum("TotalPurchaseDollars").alias("bp_purch"),
                                                   F.countDistinct("Brand").alias("brand_count"))
    j = bp.join(vi, "VendorNumber", "left")
    ratio = F.when(F.col("_vi") > 0, F.round(F.col("bp_purch") * 1.0 / F.col("_vi"), 2))
    return (j.select("VendorNumber", "bp_purch", F.coalesce("_vi", F.lit(0.0)).alias("vi_purch"),
                     "brand_count", ratio.alias("ratio"))
             .orderBy(F.col("ratio").desc_nulls_last(), "VendorNumber").limit(top))


def health_check(spark: SparkSession, tables: dict) -> DataFrame:
    """Row count per named table and whether it is non-empty."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("healthy", F.col("rows") > 0)
