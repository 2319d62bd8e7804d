"""Derive the reference's base tables from the driver's TPC-H-style tables.

Mapping (see FIXTURES.md section 3): vendor = supplier, brand = number in ``p_brand``,
InventoryId = supplier + brand (many-to-many, so the fan-out join is exercised),
sales = lines with status F, purchases = lines with status O.

Everything is a lazy DataFrame over the parquet files, so column pruning and filter
pushdown reach the scans. ``BASE_SQL`` is the same derivation as SQL text; the
oracle queries run it in DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to part and supplier, renamed into the procurement vocabulary."""
    l = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_linestatus")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    brand = F.substring("p_brand", 7, 1 << 20)
    return (l.join(p, l.l_partkey == p.p_partkey)
             .join(s, l.l_suppkey == s.s_suppkey)
             .select(
                 "l_orderkey", "l_partkey",
                 F.col("l_suppkey").alias("VendorNumber"),
                 F.concat("s_name", F.lit("   ")).alias("VendorName"),
                 brand.cast("bigint").alias("Brand"),
                 F.col("p_name").alias("Description"),
                 F.concat(F.col("l_suppkey").cast("string"), F.lit("_"), brand).alias("InventoryId"),
                 F.col("l_quantity").cast("bigint").alias("qty"),
                 F.col("l_extendedprice").alias("ext"),
                 F.col("l_discount").alias("disc"),
                 F.col("l_tax").alias("tax"),
                 F.col("l_linestatus").alias("st"),
                 F.col("p_retailprice").alias("retail")))


def sales(spark: SparkSession, sf_dir: str, v: DataFrame | None = None) -> DataFrame:
    v = lines(spark, sf_dir) if v is None else v
    return (v.filter(F.col("st") == "F")
             .select("InventoryId", "Brand", F.col("VendorNumber").alias("VendorNo"),
                     F.col("qty").alias("SalesQuantity"),
                     (F.col("ext") * (1 - F.col("disc"))).alias("SalesDollars"),
                     (F.col("ext") / F.col("qty")).alias("SalesPrice"),
                     (F.col("ext") * F.col("tax")).alias("ExciseTax")))


def purchases(spark: SparkSession, sf_dir: str, v: DataFrame | None = None) -> DataFrame:
    v = lines(spark, sf_dir) if v is None else v
    price = F.col("retail") * (1 + (F.col("VendorNumber") * 7 + F.col("Brand")) % 40)
    return (v.filter(F.col("st") == "O")
             .select("InventoryId", "VendorNumber", "VendorName", "Brand", "Description",
                     price.alias("PurchasePrice"), F.col("qty").alias("Quantity"),
                     (price * F.col("qty")).alias("Dollars"),
                     F.col("l_orderkey").alias("PONumber")))


def vendor_invoice(spark: SparkSession, sf_dir: str, purch: DataFrame | None = None) -> DataFrame:
    p = purch if purch is not None else purchases(spark, sf_dir)
    return (p.groupBy("VendorNumber", "PONumber")
             .agg(F.sum("Quantity").alias("Quantity"), F.sum("Dollars").alias("Dollars"))
             .withColumn("Freight", F.col("Dollars") * F.lit(0.005) * (F.col("VendorNumber") % 5))
             .select("VendorNumber", "PONumber", "Quantity", "Dollars", "Freight"))


def purchase_prices(spark: SparkSession, sf_dir: str, purch: DataFrame | None = None) -> DataFrame:
    p = purch if purch is not None else purchases(spark, sf_dir)
    return (p.groupBy("VendorNumber", "Brand")
             .agg(F.min("PurchasePrice").alias("PurchasePrice"))
             .select("VendorNumber", F.col("VendorNumber").alias("VendorNo"), "Brand",
                     "PurchasePrice", (F.col("PurchasePrice") * 1.3).alias("Price"),
                     F.when(F.col("VendorNumber") % 10 == 0, F.lit("Unknown"))
                      .otherwise(F.lit("750")).alias("Volume")))


@dataclass
class BaseTables:
    """The four base tables of the reference, as lazy DataFrames."""
    sales: DataFrame
    purchases: DataFrame
    vendor_invoice: DataFrame
    purchase_prices: DataFrame


def base_tables(spark: SparkSession, sf_dir: str) -> BaseTables:
    v = lines(spark, sf_dir)  # its files are listed and their schemas read once
    purch = purchases(spark, sf_dir, v)
    return BaseTables(sales=sales(spark, sf_dir, v), purchases=purch,
                      vendor_invoice=vendor_invoice(spark, sf_dir, purch),
                      purchase_prices=purchase_prices(spark, sf_dir, purch))


# The same derivation as SQL CTEs over the driver's views (runs in DuckDB and Spark SQL).
BASE_SQL = """
v_lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey AS VendorNumber,
         concat(s.s_name, '   ') AS VendorName,
         CAST(substr(p.p_brand, 7) AS BIGINT) AS Brand, p.p_name AS Description,
         concat(CAST(l.l_suppkey AS STRING), '_', substr(p.p_brand, 7)) AS InventoryId,
         CAST(l.l_quantity AS BIGINT) AS qty, l.l_extendedprice AS ext,
         l.l_discount AS disc, l.l_tax AS tax, l.l_linestatus AS st, p.p_retailprice AS retail
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                  JOIN supplier s ON s.s_suppkey = l.l_suppkey
),
sales AS (
  SELECT InventoryId, Brand, VendorNumber AS VendorNo, qty AS SalesQuantity,
         ext * (1 - disc) AS SalesDollars, ext / qty AS SalesPrice, ext * tax AS ExciseTax
  FROM v_lines WHERE st = 'F'
),
purchases AS (
  SELECT InventoryId, VendorNumber, VendorName, Brand, Description,
         retail * (1 + (VendorNumber * 7 + Brand) % 40) AS PurchasePrice, qty AS Quantity,
         retail * (1 + (VendorNumber * 7 + Brand) % 40) * qty AS Dollars, l_orderkey AS PONumber
  FROM v_lines WHERE st = 'O'
),
vendor_invoice AS (
  SELECT VendorNumber, PONumber, CAST(SUM(Quantity) AS BIGINT) AS Quantity, SUM(Dollars) AS Dollars,
         SUM(Dollars) * 0.005 * (VendorNumber % 5) AS Freight
  FROM purchases GROUP BY VendorNumber, PONumber
),
purchase_prices AS (
  SELECT VendorNumber, VendorNumber AS VendorNo, Brand, MIN(PurchasePrice) AS PurchasePrice,
         MIN(PurchasePrice) * 1.3 AS Price,
         CASE WHEN VendorNumber % 10 = 0 THEN 'Unknown' ELSE '750' END AS Volume
  FROM purchases GROUP BY VendorNumber, Brand
)"""
