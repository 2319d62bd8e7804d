"""File sources and sinks, catalog helpers.

Paths go through Hadoop's FileSystem API, so the same code lists local folders,
HDFS or object stores. Per-file work (one table per CSV) loops over file *names* on
the driver; the data itself is only ever read and written by Spark tasks.
"""

from __future__ import annotations

import logging
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorlens.functions.frames import attach
from vendorlens.sources.versions import manifest, publish, replace_table

log = logging.getLogger(__name__)

# Base-table schemas of the reference's raw CSVs (FIXTURES.md section 1).
BASE_SCHEMAS = {
    "purchases": "InventoryId string, VendorNumber bigint, VendorName string, Brand bigint, Description string, "
                 "PurchasePrice double, Quantity bigint, Dollars double, PONumber bigint",
    "sales": "InventoryId string, Brand bigint, VendorNo bigint, SalesQuantity bigint, SalesDollars double, "
             "SalesPrice double, ExciseTax double",
    "vendor_invoice": "VendorNumber bigint, PONumber bigint, Quantity bigint, Dollars double, Freight double",
    "purchase_prices": "VendorNumber bigint, VendorNo bigint, Brand bigint, PurchasePrice double, Price double, "
                       "Volume string",
}

# Strings that pandas read_csv takes as missing, beyond the empty field.
PANDAS_NULLS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                "NULL", "NaN", "None", "n/a", "nan", "null"]

CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def list_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """File paths directly under ``path`` ending in ``suffix`` (names only, via Hadoop FS)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(suffix) and not name.startswith((".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def _stem(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0]


def normalise_nulls(df: DataFrame) -> DataFrame:
    """Map pandas' missing-value spellings in text columns to NULL (exact spellings, as pandas has them)."""
    return df.select(*[F.when(~F.col(f"`{f.name}`").isin(PANDAS_NULLS), F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_text_csv(spark: SparkSession, path: str, names=None) -> DataFrame:
    """A CSV with header, all columns as text, missing-value spellings as NULL. ``names``: expected columns."""
    r = spark.read.option("header", "true")
    if names:
        r = r.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).option("enforceSchema", "false")
    return normalise_nulls(r.csv(path))


def _typed(schema: str) -> T.StructType:
    return T.StructType.fromDDL(schema)


def _cast(f: T.StructField):
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.StringType):
        return c
    c = F.trim(c)
    if isinstance(f.dataType, (T.LongType, T.IntegerType)):  # a whole float is a whole number, as in pandas
        x = c.try_cast("double")
        return F.coalesce(c.try_cast(f.dataType), F.when(x % 1 == 0, x.try_cast(f.dataType)))
    return c.try_cast(f.dataType)


def cast_csv(text: DataFrame, schema: str) -> DataFrame:
    """Columns of ``schema`` from text: what doesn't parse becomes NULL."""
    return text.select(*[_cast(f).alias(f.name) for f in T.StructType.fromDDL(schema).fields])


def unparsed(schema: str, where=None) -> list:
    """For each typed column the count of cells with text that doesn't parse, of rows with ``where``."""
    typed = [f for f in T.StructType.fromDDL(schema).fields if not isinstance(f.dataType, T.StringType)]
    rows = F.lit(True) if where is None else where
    return [(f.name, F.count_if(rows & F.col(f"`{f.name}`").isNotNull() & _cast(f).isNull())) for f in typed]


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header; explicit schema when known, else all columns as text."""
    if not schema:
        return read_text_csv(spark, path)
    return cast_csv(read_text_csv(spark, path, T.StructType.fromDDL(schema).names), schema)


def ingest(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Write a frame as a named table, replacing it.

    With ``path`` the table is a folder of versions with a manifest (``versions``), which any session reads
    with ``read_table``; a load that fails leaves the old version as it is. Without it, a catalog
    table via ``saveAsTable``.
    """
    if path:
        out = replace_table(df, path)
        out.createOrReplaceTempView(name)
        return out
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


#: Files that one job loads together, and jobs that run at a time.
TOGETHER = 32
JOBS = 4


def load_raw_data(spark: SparkSession, src_dir: str, dest_dir: str | None = None, schemas=BASE_SCHEMAS) -> DataFrame:
    """Every ``*.csv`` under ``src_dir`` becomes a table named by its file stem.

    Files with the same columns load as one job, told apart by ``_metadata.file_path``, and each is read once:
    rows and cells that don't parse as their column's type are observed while the tables are written. Such
    cells become NULL and are counted in ``error``; a file that can't be read is logged and skipped (its
    group's other files are loaded without it), and its old table stays. Returns the report (table, rows,
    columns, status, error).
    """
    groups, report = defaultdict(list), []
    for f in list_files(spark, src_dir, ".csv"):
        schema = schemas.get(_stem(f))
        try:
            key = schema or ", ".join(f"`{c}` string" for c in spark.read.option("header", "true").csv(f).columns)
            groups[key].append(f)
        except Exception as e:
            report.append(_failed(f, e))
    jobs = [(schema, files[i:i + TOGETHER]) for schema, files in groups.items() for i in range(0, len(files), TOGETHER)]
    with ThreadPoolExecutor(JOBS) as pool:
        for rows in pool.map(lambda job: _load(spark, *job, dest_dir), jobs):
            report += rows
    schema = "table string, rows bigint, columns int, status string, error string"
    return spark.createDataFrame(sorted(report, key=lambda r: r[0]), schema)


def _failed(path: str, e: Exception):
    log.warning("failed to load %s: %s", path, e)
    return _stem(path), None, None, "error", str(e)[:500]


def _load(spark: SparkSession, schema: str, files: list[str], dest_dir: str | None) -> list[tuple]:
    """Load ``files`` of one schema in a job; if that fails and there are several, one by one."""
    try:
        return _load_together(spark, schema, files, dest_dir)
    except Exception as e:  # one bad file must not stop the others
        if len(files) == 1:
            return [_failed(files[0], e)]
        return [row for f in files for row in _load(spark, schema, [f], dest_dir)]


def _load_together(spark: SparkSession, schema: str, files: list[str], dest_dir: str | None) -> list[tuple]:
    fields = T.StructType.fromDDL(schema)
    names = [_stem(f) for f in files]
    reader = spark.read.option("header", "true").option("enforceSchema", "false").schema(
        T.StructType([T.StructField(n, T.StringType()) for n in fields.names]))
    text = reader.csv(files)
    # an exported table is a folder x.csv of part files, a raw one a file x.csv: the path holds x.csv last or last but one
    steps = F.split(F.url_decode("_metadata.file_path"), "/")
    ends = [F.element_at(steps, -1), F.element_at(steps, -2)]
    name = F.coalesce(*[F.when(e == f.rstrip("/").rsplit("/", 1)[-1], F.lit(n)) for e in ends for f, n in zip(files, names)])
    text = normalise_nulls(text.select(*[F.col(f"`{n}`") for n in fields.names], name.alias("__table")))
    seen = Observation()
    metrics = []
    for i, n in enumerate(names):
        mine = F.col("__table") == n
        metrics.append(F.count_if(mine).alias(f"rows {i}"))
        metrics += [count.alias(f"bad {i} {c}") for c, count in unparsed(schema, mine)]
    rows = text.observe(seen, *metrics).select(*[_cast(f).alias(f.name) for f in fields.fields], "__table")
    if dest_dir is None:
        if len(files) > 1:
            raise ValueError("catalog tables are written one by one")
        rows.drop("__table").write.mode("overwrite").saveAsTable(names[0])
    else:
        root = f"{dest_dir.rstrip('/')}/_loads/{uuid.uuid4().hex}"
        rows.write.partitionBy("__table").parquet(root)
    got, out = seen.get, []
    for i, n in enumerate(names):
        if dest_dir is not None:
            version = f"{root}/__table={n}"
            _make_folder(spark, version)  # a file without rows has none
            path = f"{dest_dir.rstrip('/')}/{n}"
            publish(spark, path, version, fields, {"rows": got[f"rows {i}"]})
            spark.read.schema(fields).parquet(version).createOrReplaceTempView(f"`{n}`")
        bad = {c: got[f"bad {i} {c}"] for c, _ in unparsed(schema)}
        note = ", ".join(f"{c}: {k} not parsed" for c, k in bad.items() if k) or None
        out.append((n, got[f"rows {i}"], len(fields.names), "ok", note))
    return out


def _make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def written_counts(spark: SparkSession, paths: dict) -> DataFrame:
    """Rows of each written table {name: path}, as observed while it was written."""
    rows = [(n, manifest(spark, p)["rows"]) for n, p in paths.items()]
    return spark.createDataFrame(rows, "table string, rows bigint")


def first_rows(spark: SparkSession, out_dir: str, k: int = 3) -> DataFrame:
    """The first ``k`` rows of each exported CSV in file order -> (file, row, column, value as text).

    The order is that of part file, block and place within the block; each task passes on its first ``k``
    rows of a file, so no file is sorted as a whole.
    """
    parts = []
    for p in list_files(spark, out_dir, ".csv"):
        df = spark.read.option("header", "true").csv(p)
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in df.columns])
        parts.append(df.select(F.lit(_stem(p)).alias("file"), F.col("_metadata.file_name").alias("_part"),
                               F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"),
                               cells.alias("_cells")))
    if not parts:
        return spark.createDataFrame([], "file string, row int, column string, value string")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    order = Window.partitionBy("file").orderBy("_part", "_block", "_at")
    return every.withColumn("row", F.row_number().over(order)).where(F.col("row") <= k).select("file", "row", F.inline("_cells"))


def void_safe(df: DataFrame) -> DataFrame:
    """Give untyped NULL columns a type (the CSV writer rejects VOID)."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType)
                       else F.col(f.name) for f in df.schema.fields])


def export_csvs(tables: dict, out_dir: str, order=None) -> list[str]:
    """Write each named frame as a CSV folder ``out_dir/name.csv`` (header, overwrite).

    ``order``: {name: columns}; such a table's rows stand in that order through its part files.
    """
    paths = []
    for name, df in tables.items():
        p = f"{out_dir.rstrip('/')}/{name}.csv"
        if order and name in order:
            df = df.orderBy(*order[name])
        void_safe(df).write.options(**CSV_WRITE).mode("overwrite").csv(p)
        paths.append(p)
    return paths


def validate_exports(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per exported CSV: rows, columns and NULL cells per column -> long frame
    (file, column, rows, columns, nulls, status); a file that fails is reported, not raised."""
    parts = []
    schema = "file string, column string, rows bigint, columns int, nulls bigint, status string"
    for p in list_files(spark, out_dir, ".csv"):
        name = _stem(p)
        try:
            df = spark.read.option("header", "true").csv(p)
            cols = df.columns
            agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                         *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
            structs = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(cols)]
            parts.append(agg.select(F.lit(name).alias("file"), F.col("_rows").alias("rows"),
                                    F.inline(F.array(*structs)))
                            .select("file", "column", "rows", F.lit(len(cols)).alias("columns"), "nulls",
                                    F.lit("ok").alias("status")))
        except Exception as e:
            log.warning("cannot validate %s: %s", p, e)
            parts.append(spark.createDataFrame([(name, None, None, None, None, f"error: {str(e)[:200]}")], schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def list_tables(spark: SparkSession, exclude_prefix: str = "sqlite_") -> DataFrame:
    """Tables and views of the current catalog, ordered by name."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()
            if not t.name.startswith(exclude_prefix)]
    return spark.createDataFrame(rows, "name string, tableType string, isTemporary boolean").orderBy("name")


def table_counts(tables: dict) -> DataFrame:
    """Row count per named frame, as one union of single-row aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, order, n: int = 5) -> DataFrame:
    """The first rows of a table in the order of ``order`` and then of all its columns."""
    return df.orderBy(*order, *[c for c in df.columns if c not in order]).limit(n)


def require_tables(spark: SparkSession, names) -> DataFrame:
    """Fail listing the missing tables; returns (table, present) when all exist."""
    have = {t.name for t in spark.catalog.listTables()}
    missing = [n for n in names if n not in have]
    if missing:
        raise RuntimeError(f"Missing base tables: {missing}")
    return spark.createDataFrame([(n, True) for n in names], "table string, present boolean")


def key_coverage(vss: DataFrame, final_vendor: DataFrame, final_brand: DataFrame) -> DataFrame:
    """Distinct vendors and brands in the sales summary against the final tables (one row)."""
    a = vss.agg(F.countDistinct("VendorNumber").alias("summary_vendors"), F.countDistinct("Brand").alias("summary_brands"))
    b = final_vendor.agg(F.countDistinct("VendorNumber").alias("final_vendors"))
    c = final_brand.agg(F.countDistinct("Brand").alias("final_brands"))
    return attach(attach(a, b), c)


def sample_rows(df: DataFrame, n: int = 5000, seed: int = 0, keys=("VendorNumber",)) -> DataFrame:
    """Reproducible sample of up to ``n`` rows, ordered by a keyed hash."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
