"""The corpus pipeline: documents through quality rules, line dedup, near-duplicate
removal, benchmark decontamination and BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept;
``run`` writes every stage's result as Parquet under the shared checkpoint folder and
reads it back for the next. All stages but the last return the columns of ``docs``.
A verdict applies to its own row, whatever its doc_id: rows are known by a 64-bit hash of
all their columns, so only rows that are equal throughout share it. Of equal rows with words the near-duplicate
stage keeps one; of a component the row with the smallest doc_id, null being the largest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.llm import decontaminate, jaccard, lines, quality
from vendorlens.llm.common import stored, table
from vendorlens.llm.queries import bpe_digests


def _tagged(docs: DataFrame) -> DataFrame:
    """Each row as a struct ``doc``, with the key ``row`` of its content (nulls are told apart by their place)
    and what the operators read, so that no column of the table meets a name of ours."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*cols).alias("doc"), F.xxhash64(*[c.isNull() for c in cols], *cols).alias("row")).withColumns(
        {c: F.col(f"doc.`{c}`") for c in ("doc_id", "text", "lang") if c in docs.columns})


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Tagged ``rows`` less those whose ``row`` is in ``gone``."""
    return rows.join(gone.select("row").distinct(), "row", "left_anti")


def _plain(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _tagged(docs)
    return _plain(_without(rows, quality.assess(rows, "row").where(~F.col("kept"))), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.drop_recurring_lines(docs)
    cols = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("doc.text").cast(docs.schema["n_chars"].dataType)).otherwise(cols["n_chars"])
    return out.select(*[x.alias(c) for c, x in cols.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _tagged(docs)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row"))
    found = jaccard.near_duplicates(rows.select(key.alias("key"), "text"), "key")
    left = _without(rows, found.where(F.col("component_id.row") != F.col("key.row")).select("key.row"))
    copies = (found.where(F.col("n_shingles") > 0).groupBy("key.row").agg(F.count("*").alias("n"))
              .where("n > 1").select("row"))
    one = left.join(copies, "row", "left_semi").dropDuplicates(["row"])
    return _plain(left.join(copies, "row", "left_anti").unionByName(one), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _tagged(docs)
    found = decontaminate.verdicts(decontaminate.find_spans(rows, table(spark, sf_dir, "benchmark"), "row"), "row")
    return _plain(_without(rows, found.where("contaminated")), docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("BPE encoding", bpe_encoding)]

#: BPE ids aren't expressible in SQL; tests/llm hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
