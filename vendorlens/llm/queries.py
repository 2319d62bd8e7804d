"""The checked queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from importlib.util import find_spec
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.llm import (attribution, bayes, bpe, chat, decontaminate, divergence, jaccard, lines, pages, quality,
                            repeats, search, suffixes)
from vendorlens.llm.common import table

#: Where the public vocabulary files lie; every operator takes the path as a parameter.
TOKENIZERS = os.environ.get("VENDORLENS_TOKENIZERS") or (
    os.path.dirname(find_spec("public_tokenizers").origin) if find_spec("public_tokenizers")
    else "/opt/tokenizers")
BYTE_BPE = os.path.join(TOKENIZERS, "byte_bpe_50k.json")


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row per document."""
    return bpe.encode_decode(docs, BYTE_BPE).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.turns_as_calls(table(spark, sf_dir, "conversations"))
    return chat.link_calls(calls, results, chat.turn_schemas(spark)).select(
        F.col("id").alias("call_id"), F.col("at").alias("turn"), "tool", "depth", "linked",
        (F.size("errors") == 0).alias("valid"), F.sha2("line", 256).alias("line_sha256"))


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE).select(
        "doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_bpe_encode_decode": op3_bpe_encode_decode,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_source_divergence": op13_source_divergence,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_chat_formatting": chat.ORACLE_SQL,
    "op7_line_dedup": lines.ORACLE_SQL,
    "op8_decontaminate": decontaminate.ORACLE_SQL,
    "op12_ranked_search": search.ORACLE_SQL,
    "op13_source_divergence": divergence.ORACLE_SQL,
}
