"""The queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lensgraph.llm import chat_format, decontaminate, language_id, line_dedup, mixing, near_dedup, pitman_yor, quality_fm, quality_rules, substring_dedup
from lensgraph.llm.session import id_remainder, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs, id_remainder("doc_id", 4) != 2))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_documents(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), pitman_yor.learnable())


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.quality(docs, quality_fm.train(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table as an event log: each row is one whole message.
    log = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(log.unionByName(spark.createDataFrame(chat_format.CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_mix_sources": op6_mix_sources,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_format": op9_chat_format,
    "op10_line_dedup": op10_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op3_benchmark_decontamination": decontaminate.ORACLE,
    "op4_minhash_near_dedup": near_dedup.ORACLE,
    "op9_chat_format": chat_format.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
}
