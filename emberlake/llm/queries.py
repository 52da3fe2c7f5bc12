"""The registered queries of the training-data operators and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberlake.llm import (chat, decontaminate, mixing, neardup, packing, quality, repair, repeats, secrets, sharding, toxicity,
                           trie, urls)
from emberlake.llm.common import table


def _op1(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def _op2(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_classes(table(spark, d, "documents"))


def _op3(spark: SparkSession, d: str) -> DataFrame:
    return chat.chat_report(table(spark, d, "conversations"))


def _op4(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def _op5(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def _op6(spark: SparkSession, d: str) -> DataFrame:
    return secrets.secret_report(table(spark, d, "documents"))


def _op7(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_documents(table(spark, d, "documents"))


def _op8(spark: SparkSession, d: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, d, "documents"))


def _op9(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_report(table(spark, d, "documents"))


def _op10(spark: SparkSession, d: str) -> DataFrame:
    return urls.judge_urls(table(spark, d, "pages"))


def _op11(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(table(spark, d, "documents"))


def _op12(spark: SparkSession, d: str) -> DataFrame:
    return trie.trie_report(table(spark, d, "conversations"))


def _op13(spark: SparkSession, d: str) -> DataFrame:
    return repair.repair_report(table(spark, d, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_containment": _op1,
    "op2_weighted_minhash": _op2,
    "op3_chat_perspectives": _op3,
    "op4_toxicity": _op4,
    "op5_best_fit_packing": _op5,
    "op6_secret_scan": _op6,
    "op7_sampled_splitters": _op7,
    "op8_suffix_dedup": _op8,
    "op9_quality_rules": _op9,
    "op10_url_filter": _op10,
    "op11_source_schedule": _op11,
    "op12_prefix_trie": _op12,
    "op13_structure_repair": _op13,
}

ORACLES: dict[str, str] = {
    "op1_benchmark_containment": decontaminate.ORACLE,
    "op3_chat_perspectives": chat.ORACLE,
    "op6_secret_scan": secrets.ORACLE,
    "op9_quality_rules": quality.ORACLE,
    "op10_url_filter": urls.ORACLE,
    "op11_source_schedule": mixing.ORACLE,
    "op12_prefix_trie": trie.ORACLE,
    "op13_structure_repair": repair.ORACLE,
}
