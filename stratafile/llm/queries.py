"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratafile.llm.byte_bpe import byte_bpe_report
from stratafile.llm.byte_cnn import quality_scores
from stratafile.llm.conversations import damage_report
from stratafile.llm.divergence import audit
from stratafile.llm.edit_counts import token_count_report
from stratafile.llm.licenses import license_report
from stratafile.llm.mixing import mixing_report
from stratafile.llm.near_dups import near_duplicates
from stratafile.llm.packing import packing_report
from stratafile.llm.quality_rules import quality_report
from stratafile.llm.sql import ORACLES
from stratafile.llm.substrings import substring_report
from stratafile.llm.tables import table
from stratafile.llm.topk import top_k_report
from stratafile.llm.toxicity import toxicity_report

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_report(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count_report(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_report(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_near_dups": op1_near_dups,
    "op2_quality": op2_quality,
    "op3_top_k": op3_top_k,
    "op4_packing": op4_packing,
    "op5_substrings": op5_substrings,
    "op6_quality_rules": op6_quality_rules,
    "op7_licenses": op7_licenses,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_divergence": op12_divergence,
    "op13_conversations": op13_conversations,
}

__all__ = ["ORACLES", "QUERIES"]
