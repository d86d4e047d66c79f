"""The corpus pipeline: quality rules, near-duplicates, repeated substrings, source mixture, packing.

Each stage reads what the one before wrote; all but the last return the columns of documents. When a stage begins, the
result of the one before is written, so the tables that stood behind it are dropped. No SQL twin is given: the
near-duplicate and packing stages have none that works on the rows of the stage before; tests hold each stage against
brute force.

In every stage: rows are judged by doc_id, text and source, and other columns, whatever their names, are carried along; a
null in one of them changes nothing. Repeated rows are rows of their own unless a stage says otherwise. Texts of any length
are taken whole. An empty table gives an empty result of the same columns.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from stratafile.llm.mixing import mixed_documents
from stratafile.llm.near_dups import one_of_each
from stratafile.llm.packing import pack_documents
from stratafile.llm.quality_rules import keep_good
from stratafile.llm.substrings import without_repeats
from stratafile.llm.tables import drop_stored, scope, small_batches, stored, table

SCOPE = "pipeline stage"


def alone(stage):
    """A stage that drops what the stage before has left and whose own tables the next one drops."""

    @functools.wraps(stage)
    def run_alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_stored(spark, SCOPE)
        small_batches(spark)
        with scope(SCOPE):
            return stage(spark, docs, sf_dir)

    return run_alone


@alone
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null and empty texts among them, having fewer than 10 words. A null
    source is a host of its own; equal rows have equal verdicts."""
    return keep_good(docs)


@alone
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest doc_id, of several rows with it the longest text
    (ties: the smallest text). Rows without doc_id all stay, and so do null and empty texts of ids of their own."""
    return one_of_each(docs)


@alone
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that start earlier elsewhere go; every document stays, null and short texts unchanged. A null
    doc_id is the smallest; of rows with one id those stored first come first."""
    return without_repeats(docs)


@alone
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the mixture takes. A null source is the last one; null and empty texts have size 0
    and are taken as often as their source is taken whole; ties are broken by doc_id."""
    return mixed_documents(docs)


@alone
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids; a null or empty text is its closing id alone. Each row, repeated or not,
    gets pieces of its own. The columns are those of the pieces."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", substrings),
    ("source mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
