"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it again for the next stage. All stages but the last
return the columns of ``documents``.

Defined cases: null texts go through every stage as empty texts; a stage that receives no row returns none; rows of one
id are judged one by one, except that near-duplicate removal keeps one row of each group; columns beyond those of ``documents``
are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import TOKENIZER, Workspace, ship_package, table
from tidewater.llm.decontam import clean_rows
from tidewater.llm.jaccard import keep_one
from tidewater.llm.packing import pack_documents
from tidewater.llm.quality import keep_quality
from tidewater.llm.suffix import without_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship_package(spark)
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near duplicates."""
    ship_package(spark)
    return keep_one(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; those with nothing left go."""
    ship_package(spark)
    return without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    ship_package(spark)
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequences."""
    ship_package(spark)
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokens, scores of trained models and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
