"""The training-data pipeline: documents to packed token windows, each stage one operator over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdclake.llm.jaccard import one_of_each
from cdclake.llm.mixing import sample
from cdclake.llm.packing import pack
from cdclake.llm.quality import clean_documents
from cdclake.llm.scratch import Scratch
from cdclake.llm.substrings import PASSAGE, without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 or more connect."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that occur anywhere else too."""
    return without_repeats(docs, length=PASSAGE, unit="words")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens are raked to source, language and topic shares."""
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens stand in windows of the model's length."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if before:
            scratch.drop(before)
        before = f"stage{k}"
    return docs
