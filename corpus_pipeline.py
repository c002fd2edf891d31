"""A corpus pipeline: every stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statewise.llm.decontaminate import decontaminate
from statewise.llm.line_spread import remove_shared_lines
from statewise.llm.mixing import mix
from statewise.llm.ngram_join import keep_one_of_each
from statewise.llm.repetition import keep_by_repetition
from statewise.workspace import settle_result


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return keep_by_repetition(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that many sources share."""
    return remove_shared_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of the sources takes."""
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mixture),
]

#: The n-gram join finds its links by sampled shared tokens, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle_result(spark, lambda: stage(spark, docs, sf_dir), name)  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
