"""From raw documents to a training mix: five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps. Each is
written as Parquet in the shared checkpoint folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import decontaminate, exact, minhash, mixing, toxicity
from docmill.llm.workspace import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text scores less than 0.5 stay, those with null or repeated ids and empty texts too."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, null and empty being equal, that with the largest id stays; a null id only where there is no other."""
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each connected group of texts with a similarity of 0.8 or more the smallest id stays; texts without words are like no other, and null ids stay."""
    return minhash.drop_near_copies(docs, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text has a passage of the benchmark go; null and empty texts stay."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, once each, with size, taken (words, at most twice the size), source_size and target; a null source is one of its own."""
    return mixing.take(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Training the toxicity model and the flow of the mix can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return docs
