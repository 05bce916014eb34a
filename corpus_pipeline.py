"""The corpus pipeline: documents to a mixed training order.

Each stage works on all that its predecessor kept; the result of a stage is
written as Parquet and read again as the documents of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldweave.llm import line_dedup, minhash, mixing, quality_rules, tiling
from goldweave.operators.storage import new_folder


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, boilerplate lines too. Null and
    empty texts go; repeated rows are judged alike, one by one."""
    return quality_rules.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the
    smallest id; of rows that repeat in full one stays."""
    return minhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out of the later ones; a
    document stays with what is left of it, were it nothing."""
    return line_dedup.cut_text(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go; null texts stay."""
    return tiling.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, in training order. Texts without a
    word are taken with nothing and get no row."""
    return mixing.training_order(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# near-duplicate components and tiling are not expressible in SQL; tests hold
# the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
