"""The training-corpus pipeline: five operators in a row over the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` and the check tool write each result as Parquet
and read it again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from premia.llm import decontam, mixing, quality, repeats, simhash
from premia.llm.arrays import prepare
from premia.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality by text, source and section is at least one half."""
    prepare(spark)
    return quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of 200 bytes and more; the first copy stays."""
    prepare(spark)
    return repeats.without_repeats(docs, 200)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    prepare(spark)
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to target weights: a row per copy taken."""
    prepare(spark)
    return mixing.mixed_copies(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

# Classifier, XXH64 and suffix order cannot be put in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
