"""The corpus pipeline: five stages over the documents, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmurio.llm import decontamination, neardup, quality, toxicity, wordbpe
from murmurio.session import configure, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines their host repeats."""
    return quality.apply_quality(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; learned from the labelled ones among them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return neardup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left, with the digests of ids and decoded text."""
    return wordbpe.digests(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding and decoding", bpe_encoding),
]
ORACLE_SQL = None  # the toxicity model and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage is written as Parquet and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
