"""Processed texts of a raw collection, in a side table keyed by the record's ``_id``.

The raw files are never written: no field and no broken line can get lost.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental
from ..operators.skew import first_per_key
from ..session import materialize
from ..sources.raw import CORRUPT, read_raw

# Text columns of each collection.
TEXT_COLUMNS = {
    "reddit": ["title", "selftext", "body"],
    "meta": ["ad_creative_bodies"],
    "youtube_comments": ["text"],
    "youtube_videos": ["title", "description"],
}


SIDE = "_id STRING, processed_text STRING, preprocessed_at TIMESTAMP"


def read_side(spark: SparkSession, target: str) -> DataFrame:
    """The latest processed text of each record."""
    try:
        side = spark.read.schema(SIDE).parquet(target)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        side = spark.createDataFrame([], SIDE)
    return first_per_key(side, ["_id"], [F.desc("preprocessed_at"), "processed_text"])


def with_processed(raw: DataFrame, side: DataFrame) -> DataFrame:
    """Raw records with the side table's text where it has one."""
    new = side.select("_id", F.col("processed_text").alias("_texto"), F.col("preprocessed_at").alias("_em"))
    return raw.join(new, "_id", "left").withColumns({
        "processed_text": F.coalesce("_texto", "processed_text"),
        "preprocessed_at": F.coalesce("_em", "preprocessed_at")}).drop("_texto", "_em").select(*raw.columns)


def run(spark: SparkSession, source: str, target: str, collection: str, stopwords: list[str],
        as_of: str, reprocess_all: bool = False, lemma=None) -> tuple[DataFrame, dict[str, int]]:
    """Append the processed texts that are due to ``target``; returns the records with their texts
    and how many were updated, and how many failed (broken lines, records without ``_id``).

    Raises when there was something to do and all of it failed.
    """
    raw = read_raw(spark, source, collection)
    lists = [c for c in TEXT_COLUMNS[collection] if dict(raw.dtypes)[c].startswith("array")]
    ready = with_processed(raw, read_side(spark, target)).withColumns(
        {c: F.array_join(c, " ") for c in lists})
    broken = F.col(CORRUPT).isNotNull() | F.col("_id").isNull()
    due = incremental.preprocess_incremental(
        ready.where(~broken), "_id", TEXT_COLUMNS[collection], stopwords, as_of, reprocess_all, lemma)
    done = materialize(due, "processados")
    counts = {"updated": done.count(), "failed": materialize(raw.where(broken).select(
        "_id", CORRUPT), "falhas").count()}
    if counts["failed"] and not counts["updated"] and raw.where(~broken).isEmpty():
        raise ValueError(f"all {counts['failed']} records of {source} failed")
    if counts["updated"]:
        done.write.mode("append").parquet(target)
    return with_processed(raw, read_side(spark, target)), counts
