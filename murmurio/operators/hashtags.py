"""Hashtag frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import top_per_key

OWNER = ("fonte_codigo", "entidade_codigo")


def count(docs: DataFrame, text: str, by: Sequence[str] = OWNER) -> DataFrame:
    """Occurrences of every hashtag per group; counted in the map tasks before the shuffle."""
    tags = docs.select(*by, F.explode(X.extract_hashtags(text)).alias("hashtag"))
    return tags.groupBy(*by, "hashtag").agg(F.count("*").alias("contagem"))


def top(counts: DataFrame, n: int = 50, by: Sequence[str] = OWNER) -> DataFrame:
    """The ``n`` most frequent per group, ties by name."""
    return top_per_key(counts, by, [F.desc("contagem"), "hashtag"], n)
