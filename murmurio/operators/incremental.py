"""What is still to be done: rows without a result yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as D
from ..functions import text as X
from ..functions.wordlists import MODELLED_TYPE

SCORED_TYPES = ["comentario", "resposta"]


def pending_sentiment(docs: DataFrame, sentiment: DataFrame, day: str | None = None,
                      day_mode: str = "half_open", model_id: int | None = None) -> DataFrame:
    """Comments and replies with a text and without a score, over all history or of one day.

    A score of any model counts unless ``model_id`` is given.
    """
    wanted = docs.where(F.col("texto").isNotNull() & F.col("tipo").isin(SCORED_TYPES))
    if day is not None:
        wanted = wanted.where(D.on_day("coletado_em", day, day_mode))
    if model_id is not None:
        sentiment = sentiment.where(F.col("modelo_id") == model_id)
    scored = sentiment.select(F.col("documento_id").alias("id"))
    return wanted.join(scored, "id", "left_anti")


def modelled_type(fonte: str = "fonte_codigo"):
    """Document type that is modelled for a source."""
    mapping = F.create_map(*[F.lit(x) for pair in MODELLED_TYPE.items() for x in pair])
    return F.element_at(mapping, F.col(fonte))


def pending_topics(docs: DataFrame, assigned: DataFrame, topics: DataFrame,
                   scope: str = "any") -> DataFrame:
    """Documents of the modelled type with a text and without a topic.

    ``docs`` carries ``fonte_codigo``. With ``scope='any'`` a topic of any model counts; with
    ``scope='model'`` only one of the document's own model (``docs`` carries ``modelo_id``).
    """
    wanted = docs.where(F.col("texto").isNotNull() & (F.col("tipo") == modelled_type()))
    done = assigned.select(F.col("documento_id").alias("id"), "topico_id")
    if scope == "any":
        return wanted.join(done.select("id"), "id", "left_anti")
    if scope == "model":
        owned = topics.select(F.col("id").alias("topico_id"), "modelo_id")
        return wanted.join(done.join(owned, "topico_id").select("id", "modelo_id"),
                           ["id", "modelo_id"], "left_anti")
    raise ValueError(f"unknown scope {scope!r}")


def unprocessed(raw: DataFrame, reprocess_all: bool = False) -> DataFrame:
    return raw if reprocess_all else raw.where(F.col("processed_text").isNull())


def preprocess_incremental(raw: DataFrame, key: str, columns: list[str], stopwords, as_of,
                           reprocess_all: bool = False, lemma=None) -> DataFrame:
    """(key, processed_text, preprocessed_at) for the rows still without a processed text."""
    pending = unprocessed(raw, reprocess_all)
    have = [c if c in raw.columns else F.lit("") for c in columns]
    merged = X.concat_columns(*have)
    return pending.select(
        key, X.preprocess(merged, stopwords, lemma).alias("processed_text"),
        F.lit(as_of).cast("timestamp").alias("preprocessed_at"))


def after_clean(df: DataFrame, column: str) -> DataFrame:
    """Rows that still have a text after cleaning."""
    return df.where(X.strip(column) != "")
