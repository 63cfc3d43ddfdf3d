"""Samples for annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import draw_key, draw_rank

MIN_LENGTH = 15
FORM_COLUMNS = ["item_id", "form_id", "ordem_no_form", "rede_social", "id_origem", "contexto",
                "texto"]


def valid_reddit_comments(raw: DataFrame) -> DataFrame:
    body = F.col("body")
    return raw.where(
        (F.col("_tipo_documento") == "comentario") & body.isNotNull()
        & ~body.isin("[deleted]", "[removed]", "") & (F.char_length(body) >= MIN_LENGTH))


def valid_youtube_comments(raw: DataFrame) -> DataFrame:
    text = F.col("text")
    return raw.where(text.isNotNull() & (text != "") & (F.char_length(text) >= MIN_LENGTH))


def reddit_records(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("id_origem"), F.col("body").alias("texto"),
                      F.col("_termo_busca").alias("termo_busca"),
                      F.col("_subreddit_busca").alias("contexto"),
                      F.lit("reddit").alias("rede_social"))


def youtube_records(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("commentId").alias("id_origem"), F.col("text").alias("texto"),
                      F.col("_entidade_busca").alias("termo_busca"),
                      F.col("channelTitle").alias("contexto"),
                      F.lit("youtube").alias("rede_social"))


def sample_n(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """Uniform sample of ``n`` rows, the same for the same seed."""
    return df.orderBy(draw_key(seed, row_id), row_id).limit(n)


def assign_forms(sample: DataFrame, row_id: str, forms: int = 10, seed: int = 42,
                 name: str = "rede_social") -> DataFrame:
    """Spread N rows over F forms: N div F each, the first N mod F forms get one more.

    Item numbers run through all forms in the drawn order.
    """
    total = sample.count()
    base, extra = divmod(total, forms)
    ranked = draw_rank(sample, seed, row_id, name="_n")
    # rows in the forms that get one more come first
    ahead = extra * (base + 1)
    n = F.col("_n") - 1
    late = F.floor((n - ahead) / max(base, 1))
    form = F.when(n < ahead, F.floor(n / (base + 1))).otherwise(extra + late)
    start = F.when(n < ahead, form * (base + 1)).otherwise(ahead + (form - extra) * base)
    network = X.capitalize(name)
    return ranked.select(
        X.numbered(F.upper(name), "_n", 4).alias("item_id"),
        X.numbered(F.concat(F.lit("Form_"), network), form + 1, 2).alias("form_id"),
        (n - start + 1).cast("int").alias("ordem_no_form"),
        F.col(name).alias("rede_social"), F.col(row_id).alias("id_origem"),
        F.coalesce("contexto", F.lit("")).alias("contexto"),
        X.squeeze_spaces("texto").alias("texto"),
    )
