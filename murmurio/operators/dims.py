"""The small dimension tables: sources, entities, collection targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.wordlists import SOURCES
from .skew import sized, first_per_key

TARGET_COLUMNS = ["entidade_codigo", "fonte_codigo", "canal", "rotulo", "termo_busca", "tipo",
                  "usar_na_busca", "ativo"]


def load_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, n, True) for c, n in SOURCES],
                                 "codigo string, nome string, ativa boolean")


def load_config(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """Frames of the collection configuration: a hand-written list of channels and names."""
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    reddit, meta, youtube = (config.get(k, {}) for k in ("reddit", "meta", "youtube"))
    profiles = enumerate(meta.get("perfis", []))
    channels = enumerate(youtube.get("canais_noticia", []))
    return {
        "perfis": frame(((i, p["nome"], p["page_id"]) for i, p in profiles),
                        "posicao int, nome string, page_id string"),
        "canais": frame(((i, c.get("nome"), c["channel_id"]) for i, c in channels),
                        "posicao int, nome string, channel_id string"),
        "subreddits": frame(((s,) for s in reddit.get("subreddits", [])), "canal string"),
        "termos_reddit": frame(((t,) for t in reddit.get("termo_busca", [])),
                               "termo_busca string"),
        "termos_youtube": frame(((t,) for t in youtube.get("termo_busca", [])),
                                "termo_busca string"),
    }


def entities(profiles: DataFrame) -> DataFrame:
    """Profiles (posicao, nome, page_id) -> one entity per slug: first name, last page id."""
    return profiles.withColumn("codigo", X.slugify("nome")).groupBy("codigo").agg(
        F.min_by("nome", "posicao").alias("nome_exibicao"),
        F.max_by("page_id", "posicao").alias("page_id"),
    )


def expand_targets(pairs: DataFrame, entity: DataFrame, fonte: str) -> DataFrame:
    """(channel, label, term) pairs -> targets of registered entities, without repeats.

    A leading 'r/' is cut from the channel; the term must name a registered entity.
    """
    cleaned = pairs.withColumns({
        "canal": X.strip(F.replace("canal", F.lit("r/"))),
        "entidade_codigo": X.slugify("termo_busca"),
        "_rotulo": F.struct("rotulo"),
    })
    known = entity.select(F.col("codigo").alias("entidade_codigo")).distinct()
    return (
        cleaned.join(sized(known), "entidade_codigo", "left_semi")
        .groupBy("entidade_codigo", "canal", "termo_busca")
        .agg(F.min("_rotulo")["rotulo"].alias("rotulo"))
        .select("entidade_codigo", F.lit(fonte).alias("fonte_codigo"), "canal", "rotulo",
                "termo_busca", F.lit("consulta").alias("tipo"),
                F.lit(True).alias("usar_na_busca"), F.lit(True).alias("ativo"))
    )


def channel_terms(channels: DataFrame, terms: DataFrame) -> DataFrame:
    """Every channel with every term; both lists are hand-written configuration.

    The terms are gathered into one array that each channel explodes.
    """
    # two literal lists of a few rows each
    listed = terms.distinct().agg(F.collect_set("termo_busca").alias("_termos"))
    return (
        channels.withColumn("_um", F.lit(1))
        .join(F.broadcast(listed.withColumn("_um", F.lit(1))), "_um")
        .withColumn("termo_busca", F.explode("_termos")).drop("_um", "_termos")
    )


def profile_targets(entity: DataFrame) -> DataFrame:
    """Ad pages: one target per entity, without a term."""
    return entity.where(F.col("page_id").isNotNull()).select(
        F.col("codigo").alias("entidade_codigo"), F.lit("meta").alias("fonte_codigo"),
        F.col("page_id").alias("canal"), F.lit(None).cast("string").alias("rotulo"),
        F.lit("").alias("termo_busca"), F.lit("handle").alias("tipo"),
        F.lit(True).alias("usar_na_busca"), F.lit(True).alias("ativo"))


def deactivate(entity: DataFrame, listed: DataFrame, alvo: DataFrame) -> DataFrame:
    """``ativa = false`` for entities that are neither listed nor own a target."""
    used = listed.select("codigo").unionByName(
        alvo.select(F.col("entidade_codigo").alias("codigo"))
    ).distinct().withColumn("_usada", F.lit(True))
    return entity.join(used, "codigo", "left").withColumn(
        "ativa", F.col("ativa") & F.col("_usada").isNotNull()
    ).drop("_usada").select(*entity.columns)


def registered_only(df: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    """Rows whose code is registered in a dimension."""
    codes = dim.select(F.col("codigo").alias(column))
    return df.join(sized(codes), column, "left_semi")


def codes(df: DataFrame, column: str) -> DataFrame:
    """Sorted list of the different codes."""
    return df.select(column).distinct().orderBy(column)


def check_enum(df: DataFrame, column: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) for a closed domain; null is rejected."""
    ok = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.where(ok), df.where(~ok)


def first_listed(df: DataFrame, key: str, position: str) -> DataFrame:
    """Order-preserving unique list: the first position of each key, in order."""
    return first_per_key(df, [key], [position]).orderBy(position)
