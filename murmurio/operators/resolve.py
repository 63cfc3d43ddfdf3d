"""Resolving documents to collection targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import sized, first_per_key, salted_join

TARGET_KEY = ["fonte", "canal", "termo_busca"]


def _target_keys(alvo: DataFrame) -> DataFrame:
    return alvo.select(
        F.col("fonte_codigo").alias("fonte"), "canal", "termo_busca",
        F.col("id").alias("alvo_coleta_id"),
    )


def targets(docs: DataFrame, alvo: DataFrame) -> DataFrame:
    """Replace (source, channel, term) by the target id; documents without a target drop out."""
    return docs.join(sized(_target_keys(alvo).distinct()), TARGET_KEY).drop(
        *TARGET_KEY)


def rejects(docs: DataFrame, alvo: DataFrame) -> DataFrame:
    """Documents that ``targets`` drops."""
    keys = _target_keys(alvo).select(*TARGET_KEY).distinct()
    return docs.join(sized(keys), TARGET_KEY, "left_anti")


def ambiguous(alvo: DataFrame) -> DataFrame:
    """Keys that lead to more than one target."""
    return (
        _target_keys(alvo).groupBy(*TARGET_KEY)
        .agg(F.min("alvo_coleta_id").alias("primeiro"), F.max("alvo_coleta_id").alias("ultimo"))
        .where("primeiro <> ultimo")
    )


def assert_unique(alvo: DataFrame) -> DataFrame:
    """The targets unchanged; raises when a key is ambiguous."""
    found = ambiguous(alvo).first()
    if found is not None:
        raise ValueError(f"ambiguous collection target: {found.asDict()}")
    return alvo


def comment_channel(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Channel of each comment through its video; null when the video is unknown.

    One video may own a large share of the comments, so its rows are salted.
    """
    channels = first_per_key(
        videos.where(F.col("videoId").isNotNull()).select("videoId", "channelId"),
        ["videoId"], ["channelId"],
    )
    return salted_join(comments, channels, ["videoId"], ["commentId"])


def comment_title(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Term of each comment: its video's channel title or term, else its own channel title."""
    titles = first_per_key(
        videos.where(X.blank_to_null("videoId").isNotNull()).select(
            "videoId", X.first_filled("channelTitle", "_entidade_busca").alias("_titulo")),
        ["videoId"], ["_titulo"],
    )
    joined = salted_join(comments, titles, ["videoId"], ["commentId"])
    return joined.withColumn("termo", X.first_filled("_titulo", "channelTitle")).drop("_titulo")


def _lookup(alvo: DataFrame) -> DataFrame:
    """Target per key, for the channel as written and for its normalised form."""
    written = alvo.select(F.col("fonte_codigo").alias("fonte"), F.col("canal").alias("_canal"),
                          F.col("termo_busca").alias("_termo"), "id", F.lit(0).alias("_grau"))
    plain = written.withColumns({"_canal": X.normalize_target("_canal"), "_grau": F.lit(1)})
    both = written.unionByName(plain.where(F.col("_canal").isNotNull()))
    return first_per_key(both, ["fonte", "_canal", "_termo"], ["_grau", "id"]).drop("_grau")


def with_fallback(docs: DataFrame, alvo: DataFrame, channel: Column | str = "canal",
                  term: Column | str = "termo_busca") -> DataFrame:
    """Target by the channel as written, else by the normalised channel; null when neither hits."""
    lookup = sized(_lookup(alvo))
    exact = lookup.withColumnRenamed("id", "_exato")
    plain = lookup.withColumnRenamed("id", "_normal")
    term = F.coalesce(X.strip(term), F.lit(""))
    out = docs.withColumns({"_canal": X.strip(channel), "_termo": term})
    out = out.join(exact, ["fonte", "_canal", "_termo"], "left")
    out = out.withColumn("_canal", X.normalize_target("_canal"))
    out = out.join(plain, ["fonte", "_canal", "_termo"], "left")
    return out.withColumn("alvo_coleta_id", F.coalesce("_exato", "_normal")).drop(
        "_exato", "_normal", "_canal", "_termo")


def channel(requests: DataFrame, channels: DataFrame, wanted: str = "pedido") -> DataFrame:
    """Name and id of a channel given by either, ignoring case; no hit -> the input for both.

    ``channels`` has ``posicao, nome, channel_id``; the first listed hit wins, a channel without a
    name gives ''.
    """
    channels = channels.withColumn("nome", F.coalesce("nome", F.lit("")))
    by_name = channels.select(F.lower("nome").alias("_chave"), "posicao", "nome", "channel_id")
    by_id = channels.select(F.lower("channel_id").alias("_chave"), "posicao", "nome", "channel_id")
    lookup = first_per_key(by_name.unionByName(by_id), ["_chave"], ["posicao"]).drop("posicao")
    key = F.lower(X.strip(wanted))
    return (
        requests.withColumn("_chave", key)
        .join(sized(lookup), "_chave", "left")
        .withColumns({"nome": F.coalesce("nome", wanted),
                      "channel_id": F.coalesce("channel_id", wanted)})
        .drop("_chave")
    )


def of_entity(docs: DataFrame, alvo: DataFrame) -> DataFrame:
    """Documents with the source and the entity of their target."""
    owner = alvo.select(F.col("id").alias("alvo_coleta_id"), "fonte_codigo", "entidade_codigo")
    return docs.join(sized(owner), "alvo_coleta_id")


def loaded_keys(docs: DataFrame, alvo: DataFrame) -> DataFrame:
    """(source, target, native id) of every loaded document."""
    owner = alvo.select(F.col("id").alias("alvo_coleta_id"), F.col("fonte_codigo").alias("fonte"))
    return docs.select("alvo_coleta_id", "id_nativo").join(
        sized(owner), "alvo_coleta_id"
    ).select("fonte", "alvo_coleta_id", "id_nativo").distinct()


def canonical_targets(alvo: DataFrame, identities: DataFrame) -> DataFrame:
    """Old target id -> the target that stays, for channels that have a stable identity.

    ``identities`` has ``fonte_codigo, canal, entidade_codigo``. Among the targets of a channel the
    one that already carries the entity's code stays, else the lowest id.
    """
    owner = identities.select("fonte_codigo", "canal", F.col("entidade_codigo").alias("_codigo"))
    known = alvo.join(sized(owner), ["fonte_codigo", "canal"])
    preferred = F.struct((F.col("entidade_codigo") != F.col("_codigo")).alias("alheio"), "id")
    keep = known.groupBy("fonte_codigo", "canal").agg(
        F.min_by("id", preferred).alias("canonico"), F.first("_codigo").alias("entidade_codigo"))
    return known.select("id", "fonte_codigo", "canal").join(keep, ["fonte_codigo", "canal"]).select(
        F.col("id").alias("alvo_coleta_id"), "canonico", "entidade_codigo")


def merge_target_documents(docs: DataFrame, moves: DataFrame) -> DataFrame:
    """Documents re-pointed to their canonical target.

    A document of an old target goes when the canonical target has the same native id; between
    several old targets the lowest target id keeps its copy.
    """
    plan = sized(moves.select("alvo_coleta_id", "canonico"))
    # only documents of the channels concerned are shuffled
    untouched = docs.join(plan, "alvo_coleta_id", "left_anti")
    moved = docs.join(plan, "alvo_coleta_id").withColumns({
        "_legado": F.col("canonico") != F.col("alvo_coleta_id"),
        "_antigo": F.col("alvo_coleta_id"),
        "alvo_coleta_id": F.col("canonico"),
    })
    kept = first_per_key(moved, ["alvo_coleta_id", "id_nativo"], ["_legado", "_antigo"])
    return untouched.unionByName(kept.select(*docs.columns))


def merge_targets(alvo: DataFrame, moves: DataFrame) -> DataFrame:
    """Targets without the old ones; the canonical target carries the entity's code."""
    plan = moves.select(F.col("alvo_coleta_id").alias("id"), "canonico",
                        F.col("entidade_codigo").alias("_codigo"))
    joined = alvo.join(sized(plan), "id", "left")
    stays = F.col("canonico").isNull() | (F.col("canonico") == F.col("id"))
    return joined.where(stays).withColumn(
        "entidade_codigo", F.coalesce("_codigo", "entidade_codigo")
    ).drop("canonico", "_codigo")
