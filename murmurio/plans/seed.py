"""Configuration -> sources, entities and collection targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims, resolve
from ..operators.upsert import insert_ignore, surrogate_id, update_cols
from ..schemas import TABLE_KEYS
from ..sources.sinks import read_partitioned, read_table, replace_partitions, write_table


def targets_of(frames: dict[str, DataFrame], entity: DataFrame) -> DataFrame:
    """Targets of all sources: ad pages, channels x terms of the forum and of the videos."""
    no_label = F.lit(None).cast("string")
    forum = dims.channel_terms(frames["subreddits"].withColumn("rotulo", no_label),
                               frames["termos_reddit"])
    video = dims.channel_terms(frames["canais"].select(F.col("channel_id").alias("canal"),
                                                       F.col("nome").alias("rotulo")),
                               frames["termos_youtube"])
    found = dims.profile_targets(entity).unionByName(
        dims.expand_targets(forum, entity, "reddit")).unionByName(
        dims.expand_targets(video, entity, "youtube"))
    return found.withColumn("id", surrogate_id(*TABLE_KEYS["alvo_coleta"]))


def run(spark: SparkSession, config: dict, root: str) -> None:
    """Idempotent: running it again after editing the configuration adds and updates."""
    frames = dims.load_config(spark, config)
    entity = dims.entities(frames["perfis"])
    write_table(insert_ignore(read_table(spark, root, "fonte"), dims.load_sources(spark),
                              ["codigo"], ["codigo"]), root, "fonte")
    listed = entity.select("codigo", "nome_exibicao").withColumn("ativa", F.lit(True))
    stored = update_cols(read_table(spark, root, "entidade"), listed, ["codigo"],
                         ["nome_exibicao", "ativa"], ["codigo"])
    alvo = reconcile(spark, root, entity)
    alvo = write_table(
        update_cols(alvo, targets_of(frames, entity), TABLE_KEYS["alvo_coleta"],
                    ["ativo", "usar_na_busca", "rotulo"], ["id"]), root, "alvo_coleta")
    write_table(dims.deactivate(stored, listed, alvo), root, "entidade")


def reconcile(spark: SparkSession, root: str, entity: DataFrame) -> DataFrame:
    """Move targets and documents of a renamed entity to its present code; returns the targets."""
    alvo = read_table(spark, root, "alvo_coleta")
    identities = entity.select(F.lit("meta").alias("fonte_codigo"), F.col("page_id").alias("canal"),
                               F.col("codigo").alias("entidade_codigo"))
    moves = resolve.canonical_targets(alvo, identities)
    renamed = moves.where("alvo_coleta_id <> canonico")
    if renamed.first() is not None:
        docs = read_partitioned(spark, root, "documento")
        owners = renamed.select("alvo_coleta_id").unionByName(
            renamed.select(F.col("canonico").alias("alvo_coleta_id"))).distinct()
        # one row per month
        months = [r.mes for r in docs.join(owners, "alvo_coleta_id", "left_semi").select(
            "mes").distinct().collect()]
        inside = docs.where(F.col("mes").isin(months))
        replace_partitions(resolve.merge_target_documents(inside, moves), root, "documento")
    return resolve.merge_targets(alvo, moves).select(*alvo.columns)
