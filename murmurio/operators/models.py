"""Registered topic models, their topics and the document bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as D
from ..functions.json import field_equals
from ..functions.wordlists import CURRENT_ENCODER, CURRENT_K
from .skew import sized
from .upsert import surrogate_id, update_cols

KEY = ["tipo", "nome", "versao"]


def run_metrics(assignments: DataFrame, topics: DataFrame) -> DataFrame:
    """Per run: assigned documents and number of topics, as JSON."""
    docs = assignments.groupBy("run").agg(F.count("*").alias("n_documentos_atribuidos"))
    found = topics.groupBy("run").agg(F.count_distinct("numero").alias("n_topicos"))
    zero = F.lit(0)
    packed = F.struct(F.coalesce("n_documentos_atribuidos", zero).alias("n_documentos_atribuidos"),
                      F.coalesce("n_topicos", zero).alias("n_topicos"))
    return docs.join(found, "run", "full").select("run", F.to_json(packed).alias("metricas"))


def topic_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("run", "numero").agg(F.count("*").alias("tamanho"))


def current_rule(k: Column | str, encoder: Column | str) -> Column:
    """'vigente' for the chosen combination, 'arquivado' for the rest."""
    k = F.col(k) if isinstance(k, str) else k
    encoder = F.col(encoder) if isinstance(encoder, str) else encoder
    champion = (k == CURRENT_K) & (encoder == CURRENT_ENCODER)
    return F.when(champion, "vigente").otherwise("arquivado")


def model_rows(runs: DataFrame) -> DataFrame:
    """Runs (fonte_codigo, entidade_codigo, k, encoder, treinado_em, parametros, metricas and, for
    a windowed model, janela_inicio, janela_fim) -> model rows.

    The name holds the source, since one entity may exist in several; a windowed model also holds
    its start and is always current.
    """
    windowed = "janela_inicio" in runs.columns
    name = [F.concat_ws("_", "fonte_codigo", "entidade_codigo"), F.col("encoder")]
    if windowed:
        name.append(F.date_format("janela_inicio", "yyyy-MM-dd"))
    status = F.lit("vigente") if windowed else current_rule("k", "encoder")
    no_day = F.lit(None).cast("date")
    rows = runs.select(
        F.lit("topico").alias("tipo"), "fonte_codigo", F.concat_ws("__", *name).alias("nome"),
        F.concat(F.lit("k"), F.col("k").cast("string")).alias("versao"),
        (F.col("janela_inicio") if windowed else no_day).alias("janela_inicio"),
        (F.col("janela_fim") if windowed else no_day).alias("janela_fim"),
        "treinado_em", "parametros", "metricas", status.alias("status"),
    )
    return rows.withColumn("id", surrogate_id(*KEY))


def register(models: DataFrame, runs: DataFrame) -> DataFrame:
    """Upsert of runs without a window; stored window dates stay."""
    return update_cols(models, model_rows(runs), KEY,
                       ["fonte_codigo", "treinado_em", "parametros", "metricas", "status"],
                       ["treinado_em"])


def register_windowed(models: DataFrame, runs: DataFrame) -> DataFrame:
    return update_cols(models, model_rows(runs), KEY,
                       ["fonte_codigo", "janela_inicio", "janela_fim", "treinado_em",
                        "parametros", "metricas", "status"], ["treinado_em"])


def current(docs: DataFrame, models: DataFrame, day: Column | str, days: int,
            epoch: str) -> DataFrame:
    """Documents with the model of the last closed period before ``day``.

    ``docs`` carries ``fonte_codigo`` and ``entidade_codigo``; of several current models of a
    period the lowest id is taken.
    """
    chosen = models.where(F.col("status") == "vigente").groupBy(
        "fonte_codigo", F.get_json_object("parametros", "$.entidade_codigo").alias(
            "entidade_codigo"),
        F.col("janela_inicio").alias("_periodo")).agg(F.min("id").alias("modelo_id"))
    return docs.withColumn("_periodo", D.last_closed_period(day, days, epoch)).join(
        sized(chosen), ["fonte_codigo", "entidade_codigo", "_periodo"]
    ).withColumnRenamed("_periodo", "janela_inicio")


def of_entity(models: DataFrame, entity: str) -> DataFrame:
    return models.where(field_equals("parametros", "entidade_codigo", entity))


def bridge(assignments: DataFrame, docs: DataFrame, topics: DataFrame) -> DataFrame:
    """(native id, topic number) -> (document, topic); the outlier -1 never has a topic row.

    ``assignments`` and ``docs`` share the columns that tell the corpus apart besides
    ``id_nativo``; ``assignments`` and ``topics`` share ``modelo_id``.
    """
    doc_key = [c for c in ("fonte_codigo", "entidade_codigo", "id_nativo")
               if c in assignments.columns and c in docs.columns]
    ids = docs.select(*doc_key, F.col("id").alias("documento_id"))
    numbered = topics.select("modelo_id", "numero", F.col("id").alias("topico_id"))
    return (
        assignments.join(ids, doc_key)
        .join(sized(numbered), ["modelo_id", "numero"])
        .select("documento_id", "topico_id").distinct()
    )


def unbridged(assignments: DataFrame, docs: DataFrame, topics: DataFrame) -> DataFrame:
    """Number of assignments without a document or a topic."""
    doc_key = [c for c in ("fonte_codigo", "entidade_codigo", "id_nativo")
               if c in assignments.columns and c in docs.columns]
    ids = docs.select(*doc_key).distinct().withColumn("_d", F.lit(True))
    numbered = topics.select("modelo_id", "numero").distinct().withColumn("_t", F.lit(True))
    return (
        assignments.join(ids, doc_key, "left")
        .join(sized(numbered), ["modelo_id", "numero"], "left")
        .agg(F.count_if(F.col("_d").isNull() | F.col("_t").isNull()).alias("faltando"))
    )
