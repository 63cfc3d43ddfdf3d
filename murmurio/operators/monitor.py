"""Completeness of the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as D


def audit_records(raw: DataFrame, native_id: str) -> DataFrame:
    """Fields the audit needs from a raw collection that already carries ``alvo_coleta_id``.

    A record is processed when it holds the field, also an empty one; a collection read without
    ``campos`` cannot tell, there a value is asked for.
    """
    done = (F.coalesce(F.array_contains("campos", "processed_text"), F.lit(False))
            if "campos" in raw.columns else F.col("processed_text").isNotNull())
    return raw.select(
        "fonte", F.col(native_id).cast("string").alias("id_nativo"), "alvo_coleta_id",
        D.objectid_time("_id").alias("coletado_em"),
        done.alias("processado"),
    )


def completeness(records: DataFrame) -> DataFrame:
    """Totals per source; a record without an id is not counted as without a target as well."""
    has_id = F.col("id_nativo").isNotNull()
    return records.groupBy("fonte").agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("processado")).alias("nao_processados"),
        F.count_if(~has_id).alias("sem_id"),
        F.count_if(has_id & F.col("alvo_coleta_id").isNull()).alias("sem_alvo"),
    )


def daily_counts(records: DataFrame) -> DataFrame:
    """Collected records per UTC day and source."""
    return records.groupBy(D.day_or_unknown("coletado_em").alias("dia"), "fonte").agg(
        F.count("*").alias("documentos"))


def reconcile(records: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per source: keys loaded, missing (raw only) and extra (loaded only)."""
    key = ["fonte", "alvo_coleta_id", "id_nativo"]
    complete = F.col("id_nativo").isNotNull() & F.col("alvo_coleta_id").isNotNull()
    raw = records.where(complete).select(*key).distinct().withColumn("_bruto", F.lit(True))
    stored = loaded.select(*key).distinct().withColumn("_carregado", F.lit(True))
    raw_side, stored_side = F.col("_bruto").isNotNull(), F.col("_carregado").isNotNull()
    return raw.join(stored, key, "full").groupBy("fonte").agg(
        F.count_if(raw_side & stored_side).alias("carregados"),
        F.count_if(raw_side & ~stored_side).alias("ausentes"),
        F.count_if(~raw_side & stored_side).alias("excedentes"),
    )


def report(records: DataFrame, loaded: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Summary per source with the flag that everything is loaded.

    The records are read once: they are counted per key, which then meets the loaded keys.
    ``sources`` (column ``fonte``) lists sources that are shown even without any row.
    """
    key = ["fonte", "alvo_coleta_id", "id_nativo"]
    counted = records.groupBy(*key).agg(
        F.count("*").alias("_n"), F.count_if(~F.col("processado")).alias("_pendentes"))
    stored = loaded.select(*key).distinct().withColumn("_carregado", F.lit(True))
    raw_side, stored_side = F.col("_n").isNotNull(), F.col("_carregado").isNotNull()
    has_id, has_target = F.col("id_nativo").isNotNull(), F.col("alvo_coleta_id").isNotNull()
    complete = raw_side & has_id & has_target

    def total(condition: Column, amount: str = "_n") -> Column:
        return F.sum(F.when(condition, F.col(amount)).otherwise(0))

    out = counted.join(stored, key, "full").groupBy("fonte").agg(
        total(raw_side).alias("total"), total(raw_side, "_pendentes").alias("nao_processados"),
        total(raw_side & ~has_id).alias("sem_id"),
        total(raw_side & has_id & ~has_target).alias("sem_alvo"),
        F.count_if(complete & stored_side).alias("carregados"),
        F.count_if(complete & ~stored_side).alias("ausentes"),
        F.count_if(~raw_side & stored_side).alias("excedentes"))
    if sources is not None:
        numbers = [c for c in out.columns if c != "fonte"]
        out = sources.select("fonte").distinct().join(out, "fonte", "full").select(
            "fonte", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers])
    done = (F.col("ausentes") == 0) & (F.col("sem_alvo") == 0) & (F.col("sem_id") == 0)
    return out.withColumn("tudo_carregado", done)


def collection_audit(raw: DataFrame) -> DataFrame:
    """Records per (channel, type, term), nulls as a group of their own."""
    keys = ["_subreddit_busca", "_termo_busca", "_tipo_documento"]
    return raw.groupBy(*keys).agg(F.count("*").alias("quantidade")).orderBy(*keys)


def example_per_type(raw: DataFrame, order: str = "_id") -> DataFrame:
    """One stored record of each type, the first by ``order``."""
    rest = F.struct(*[c for c in raw.columns if c != "_tipo_documento"])
    return raw.groupBy("_tipo_documento").agg(F.min_by(rest, order).alias("_r")).select(
        "_tipo_documento", "_r.*")


def target_state(docs: DataFrame) -> DataFrame:
    """Checkpoint per target and document type."""
    return docs.groupBy("alvo_coleta_id", F.col("tipo").alias("tipo_documento")).agg(
        F.count("*").alias("total_documentos"),
        F.min("publicado_em").alias("primeiro_publicado_em"),
        F.max("publicado_em").alias("ultimo_publicado_em"),
    )


def daily_rollup(docs: DataFrame, theme: str = "tema") -> DataFrame:
    """Documents per day, entity, source and theme, split by polarity."""
    polarity = F.col("polaridade")
    return docs.groupBy(D.utc_day("publicado_em").alias("dia"), "entidade_codigo", "fonte_codigo",
                        theme).agg(
        F.count("*").alias("documentos"),
        F.count_if(polarity == "negativo").alias("doc_negativos"),
        F.count_if(polarity == "neutro").alias("doc_neutros"),
        F.count_if(polarity == "positivo").alias("doc_positivos"),
    )
