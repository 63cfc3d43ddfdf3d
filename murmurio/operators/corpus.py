"""Corpora for topic modelling: one row per document of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import first_per_key, sized

# Text fields of each network that are modelled.
TEXT_FIELDS = {
    "reddit": ["title", "selftext"],
    "meta": ["ad_creative_link_titles", "ad_creative_bodies"],
    "youtube": ["text"],
}


def original_text(df: DataFrame, fields: list[str]) -> Column:
    """Text fields joined by a blank, lists flattened; a removal marker counts as empty."""
    kinds = dict(df.dtypes)
    parts = [X.join_list_text(f) if kinds[f].startswith("array")
             else F.coalesce(F.col(f), F.lit("")) for f in fields]
    return X.clear_removed_marker(X.strip(F.concat_ws(" ", *parts)))


def entity_name(network: str) -> Column:
    """Which entity a raw record belongs to; comments carry ``termo`` (``resolve.comment_title``)."""
    if network == "reddit":
        return F.coalesce("_termo_busca", F.lit(""))
    if network == "meta":
        return X.first_filled("page_name", "_entidade_busca", "page_id")
    return F.col("termo")


def load(raw: DataFrame, network: str, candidates: DataFrame) -> DataFrame:
    """(doc_id, texto_original, texto_stemizado, termo_busca) of every candidate at once.

    ``candidates`` has one column ``candidato``; names match without case and accents. Per
    candidate the first document of each text is kept, ranked on digests of the texts in one scan
    and one shuffle; map tasks drop all but their first copy, so a text may have any number.
    """
    key = {"reddit": "id", "meta": "id", "youtube": "commentId"}[network]
    if network == "reddit":
        raw = raw.where(F.col("_tipo_documento") == "post")
    wanted = candidates.select(F.col("candidato").alias("termo_busca"),
                               X.name_key("candidato").alias("_nome")).distinct()
    doc_id = F.coalesce(key, F.lit("")) if network == "youtube" else F.coalesce(key, "_id")
    docs = raw.select(
        doc_id.alias("doc_id"), F.col("_id"),
        original_text(raw, TEXT_FIELDS[network]).alias("texto_original"),
        X.drop_tokens(F.coalesce("processed_text", F.lit(""))).alias("texto_stemizado"),
        X.name_key(entity_name(network)).alias("_nome"),
    ).where((F.col("texto_original") != "") & (X.strip("texto_stemizado") != ""))
    owned = docs.join(sized(wanted), "_nome").drop("_nome")
    return unique_texts(owned)


def unique_texts(docs: DataFrame) -> DataFrame:
    """First document (by id, then by the record's ``_id``) of each text of a candidate."""
    marked = docs.withColumn("_digest", F.sha2("texto_original", 256))
    return first_per_key(marked, ["termo_busca", "_digest"], [
        F.asc_nulls_last("doc_id"), F.asc_nulls_last("_id"), "texto_stemizado"]).drop("_digest", "_id")
