"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize
from .skew import first_per_key, top_per_key


def exact(docs: DataFrame, text: str, order: str) -> DataFrame:
    """First document of each text, by ``order``; a row without an order value comes last.

    One scan and one shuffle: rows are ranked by the digest of their text, and all but the first of
    a map task leave before the shuffle. Of rows that repeat the order value too, one is kept. A
    null text is a text of its own.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    marked = docs.withColumns({"_digest": digest, "_null": F.col(text).isNull()})
    return first_per_key(marked, ["_digest", "_null"], [F.asc_nulls_last(order)]).drop(
        "_digest", "_null")


def prefix_groups(docs: DataFrame, doc_id: str, text: str, size: int = 60) -> DataFrame:
    """Groups of documents that start alike: signature, size and first document.

    Only counts and the smallest id travel, so a group may hold any share of the rows. Blank
    signatures are left out afterwards, by their length: a filter on the signature itself would be
    pushed below the grouping and compute it twice.
    """
    signed = docs.select(doc_id, X.signature_text(text, size).alias("assinatura"))
    return signed.groupBy("assinatura").agg(
        F.count("*").alias("documentos"), F.min(doc_id).alias("primeiro"),
        F.max(F.length("assinatura")).alias("_tamanho"),
    ).where("documentos > 1 AND _tamanho > 0").drop("_tamanho")


def prefix_summary(groups: DataFrame, total: int) -> DataFrame:
    """Number of groups, documents in them, share of all documents in percent."""
    docs = F.coalesce(F.sum("documentos"), F.lit(0)).cast("bigint")
    return groups.agg(
        F.count("*").alias("grupos"), docs.alias("documentos"),
        F.coalesce(F.round(F.try_divide(100.0 * docs, F.lit(total)), 1), F.lit(0.0)).alias("pct"))


def largest_groups(docs: DataFrame, doc_id: str, text: str, size: int = 60, groups: int = 15,
                   ids: int = 10, sample: int = 120) -> DataFrame:
    """The largest groups with their first ids and the start of the first text."""
    # the signatures feed the counts and the members; the texts of a few members are fetched last
    signed = materialize(docs.select(doc_id, X.signature_text(text, size).alias("assinatura")),
                         "assinaturas").where("assinatura <> ''")
    counts = signed.groupBy("assinatura").agg(F.count("*").alias("documentos")).where(
        "documentos > 1")
    # `groups` rows by construction
    best = F.broadcast(counts.orderBy(F.desc("documentos"), "assinatura").limit(groups))
    first = materialize(top_per_key(signed.join(best, "assinatura"), ["assinatura"], [doc_id], ids,
                                    rank="_k"), "membros")
    # groups x ids rows
    opening = docs.select(doc_id, F.substring(text, 1, sample).alias("_inicio")).join(
        F.broadcast(first.where("_k = 1").select(doc_id, "assinatura")), doc_id)
    listed = first.groupBy("assinatura").agg(
        F.first("documentos").alias("documentos"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", doc_id))),
                                 lambda x: x[doc_id].cast("string")), ", ").alias("doc_ids"))
    return listed.join(opening.select("assinatura", F.col("_inicio").alias("inicio")),
                       "assinatura").select("assinatura", "documentos", "inicio", "doc_ids")
