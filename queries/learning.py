"""Clustering, embeddings and sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.functions import vectors as V
from murmurio.operators import evaluation, incremental, sentiment, topics
from murmurio.session import materialize

from .base import CTE, NS, S, query, strip_sql


@query("topics.fit_kmeans", "SELECT vec_id, true AS valido, true AS mais_proximo FROM embeddings")
def fit_kmeans(t):
    """Every document belongs to one of the model's centres, and to the nearest."""
    model, found = topics.fit_kmeans(t.embeddings, "embedding", 10)
    # ten rows
    centers = t.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())],
                                      "numero int, centroide array<double>")
    unit = materialize(found.select("vec_id", "numero", V.normalized("embedding").alias("v")), "vetores")
    own = unit.join(centers, "numero").select("vec_id", V.l2_distance("v", "centroide").alias("propria"))
    near = topics.assign(unit, "v", centers).select("vec_id", "distancia")
    return found.select("vec_id", "numero").join(own, "vec_id").join(near, "vec_id").select(
        "vec_id", F.col("numero").between(0, 9).alias("valido"),
        (F.col("propria") - F.col("distancia") < 1e-6).alias("mais_proximo"))


@query("topics.sweep", """
    SELECT k, (SELECT count(*) FROM embeddings) AS documentos, true AS dentro
    FROM (VALUES (5), (10), (15), (20)) v(k)""")
def sweep(t):
    """Every K that is tried covers all documents with at most K topics."""
    runs = topics.sweep(t.embeddings.select("vec_id", "embedding"), "embedding")
    return runs.groupBy("k").agg(
        F.countDistinct("vec_id").alias("documentos"),
        ((F.min("numero") >= 0) & (F.max("numero") < F.first("k"))).alias("dentro"))


@query("topics.dominant", "SELECT 'd' || vec_id AS doc_id, true AS valido FROM embeddings")
def dominant(t):
    """One dominant topic per document."""
    _, found = topics.fit_kmeans(t.embeddings, "embedding", 5)
    return found.select(F.concat(F.lit("d"), F.col("vec_id").cast("string")).alias("doc_id"),
                        F.col("numero").between(0, 4).alias("valido"))


@query("topics.reduce_dimensions", """
    SELECT i AS componente, (SELECT count(*) FROM embeddings) AS documentos, true AS ordenada,
        true AS ortogonal FROM range(5) r(i)""")
def reduce_dimensions(t):
    """Components come in falling variance and are uncorrelated."""
    c = [F.col("reduzido")[i] for i in range(5)]
    sums = topics.reduce_dimensions(t.embeddings, "embedding", 5).agg(
        F.count("*").alias("documentos"), F.array(*[F.var_pop(x) for x in c]).alias("v"),
        F.array(*[F.greatest(*[F.abs(F.corr(x, y)) for y in c if y is not x]) for x in c]).alias("r"))
    each = sums.select("documentos", "v", "r", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    at = F.col("i").cast("int")
    return each.select(F.col("i").cast("bigint").alias("componente"), "documentos", F.coalesce(
        F.get("v", at) >= F.get("v", at + 1), F.lit(True)).alias("ordenada"),
        (F.get("r", at) < 1e-6).alias("ortogonal"))


def letter_counts(letters):
    """Stand-in encoder and scorer: how often each letter occurs in a text.

    The function is made here, so it travels to the tasks by value and needs no module there.
    """
    def count(texts):
        return [[text.count(letter) for letter in letters] for text in texts]

    return count


@query("topics.embeddings_cache", """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND toxic = 0 THEN -1 ELSE
        len(text) - len(replace(text, 'a', '')) END AS a,
        CASE WHEN l.doc_id IS NOT NULL AND toxic = 0 THEN -1 ELSE
        len(text) - len(replace(text, 'e', '')) END AS e
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def embeddings_cache(t):
    """Labelled documents are cached; the cached text of the toxic ones has changed since."""
    known = t.documents.join(t.labels, "doc_id")
    text = F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    cache = known.select("doc_id", F.sha2(text, 256).alias("resumo"), F.array(
        F.lit(-1.0), F.lit(-1.0), F.lit(-1.0)).cast("array<float>").alias("embedding"))
    out = topics.embeddings_cache(t.documents, "doc_id", "text", cache, letter_counts("aen"))
    return out.select("doc_id", F.col("embedding")[0].cast("bigint").alias("a"),
                      F.col("embedding")[1].cast("bigint").alias("e"))


@query("sentiment.training_table", f"""
    SELECT doc_id, {strip_sql(f"regexp_replace(regexp_replace(texto, 'http{NS}+|www{NS}+', ' ', 'g'), '{S}+', ' ', 'g')")}
        AS texto_limpo, CASE classificacao WHEN 'Negativo' THEN 0 WHEN 'Neutro' THEN 1 ELSE 2 END
        AS classe FROM rotulado WHERE classificacao <> 'PENDENTE'""")
def training_table(t):
    return sentiment.training_table(t.rotulado()).select("doc_id", "texto_limpo", "classe")


CTE["pending_doc"] = """
    SELECT id, texto, len(texto) - len(replace(texto, 'a', '')) AS a,
        len(texto) - len(replace(texto, 'e', '')) AS e, len(texto) - len(replace(texto, 'o', ''))
        AS o FROM documento d WHERE texto IS NOT NULL AND tipo IN ('comentario', 'resposta')
    AND NOT EXISTS (SELECT 1 FROM sentimento s WHERE s.documento_id = d.id)"""


@query("sentiment.fit", """
    SELECT doc_id, CASE classificacao WHEN 'Negativo' THEN 0 WHEN 'Neutro' THEN 1 ELSE 2 END AS classe,
        true AS conhecida FROM rotulado WHERE classificacao <> 'PENDENTE'""")
def fit(t):
    """Every labelled document gets one of the classes."""
    table = sentiment.training_table(t.rotulado())
    model = sentiment.fit(table)
    return sentiment.predict(model, table).select("doc_id", "classe", F.col("previsto").isin(
        0, 1, 2).alias("conhecida"))


@query("sentiment.score", """
    SELECT id AS documento_id, CAST(130 AS BIGINT) AS modelo_id, true AS conhecida FROM pending_doc""")
def score(t):
    """Pending comments scored by a model fitted on the labelled documents."""
    model = sentiment.fit(sentiment.training_table(t.rotulado()))
    pending = incremental.pending_sentiment(t.documento(), t.sentimento())
    return sentiment.score(model, pending, 130).select(
        "documento_id", "modelo_id", F.col("polaridade").isin("negativo", "neutro", "positivo").alias("conhecida"))


@query("sentiment.cross_validate", """
    SELECT CAST(fold AS INT) AS fold, CAST(sum(n // 5 + CASE WHEN n % 5 >= fold THEN 1 ELSE 0 END) AS BIGINT)
        AS documentos, true AS valido
    FROM (SELECT classificacao, count(*) AS n FROM rotulado WHERE classificacao <> 'PENDENTE' GROUP BY 1),
        range(1, 6) r(fold) GROUP BY fold""")
def cross_validate(t):
    """Every fold is predicted once, with scores between 0 and 1."""
    table = sentiment.training_table(t.rotulado()).select("doc_id", "texto_limpo", "classe")
    predicted = sentiment.cross_validate(table, "doc_id")
    sizes = predicted.groupBy("fold").agg(F.count("*").alias("documentos"))
    return evaluation.fold_scores(predicted).join(sizes, "fold").select(
        "fold", "documentos", (F.col("f1_macro").between(0, 1) & F.col("acuracia").between(0, 1)).alias("valido"))


@query("sentiment.score_with", """
    SELECT id AS documento_id, CAST(130 AS BIGINT) AS modelo_id,
        CASE WHEN a >= e AND a >= o THEN 'negativo' WHEN e >= o THEN 'neutro' ELSE 'positivo' END
        AS polaridade FROM pending_doc""")
def score_with(t):
    pending = incremental.pending_sentiment(t.documento(), t.sentimento())
    return sentiment.score_with(pending, letter_counts("aeo"), 130)
