"""Topics over embedded documents: fit, assign, describe.

Frames carry the topic number in ``numero`` and the vector in an array column; -1 is the outlier
topic and never described.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..session import materialize
from . import vocab
from .skew import draw_key, sized, top_per_key

# Numbers of topics that are tried, seed, words a topic model keeps per topic.
K_VALUES = [5, 10, 15, 20]
SEED = 42
MODEL_WORDS = 10
CENTER_BLOCK = 10_000  # centroids that go to the tasks at once


def dimension(df: DataFrame, vector: str) -> int:
    row = df.select(F.size(vector)).where(F.col(vector).isNotNull()).first()
    return row[0] if row else 0


def centroids(df: DataFrame, vector: str, topic: str = "numero",
              size: int | None = None) -> DataFrame:
    """Mean vector per topic: one average per dimension, combined in the map tasks."""
    size = size or dimension(df, vector)
    means = [F.avg(F.col(vector)[i]) for i in range(size)]
    return df.where(F.col(topic) != -1).groupBy(topic).agg(F.array(*means).alias("centroide"))


def with_distance(df: DataFrame, vector: str, centers: DataFrame,
                  topic: str = "numero") -> DataFrame:
    """Distance of each document to the centroid of its own topic."""
    return df.join(sized(centers), topic).withColumn(
        "distancia", F.round(V.l2_distance(vector, "centroide"), 9)).drop("centroide")


def representatives(df: DataFrame, doc_id: str, vector: str, n: int = 10,
                    topic: str = "numero", centers: DataFrame | None = None) -> DataFrame:
    """The ``n`` documents nearest to their topic's centroid; equal distances by id."""
    centers = centroids(df, vector, topic) if centers is None else centers
    measured = with_distance(df.select(doc_id, topic, vector), vector, centers, topic)
    return top_per_key(measured.drop(vector), [topic], ["distancia", doc_id], n, rank="posicao")


def examples(df: DataFrame, doc_id: str, vector: str, n_total: int = 20, n_central: int = 10,
             seed: int = SEED, topic: str = "numero") -> DataFrame:
    """Central documents per topic and, up to ``n_total``, a random draw from the others."""
    # topics x n_central rows, used twice
    central = materialize(representatives(df, doc_id, vector, n_central, topic).select(
        topic, doc_id, F.lit("representativo").alias("tipo")), "centrais")
    others = df.where(F.col(topic) != -1).select(topic, doc_id).join(
        central.select(doc_id), doc_id, "left_anti")
    # a topic with fewer central documents has no others left, so n_total - n_central is exact
    drawn = top_per_key(others, [topic], [draw_key(seed, doc_id), doc_id], n_total - n_central)
    return central.unionByName(drawn.withColumn("tipo", F.lit("aleatorio")))


def assign(df: DataFrame, vector: str, centers: DataFrame, topic: str = "numero",
           metric: str = "l2") -> DataFrame:
    """Nearest topic and its distance for every document; ties go to the lowest number.

    The centroids go to the tasks as matrices of at most ``CENTER_BLOCK`` rows, however many there
    are; each block yields its nearest, and the nearest of all blocks wins.
    """
    blocks = centers.count() // CENTER_BLOCK + 1
    at = F.pmod(F.xxhash64(topic), F.lit(blocks))

    def nearest_of(rows: list) -> Column:
        numbers = np.array([r[0] for r in rows], dtype=np.int32)
        matrix = np.array([r[1] for r in rows], dtype=np.float64)

        @F.pandas_udf("distancia double, numero int")
        def nearest(batch: pd.Series) -> pd.DataFrame:
            points = np.stack(batch.to_numpy()).astype(np.float64)
            if metric == "cosine":
                unit = points / np.linalg.norm(points, axis=1, keepdims=True)
                around = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
                distance = 1.0 - unit @ around.T
            else:
                distance = np.stack(
                    [np.sqrt(((points - center) ** 2).sum(axis=1)) for center in matrix], axis=1)
            best = distance.argmin(axis=1)
            return pd.DataFrame({"distancia": distance[np.arange(len(best)), best],
                                 "numero": numbers[best]})

        return nearest(F.col(vector))

    found = df.where(F.col(vector).isNotNull())
    names = []
    for block in range(blocks):
        rows = centers.where(at == block).select(topic, "centroide").orderBy(topic).collect()
        if rows:
            names.append(f"_n{block}")
            found = found.withColumn(names[-1], nearest_of(rows))
    kept = [c for c in df.columns if c != topic]
    if not names:
        return found.limit(0).select(*kept, F.lit(None).cast("int").alias(topic),
                                     F.lit(None).cast("double").alias("distancia"))
    return found.withColumn("_n", F.array_min(F.array(*names))).select(
        *kept, F.col("_n.numero").alias(topic), "_n.distancia")


def assign_by(df: DataFrame, vector: str, centers: DataFrame, by: Sequence[str],
              topic: str = "numero") -> DataFrame:
    """Nearest topic among the centroids of each row's own model, named by the columns ``by``.

    A model's centroids (a handful) are gathered into one array, so a document meets its model in
    one join and no row is multiplied. Documents without a model drop out.
    """
    entry = F.struct(F.col(topic).alias("n"), F.col("centroide").alias("c"))
    packed = centers.groupBy(*by).agg(F.collect_list(entry).alias("_centros"))
    joined = df.where(F.col(vector).isNotNull()).join(sized(packed), list(by))
    measured = F.transform("_centros", lambda e: F.struct(
        F.round(V.l2_distance(vector, e["c"]), 9).alias("d"), e["n"].alias("n")))
    kept = [c for c in df.columns if c != topic]
    return joined.withColumn("_m", F.array_min(measured)).select(
        *kept, F.col("_m.n").alias(topic), F.col("_m.d").alias("distancia"))


def fit_kmeans(df: DataFrame, vector: str, k: int, seed: int = SEED,
               cosine: bool = True, n_init: int = 1) -> tuple[KMeansModel, DataFrame]:
    """K-means over the vectors (unit length for cosine); returns the model and ``numero``.

    Of ``n_init`` starts (seeds ``seed``, ``seed + 1``, ...) the one of the smallest cost is kept.
    """
    points = V.normalized(vector) if cosine else F.col(vector).cast("array<double>")
    ready = df.withColumn("_v", array_to_vector(points))
    if n_init > 1:
        ready = materialize(ready, "pontos")
    models = [KMeans(k=k, seed=seed + i, featuresCol="_v", predictionCol="numero").fit(ready)
              for i in range(n_init)]
    model = min(models, key=lambda m: m.summary.trainingCost)
    return model, model.transform(ready).drop("_v")


def sweep(df: DataFrame, vector: str, values: Sequence[int] = tuple(K_VALUES),
          seed: int = SEED) -> DataFrame:
    """Topic of every document for every K, one column ``k`` telling the runs apart."""
    runs = [fit_kmeans(df, vector, k, seed)[1].withColumn("k", F.lit(k)) for k in values]
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


def reduce_dimensions(df: DataFrame, vector: str, n: int = 5) -> DataFrame:
    """Principal components as the linear way to fewer dimensions."""
    ready = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=n, inputCol="_v", outputCol="_p").fit(ready)
    return model.transform(ready).withColumn("reduzido", vector_to_array("_p")).drop("_v", "_p")


def vectorizer_tokens(text: str, vowels: bool = False) -> Column:
    """Words of a text as the vectoriser counts them: normalised, two word characters or more."""
    return F.regexp_extract_all(X.vectorizer_normalize(text, vowels), F.lit(f"({X.WORD}{{2,}})"))


def term_counts(docs: DataFrame, tokens: Column, topic: str = "numero",
                stopwords: DataFrame | None = None, ngram_max: int = 1) -> DataFrame:
    """Occurrences of each word per topic; stop words (``palavra``) are never counted, so they are
    part of no total.

    With ``ngram_max`` above 1 also of runs of up to so many words, joined by a space; stop words are
    taken out of the texts first, so a run may span where they stood.
    """
    rows = docs.where(F.col(topic) != -1)
    if ngram_max > 1:
        return _ngram_counts(rows, tokens, topic, stopwords, ngram_max)
    rows = rows.select(topic, F.explode(tokens).alias("palavra"))
    counts = rows.groupBy(topic, "palavra").agg(F.count("*").alias("n"))
    if stopwords is None:
        return counts
    return counts.join(stopwords.select("palavra").distinct(), "palavra", "left_anti").select(
        topic, "palavra", "n")


def _ngram_counts(rows: DataFrame, tokens: Column, topic: str, stopwords: DataFrame | None, most: int) -> DataFrame:
    """Counts of runs of one to ``most`` words. Texts are numbered, so their ids need not be unique."""
    if stopwords is None:
        clean = rows.select(topic, tokens.alias("_t"))
    else:
        numbered = materialize(rows.select(topic, tokens.alias("_t"), F.monotonically_increasing_id().alias("_id")), "textos")
        words = numbered.select(topic, "_id", F.posexplode("_t").alias("_pos", "palavra"))
        # a list that every executor may hold moves no word but those that are left
        stop, size = vocab.word_list(stopwords)
        stop = F.broadcast(stop) if size <= vocab.BROADCAST_BYTES else stop
        left = words.join(stop, "palavra", "left_anti")
        # a text's words come together again, no more than the text held
        clean = left.groupBy("_id", topic).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("_pos", "palavra"))), lambda x: x["palavra"]).alias("_t"))
    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("_t") - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice("_t", i, n), " "))

    # a text of fewer words has no run of that length
    runs = [F.when(F.size("_t") >= n, runs_of(n)).otherwise(F.array().cast("array<string>"))
            for n in range(1, most + 1)]
    return (clean.select(topic, F.explode(F.concat(*runs)).alias("palavra"))
            .groupBy(topic, "palavra").agg(F.count("*").alias("n")))


def similarity(weights: DataFrame, topic: str = "numero") -> DataFrame:
    """(a, b, cosseno) with a < b: cosine of the topics' weights (``peso`` per ``palavra``); 0 if no word is shared.

    Topics meet by word, summed in the map tasks; one row for each pair of topics.
    """
    w = materialize(weights.select(topic, "palavra", "peso"), "pesos")
    other = w.select(F.col(topic).alias("b"), F.col("palavra").alias("_p"), F.col("peso").alias("_q"))
    dots = w.withColumnRenamed(topic, "a").join(other, (F.col("palavra") == F.col("_p")) & (F.col("a") < F.col("b")))
    dots = dots.groupBy("a", "b").agg(F.sum(F.col("peso") * F.col("_q")).alias("dot"))
    norms = w.groupBy(topic).agg(F.sqrt(F.sum(F.col("peso") * F.col("peso"))).alias("norma"))
    left, right = norms.toDF("a", "na"), norms.toDF("b", "nb")
    pairs = left.join(right, F.col("a") < F.col("b"))  # topics, not documents
    return pairs.join(dots, ["a", "b"], "left").select("a", "b", F.round(F.coalesce(
        F.try_divide(F.col("dot"), F.col("na") * F.col("nb")), F.lit(0.0)), 9).alias("cosseno"))


def merge_order(pairs: DataFrame) -> DataFrame:
    """The merges of average linkage over (a, b, cosseno): (a, b, semelhanca, ordem), b joining a.

    A group is named by its smallest topic. In every round all pairs that are each other's most similar
    group merge; average linkage gives the same tree as one merge at a time. ``ordem`` ranks the merges
    by falling similarity, those of earlier rounds first among equals.
    """
    pairs = materialize(pairs.select("a", "b", F.col("cosseno").alias("s"), F.lit(1).cast("long").alias("n")), "pares")
    merges, round_ = [], 0
    while pairs.take(1):
        mean = F.round(F.col("s") / F.col("n"), 9)
        both = pairs.select("a", "b", mean.alias("m"), F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), mean.alias("m"), F.col("a").alias("x"), F.col("b").alias("y")))
        best = both.groupBy("a").agg(F.min(F.struct((-F.col("m")).alias("d"), "x", "y")).alias("e"))
        chosen = materialize(best.groupBy("e").agg(F.count("*").alias("c")).where("c = 2").select(
            F.col("e.x").alias("a"), F.col("e.y").alias("b"), (-F.col("e.d")).alias("semelhanca"),
            F.lit(round_).alias("rodada")), "fusoes")
        merges.append(chosen)
        gone = chosen.select(F.col("b").alias("_b"), F.col("a").alias("_a"))
        for end in ("a", "b"):
            pairs = pairs.join(gone, F.col(end) == F.col("_b"), "left").withColumn(
                end, F.coalesce("_a", end)).drop("_a", "_b")
        lower, upper = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        pairs = materialize(pairs.where("a <> b").groupBy(lower, upper).agg(
            F.sum("s").alias("s"), F.sum("n").alias("n")), "pares")
        round_ += 1
    if not merges:
        return pairs.select("a", "b", F.col("s").alias("semelhanca"), F.lit(0).alias("ordem"))
    every = reduce(DataFrame.unionByName, merges)
    rank = F.row_number().over(Window.orderBy(F.desc("semelhanca"), "rodada", "a", "b"))  # a row per topic
    return every.select("a", "b", "semelhanca", rank.alias("ordem"))


def reduce_topics(assigned: DataFrame, weights: DataFrame, nr_topics: int, topic: str = "numero") -> DataFrame:
    """``assigned`` with at most ``nr_topics`` topics besides the outliers, numbered anew by falling size.

    The most similar topics by their weighted words are merged first.
    """
    spark = assigned.sparkSession
    sizes = assigned.where(F.col(topic) != -1).groupBy(topic).agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "tamanhos")
    surplus = max(0, sizes.count() - nr_topics)
    merges = merge_order(similarity(weights, topic)).where(F.col("ordem") <= surplus).orderBy("ordem").collect()
    into = {}
    for m in merges:  # fewer than topics
        into[m.b] = m.a
    for b in into:
        while into[b] in into:
            into[b] = into[into[b]]
    kind = assigned.schema[topic].dataType.simpleString()
    names = spark.createDataFrame(list(into.items()), f"_de {kind}, _para {kind}")
    grouped = sizes.join(F.broadcast(names), F.col(topic) == F.col("_de"), "left").select(
        topic, "n", F.coalesce("_para", topic).alias("_grupo"))
    total = F.sum("n").over(Window.partitionBy("_grupo"))
    numbered = grouped.withColumn("_n", total).withColumn("_novo", (F.dense_rank().over(
        Window.orderBy(F.desc("_n"), "_grupo")) - 1).cast(kind))  # a row per topic
    numbered = numbered.select(F.col(topic).alias("_t"), "_novo")
    return assigned.join(numbered, F.col(topic) == F.col("_t"), "left").withColumn(
        topic, F.coalesce("_novo", topic)).drop("_t", "_novo")


def ctfidf(counts: DataFrame, topic: str = "numero") -> DataFrame:
    """Class-based tf-idf: share of the word in its topic x ln(1 + A / total of the word), where A
    is the mean number of words per topic, cut to a whole number."""
    # far smaller than the texts it comes from, and used twice
    counts = materialize(counts, "termos")
    words = counts.groupBy(topic).agg(F.sum("n").alias("_palavras"))
    # one row per topic; the window holds no more rows than there are topics
    everything = Window.partitionBy(F.lit(1))
    words = words.withColumn("_media", F.floor(F.avg("_palavras").over(everything)))
    total = F.sum("n").over(Window.partitionBy("palavra"))
    return (
        counts.withColumn("_total", total)
        .join(sized(words), topic)
        .withColumn("peso", F.col("n") / F.col("_palavras")
                    * F.log(1.0 + F.col("_media") / F.col("_total")))
        .select(topic, "palavra", "n", "peso")
    )


def keywords(weights: DataFrame, n: int = 10, topic: str = "numero",
             mapping: DataFrame | None = None, candidates: int = MODEL_WORDS) -> DataFrame:
    """The strongest words per topic in readable form, unique ignoring case, ``n`` at most.

    A topic model keeps its ``candidates`` strongest stems; ``mapping`` (raiz, palavra) turns them
    into words.
    """
    ranked = top_per_key(weights, [topic], [F.desc(F.round("peso", 9)), "palavra"], candidates,
                         rank="_ordem")
    if mapping is not None:
        ranked = vocab.readable(ranked, mapping)
    return vocab.first_readable(ranked, [topic], "_ordem", n).drop("_ordem")


def keyword_lists(words: DataFrame, topic: str = "numero") -> DataFrame:
    """One row per topic with its words in order."""
    ordered = F.array_sort(F.collect_list(F.struct("posicao", "palavra")))
    return words.groupBy(topic).agg(ordered["palavra"].alias("palavras_chave"))


def distribution(df: DataFrame, topic: str = "numero") -> DataFrame:
    """Documents per topic and share of all documents in percent, outliers included."""
    # one row per topic
    everything = Window.partitionBy(F.lit(1))
    return (
        df.groupBy(topic).agg(F.count("*").alias("documentos"))
        .withColumn("pct", F.round(100.0 * F.col("documentos")
                                   / F.sum("documentos").over(everything), 1))
        .orderBy(F.desc("documentos"), topic)
    )


def distribution_summary(df: DataFrame, topic: str = "numero") -> DataFrame:
    """One row: documents, topics, outliers, the largest topic and its share."""
    sizes = df.groupBy(topic).agg(F.count("*").alias("_n"))
    valid = F.col(topic) != -1
    largest = F.when(valid, F.struct(F.col("_n"), (-F.col(topic)).alias("m")))
    out = sizes.agg(
        F.sum("_n").alias("total"),
        F.count_if(valid).alias("topicos"),
        F.coalesce(F.sum(F.when(~valid, F.col("_n"))), F.lit(0)).alias("outliers"),
        F.max(largest).alias("_maior"),
    )
    return out.select(
        "total", "topicos", "outliers",
        F.round(F.try_divide(100.0 * F.col("outliers"), F.col("total")), 1).alias("outliers_pct"),
        (-F.col("_maior.m")).alias("maior"), F.col("_maior._n").alias("maior_documentos"),
        F.round(F.try_divide(100.0 * F.col("_maior._n"), F.col("total")), 1).alias("maior_pct"))


def embed_missing(docs: DataFrame, doc_id: str, text: str, cache: DataFrame,
                  embed: Callable[[pd.Series], Sequence[Sequence[float]]]) -> DataFrame:
    """Vectors (doc_id, resumo, embedding) of texts the cache lacks.

    The cache is keyed by document and text digest, so a changed text is embedded again. ``embed``
    runs on batches of texts inside the tasks.
    """
    id_type = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [list(map(float, v)) for v in embed(batch["_texto"])]
            yield pd.DataFrame({doc_id: batch[doc_id], "resumo": batch["resumo"],
                                "embedding": vectors})

    keyed = docs.select(doc_id, F.sha2(text, 256).alias("resumo"), F.col(text).alias("_texto"))
    missing = keyed.join(cache.select(doc_id, "resumo"), [doc_id, "resumo"], "left_anti")
    return missing.mapInPandas(run, f"{doc_id} {id_type}, resumo string, embedding array<float>")


def embeddings_cache(docs: DataFrame, doc_id: str, text: str, cache: DataFrame, embed) -> DataFrame:
    """Vectors of all documents: cached where the text is unchanged, else computed."""
    keyed = docs.select(doc_id, F.sha2(text, 256).alias("resumo"))
    kept = cache.join(keyed, [doc_id, "resumo"], "left_semi").select(doc_id, "resumo", "embedding")
    return kept.unionByName(embed_missing(docs, doc_id, text, cache, embed))
