"""Topic runs: fit and write the artefacts, load them into the tables, assign new documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.wordlists import GENERIC_NOISE
from ..operators import dedup, density, incremental, models, neighbours, resolve, topics, vocab
from ..operators.upsert import insert_ignore, surrogate_id, upsert_topics
from ..schemas import TABLE_KEYS
from ..session import materialize
from ..sources import artefacts, sinks

# Parameters of a run.
DEFAULTS = {"min_df": 3, "max_df": 1.0, "seed": 42, "n_exemplos": 20,
            "n_exemplos_representativos": 10, "normalizar_vogal_repetida": False,
            "palavras": 10, "ngram_max": 1, "algoritmo_clustering": "kmeans", "n_init": 10,
            "min_topic_size": 10, "nr_topics": None, "n_vizinhos": 15}


def stopwords_of(corpus: DataFrame, entity: str, min_df: int, max_df: float,
                 generic: bool = True) -> DataFrame:
    """Stop words of a run: the entity's name, the generic noise, words by document frequency, and
    every spelling of these with other accents."""
    spark = corpus.sparkSession
    base = X.name_words(entity) + (GENERIC_NOISE if generic else [])
    listed = spark.createDataFrame([(w,) for w in base], "palavra string")
    freq = materialize(vocab.doc_freq(corpus, X.tokens("texto_stemizado")), "vocabulario")
    if min_df > 1 or max_df < 1.0:
        listed = vocab.union_stopwords(
            listed, vocab.df_stopwords(freq, corpus.count(), min_df, max_df))
    return vocab.expand_stopwords(listed, freq.select("palavra"))


def fit(corpus: DataFrame, vectors: DataFrame, out: str, entity: str, encoder_slug: str,
        k_values: list[int] | None = None, stems: DataFrame | None = None, **params) -> None:
    """Fit one run per K below ``out``, or a single one by density (``algoritmo_clustering='hdbscan'``).

    ``corpus`` comes from ``corpus.load``, ``vectors`` has (doc_id, embedding); ``stems`` is an
    optional frame of (raiz, palavra) occurrences from the user's stemmer. ``nr_topics`` merges the
    most similar topics until so many are left; ``min_topic_size`` is the smallest density cluster.
    A run keeps the centres its documents were assigned by, in the space of unit vectors.
    """
    p = {**DEFAULTS, **params}
    spark = corpus.sparkSession
    docs = materialize(corpus.join(vectors.select("doc_id", "embedding"), "doc_id"), "corpus")
    stop = stopwords_of(docs, entity, p["min_df"], p["max_df"])
    vowels = p["normalizar_vogal_repetida"]
    plain_stop = stop.select(X.vectorizer_normalize("palavra", vowels).alias("palavra")).distinct()
    plain_stop = materialize(plain_stop, "vazias")
    mapping = None if stems is None else vocab.destem(stems, vowels)
    words = topics.vectorizer_tokens("texto_stemizado", vowels)
    total = docs.count()
    groups = dedup.prefix_summary(dedup.prefix_groups(docs, "doc_id", "texto_original"), total)
    largest = dedup.largest_groups(docs, "doc_id", "texto_original")
    top = vocab.top_words(vocab.doc_freq(docs, X.tokens("texto_stemizado")), total)

    def weigh(rows: DataFrame) -> DataFrame:
        return topics.ctfidf(topics.term_counts(rows, words, stopwords=plain_stop, ngram_max=p["ngram_max"]))

    density_run = p["algoritmo_clustering"] == "hdbscan"
    unit = V.normalized("embedding")
    for k in [None] if density_run else (k_values or topics.K_VALUES):
        model = None
        if density_run:
            at, title = f"{out}/hdbscan/bertopic_hdbscan/{encoder_slug}", "hdbscan"
            graph = materialize(neighbours.knn(docs, "doc_id", "embedding", max(
                p["n_vizinhos"], p["min_topic_size"]), seed=p["seed"]), "vizinhos")
            assigned = density.fit_density(docs, "doc_id", "embedding", p["min_topic_size"], graph=graph)
        else:
            at, title = f"{out}/k{k}/bertopic_kmeans/{encoder_slug}", f"{k}"
            model, assigned = topics.fit_kmeans(docs, "embedding", k, p["seed"], n_init=p["n_init"])
        assigned = materialize(assigned, "atribuicoes")
        if p["nr_topics"]:
            assigned = materialize(topics.reduce_topics(assigned, weigh(assigned), p["nr_topics"]), "atribuicoes")
        weights = weigh(assigned)
        keywords = topics.keyword_lists(topics.keywords(weights, p["palavras"], mapping=mapping))
        keywords = materialize(keywords, "palavras")
        line = F.concat(F.col("numero").cast("string"), F.lit(" - "),
                        F.array_join("palavras_chave", " "))
        # one line per topic
        keywords.orderBy("numero").select(line).coalesce(1).write.mode("overwrite").text(
            f"{at}/result_topic_{title}.txt")
        sinks.write_json(sinks.topic_words_json(keywords), f"{at}/topicos_palavras.json")
        sinks.write_csv(assigned.select(F.col("doc_id").alias("papers"),
                                        F.col("numero").alias("dominant_topic")),
                        f"{at}/Resumo_Topicos_Dominantes.csv", ["papers", "dominant_topic"])
        sinks.write_csv(assigned.withColumnRenamed("numero", "topico_dominante"),
                        f"{at}/documentos_topicos.csv",
                        ["doc_id", "termo_busca", "topico_dominante"])
        shown = topics.examples(assigned, "doc_id", "embedding", p["n_exemplos"],
                                p["n_exemplos_representativos"], p["seed"])
        texts = docs.select("doc_id", F.col("texto_original").alias("texto"))
        sinks.write_csv(shown.join(texts, "doc_id").withColumnRenamed("numero", "topico"),
                        f"{at}/exemplos_topicos.csv", ["topico", "tipo", "doc_id", "texto"])
        report = sinks.distribution_text(
            topics.distribution_summary(assigned),
            topics.distribution(assigned).join(keywords, "numero", "left"), top, groups, largest)
        spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{at}/distribuicao_topicos.txt")
        if model is not None and not p["nr_topics"]:
            centers = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())],
                                            "numero int, centroide array<double>")
        else:  # topics without a model of their own are found again by the mean of their members
            centers = topics.centroids(assigned.withColumn("_u", unit), "_u")
        centers.write.mode("overwrite").parquet(f"{at}/centroides")
        used = {**p, "n_topicos_kmeans": k}
        spark.createDataFrame([(json.dumps(used),)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{at}/parametros_usados.json")
        if model is not None:
            model.write().overwrite().save(f"{at}/modelo")


def load(spark: SparkSession, artefact_root: str, root: str, windowed: bool = False,
         dry_run: bool = False) -> DataFrame:
    """Discovered runs -> modelo, topico and documento_topico. Returns the runs; a dry run writes
    nothing."""
    find = artefacts.discover_windows if windowed else artefacts.discover_runs
    words = artefacts.read_topic_words(spark, artefact_root)
    assigned = artefacts.read_assignments(spark, artefact_root)
    found = find(spark, artefact_root).join(models.run_metrics(assigned, words), "run", "left")
    window = ["janela_inicio", "janela_fim"] if windowed else []
    stamped = F.struct("entidade_codigo", F.col("encoder_nome").alias("embedding_model"), "k",
                       F.lit("kmeans").alias("algoritmo_clustering"), *window)
    runs = materialize(found.withColumn("parametros", F.to_json(stamped)), "execucoes")
    if dry_run:
        return runs
    write_models = models.register_windowed if windowed else models.register
    sinks.write_table(write_models(sinks.read_table(spark, root, "modelo"), runs), root, "modelo")
    # the surrogate id is a function of the natural key, so runs know theirs
    keyed = runs.join(models.model_rows(runs.withColumn("metricas", F.col("run"))).select(
        F.col("metricas").alias("run"), F.col("id").alias("modelo_id")), "run")
    rows = (
        words.join(keyed.select("run", "modelo_id"), "run")
        .join(models.topic_sizes(assigned), ["run", "numero"], "left")
        .join(artefacts.read_topic_labels(spark, artefact_root), ["run", "numero"], "left")
        .select(surrogate_id("modelo_id", "numero").alias("id"), "modelo_id", "numero", "rotulo",
                F.lit(False).alias("revisado"), "palavras_chave",
                F.coalesce("tamanho", F.lit(0)).alias("tamanho"), "descricao"))
    stored = sinks.write_table(upsert_topics(sinks.read_table(spark, root, "topico"), rows), root,
                               "topico")
    alvo = sinks.read_table(spark, root, "alvo_coleta")
    docs = resolve.of_entity(sinks.read_partitioned(spark, root, "documento").select(
        "id", "alvo_coleta_id", "id_nativo"), alvo)
    pairs = models.bridge(
        assigned.join(keyed.select("run", "modelo_id", "fonte_codigo", "entidade_codigo"), "run"),
        docs, stored)
    add_pairs(spark, root, pairs)
    return runs


def add_pairs(spark: SparkSession, root: str, pairs: DataFrame) -> None:
    key = TABLE_KEYS["documento_topico"]
    sinks.write_table(insert_ignore(sinks.read_table(spark, root, "documento_topico"), pairs, key,
                                    key), root, "documento_topico")


def infer(spark: SparkSession, root: str, artefact_root: str, day: str, days: int, epoch: str,
          embed, clean=None, scope: str = "any") -> DataFrame:
    """Assign every pending document to a topic of its entity's last closed period.

    ``embed`` maps a batch of texts to vectors; ``clean`` is the Column -> Column cleaning the model
    was fitted with. Returns the new (documento_id, topico_id) pairs.
    """
    tables = {n: sinks.read_table(spark, root, n) for n in
              ("alvo_coleta", "modelo", "topico", "documento_topico", "entidade")}
    docs = resolve.of_entity(sinks.read_partitioned(spark, root, "documento").select(
        "id", "alvo_coleta_id", "id_nativo", "tipo", "texto"), tables["alvo_coleta"])
    routed = models.current(docs.withColumn("_dia", F.lit(day).cast("date")), tables["modelo"],
                            "_dia", days, epoch)
    pending = incremental.pending_topics(routed, tables["documento_topico"], tables["topico"], scope)
    names = tables["entidade"].select(F.col("codigo").alias("entidade_codigo"), "nome_exibicao")
    cleaned = pending.join(names, "entidade_codigo").withColumn(
        "texto", X.strip_name_tokens(clean("texto") if clean else F.col("texto"), "nome_exibicao"))
    ready = materialize(incremental.after_clean(cleaned, "texto"), "pendentes")
    vectors = cached_vectors(spark, root, ready, embed)
    centers = run_centroids(spark, artefact_root, tables["modelo"])
    # centres lie among unit vectors, so documents are measured there too
    unit = vectors.select("id", V.normalized("embedding").alias("embedding"))
    found = topics.assign_by(ready.select("id", "id_nativo", "modelo_id").join(unit, "id"),
                             "embedding", centers, ["modelo_id"])
    numbered = tables["topico"].select("modelo_id", "numero", F.col("id").alias("topico_id"))
    pairs = materialize(found.join(numbered, ["modelo_id", "numero"]).select(
        F.col("id").alias("documento_id"), "topico_id"), "pares")
    add_pairs(spark, root, pairs)
    return pairs


def cached_vectors(spark: SparkSession, root: str, docs: DataFrame, embed) -> DataFrame:
    """Vectors (id, embedding) of the documents; those of texts met before come from the cache table.

    New vectors are appended to the cache, so a run that is repeated embeds nothing.
    """
    schema, path = "id bigint, resumo string, embedding array<float>", f"{root}/cache_embeddings"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    cache = spark.read.schema(schema).parquet(path) if found else spark.createDataFrame([], schema)
    new = materialize(topics.embed_missing(docs, "id", "texto", cache, embed), "vetores")
    keyed = docs.select("id", F.sha2("texto", 256).alias("resumo"))
    # two runs at once may both have added a vector
    kept = cache.join(keyed, ["id", "resumo"], "left_semi").dropDuplicates(["id", "resumo"])
    out = materialize(kept.select(*new.columns).unionByName(new), "vetores").select("id", "embedding")
    if new.take(1):
        new.write.mode("append").parquet(path)
    return out


def run_centroids(spark: SparkSession, artefact_root: str, stored: DataFrame) -> DataFrame:
    """Centroids of the windowed runs, under the id of their model."""
    runs = artefacts.discover_windows(spark, artefact_root)
    rows = models.model_rows(runs.withColumns({"metricas": F.col("run"),
                                               "parametros": F.lit("{}")}))
    keyed = rows.select(F.col("metricas").alias("run"), F.col("id").alias("modelo_id")).join(
        stored.select(F.col("id").alias("modelo_id")), "modelo_id", "left_semi")
    files = (spark.read.schema("numero int, centroide array<double>")
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .parquet(artefact_root).where(artefacts.file_path().contains("/centroides/")))
    placed = files.select(F.regexp_extract(artefacts.file_path(), r"^(.*)/centroides/[^/]+$", 1)
                          .alias("run"), "numero", "centroide")
    return placed.join(keyed, "run").select("modelo_id", "numero", "centroide")
