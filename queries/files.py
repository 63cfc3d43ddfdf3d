"""Readers and writers, over files that Spark writes from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.operators import models, sentiment, topics, upsert
from murmurio.session import scratch_path
from murmurio.sources import artefacts, raw, sinks

from .base import CTE, T0, TERMS, TERM_SLUG_SQL, query, term_of
from .corpus_stats import topic_weights
from .loading import ITEM_ORDER, stored_orders

EXTRA = ["doc_id", "lang", "n_chars"]


def raw_json(t):
    """The forum records as JSON lines; absent fields are absent."""
    path = scratch_path(t.spark, "reddit")
    t.raw_reddit().drop(*EXTRA).write.json(path)
    return path


@query("io.read_raw", """
    SELECT coalesce(id, '<null>') AS id, _id, coalesce(body, '<null>') AS body, score
    FROM raw_reddit WHERE _tipo_documento = 'comentario'""")
def read_raw(t):
    df = raw.read_raw(t.spark, raw_json(t), "reddit",
                      where=F.col("_tipo_documento") == "comentario",
                      columns=["id", "_id", "body", "score"])
    return df.fillna("<null>", ["id", "body"])


@query("io.read_raw_projected", """
    SELECT _subreddit_busca, count(*) AS linhas, count(*) FILTER (processed_text IS NULL) AS
        pendentes FROM raw_reddit GROUP BY _subreddit_busca""")
def read_raw_projected(t):
    df = raw.read_raw(t.spark, raw_json(t), "reddit", columns=["_subreddit_busca", "processed_text"])
    return df.groupBy("_subreddit_busca").agg(
        F.count("*").alias("linhas"), F.count_if(F.col("processed_text").isNull()).alias(
            "pendentes"))


@query("io.read_raw_limited", """
    SELECT id, score FROM raw_reddit WHERE id IS NOT NULL ORDER BY id LIMIT 100""")
def read_raw_limited(t):
    return raw.read_raw(t.spark, raw_json(t), "reddit", where="id IS NOT NULL",
                        columns=["id", "score"], limit=100, order=["id"])


@query("io.read_raw_presence", """
    SELECT id, permalink IS NOT NULL AS tem_link, FALSE AS quebrada FROM raw_reddit
    WHERE id IS NOT NULL""")
def read_raw_presence(t):
    df = raw.read_raw(t.spark, raw_json(t), "reddit", where="id IS NOT NULL", presence=True)
    return df.select("id", F.array_contains("campos", "permalink").alias("tem_link"),
                     F.col(raw.CORRUPT).isNotNull().alias("quebrada"))


@query("io.read_by_path", f"""
    SELECT CASE WHEN lang IN ('en', 'de') THEN 'reddit' ELSE 'youtube' END AS fonte_codigo,
        {TERM_SLUG_SQL} AS entidade_codigo, text AS text_raw FROM documents WHERE lang <> 'fr'""")
def read_by_path(t):
    """One folder per collection, one Parquet per entity; one collection is unknown."""
    root = scratch_path(t.spark, "corpora")
    folder = {"en": "reddit", "de": "reddit", "es": "youtube_comments", "fr": "outra"}
    names = {"en": "ana_lima", "de": "ze_ramos", "es": "iris_couto", "fr": "otto_braga"}
    for lang in TERMS:
        docs = t.documents.where(F.col("lang") == lang)
        docs.select(F.col("text").alias("text_raw")).write.parquet(
            f"{root}/{folder[lang]}/{names[lang]}.parquet")
    return raw.read_by_path(t.spark, root)


@query("io.read_labels", """
    SELECT texto, classificacao, count(*) AS linhas FROM rotulado GROUP BY texto, classificacao""")
def read_labels(t):
    path = scratch_path(t.spark, "rotulos")
    quoted = t.rotulado().select(F.concat(F.lit('"'), F.replace("texto", F.lit('"'), F.lit('""')),
                                          F.lit('",'), "classificacao").alias("value"))
    quoted.write.text(path)
    # the files have no header line of their own
    df = t.spark.read.schema("texto STRING, classificacao STRING").option("multiLine", True).option(
        "escape", '"').csv(path)
    out = scratch_path(t.spark, "rotulos")
    sinks.write_csv(df, out, ["texto", "classificacao"])
    return raw.read_labels(t.spark, out).groupBy("texto", "classificacao").agg(
        F.count("*").alias("linhas"))


@query("io.read_words", """
    SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]+')) AS palavra
    FROM benchmark""")
def read_words(t):
    path = scratch_path(t.spark, "palavras")
    words = t.benchmark.select(F.explode(X.extract_words("text")).alias("w")).distinct()
    words.select(F.explode(F.array(F.concat(F.lit(" "), "w", F.lit("\t")), F.lit("")))).write.text(
        path)
    return raw.read_words(t.spark, path)


CTE["run_docs"] = f"""
    SELECT CASE lang WHEN 'en' THEN 'reddit/ana_lima/k15' WHEN 'de' THEN 'reddit/ze_ramos/k5'
            WHEN 'es' THEN 'meta/iris_couto/k10' END AS pasta, lang,
        'd' || doc_id AS id_nativo, CAST(substr(source, 4) AS INT) AS numero, source,
        {TERM_SLUG_SQL} AS entidade_codigo FROM documents WHERE lang <> 'fr'"""

RUNS = {  # language -> (folder, encoder folder, has assignments, has labels)
    "en": ("reddit/ana_lima/k15", "qwen_qwen3_embedding_0_6b", True, True),
    "de": ("reddit/ze_ramos/k5", "sentence_transformers_all_minilm_l12_v2", True, False),
    "es": ("meta/iris_couto/k10", "ricardoz_bertugues_base_portuguese_cased", True, True),
    "fr": ("meta/otto_braga/k10", "qwen_qwen3_embedding_0_6b", False, False),
}


def run_tree(t, window=None):
    """Artefacts of one topic run per language; the source number is the topic. The run of one
    language is incomplete, another copy has an unknown encoder."""
    root = scratch_path(t.spark, "resultado")
    number = F.substring("source", 4, 9).cast("int")
    for lang, (folder, encoder, assigned, labelled) in RUNS.items():
        if window:
            entity, k = folder.rsplit("/", 1)
            folder = f"{entity}/{window[lang]}/{k}"
        at = f"{root}/{folder}/bertopic_kmeans/{encoder}"
        docs = t.documents.where(F.col("lang") == lang).withColumn("numero", number)
        per_topic = docs.groupBy("numero").agg(F.max("source").alias("source"))
        line = F.concat_ws(" ", F.col("numero").cast("string"), F.lit("-"), "source", F.lit(lang))
        lines = per_topic.select(F.explode(F.array(F.lit("cabeçalho"), line)).alias("value"))
        lines.coalesce(1).write.text(f"{at}/result_topic_20.txt")
        if lang == "en":
            lines.coalesce(1).write.text(
                f"{root}/{folder}/bertopic_kmeans/desconhecido/result_topic_20.txt")
        if assigned:
            rows = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("papers"),
                               F.col("numero").cast("string").alias("dominant_topic"))
            sinks.write_csv(rows, f"{at}/Resumo_Topicos_Dominantes.csv",
                            ["papers", "dominant_topic"])
        if labelled:
            titled = F.to_json(F.struct(F.col("source").alias("titulo"),
                                        F.lit(lang).alias("descricao")))
            value = F.when(F.col("numero") % 2 == 0, titled).otherwise(
                F.concat(F.lit('"'), "source", F.lit('"')))
            entry = F.concat(F.lit('"'), F.col("numero").cast("string"), F.lit('": '), value)
            packed = per_topic.select(entry.alias("e")).agg(F.array_join(F.array_sort(
                F.collect_list("e")), ", ").alias("e"))
            packed.select(F.concat(F.lit("{"), "e", F.lit("}"))).coalesce(1).write.text(
                f"{at}/rotulos_topicos.json")
    return root


def folder_of(root):
    """Path of the run below the root, without the encoder."""
    inside = F.regexp_extract("run", r"/(resultado-[^/]+)/(.*)/bertopic_kmeans/", 2)
    return inside.alias("pasta")


@query("io.discover_runs", """
    SELECT pasta, split_part(pasta, '/', 1) AS fonte_codigo, entidade_codigo,
        CASE lang WHEN 'en' THEN 15 WHEN 'de' THEN 5 ELSE 10 END AS k,
        CASE lang WHEN 'en' THEN 'qwen3_0_6b' WHEN 'de' THEN 'minilm_l12' ELSE 'bertugues' END
        AS encoder, lang <> 'de' AS tem_rotulos, TRUE AS tem_data
    FROM run_docs GROUP BY ALL""")
def discover_runs(t):
    root = run_tree(t)
    return artefacts.discover_runs(t.spark, root).select(
        folder_of(root), "fonte_codigo", "entidade_codigo", "k", "encoder", "tem_rotulos",
        F.col("treinado_em").isNotNull().alias("tem_data"))


WINDOWS = {"en": "2024-01-03", "de": "semana_2024-01-01", "es": "sem_data", "fr": "2024-01-04"}


@query("io.discover_windows", """
    SELECT entidade_codigo, CASE lang WHEN 'en' THEN '2024-01-03' ELSE '2024-01-01' END AS inicio,
        CASE lang WHEN 'en' THEN '2024-01-03' ELSE '2024-01-07' END AS fim FROM run_docs
    WHERE lang IN ('de') GROUP BY ALL""")
def discover_windows(t):
    """The day folder of one entity starts with a run of an unknown encoder, so it drops out."""
    root = run_tree(t, WINDOWS)
    found = artefacts.discover_windows(t.spark, root)
    return found.select("entidade_codigo", F.col("janela_inicio").cast("string").alias("inicio"),
                        F.col("janela_fim").cast("string").alias("fim"))


@query("io.read_topic_words", """
    SELECT pasta, numero, source || ' ' || lang AS palavras FROM run_docs GROUP BY ALL
    UNION ALL SELECT 'meta/otto_braga/k10', CAST(substr(source, 4) AS INT), source || ' fr'
    FROM documents WHERE lang = 'fr' GROUP BY ALL""")
def read_topic_words(t):
    root = run_tree(t)
    words = artefacts.read_topic_words(t.spark, root).where(~F.col("run").endswith("desconhecido"))
    return words.select(folder_of(root), "numero", F.array_join("palavras_chave", " ").alias(
        "palavras"))


@query("io.read_assignments", "SELECT pasta, id_nativo, numero FROM run_docs")
def read_assignments(t):
    root = run_tree(t)
    return artefacts.read_assignments(t.spark, root).select(folder_of(root), "id_nativo", "numero")


@query("io.read_topic_labels", """
    SELECT pasta, numero, source AS rotulo, CASE WHEN numero % 2 = 0 THEN lang ELSE '<null>' END
        AS descricao FROM run_docs WHERE lang <> 'de' GROUP BY ALL""")
def read_topic_labels(t):
    root = run_tree(t)
    return artefacts.read_topic_labels(t.spark, root).select(
        folder_of(root), "numero", "rotulo", F.coalesce("descricao", F.lit("<null>")).alias(
            "descricao"))


@query("models.load_runs", """
    SELECT pasta, CASE lang WHEN 'en' THEN 'vigente' ELSE 'arquivado' END AS status,
        '{"n_documentos_atribuidos":' || count(*) || ',"n_topicos":' || count(DISTINCT numero) ||
        '}' AS metricas FROM run_docs GROUP BY pasta, lang""")
def load_runs(t):
    """Discovered runs -> model rows with their metrics."""
    root = run_tree(t)
    found = artefacts.discover_runs(t.spark, root)
    metrics = models.run_metrics(artefacts.read_assignments(t.spark, root),
                                 artefacts.read_topic_words(t.spark, root))
    runs = found.join(metrics, "run").withColumn("parametros", F.to_json(F.struct(
        "entidade_codigo", "k")))
    rows = models.model_rows(runs)
    names = runs.select(folder_of(root), F.concat_ws("_", "fonte_codigo", "entidade_codigo").alias(
        "_inicio"))
    return rows.withColumn("_inicio", F.regexp_extract("nome", "^(.*)__", 1)).join(
        names, "_inicio").select("pasta", "status", "metricas")


@query("io.write_csv", """
    SELECT 'd' || vec_id AS doc_id, CAST(numero AS VARCHAR) AS topico_dominante FROM topic_docs""")
def write_csv(t):
    path = scratch_path(t.spark, "csv")
    docs = t.topic_docs().select(F.concat(F.lit("d"), F.col("vec_id").cast("string")).alias(
        "doc_id"), F.col("numero").alias("topico_dominante"))
    sinks.write_csv(docs, path, ["doc_id", "topico_dominante"])
    return t.spark.read.option("header", True).csv(path)


@query("io.topic_words_json", """
    SELECT '{' || string_agg('"' || numero || '":["' || p || '"]', ',' ORDER BY CAST(numero AS
        VARCHAR)) || '}' AS json FROM (
        SELECT numero, string_agg(palavra, '","' ORDER BY round(peso, 9) DESC, palavra) AS p FROM (
            SELECT *, row_number() OVER (PARTITION BY numero ORDER BY round(peso, 9) DESC, palavra)
                AS k FROM topic_weight WHERE regexp_full_match(palavra, '[a-z]+')) WHERE k <= 10
        GROUP BY numero)""")
def topic_words_json(t):
    plain = topic_weights(t).where(F.col("palavra").rlike("^[a-z]+$"))
    lists = topics.keyword_lists(topics.keywords(plain, 10))
    path = scratch_path(t.spark, "palavras")
    sinks.write_json(lists, path)
    back = t.spark.read.schema("numero int, palavras_chave array<string>").json(path)
    return sinks.topic_words_json(back)


@query("io.tables", """
    SELECT documento_id, modelo_id, polaridade FROM sentimento
    UNION ALL SELECT CAST(event_id + 1000000000 AS BIGINT), CAST(130 AS BIGINT), 'neutro'
    FROM events WHERE event_type = 'view'""")
def tables(t):
    """A table written twice: the second version is the first one with new rows."""
    root = scratch_path(t.spark, "tabelas")
    stored = sinks.write_table(t.sentimento(), root, "sentimento")
    fresh = t.events.where("event_type = 'view'").select(
        (F.col("event_id") + 1000000000).alias("documento_id"),
        F.lit(130).cast("bigint").alias("modelo_id"), F.lit("neutro").alias("polaridade"))
    again = fresh.unionByName(t.sentimento().withColumn("polaridade", F.lit("positivo")))
    key = ["documento_id", "modelo_id"]
    return sinks.write_table(upsert.insert_ignore(stored, again, key, ["polaridade"]), root,
                             "sentimento")


@query("upsert.fresh_rows", """
    SELECT l_orderkey AS chave, l_extendedprice AS valor FROM first_item WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def fresh_rows(t):
    """A dry run: the rows an insert would add, nothing written."""
    target, incoming = stored_orders(t)
    return upsert.fresh_rows(target, incoming, ["chave"], ITEM_ORDER).select("chave", "valor")


PHOTO_SQL = f"""
    SELECT lower(n_name) AS codigo, lower(n_name) || '.jpg' AS arquivo,
        {T0} + n_nationkey * 100 AS modificado FROM nation"""


def photo_files(t):
    return t.nation.select(F.lower("n_name").alias("codigo"),
                           F.concat(F.lower("n_name"), F.lit(".jpg")).alias("arquivo"),
                           F.timestamp_seconds(F.lit(T0) + F.col("n_nationkey") * 100).alias(
                               "modificado_em"))


def photo_entities(t):
    """Nations with a supplier are the registered entities."""
    used = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"))
    return t.nation.join(used, "n_nationkey", "left_semi").select(
        F.lower("n_name").alias("codigo"), F.col("n_name").alias("nome_exibicao"),
        F.lit(None).cast("string").alias("foto"))


@query("entities.update_photos", f"""
    WITH f AS ({PHOTO_SQL})
    SELECT f.codigo, n_name AS nome_exibicao, '/fotos/' || arquivo || '?v=' || modificado AS foto
    FROM f JOIN nation ON lower(n_name) = f.codigo
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def update_photos(t):
    return upsert.update_photos(photo_entities(t), photo_files(t))


@query("entities.unmatched_photos", f"""
    WITH f AS ({PHOTO_SQL})
    SELECT f.codigo, arquivo FROM f JOIN nation ON lower(n_name) = f.codigo
    WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name >= 'B')""")
def unmatched_photos(t):
    """Entities are the nations of the first region by name."""
    region = t.region.where("r_name < 'B'").select(F.col("r_regionkey").alias("n_regionkey"))
    entity = t.nation.join(region, "n_regionkey", "left_semi").select(F.lower("n_name").alias(
        "codigo"))
    return upsert.unmatched_photos(entity, photo_files(t)).select("codigo", "arquivo")
