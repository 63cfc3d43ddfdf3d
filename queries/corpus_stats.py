"""Counts, vocabularies, duplicates, samples, topics and completeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.functions import wordlists as WL
from murmurio.operators import (corpus, dedup, evaluation, hashtags, models, monitor, normalize,
                                resolve, sampling, topics, vocab)
from murmurio.session import materialize

from .base import CTE, S, TERMS, W, query, strip_sql, tokens_sql
from .loading import assignments, norm_comments, runs, topic_rows
from .scalars import _CENTROID_SQL

TOKENS_SQL = tokens_sql("lower(text)")
CTE["token_rows"] = f"""
    SELECT doc_id, unnest(list_distinct({TOKENS_SQL})) AS palavra FROM documents"""
CTE["doc_freq"] = "SELECT palavra, count(*) AS docs FROM token_rows GROUP BY palavra"
CTE["tag_counts"] = f"""
    SELECT source AS fonte_codigo, lang AS entidade_codigo, hashtag, count(*) AS contagem
    FROM (SELECT source, lang, unnest(regexp_extract_all(lower(t), '#{W}+')) AS hashtag
          FROM decorated) GROUP BY ALL"""


def freq(t):
    return vocab.doc_freq(t.texts(), X.tokens(F.lower("text")))


# --- hashtags ---------------------------------------------------------------------------------


def tag_counts(t):
    docs = t.decorated().select(F.col("source").alias("fonte_codigo"),
                                F.col("lang").alias("entidade_codigo"), "t")
    return hashtags.count(docs, "t")


@query("hashtags.count", "SELECT * FROM tag_counts")
def hashtag_count(t):
    return tag_counts(t)


@query("hashtags.top", """
    SELECT fonte_codigo, entidade_codigo, hashtag, contagem FROM (
        SELECT *, row_number() OVER (PARTITION BY fonte_codigo, entidade_codigo
            ORDER BY contagem DESC, hashtag) AS rn FROM tag_counts) WHERE rn <= 50""")
def hashtag_top(t):
    return hashtags.top(tag_counts(t))


@query("hashtags.upsert", """
    SELECT fonte_codigo, entidade_codigo, hashtag, contagem FROM (
        SELECT *, row_number() OVER (PARTITION BY fonte_codigo, entidade_codigo
            ORDER BY contagem DESC, hashtag) AS rn FROM tag_counts) WHERE rn <= 50
    UNION ALL SELECT source, lang, '#antiga', count(*) FROM documents GROUP BY source, lang""")
def hashtag_upsert(t):
    """A stored count is replaced; a hashtag that left the top stays as it was."""
    from murmurio.operators.upsert import update_cols

    key = ["fonte_codigo", "entidade_codigo", "hashtag"]
    pairs = t.documents.select(F.col("source").alias("fonte_codigo"),
                               F.col("lang").alias("entidade_codigo"))
    old = pairs.groupBy("fonte_codigo", "entidade_codigo").agg(F.count("*").alias("contagem"))
    stale = old.select("fonte_codigo", "entidade_codigo", F.lit("#antiga").alias("hashtag"),
                       "contagem")
    shared = old.select("fonte_codigo", "entidade_codigo", F.concat(
        F.lit("#"), "fonte_codigo").alias("hashtag"), F.lit(0).cast("bigint").alias("contagem"))
    return update_cols(stale.unionByName(shared), hashtags.top(tag_counts(t)), key, ["contagem"],
                       ["hashtag"])


# --- vocabulary -------------------------------------------------------------------------------


@query("vocab.doc_freq", "SELECT * FROM doc_freq")
def doc_freq(t):
    return freq(t)


@query("vocab.top_words", """
    SELECT palavra, docs, round(100.0 * docs / (SELECT count(*) FROM documents), 1) AS pct
    FROM doc_freq ORDER BY docs DESC, palavra LIMIT 20""")
def top_words(t):
    return vocab.top_words(freq(t), t.documents.count())


@query("vocab.df_stopwords", """
    SELECT palavra FROM doc_freq WHERE docs < 3 OR docs / (SELECT count(*) FROM documents) > 0.2""")
def df_stopwords(t):
    return vocab.df_stopwords(freq(t), t.documents.count(), 3, 0.2)


NOISE_SQL = "(VALUES " + ", ".join(f"('{w}')" for w in WL.GENERIC_NOISE) + ") AS n(palavra)"
CTE["accented"] = "SELECT palavra FROM doc_freq WHERE docs > 20"


@query("vocab.expand_stopwords", """
    WITH sem AS (SELECT DISTINCT strip_accents(palavra) AS palavra FROM accented)
    SELECT palavra FROM accented UNION SELECT palavra FROM sem
    UNION SELECT palavra FROM doc_freq WHERE strip_accents(palavra) IN (SELECT palavra FROM sem)""")
def expand_stopwords(t):
    words = materialize(freq(t), "vocabulario")
    return vocab.expand_stopwords(words.where("docs > 20").select("palavra"), words)


@query("vocab.union_stopwords", f"""
    SELECT palavra FROM {NOISE_SQL} UNION SELECT palavra FROM accented
    UNION SELECT unnest(regexp_extract_all(lower(n_name), '[a-zA-ZÀ-ÿ]{{2,}}')) FROM nation""")
def union_stopwords(t):
    noise = t.spark.createDataFrame([(w,) for w in WL.GENERIC_NOISE], "palavra string")
    names = t.nation.select(F.explode(X.extract_words("n_name", 2)).alias("palavra"))
    return vocab.union_stopwords(noise, freq(t).where("docs > 20"), names)


@query("vocab.extra_stopwords", f"""
    SELECT DISTINCT palavra FROM (SELECT unnest({tokens_sql("lower(text)")}) AS palavra
        FROM benchmark) WHERE palavra NOT IN (SELECT palavra FROM accented)""")
def extra_stopwords(t):
    extra = t.benchmark.select(F.explode(X.tokens(F.lower("text"))).alias("palavra"))
    return vocab.extra_stopwords(extra, freq(t).where("docs > 20"))


CTE["idf_rows"] = f"""
    SELECT palavra, docs, ln((1.0 + (SELECT count(*) FROM documents))::DOUBLE / (1.0 + docs)::DOUBLE)
        + 1.0 AS idf
    FROM (SELECT palavra, count(*) AS docs FROM (
        SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{W}{{2,}}'))) AS palavra
        FROM documents) GROUP BY palavra)"""
CTE["low_idf"] = """
    SELECT palavra FROM idf_rows WHERE idf <= (SELECT quantile_cont(idf, 0.001) FROM idf_rows)"""


@query("vocab.idf", "SELECT palavra, docs, round(idf, 6) AS idf FROM idf_rows")
def idf(t):
    scored = vocab.idf(vocab.doc_freq(t.texts(), vocab.idf_words("text")), t.documents.count())
    return scored.select("palavra", "docs", F.round("idf", 6).alias("idf"))


@query("vocab.filter_by_idf", """
    SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda x: NOT
        list_contains(fora, x)), ' ') AS texto
    FROM documents, (SELECT list(palavra) AS fora FROM low_idf)""")
def filter_by_idf(t):
    return vocab.filter_by_idf(t.texts(), "text").select(
        "doc_id", F.col("text").alias("texto"))


@query("vocab.drop_words", """
    SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda x: NOT
        list_contains(fora, x)), ' ') AS texto
    FROM (SELECT doc_id, text FROM documents UNION ALL SELECT doc_id % 7, text || ' the de la'
          FROM documents), (SELECT list(palavra) AS fora FROM low_idf)""")
def drop_words(t):
    """Repeated ids and a null word among the words to drop."""
    docs = t.documents.select("doc_id", "text")
    twice = docs.unionAll(docs.select(F.col("doc_id") % 7, F.concat("text", F.lit(" the de la"))))
    words = vocab.low_idf_words(t.texts(), "text")
    null = words.limit(1).select(F.lit(None).cast("string").alias("palavra"))
    return vocab.drop_words(twice, "text", words.unionAll(null)).select(
        "doc_id", F.col("text").alias("texto"))


CTE["stem_pairs"] = """
    SELECT substr(palavra, 1, 4) AS raiz, palavra FROM (
        SELECT unnest(list_filter(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]+'),
               lambda x: length(x) >= 3)) AS palavra FROM documents)"""
CTE["destemmed"] = """
    WITH best AS (SELECT raiz, palavra FROM (SELECT raiz, palavra, row_number() OVER (
            PARTITION BY raiz ORDER BY count(*) DESC, palavra) AS rn
        FROM stem_pairs GROUP BY raiz, palavra) WHERE rn = 1),
    formas AS (SELECT strip_accents(raiz) AS forma, arg_min(palavra, raiz) AS palavra FROM best
        GROUP BY 1)
    SELECT raiz, palavra FROM best
    UNION ALL SELECT forma, palavra FROM formas WHERE forma NOT IN (SELECT raiz FROM best)"""


def stem_pairs(t):
    """The stemmer is the user's; here a stem is the first four letters of a word."""
    words = t.texts().select(F.explode(X.extract_words("text", 3)).alias("palavra"))
    return words.select(F.substring("palavra", 1, 4).alias("raiz"), "palavra")


@query("vocab.destem", "SELECT * FROM destemmed")
def destem(t):
    return vocab.destem(stem_pairs(t))


# --- duplicates -------------------------------------------------------------------------------


@query("dedup.exact", """
    SELECT coalesce(min(CASE WHEN doc_id % 11 > 0 THEN doc_id END), -1) AS doc_id, text AS texto
    FROM documents GROUP BY text""")
def dedup_exact(t):
    """Every raw row twice, some without an id."""
    docs = t.documents.select(F.when(F.col("doc_id") % 11 > 0, F.col("doc_id")).alias("doc_id"), "text")
    return dedup.exact(docs.unionAll(docs), "text", "doc_id").select(
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("text").alias("texto"))


SIGNATURE_SQL = "substr(" + strip_sql(
    f"regexp_replace(regexp_replace(lower(text), '[^a-z0-9À-ÿ{S[1:-1]}]', '', 'g'), "
    f"'{S}+', ' ', 'g')") + ", 1, 60)"
CTE["signed"] = f"SELECT doc_id, text, {SIGNATURE_SQL} AS assinatura FROM documents"
CTE["prefix_group"] = """
    SELECT assinatura, count(*) AS documentos, min(doc_id) AS primeiro FROM signed
    WHERE assinatura <> '' GROUP BY assinatura HAVING count(*) > 1"""


@query("dedup.prefix_groups", "SELECT * FROM prefix_group")
def prefix_groups(t):
    return dedup.prefix_groups(t.texts(), "doc_id", "text")


@query("dedup.prefix_summary", """
    SELECT count(*) AS grupos, CAST(coalesce(sum(documentos), 0) AS BIGINT) AS documentos,
        coalesce(round(100.0 * sum(documentos) / (SELECT count(*) FROM documents), 1), 0) AS pct
    FROM prefix_group""")
def prefix_summary(t):
    return dedup.prefix_summary(dedup.prefix_groups(t.texts(), "doc_id", "text"),
                                t.documents.count())


@query("dedup.largest_groups", """
    WITH maiores AS (SELECT * FROM prefix_group ORDER BY documentos DESC, assinatura LIMIT 15),
    membros AS (SELECT g.assinatura, g.documentos, s.doc_id, s.text, row_number() OVER (
        PARTITION BY g.assinatura ORDER BY s.doc_id) AS k FROM signed s JOIN maiores g
        USING (assinatura))
    SELECT assinatura, max(documentos) AS documentos, substr(arg_min(text, k), 1, 120) AS inicio,
        string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY k) AS doc_ids
    FROM membros WHERE k <= 10 GROUP BY assinatura""")
def largest_groups(t):
    return dedup.largest_groups(t.texts(), "doc_id", "text")


# --- monitoring -------------------------------------------------------------------------------

CTE["audit"] = """
    SELECT 'reddit' AS fonte, r.id AS id_nativo, a.id AS alvo, r._id, r.processed_text
    FROM raw_reddit r LEFT JOIN alvo a ON a.canal = r._subreddit_busca
        AND a.termo_busca = r._termo_busca
    UNION ALL
    SELECT 'youtube', c.commentId, NULL, c._id, c.processed_text FROM comments c"""
CTE["loaded"] = """
    SELECT DISTINCT a.fonte_codigo AS fonte, d.alvo_coleta_id, d.id_nativo
    FROM documento d JOIN alvo a ON d.alvo_coleta_id = a.id JOIN labels l ON l.doc_id = d.id"""
HEX_OK = "regexp_full_match(_id, '[0-9a-fA-F]{24}')"


def audit(t):
    """Forum and video records; loaded are the documents that have a label."""
    posts = t.raw_reddit().withColumns({"fonte": F.lit("reddit"), "canal": F.col(
        "_subreddit_busca"), "termo_busca": F.col("_termo_busca")})
    posts = monitor.audit_records(resolve.with_fallback(posts, t.alvo()), "id")
    comments = t.comments().withColumns({"fonte": F.lit("youtube"), "canal": F.lit("UC"),
                                         "termo_busca": F.col("_entidade_busca")})
    comments = monitor.audit_records(resolve.with_fallback(comments, t.alvo()), "commentId")
    return posts.unionByName(comments)


def loaded(t):
    docs = t.documento().join(t.labels.select(F.col("doc_id").alias("id")), "id", "left_semi")
    return resolve.loaded_keys(docs, t.alvo())


@query("monitor.completeness", """
    SELECT fonte, count(*) AS total, count(*) FILTER (processed_text IS NULL) AS nao_processados,
        count(*) FILTER (id_nativo IS NULL) AS sem_id,
        count(*) FILTER (id_nativo IS NOT NULL AND alvo IS NULL) AS sem_alvo
    FROM audit GROUP BY fonte""")
def completeness(t):
    return monitor.completeness(audit(t))


@query("monitor.daily_counts", f"""
    SELECT CASE WHEN {HEX_OK} THEN strftime(make_timestamp(CAST('0x' || substr(_id, 1, 8) AS
        BIGINT) * 1000000), '%Y-%m-%d') ELSE 'unknown' END AS dia, fonte, count(*) AS documentos
    FROM audit GROUP BY 1, 2""")
def daily_counts(t):
    return monitor.daily_counts(audit(t))


CTE["reconciled"] = """
    SELECT coalesce(r.fonte, l.fonte) AS fonte,
        count(*) FILTER (r.fonte IS NOT NULL AND l.fonte IS NOT NULL) AS carregados,
        count(*) FILTER (l.fonte IS NULL) AS ausentes,
        count(*) FILTER (r.fonte IS NULL) AS excedentes
    FROM (SELECT DISTINCT fonte, alvo, id_nativo FROM audit WHERE id_nativo IS NOT NULL
          AND alvo IS NOT NULL) r
    FULL JOIN loaded l ON l.fonte = r.fonte AND l.alvo_coleta_id = r.alvo
        AND l.id_nativo = r.id_nativo GROUP BY 1"""


@query("monitor.reconcile", "SELECT * FROM reconciled")
def reconcile(t):
    return monitor.reconcile(audit(t), loaded(t))


@query("monitor.report", """
    WITH c AS (SELECT fonte, count(*) AS total,
        count(*) FILTER (processed_text IS NULL) AS nao_processados,
        count(*) FILTER (id_nativo IS NULL) AS sem_id,
        count(*) FILTER (id_nativo IS NOT NULL AND alvo IS NULL) AS sem_alvo
    FROM audit GROUP BY fonte)
    SELECT c.*, coalesce(carregados, 0) AS carregados, coalesce(ausentes, 0) AS ausentes,
        coalesce(excedentes, 0) AS excedentes,
        coalesce(ausentes, 0) = 0 AND sem_alvo = 0 AND sem_id = 0 AS tudo_carregado
    FROM c LEFT JOIN reconciled USING (fonte)
    UNION ALL SELECT 'vazia', 0, 0, 0, 0, 0, 0, 0, true""")
def report(t):
    """A source without rows is listed too."""
    sources = t.spark.createDataFrame([("reddit",), ("vazia",)], "fonte string")
    return monitor.report(audit(t), loaded(t), sources)


@query("monitor.key_sets", """
    SELECT 'intersecao' AS conjunto, count(*) AS chaves FROM (SELECT l_orderkey FROM lineitem
        INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'diferenca', count(*) FROM (SELECT l_orderkey FROM lineitem
        EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'uniao', count(*) FROM (SELECT l_orderkey FROM lineitem
        UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def key_sets(t):
    """Line-item keys against finished orders, at volume."""
    raw = t.lineitem.select(F.lit("tpch").alias("fonte"), F.lit(1).alias("alvo_coleta_id"),
                            F.col("l_orderkey").alias("id_nativo"))
    stored = t.orders.where("o_orderstatus = 'F'").select(
        F.lit("tpch").alias("fonte"), F.lit(1).alias("alvo_coleta_id"),
        F.col("o_orderkey").alias("id_nativo"))
    sums = monitor.reconcile(raw, stored)
    both = F.col("carregados") + F.col("ausentes") + F.col("excedentes")
    pairs = F.array(F.struct(F.lit("intersecao").alias("conjunto"), F.col("carregados").alias("c")),
                    F.struct(F.lit("diferenca").alias("conjunto"), F.col("ausentes").alias("c")),
                    F.struct(F.lit("uniao").alias("conjunto"), both.alias("c")))
    return sums.select(F.explode(pairs).alias("p")).select("p.conjunto", F.col("p.c").alias(
        "chaves"))


@query("monitor.collection_audit", """
    SELECT _subreddit_busca, _termo_busca, _tipo_documento, count(*) AS quantidade FROM raw_reddit
    GROUP BY 1, 2, 3""")
def collection_audit(t):
    return monitor.collection_audit(t.raw_reddit())


@query("monitor.example_per_type", """
    SELECT _tipo_documento, min(doc_id) AS doc_id, arg_min(_termo_busca, doc_id) AS _termo_busca
    FROM raw_reddit GROUP BY _tipo_documento""")
def example_per_type(t):
    return monitor.example_per_type(t.raw_reddit(), "doc_id").select(
        "_tipo_documento", "doc_id", "_termo_busca")


@query("monitor.target_state", """
    SELECT alvo_coleta_id, tipo AS tipo_documento, count(*) AS total_documentos,
        CAST(epoch(min(publicado_em)) AS BIGINT) AS primeiro,
        CAST(epoch(max(publicado_em)) AS BIGINT) AS ultimo FROM documento GROUP BY 1, 2""")
def target_state(t):
    return monitor.target_state(t.documento()).select(
        "alvo_coleta_id", "tipo_documento", "total_documentos",
        F.unix_timestamp("primeiro_publicado_em").alias("primeiro"),
        F.unix_timestamp("ultimo_publicado_em").alias("ultimo"))


@query("monitor.daily_rollup", """
    SELECT strftime(publicado_em, '%Y-%m-%d') AS dia, entidade_codigo, fonte_codigo, source AS tema,
        count(*) AS documentos, count(*) FILTER (polaridade = 'negativo') AS doc_negativos,
        count(*) FILTER (polaridade = 'neutro') AS doc_neutros,
        count(*) FILTER (polaridade = 'positivo') AS doc_positivos
    FROM documento d LEFT JOIN sentimento s ON s.documento_id = d.id GROUP BY 1, 2, 3, 4""")
def daily_rollup(t):
    scored = t.sentimento().withColumnRenamed("documento_id", "id")
    docs = t.documento().join(scored, "id", "left").withColumnRenamed("source", "tema")
    return monitor.daily_rollup(docs).withColumn("dia", F.col("dia").cast("string"))


@query("monitor.events_per_day", """
    SELECT strftime(ts, '%Y-%m-%d') AS dia, event_type AS fonte, count(*) AS documentos
    FROM events GROUP BY 1, 2""")
def events_per_day(t):
    return monitor.daily_counts(t.events.select(
        F.col("event_type").alias("fonte"), F.col("ts").cast("timestamp").alias("coletado_em")))


# --- sampling ---------------------------------------------------------------------------------

CTE["valid_comment"] = """
    SELECT id AS id_origem, body AS texto, _termo_busca AS termo_busca, _subreddit_busca AS
        contexto, 'reddit' AS rede_social FROM raw_reddit
    WHERE _tipo_documento = 'comentario' AND body IS NOT NULL AND body NOT IN ('[deleted]',
        '[removed]', '') AND length(body) >= 15 AND id IS NOT NULL"""
CTE["drawn"] = """
    SELECT *, md5('42:' || id_origem) AS sorteio FROM valid_comment
    ORDER BY sorteio, id_origem LIMIT 123"""


def valid(t):
    raw = t.raw_reddit().where(F.col("id").isNotNull())
    return sampling.reddit_records(sampling.valid_reddit_comments(raw))


@query("sampling.valid_reddit", "SELECT * FROM valid_comment")
def valid_reddit(t):
    return valid(t)


@query("sampling.valid_youtube", """
    SELECT commentId AS id_origem, text AS texto, _entidade_busca AS termo_busca,
        coalesce(channelTitle, '<null>') AS contexto, 'youtube' AS rede_social FROM comments
    WHERE text IS NOT NULL AND text <> '' AND length(text) >= 15""")
def valid_youtube(t):
    found = sampling.youtube_records(sampling.valid_youtube_comments(t.comments()))
    return found.withColumn("contexto", F.coalesce("contexto", F.lit("<null>")))


@query("sampling.sample_n", "SELECT id_origem, texto, sorteio FROM drawn")
def sample_n(t):
    from murmurio.operators.skew import draw_key

    return sampling.sample_n(valid(t), "id_origem", 123).select(
        "id_origem", "texto", draw_key(42, "id_origem").alias("sorteio"))


@query("sampling.assign_forms", f"""
    WITH r AS (SELECT *, row_number() OVER (ORDER BY sorteio, id_origem) AS n,
        ntile(10) OVER (ORDER BY sorteio, id_origem) AS f FROM drawn)
    SELECT 'REDDIT_' || lpad(CAST(n AS VARCHAR), 4, '0') AS item_id,
        'Form_Reddit_' || lpad(CAST(f AS VARCHAR), 2, '0') AS form_id,
        CAST(row_number() OVER (PARTITION BY f ORDER BY n) AS INT) AS ordem_no_form, rede_social,
        id_origem, contexto, {strip_sql(f"regexp_replace(texto, '{S}+', ' ', 'g')")} AS texto
    FROM r""")
def assign_forms(t):
    sample = materialize(sampling.sample_n(valid(t), "id_origem", 123), "amostra")
    return sampling.assign_forms(sample, "id_origem")


@query("sampling.forms_of_all", """
    WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('7:' || id_origem), id_origem) AS n,
        ntile(7) OVER (ORDER BY md5('7:' || id_origem), id_origem) AS f FROM valid_comment)
    SELECT id_origem, 'Form_Reddit_' || lpad(CAST(f AS VARCHAR), 2, '0') AS form_id,
        CAST(row_number() OVER (PARTITION BY f ORDER BY n) AS INT) AS ordem_no_form FROM r""")
def forms_of_all(t):
    return sampling.assign_forms(valid(t), "id_origem", 7, seed=7).select(
        "id_origem", "form_id", "ordem_no_form")


@query("eval.kfold", """
    SELECT doc_id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id),
        doc_id) - 1) % 5 + 1 AS INT) AS fold FROM labels""")
def kfold(t):
    return evaluation.kfold(t.labels.select("doc_id", "toxic"), "doc_id", "toxic")


CTE["classed"] = """
    SELECT doc_id, CASE classificacao WHEN 'Negativo' THEN 0 WHEN 'Neutro' THEN 1 ELSE 2 END
        AS classe, CAST(doc_id % 5 + 1 AS INT) AS fold,
        CAST(CASE WHEN doc_id % 4 = 0 THEN doc_id % 3 ELSE CASE classificacao WHEN 'Negativo' THEN 0
            WHEN 'Neutro' THEN 1 ELSE 2 END END AS INT) AS previsto
    FROM rotulado WHERE classificacao <> 'PENDENTE'"""
CTE["fold_score"] = """
    WITH k AS (SELECT fold, c, count(*) FILTER (classe = c) AS n, count(*) FILTER (previsto = c)
            AS p, count(*) FILTER (classe = c AND previsto = c) AS tp
        FROM classed, (VALUES (0), (1), (2)) AS g(c) GROUP BY fold, c)
    SELECT fold, avg(2.0 * tp / (n + p)) AS f1_macro, sum(tp) / sum(n) AS acuracia
    FROM k WHERE n + p > 0 GROUP BY fold"""


def classed(t):
    from murmurio.operators import sentiment as S2

    table = S2.drop_pending(t.rotulado()).withColumn("classe", S2.encode_label("classificacao"))
    d = F.col("doc_id")
    return table.select("doc_id", "classe", (d % 5 + 1).cast("int").alias("fold"),
                        F.when(d % 4 == 0, (d % 3).cast("int")).otherwise(F.col("classe")).alias(
                            "previsto"))


@query("eval.macro_f1", """
    SELECT fold, round(f1_macro, 6) AS f1_macro, round(acuracia, 6) AS acuracia FROM fold_score""")
def macro_f1(t):
    return evaluation.fold_scores(classed(t)).select(
        "fold", F.round("f1_macro", 6).alias("f1_macro"), F.round("acuracia", 6).alias("acuracia"))


@query("eval.summary", """
    SELECT round(avg(f1_macro), 6) AS f1_medio, round(stddev_pop(f1_macro), 6) AS f1_desvio,
        round(avg(acuracia), 6) AS acuracia_media, round(stddev_pop(acuracia), 6)
        AS acuracia_desvio FROM fold_score""")
def eval_summary(t):
    out = evaluation.summary(evaluation.fold_scores(classed(t)))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("eval.class_weights", """
    SELECT classe, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6)
        AS peso FROM classed GROUP BY classe""")
def class_weights(t):
    return evaluation.class_weights(classed(t)).withColumn("peso", F.round("peso", 6))


# --- corpora and topics -----------------------------------------------------------------------


def candidates(t):
    return t.documents.select(F.element_at(F.create_map(
        *[F.lit(x) for k, v in TERMS.items() for x in (k, f" {v.upper()} ")]), F.col("lang")).alias(
        "candidato")).distinct()


@query("corpus.load_reddit", f"""
    SELECT doc_id, texto_original, md5(texto_stemizado) AS resumo, termo_busca FROM (
        SELECT id AS doc_id, {strip_sql("title || ' ' || selftext")} AS texto_original,
            array_to_string(list_filter({tokens_sql('processed_text')}, lambda x: x NOT IN
                ('removed', 'deleted')), ' ') AS texto_stemizado,
            upper(_termo_busca) AS termo_busca, row_number() OVER (PARTITION BY _termo_busca,
                {strip_sql("title || ' ' || selftext")} ORDER BY id) AS rn
        FROM (SELECT coalesce(id, _id) AS id, title, selftext, processed_text, _termo_busca
              FROM raw_reddit WHERE _tipo_documento = 'post' AND processed_text IS NOT NULL
              AND {strip_sql("processed_text")} <> '')) WHERE rn = 1""")
def load_reddit(t):
    return corpus.load(t.raw_reddit(), "reddit", candidates(t)).select(
        "doc_id", "texto_original", F.md5("texto_stemizado").alias("resumo"),
        X.strip("termo_busca").alias("termo_busca"))


@query("corpus.load_meta", """
    SELECT min(id) AS doc_id, url AS texto, nome AS termo_busca FROM (
        SELECT id, url || '  ' || html AS corpo, url, html,
            coalesce(nullif(page_name, ''), _entidade_busca) AS nome
        FROM ads WHERE processed_text IS NOT NULL) GROUP BY url, html, nome""")
def load_meta(t):
    ads = t.ads()
    names = ads.select(X.first_filled("page_name", "_entidade_busca").alias("candidato")).distinct()
    found = corpus.load(ads, "meta", names)
    urls = ads.select(F.col("id").alias("doc_id"), F.col("ad_creative_bodies")[0].alias("texto"))
    return found.join(urls, "doc_id").select("doc_id", "texto", "termo_busca")


@query("corpus.load_youtube", f"""
    SELECT min(commentId) AS doc_id, texto, termo AS termo_busca FROM (
        SELECT c.commentId, {strip_sql('c.text')} AS texto, coalesce(nullif(v.channelTitle, ''),
            nullif(v._entidade_busca, ''), nullif(c.channelTitle, ''), '') AS termo
        FROM comments c LEFT JOIN videos v USING (videoId))
    WHERE texto <> '' AND termo <> '' GROUP BY texto, termo""")
def load_youtube(t):
    titled = resolve.comment_title(t.comments(), t.videos())
    names = titled.where("termo <> ''").select(F.col("termo").alias("candidato")).distinct()
    return corpus.load(titled, "youtube", names).select(
        "doc_id", F.col("texto_original").alias("texto"), "termo_busca")


@query("topics.sizes", """
    SELECT 'd0' AS run, numero, count(*) AS tamanho FROM topic_docs GROUP BY numero""")
def topic_sizes(t):
    return models.topic_sizes(t.topic_docs().withColumn("run", F.lit("d0")))


@query("topics.run_metrics", """
    SELECT 'd0' AS run, '{"n_documentos_atribuidos":' || count(*) || ',"n_topicos":'
        || count(DISTINCT CASE WHEN numero <> -1 THEN numero END) || '}' AS metricas
    FROM topic_docs""")
def run_metrics(t):
    return models.run_metrics(t.topic_docs().withColumn("run", F.lit("d0")),
                              topic_rows(t).withColumn("run", F.lit("d0")))


@query("topics.distribution", """
    SELECT numero, count(*) AS documentos, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
    FROM topic_docs GROUP BY numero""")
def distribution(t):
    return topics.distribution(t.topic_docs())


@query("topics.distribution_summary", """
    WITH s AS (SELECT numero, count(*) AS n FROM topic_docs GROUP BY numero),
    m AS (SELECT numero, n FROM s WHERE numero <> -1 ORDER BY n DESC, numero LIMIT 1),
    a AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (numero <> -1) AS topicos,
        CAST(coalesce(sum(n) FILTER (numero = -1), 0) AS BIGINT) AS outliers FROM s)
    SELECT total, topicos, outliers, round(100.0 * outliers / total, 1) AS outliers_pct,
        m.numero AS maior, m.n AS maior_documentos, round(100.0 * m.n / total, 1) AS maior_pct
    FROM a, m""")
def distribution_summary(t):
    return topics.distribution_summary(t.topic_docs())


@query("topics.centroids", """
    SELECT numero, CAST(pos AS INT) AS pos, round(avg(CAST(embedding[pos] AS DOUBLE)), 6) AS media
    FROM topic_docs, generate_series(1, 64) AS g(pos) WHERE numero <> -1 GROUP BY numero, pos""")
def centroids(t):
    centers = topics.centroids(t.topic_docs(), "embedding")
    return centers.select("numero", F.posexplode("centroide").alias("pos", "media")).select(
        "numero", (F.col("pos") + 1).alias("pos"), F.round("media", 6).alias("media"))


CTE["center"] = """
    SELECT numero, list(media ORDER BY pos) AS c FROM (
        SELECT numero, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS media
        FROM topic_docs, generate_series(1, 64) AS g(pos) WHERE numero <> -1
        GROUP BY numero, pos) GROUP BY numero"""
CTE["central"] = """
    SELECT * FROM (SELECT vec_id, numero, row_number() OVER (PARTITION BY numero ORDER BY
            round(list_distance(CAST(embedding AS DOUBLE[]), c), 9), vec_id) AS posicao
        FROM topic_docs JOIN center USING (numero)) WHERE posicao <= 10"""


@query("topics.representatives", """
    SELECT vec_id, numero, CAST(posicao AS INT) AS posicao FROM central""")
def representatives(t):
    return topics.representatives(t.topic_docs(), "vec_id", "embedding").select(
        "vec_id", "numero", "posicao")


@query("topics.examples", """
    SELECT numero, vec_id, 'representativo' AS tipo FROM central
    UNION ALL SELECT numero, vec_id, 'aleatorio' FROM (
        SELECT numero, vec_id, row_number() OVER (PARTITION BY numero ORDER BY md5('42:' || vec_id),
            vec_id) AS rn FROM topic_docs WHERE numero <> -1 AND vec_id NOT IN
            (SELECT vec_id FROM central)) WHERE rn <= 10""")
def examples(t):
    return topics.examples(t.topic_docs(), "vec_id", "embedding")


@query("topics.assign", """
    SELECT vec_id, arg_min(c.numero, struct_pack(d := round(list_distance(
        CAST(e.embedding AS DOUBLE[]), c.c), 9), n := c.numero)) AS numero,
        round(min(list_distance(CAST(e.embedding AS DOUBLE[]), c.c)), 6) AS distancia
    FROM topic_docs e, center c GROUP BY vec_id""")
def assign(t):
    docs = t.topic_docs()
    found = topics.assign(docs, "embedding", topics.centroids(docs, "embedding"))
    return found.select("vec_id", "numero", F.round("distancia", 6).alias("distancia"))


@query("topics.assign_cosine", """
    SELECT vec_id, arg_max(c.numero, struct_pack(d := round(list_cosine_similarity(
        CAST(e.embedding AS DOUBLE[]), c.c), 9), n := -c.numero)) AS numero
    FROM topic_docs e, center c GROUP BY vec_id""")
def assign_cosine(t):
    docs = t.topic_docs()
    centers = topics.centroids(docs, "embedding")
    return topics.assign(docs, "embedding", centers, metric="cosine").select("vec_id", "numero")


@query("topics.assign_by", """
    WITH c3 AS (SELECT grupo, numero, list(media ORDER BY pos) AS c FROM (
        SELECT vec_id % 3 AS grupo, numero, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS media
        FROM topic_docs, generate_series(1, 64) AS g(pos) WHERE numero <> -1
        GROUP BY ALL) GROUP BY grupo, numero)
    SELECT vec_id, arg_min(c3.numero, struct_pack(d := round(list_distance(
        CAST(e.embedding AS DOUBLE[]), c3.c), 9), n := c3.numero)) AS numero
    FROM topic_docs e JOIN c3 ON c3.grupo = e.vec_id % 3 GROUP BY vec_id""")
def assign_by(t):
    """Three models side by side."""
    docs = t.topic_docs().withColumn("grupo", F.col("vec_id") % 3)
    means = F.array(*[F.avg(F.col("embedding")[i]) for i in range(64)])
    centers = docs.where("numero <> -1").groupBy("grupo", "numero").agg(means.alias("centroide"))
    return topics.assign_by(docs, "embedding", centers, ["grupo"]).select("vec_id", "numero")


@query("topics.infer", """
    SELECT d.id AS documento_id, CAST(100 + c.numero AS BIGINT) AS topico_id FROM (
        SELECT vec_id, arg_min(c.numero, struct_pack(d := round(list_distance(
            CAST(e.embedding AS DOUBLE[]), c.c), 9), n := c.numero)) AS numero
        FROM topic_docs e, center c GROUP BY vec_id) c
    JOIN documento d ON d.id = c.vec_id WHERE d.texto IS NOT NULL AND d.tipo = 'post'""")
def infer(t):
    """Pending posts -> nearest topic -> document bridge, nothing stored before."""
    from murmurio.operators import incremental

    vectors = t.topic_docs()
    none = t.spark.createDataFrame([], "documento_id bigint, topico_id bigint")
    pending = incremental.pending_topics(t.documento(), none, topic_rows(t))
    embedded = pending.join(vectors.select(F.col("vec_id").alias("id"), "embedding"), "id")
    found = topics.assign(embedded.select("id", "id_nativo", "embedding"), "embedding",
                          topics.centroids(vectors, "embedding"))
    return models.bridge(found.select("id_nativo", "numero", F.lit(7).cast("bigint").alias(
        "modelo_id")), pending.select("id", "id_nativo"), topic_rows(t))


CTE["topic_term"] = f"""
    SELECT numero, palavra, count(*) AS n FROM (
        SELECT numero, unnest(regexp_extract_all(strip_accents(lower(text)),
            '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS palavra
        FROM topic_texts WHERE numero <> -1) GROUP BY 1, 2"""
CTE["content_weight"] = """
    WITH term AS (SELECT * FROM topic_term WHERE palavra NOT IN (SELECT palavra FROM accented)),
    w AS (SELECT numero, sum(n) AS palavras FROM term GROUP BY numero),
    a AS (SELECT floor(avg(palavras)) AS media FROM w),
    f AS (SELECT palavra, sum(n) AS total FROM term GROUP BY palavra)
    SELECT t.numero, t.palavra, t.n, t.n / w.palavras * ln(1.0 + a.media / f.total) AS peso
    FROM term t JOIN w USING (numero) JOIN f USING (palavra), a"""
CTE["topic_weight"] = """
    WITH w AS (SELECT numero, sum(n) AS palavras FROM topic_term GROUP BY numero),
    a AS (SELECT floor(avg(palavras)) AS media FROM w),
    f AS (SELECT palavra, sum(n) AS total FROM topic_term GROUP BY palavra)
    SELECT t.numero, t.palavra, t.n, t.n / w.palavras * ln(1.0 + a.media / f.total) AS peso
    FROM topic_term t JOIN w USING (numero) JOIN f USING (palavra), a"""


def topic_weights(t, stopwords=None):
    return topics.ctfidf(topics.term_counts(
        t.topic_texts(), topics.vectorizer_tokens("text"), stopwords=stopwords))


@query("topics.ctfidf", "SELECT numero, palavra, n, round(peso, 8) AS peso FROM topic_weight")
def ctfidf(t):
    return topic_weights(t).withColumn("peso", F.round("peso", 8))


@query("topics.keywords", """
    SELECT numero, palavra, CAST(row_number() OVER (PARTITION BY numero ORDER BY round(peso, 9)
        DESC, palavra) AS INT) AS posicao FROM content_weight QUALIFY posicao <= 10""")
def keywords(t):
    """Stop words are left out before anything is counted."""
    stop = freq(t).where("docs > 20").select("palavra")
    return topics.keywords(topic_weights(t, stop), 10).select("numero", "palavra", "posicao")


@query("topics.readable_keywords", """
    WITH r AS (SELECT numero, palavra, row_number() OVER (PARTITION BY numero ORDER BY
            round(peso, 9) DESC, palavra) AS k FROM topic_weight),
    l AS (SELECT r.numero, r.k, coalesce(d.palavra, r.palavra) AS palavra FROM r
        LEFT JOIN destemmed d ON d.raiz = r.palavra WHERE k <= 30),
    u AS (SELECT numero, lower(palavra) AS chave, arg_min(palavra, k) AS palavra, min(k) AS k FROM l
        GROUP BY 1, 2)
    SELECT numero, string_agg(palavra, ' ' ORDER BY k) AS palavras FROM (
        SELECT *, row_number() OVER (PARTITION BY numero ORDER BY k) AS p FROM u) WHERE p <= 10
    GROUP BY numero""")
def readable_keywords(t):
    words = topics.keywords(topic_weights(t), 10, mapping=vocab.destem(stem_pairs(t)),
                            candidates=30)
    return topics.keyword_lists(words).select("numero", F.array_join("palavras_chave", " ").alias(
        "palavras"))


@query("skew.salted_join", """
    SELECT d.doc_id, d.source, s.n FROM (
        SELECT doc_id, CASE WHEN doc_id % 13 > 0 THEN source END AS source FROM documents) d
    LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) s USING (source)""")
def salted_join(t):
    """Every source above a thousandth of the rows is salted, however small the table; null keys too."""
    from murmurio.operators import skew

    left = t.documents.select("doc_id", F.when(F.col("doc_id") % 13 > 0, F.col("source")).alias("source"))
    right = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    return skew.salted_join(left, right, ["source"], ["doc_id"], least=0)
