"""Normalising, resolving and upserting documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.operators import dims, incremental, models, normalize, resolve, upsert
from murmurio.operators.skew import first_per_key

from .base import (ALVO_ID_SQL, CTE, EPOCH, T0, TERM_SLUG_SQL, TERM_SQL, TERMS, query, slugify_sql,
                   strip_sql, term_of)
from .text_functions import STEPS, STOPWORDS


def seconds(name):
    return F.coalesce(F.unix_timestamp(name), F.lit(-1)).alias(name)


def filled(name):
    return F.coalesce(F.col(name), F.lit("<null>")).alias(name)


def shown(docs):
    """A normalised frame with plain types only."""
    return docs.select("fonte", filled("canal"), filled("termo_busca"), "id_nativo", "id_mongo",
                       "tipo", filled("url"), filled("texto"), seconds("publicado_em"),
                       seconds("coletado_em"), "metadados")


HEX_SECONDS = ("CASE WHEN regexp_full_match(_id, '[0-9a-fA-F]{24}') THEN "
               "CAST('0x' || substr(_id, 1, 8) AS BIGINT) ELSE -1 END")
JOINED_SQL = (f"nullif(array_to_string(list_filter([{strip_sql('title')}, {strip_sql('selftext')},"
              f" {strip_sql('body')}], lambda x: x IS NOT NULL AND x <> ''), ' '), '')")

CTE["norm_reddit"] = f"""
    SELECT 'reddit' AS fonte, _subreddit_busca AS canal, _termo_busca AS termo_busca,
        id AS id_nativo, _id AS id_mongo, _tipo_documento AS tipo,
        coalesce('https://reddit.com' || permalink, '<null>') AS url,
        coalesce({JOINED_SQL}, '<null>') AS texto,
        CAST(created_utc AS BIGINT) AS publicado_em, {HEX_SECONDS} AS coletado_em,
        '{{"score":' || score || ',"num_comments":' || CASE WHEN _tipo_documento = 'post' THEN
        CAST(n_chars % 17 AS VARCHAR) ELSE 'null' END || ',"upvote_ratio":' || CASE WHEN
        _tipo_documento = 'post' THEN CAST(CAST(round((n_chars % 100) / 100, 2) AS DOUBLE) AS
        VARCHAR) ELSE 'null' END || ',"total_awards_received":' || (n_chars % 3) ||
        ',"controversiality":' || CASE WHEN _tipo_documento <> 'post' THEN CAST(n_chars % 2 AS
        VARCHAR) ELSE 'null' END || ',"stickied":' || CAST(n_chars % 7 = 0 AS VARCHAR) ||
        ',"distinguished":null,"over_18":' || CASE WHEN _tipo_documento = 'post' THEN
        CAST(n_chars % 13 = 0 AS VARCHAR) ELSE 'null' END || ',"link_flair_text":' || CASE WHEN
        _tipo_documento = 'post' AND n_chars % 2 = 0 THEN '"' || lang || '"' ELSE 'null' END
        || '}}' AS metadados
    FROM raw_reddit WHERE id IS NOT NULL AND created_utc <> 'ontem'"""
CTE["norm_videos"] = f"""
    SELECT 'youtube' AS fonte, channelId AS canal, _entidade_busca AS termo_busca,
        videoId AS id_nativo, _id AS id_mongo, 'video' AS tipo,
        'https://www.youtube.com/watch?v=' || videoId AS url,
        array_to_string(list_filter([{strip_sql('title')}, {strip_sql('description')}],
            lambda x: x <> ''), ' ') AS texto,
        {T0} + conv_id * 3600 AS publicado_em, {HEX_SECONDS} AS coletado_em,
        '{{"viewCount":' || viewCount || ',"likeCount":' || likeCount || ',"commentCount":'
        || commentCount || ',"channelTitle":' || coalesce('"' || channelTitle || '"', 'null')
        || ',"tags":null,"categoryId":"' || categoryId || '"}}' AS metadados
    FROM videos"""
CTE["norm_comments"] = f"""
    SELECT 'youtube' AS fonte, coalesce(v.channelId, '<null>') AS canal,
        c._entidade_busca AS termo_busca, c.commentId AS id_nativo, c._id AS id_mongo,
        'comentario' AS tipo, '<null>' AS url,
        coalesce(nullif({strip_sql('c.text')}, ''), '<null>') AS texto,
        CAST(epoch(strptime(c.publishedAt, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT) AS publicado_em,
        {HEX_SECONDS.replace('_id', 'c._id')} AS coletado_em,
        '{{"likeCount":' || c.likeCount || ',"replyCount":' || c.replyCount
        || ',"authorChannelId":"' || c.authorChannelId || '"}}' AS metadados
    FROM comments c LEFT JOIN videos v USING (videoId)"""
CTE["norm_ads"] = f"""
    SELECT 'meta' AS fonte, coalesce(nullif(page_id, ''), _entidade_busca) AS canal,
        '' AS termo_busca, id AS id_nativo, 'anuncio' AS tipo, start_epoch AS publicado_em,
        array_to_string(list_filter([{strip_sql('url')}, {strip_sql('html')}],
            lambda x: x <> ''), ' ') AS texto, spend
    FROM ads"""


def norm_comments(t):
    return normalize.yt_comments(resolve.comment_channel(t.comments(), t.videos().select(
        "videoId", "channelId")))


@query("normalize.reddit", "SELECT * FROM norm_reddit")
def norm_reddit(t):
    return shown(normalize.reddit(t.raw_reddit()))


@query("normalize.yt_videos", "SELECT * FROM norm_videos")
def norm_videos(t):
    return shown(normalize.yt_videos(t.videos()))


@query("normalize.yt_comments", "SELECT * FROM norm_comments")
def norm_yt_comments(t):
    return shown(norm_comments(t))


@query("normalize.ads", """
    SELECT n.fonte, n.canal, n.termo_busca, n.id_nativo, n.tipo, n.publicado_em, n.texto,
        p.page_id % 100 AS menor, '<null>' AS impressions,
        CASE WHEN p.page_id % 4 <> 0 THEN 'Página ' || (p.page_id % 6) ELSE '<null>' END AS page_name,
        '<null>' AS fim, p.url || ',' AS titulos, 'facebook,instagram' AS plataformas
    FROM norm_ads n JOIN pages p ON n.id_nativo = 'a' || p.page_id""")
def norm_ads(t):
    docs = normalize.ads(t.ads())
    text = lambda name: F.coalesce(
        F.get_json_object("metadados", f"$.{name}"), F.lit("<null>"))
    listed = lambda name: F.array_join(F.from_json(F.get_json_object(
        "metadados", f"$.{name}"), "array<string>"), ",")
    return docs.select(
        "fonte", "canal", "termo_busca", "id_nativo", "tipo", seconds("publicado_em"), "texto",
        F.get_json_object("metadados", "$.spend.lower").cast("bigint").alias("menor"),
        text("impressions").alias("impressions"), text("page_name").alias("page_name"),
        text("ad_delivery_stop_time").alias("fim"), listed("ad_creative_link_titles").alias("titulos"),
        listed("publisher_platforms").alias("plataformas"))


@query("normalize.select_sources", """
    SELECT fonte, tipo, count(*) AS documentos FROM (
        SELECT fonte, tipo FROM norm_reddit UNION ALL SELECT fonte, tipo FROM norm_videos
        UNION ALL SELECT fonte, tipo FROM norm_comments) GROUP BY fonte, tipo""")
def select_sources(t):
    """Ads are loaded too, but own no target here and so drop out."""
    frames = {"reddit": [normalize.reddit(t.raw_reddit())],
              "youtube": [normalize.yt_videos(t.videos()), norm_comments(t)],
              "meta": [normalize.ads(t.ads())]}
    forum = t.alvo()
    alvo = forum.unionByName(forum.withColumn("fonte_codigo", F.lit("youtube")))
    docs = normalize.select_sources(frames, dims.load_sources(t.spark), alvo)
    return docs.groupBy("fonte", "tipo").agg(F.count("*").alias("documentos"))


@query("normalize.flatten_threads", """
    SELECT 'c' || conv_id || '_' || turn AS commentId, 'v' || conv_id AS videoId, text,
        CASE WHEN turn % 2 = 0 THEN turn ELSE 0 END AS likeCount, turn AS replyCount,
        CASE WHEN turn % 3 = 0 THEN 'u' || conv_id ELSE '<null>' END AS authorChannelId,
        'Ana Lima' AS _entidade_busca FROM conversations""")
def flatten_threads(t):
    c, turn = F.col("conv_id").cast("string"), F.col("turn")
    top = F.struct(
        F.col("text").alias("textOriginal"),
        F.when(turn % 2 == 0, turn.cast("string")).alias("likeCount"),
        F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        F.when(turn % 3 == 0, F.struct(F.concat(F.lit("u"), c).alias("value"))).alias(
            "authorChannelId"))
    items = t.conversations.select(
        F.concat(F.lit("c"), c, F.lit("_"), turn.cast("string")).alias("id"),
        F.struct(F.concat(F.lit("v"), c).alias("videoId"),
                 turn.cast("string").alias("totalReplyCount"),
                 F.struct(top.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    return normalize.flatten_threads(items, "Ana Lima").withColumn(
        "authorChannelId", filled("authorChannelId")).drop("publishedAt")


@query("normalize.flatten_videos", """
    SELECT 'v' || page_id AS videoId, 'UC' || (page_id % 9) AS channelId,
        url || ',' || url AS tags, 'PT' || (page_id % 60) || CASE WHEN page_id % 2 = 0 THEN 'S'
        ELSE 'M' END AS duration, page_id % 2 = 0 AS is_short, page_id AS viewCount,
        0 AS likeCount, html AS description FROM pages""")
def flatten_videos(t):
    p = F.col("page_id")
    null = F.lit(None).cast("string")
    items = t.pages.select(
        F.concat(F.lit("v"), p.cast("string")).alias("id"),
        F.struct(F.concat(F.lit("UC"), (p % 9).cast("string")).alias("channelId"),
                 null.alias("channelTitle"), null.alias("publishedAt"), null.alias("title"),
                 F.col("html").alias("description"), F.array("url", "url").alias("tags"),
                 null.alias("categoryId")).alias("snippet"),
        F.struct(p.cast("string").alias("viewCount"), null.alias("likeCount"),
                 null.alias("commentCount")).alias("statistics"),
        F.struct(F.concat(F.lit("PT"), (p % 60).cast("string"), F.when(p % 2 == 0, "S").otherwise(
            "M")).alias("duration")).alias("contentDetails"))
    return normalize.flatten_videos(items, "Ana Lima").select(
        "videoId", "channelId", "tags", "duration", "is_short", "viewCount", "likeCount",
        "description")


@query("normalize.stamp_search", """
    SELECT event_id, 'brasil' AS _subreddit_busca, 'Ana Lima' AS _termo_busca FROM events""")
def stamp_search(t):
    return normalize.stamp_search(t.events.select("event_id"), _subreddit_busca="brasil",
                                  _termo_busca="Ana Lima")


# --- joins ------------------------------------------------------------------------------------


@query("resolve.targets", """
    SELECT a.id AS alvo_coleta_id, n.id_nativo, n.tipo, n.texto, n.publicado_em
    FROM norm_reddit n JOIN alvo a ON a.canal = n.canal AND a.termo_busca = n.termo_busca""")
def targets(t):
    docs = resolve.targets(normalize.reddit(t.raw_reddit()), resolve.assert_unique(t.alvo()))
    return docs.select("alvo_coleta_id", "id_nativo", "tipo", filled("texto"),
                       seconds("publicado_em"))


@query("resolve.rejects", """
    SELECT n.canal, n.termo_busca, n.id_nativo FROM norm_reddit n
    WHERE NOT EXISTS (SELECT 1 FROM alvo a WHERE a.canal = n.canal
                      AND a.termo_busca = n.termo_busca)""")
def rejects(t):
    return resolve.rejects(normalize.reddit(t.raw_reddit()), t.alvo()).select(
        "canal", "termo_busca", "id_nativo")


@query("resolve.ambiguous", """
    SELECT 'reddit' AS fonte, canal, '' AS termo_busca, min(id) AS primeiro, max(id) AS ultimo
    FROM alvo GROUP BY canal HAVING min(id) <> max(id)""")
def ambiguous(t):
    return resolve.ambiguous(t.alvo().withColumn("termo_busca", F.lit("")))


@query("resolve.comment_channel", """
    SELECT c.commentId, coalesce(v.channelId, '<null>') AS channelId
    FROM comments c LEFT JOIN videos v USING (videoId)""")
def comment_channel(t):
    return resolve.comment_channel(t.comments(), t.videos()).select("commentId",
                                                                    filled("channelId"))


@query("resolve.comment_title", """
    SELECT c.commentId, coalesce(nullif(v.channelTitle, ''), nullif(v._entidade_busca, ''),
        nullif(c.channelTitle, ''), '') AS termo FROM comments c LEFT JOIN videos v USING (videoId)
    """)
def comment_title(t):
    return resolve.comment_title(t.comments(), t.videos()).select("commentId", "termo")


@query("resolve.with_fallback", """
    SELECT d.doc_id, coalesce(a.id, -1) AS alvo_coleta_id FROM raw_reddit d LEFT JOIN alvo a
    ON a.canal = d._subreddit_busca AND a.termo_busca = d._termo_busca""")
def with_fallback(t):
    """Channels are written with and without the prefix 'r/' and with outer blanks."""
    written = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit(" r/"), "_subreddit_busca"))
    docs = t.raw_reddit().withColumns({
        "fonte": F.lit("reddit"), "canal": F.coalesce(written, "_subreddit_busca"),
        "termo_busca": F.concat("_termo_busca", F.lit(" "))})
    return resolve.with_fallback(docs, t.alvo()).select(
        "doc_id", F.coalesce("alvo_coleta_id", F.lit(-1)).alias("alvo_coleta_id"))


@query("resolve.channel", """
    WITH canais AS (SELECT channelId, max(channelTitle) AS nome FROM videos GROUP BY channelId)
    SELECT v.videoId, CASE WHEN c.channelId IS NULL THEN v.pedido ELSE coalesce(c.nome, '') END AS
        nome, coalesce(c.channelId, v.pedido) AS channel_id
    FROM (SELECT *, CASE conv_id % 3 WHEN 0 THEN lower(channelId) WHEN 1 THEN
              coalesce(upper(channelTitle), '?') ELSE 'outro' END AS pedido FROM videos) v
    LEFT JOIN canais c ON lower(c.channelId) = lower(v.pedido) OR lower(c.nome) = lower(v.pedido)
    """)
def channel(t):
    videos = t.videos()
    number = F.substring("channelId", 3, 9).cast("int")
    channels = videos.groupBy("channelId").agg(F.max("channelTitle").alias("nome")).select(
        number.alias("posicao"), "nome", F.col("channelId").alias("channel_id"))
    asked = (F.when(F.col("conv_id") % 3 == 0, F.lower("channelId"))
             .when(F.col("conv_id") % 3 == 1, F.coalesce(F.upper("channelTitle"), F.lit("?")))
             .otherwise("outro"))
    requests = videos.select("videoId", asked.alias("pedido"))
    return resolve.channel(requests, channels).select("videoId", "nome", "channel_id")


@query("resolve.of_entity", """
    SELECT a.entidade_codigo, a.fonte_codigo, d.id FROM documento d JOIN alvo a
    ON d.alvo_coleta_id = a.id""")
def of_entity(t):
    docs = t.documento().drop("fonte_codigo", "entidade_codigo")
    return resolve.of_entity(docs, t.alvo()).select("entidade_codigo", "fonte_codigo", "id")


@query("resolve.loaded_keys", """
    SELECT DISTINCT a.fonte_codigo AS fonte, d.alvo_coleta_id, d.id_nativo
    FROM documento d JOIN alvo a ON d.alvo_coleta_id = a.id""")
def loaded_keys(t):
    return resolve.loaded_keys(t.documento(), t.alvo())


CTE["legacy_docs"] = f"""
    SELECT {ALVO_ID_SQL} AS alvo_coleta_id, 'd' || (n_chars % 60) AS id_nativo,
        min(doc_id) AS id FROM documents GROUP BY 1, 2"""
CTE["moves"] = """
    SELECT id AS alvo_coleta_id, coalesce(max(CASE WHEN entidade_codigo = 'ana_lima' THEN id END)
        OVER (PARTITION BY canal), min(id) OVER (PARTITION BY canal)) AS canonico FROM alvo"""


def legacy(t):
    """Documents of targets that all belong to one channel, with colliding native ids."""
    docs = t.documento().groupBy(
        "alvo_coleta_id", F.concat(F.lit("d"), (F.col("n_chars") % 60).cast("string")).alias(
            "id_nativo")).agg(F.min("id").alias("id"))
    alvo = t.alvo()
    identities = alvo.select("fonte_codigo", "canal", F.lit("ana_lima").alias(
        "entidade_codigo")).distinct()
    return docs, alvo, resolve.canonical_targets(alvo, identities)


@query("reconcile.merge_target_documents", """
    SELECT alvo_coleta_id, id_nativo, id FROM (
        SELECT coalesce(m.canonico, d.alvo_coleta_id) AS alvo_coleta_id, d.id_nativo, d.id,
            row_number() OVER (PARTITION BY coalesce(m.canonico, d.alvo_coleta_id), d.id_nativo
                ORDER BY coalesce(m.canonico <> d.alvo_coleta_id, FALSE), d.alvo_coleta_id) AS rn
        FROM legacy_docs d LEFT JOIN moves m USING (alvo_coleta_id)) WHERE rn = 1""")
def merge_target_documents(t):
    docs, _, moves = legacy(t)
    return resolve.merge_target_documents(docs, moves)


@query("reconcile.merge_targets", """
    SELECT DISTINCT a.id, a.canal, 'ana_lima' AS entidade_codigo FROM alvo a
    JOIN moves m ON a.id = m.canonico""")
def merge_targets(t):
    _, alvo, moves = legacy(t)
    return resolve.merge_targets(alvo, moves).select("id", "canal", "entidade_codigo")


# --- dimensions -------------------------------------------------------------------------------


@query("dims.entities", f"""
    SELECT {slugify_sql('p_brand')} AS codigo, arg_min(p_brand, p_partkey) AS nome_exibicao,
        arg_max(p_name, p_partkey) AS page_id FROM part GROUP BY 1""")
def entities(t):
    return dims.entities(t.part.select(
        F.col("p_partkey").alias("posicao"), F.col("p_brand").alias("nome"),
        F.col("p_name").alias("page_id")))


@query("dims.expand_targets", f"""
    SELECT DISTINCT {TERM_SLUG_SQL.replace('lang', 'l.lang')} AS entidade_codigo,
        'reddit' AS fonte_codigo, s.source AS canal, {TERM_SQL.replace('lang', 'l.lang')}
        AS termo_busca, 'consulta' AS tipo
    FROM (SELECT DISTINCT source FROM documents) s, (SELECT DISTINCT lang FROM documents) l
    WHERE l.lang < 'fr'""")
def expand_targets(t):
    """Channels with and without 'r/' times terms; one term is no registered entity."""
    plain = t.documents.select(F.col("source").alias("canal")).distinct()
    channels = plain.unionByName(plain.select(F.concat(F.lit("r/"), "canal").alias("canal")))
    terms = t.documents.select(term_of("lang").alias("termo_busca")).distinct()
    pairs = dims.channel_terms(channels.withColumn("rotulo", F.lit(None).cast("string")), terms)
    registered = t.entidade().where(F.col("nome_exibicao") != TERMS["fr"])
    return dims.expand_targets(pairs, registered, "reddit").select(
        "entidade_codigo", "fonte_codigo", "canal", "termo_busca", "tipo")


@query("dims.profile_targets", f"""
    SELECT {slugify_sql('s_name')} AS entidade_codigo, 'meta' AS fonte_codigo,
        CAST(s_suppkey AS VARCHAR) AS canal, '' AS termo_busca, 'handle' AS tipo FROM supplier""")
def profile_targets(t):
    profiles = t.supplier.select(F.col("s_suppkey").alias("posicao"), F.col("s_name").alias("nome"),
                                 F.col("s_suppkey").cast("string").alias("page_id"))
    return dims.profile_targets(dims.entities(profiles)).select(
        "entidade_codigo", "fonte_codigo", "canal", "termo_busca", "tipo")


@query("dims.deactivate", """
    SELECT n_name AS codigo, n_name IN (SELECT n_name FROM nation JOIN region ON n_regionkey =
        r_regionkey WHERE r_name < 'B') OR n_nationkey IN (SELECT s_nationkey FROM supplier)
        AS ativa FROM nation""")
def deactivate(t):
    entity = t.nation.select(F.col("n_name").alias("codigo"), F.lit(True).alias("ativa"))
    near = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    listed = near.where("r_name < 'B'").select(F.col("n_name").alias("codigo"))
    alvo = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("entidade_codigo"))
    return dims.deactivate(entity, listed, alvo)


@query("dims.registered_only", """
    SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (
        SELECT s_nationkey FROM supplier WHERE s_acctbal > 0)""")
def registered_only(t):
    dim = t.supplier.where("s_acctbal > 0").select(F.col("s_nationkey").alias("codigo")).distinct()
    return dims.registered_only(t.customer.select("c_custkey", "c_nationkey"), dim, "c_nationkey")


@query("dims.codes", "SELECT DISTINCT source AS codigo FROM documents ORDER BY 1")
def codes(t):
    return dims.codes(t.documents.select(F.col("source").alias("codigo")), "codigo")


@query("dims.check_enum", """
    SELECT event_type, event_type IN ('click', 'view', 'purchase') AS valido, count(*) AS eventos
    FROM events GROUP BY 1, 2""")
def check_enum(t):
    good, bad = dims.check_enum(t.events, "event_type", ["click", "view", "purchase"])
    return good.withColumn("valido", F.lit(True)).unionByName(
        bad.withColumn("valido", F.lit(False))).groupBy("event_type", "valido").agg(
        F.count("*").alias("eventos"))


@query("dims.first_listed", """
    SELECT l_orderkey, min(l_partkey * 10 + l_linenumber) AS posicao FROM lineitem
    GROUP BY l_orderkey""")
def first_listed(t):
    rows = t.lineitem.select("l_orderkey", (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias(
        "posicao"))
    return dims.first_listed(rows, "l_orderkey", "posicao")


@query("dims.modelled_type", """
    SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'anuncio' WHEN 1 THEN 'post' WHEN 2 THEN
        'comentario' ELSE '<null>' END AS tipo FROM nation""")
def modelled_type(t):
    named = (F.when(F.col("n_regionkey") == 0, "meta").when(F.col("n_regionkey") == 1, "reddit")
             .when(F.col("n_regionkey") == 2, "youtube").otherwise("outra"))
    return t.nation.withColumn("fonte_codigo", named).select(
        "n_nationkey", F.coalesce(incremental.modelled_type(), F.lit("<null>")).alias("tipo"))


# --- keyed writes -----------------------------------------------------------------------------

ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
ITEM_ORDER_SQL = ", ".join(ITEM_ORDER)
CTE["first_item"] = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ITEM_ORDER_SQL})
        AS rn FROM lineitem) WHERE rn = 1"""


def stored_orders(t):
    """Finished orders as what is stored, line items as what comes in."""
    target = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("chave"), F.col("o_totalprice").alias("valor"),
        F.col("o_orderpriority").alias("metadados"))
    incoming = t.lineitem.withColumns({
        "chave": F.col("l_orderkey"), "valor": F.col("l_extendedprice"),
        "metadados": F.col("l_returnflag")})
    return target, incoming


@query("upsert.insert_ignore", """
    SELECT o_orderkey AS chave, o_totalprice AS valor, o_orderpriority AS metadados FROM orders
    WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT l_orderkey, l_extendedprice, l_returnflag FROM first_item WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def insert_ignore(t):
    target, incoming = stored_orders(t)
    return upsert.insert_ignore(target, incoming, ["chave"], ITEM_ORDER)


@query("upsert.insert_counts", """
    WITH novos AS (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
    SELECT n AS inseridos, (SELECT count(*) FROM lineitem) - n AS duplicados FROM novos""")
def insert_counts(t):
    target, incoming = stored_orders(t)
    return upsert.insert_counts(target, incoming, ["chave"])


CTE["rows_in"] = f"""
    SELECT id, _tipo_documento, _termo_busca, doc_id AS ordem FROM raw_reddit WHERE id IS NOT NULL
    UNION ALL
    SELECT id, _tipo_documento, 'Ana Lima', doc_id + 1000000000 FROM raw_reddit
    WHERE id IS NOT NULL"""


@query("upsert.insert_ignore_composite", """
    SELECT id, _tipo_documento, _termo_busca, min(ordem) AS ordem FROM rows_in
    GROUP BY id, _tipo_documento, _termo_busca""")
def insert_ignore_composite(t):
    """A post found under two terms is stored once per term."""
    raw = t.raw_reddit().where(F.col("id").isNotNull())
    key = ["id", "_tipo_documento", "_termo_busca"]
    stored = raw.where(F.col("_tipo_documento") == "post").select(*key, F.col("doc_id").alias(
        "ordem"))
    again = raw.select("id", "_tipo_documento", F.lit("Ana Lima").alias("_termo_busca"),
                       (F.col("doc_id") + 1000000000).alias("ordem"))
    incoming = raw.select(*key, F.col("doc_id").alias("ordem")).unionByName(again)
    return upsert.insert_ignore(stored, incoming, key, ["ordem"])


@query("upsert.update_cols", """
    SELECT coalesce(o_orderkey, l_orderkey) AS chave,
        CASE WHEN o_orderkey IS NOT NULL THEN o_totalprice ELSE l_extendedprice END AS valor,
        CASE WHEN l_orderkey IS NOT NULL THEN l_returnflag ELSE o_orderpriority END AS metadados
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') o
    FULL JOIN first_item i ON o.o_orderkey = i.l_orderkey""")
def update_cols(t):
    target, incoming = stored_orders(t)
    return upsert.update_cols(target, incoming, ["chave"], ["metadados"], ITEM_ORDER)


@query("upsert.update_all_cols", """
    SELECT coalesce(o_orderkey, l_orderkey) AS chave,
        CASE WHEN l_orderkey IS NOT NULL THEN l_extendedprice ELSE o_totalprice END AS valor,
        CASE WHEN l_orderkey IS NOT NULL THEN coalesce(nullif(l_returnflag, 'N'), '<null>')
             ELSE o_orderpriority END AS metadados
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') o
    FULL JOIN first_item i ON o.o_orderkey = i.l_orderkey""")
def update_all_cols(t):
    """Every column follows the incoming row, a null as well."""
    target, incoming = stored_orders(t)
    incoming = incoming.withColumn("metadados", F.nullif("metadados", F.lit("N")))
    return upsert.update_cols(target, incoming, ["chave"], ["valor", "metadados"],
                              ITEM_ORDER).withColumn("metadados", filled("metadados"))


@query("upsert.guarded", """
    WITH novo AS (SELECT l_partkey, 'r' || max(l_returnflag) AS rotulo, max(l_linestatus) AS
        descricao, count(*) AS tamanho, ['peça', max(l_linestatus)] AS palavras
        FROM lineitem GROUP BY l_partkey),
    velho AS (SELECT * FROM part WHERE p_size > 10)
    SELECT CAST(coalesce(p_partkey, l_partkey) AS INT) AS numero,
        CASE WHEN l_partkey IS NULL OR (p_partkey IS NOT NULL AND p_size > 25) THEN p_type
             ELSE rotulo END AS rotulo,
        CASE WHEN l_partkey IS NULL OR (p_partkey IS NOT NULL AND p_size > 25) THEN p_brand
             ELSE descricao END AS descricao,
        CASE WHEN l_partkey IS NULL THEN CAST(p_size AS BIGINT) ELSE tamanho END AS tamanho,
        array_to_string(CASE WHEN l_partkey IS NULL THEN string_split(p_name, ' ') ELSE palavras
            END, ' ') AS palavras
    FROM velho FULL JOIN novo ON p_partkey = l_partkey""")
def guarded(t):
    """Reviewed labels stay, words and sizes follow the last run."""
    target = t.part.where("p_size > 10").select(
        F.lit(1).cast("bigint").alias("modelo_id"), F.col("p_partkey").cast("int").alias("numero"),
        F.col("p_type").alias("rotulo"), (F.col("p_size") > 25).alias("revisado"),
        F.split("p_name", " ").alias("palavras_chave"), F.col("p_size").cast("bigint").alias(
            "tamanho"), F.col("p_brand").alias("descricao"))
    incoming = t.lineitem.groupBy(F.col("l_partkey").cast("int").alias("numero")).agg(
        F.concat(F.lit("r"), F.max("l_returnflag")).alias("rotulo"),
        F.max("l_linestatus").alias("descricao"), F.count("*").alias("tamanho"),
        F.array(F.lit("peça"), F.max("l_linestatus")).alias("palavras_chave"),
    ).withColumns({"modelo_id": F.lit(1).cast("bigint"), "revisado": F.lit(False)})
    return upsert.upsert_topics(target, incoming).select(
        "numero", "rotulo", "descricao", "tamanho",
        F.array_join("palavras_chave", " ").alias("palavras"))


@query("upsert.merge_fields", """
    WITH alvo_u AS (SELECT user_id, arg_max(value, event_id) AS value, arg_max(props, event_id) AS
        props FROM events WHERE event_type = 'signup' GROUP BY user_id),
    novo AS (SELECT user_id,
        arg_max(struct_pack(v := CASE WHEN event_type = 'error' THEN NULL ELSE value END), event_id)
            FILTER (event_type IN ('purchase', 'error')) AS value,
        arg_max(struct_pack(v := props), event_id) FILTER (event_type IN ('click', 'error')) AS props
        FROM events WHERE event_type <> 'signup' GROUP BY user_id)
    SELECT coalesce(a.user_id, n.user_id) AS user_id,
        coalesce(CASE WHEN n.value IS NOT NULL THEN n.value.v ELSE a.value END, -1.0) AS value,
        coalesce(CASE WHEN n.props IS NOT NULL THEN n.props.v ELSE a.props END, '<null>') AS props
    FROM alvo_u a FULL JOIN novo n ON a.user_id = n.user_id""")
def merge_fields(t):
    """Purchases hold a value, clicks hold properties, errors hold both with a null value."""
    kind = F.col("event_type")
    stored = first_per_key(t.events.where(kind == "signup"), ["user_id"], [F.desc("event_id")])
    held = (F.when(kind == "purchase", F.array(F.lit("value")))
            .when(kind == "click", F.array(F.lit("props")))
            .when(kind == "error", F.array(F.lit("value"), F.lit("props")))
            .otherwise(F.array().cast("array<string>")))
    incoming = t.events.where(kind != "signup").withColumns({
        "campos": held, "value": F.when(kind != "error", F.col("value"))})
    merged = upsert.merge_fields(stored.select("user_id", "value", "props"), incoming,
                                 ["user_id"], ["event_id"], "campos")
    return merged.select("user_id", F.coalesce("value", F.lit(-1.0)).alias("value"),
                         filled("props"))


@query("upsert.merge_counts", """
    SELECT count(*) FILTER (o_orderkey IS NULL) AS inseridos,
        count(*) FILTER (o_orderkey IS NOT NULL) AS atualizados
    FROM (SELECT DISTINCT l_orderkey FROM lineitem) i
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o.o_orderkey = i.l_orderkey""")
def merge_counts(t):
    target, incoming = stored_orders(t)
    return upsert.merge_counts(target, incoming, ["chave"])


CTE["topic_rows"] = """
    SELECT CAST(7 AS BIGINT) AS modelo_id, numero, CAST(100 + numero AS BIGINT) AS id
    FROM topic_docs WHERE numero <> -1 GROUP BY numero"""


def topic_rows(t):
    return t.topic_docs().where("numero <> -1").select(
        F.lit(7).cast("bigint").alias("modelo_id"), "numero",
        (F.col("numero") + 100).cast("bigint").alias("id")).distinct()


def assignments(t):
    return t.topic_docs().select(
        F.lit(7).cast("bigint").alias("modelo_id"), "numero",
        F.concat(F.lit("d"), F.col("vec_id").cast("string")).alias("id_nativo"))


@query("models.bridge", """
    SELECT d.id AS documento_id, t.id AS topico_id FROM topic_docs a
    JOIN documento d ON d.id_nativo = 'd' || a.vec_id JOIN topic_rows t USING (numero)""")
def bridge(t):
    return models.bridge(assignments(t), t.documento().select("id", "id_nativo"), topic_rows(t))


@query("models.unbridged", """
    SELECT count(*) FILTER (d.id IS NULL OR t.id IS NULL) AS faltando FROM topic_docs a
    LEFT JOIN documento d ON d.id_nativo = 'd' || a.vec_id LEFT JOIN topic_rows t USING (numero)""")
def unbridged(t):
    return models.unbridged(assignments(t), t.documento().select("id", "id_nativo"), topic_rows(t))


@query("models.insert_bridge", """
    SELECT d.id AS documento_id, t.id AS topico_id FROM topic_docs a
    JOIN documento d ON d.id_nativo = 'd' || a.vec_id JOIN topic_rows t USING (numero)
    UNION SELECT doc_id, CAST(100 AS BIGINT) FROM labels""")
def insert_bridge(t):
    """Stored pairs win, new pairs are added."""
    stored = t.labels.select(F.col("doc_id").alias("documento_id"),
                             F.lit(100).cast("bigint").alias("topico_id"))
    key = ["documento_id", "topico_id"]
    return upsert.insert_ignore(stored, bridge(t), key, key)


def runs(t):
    pairs = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    return pairs.select(
        F.col("source").alias("fonte_codigo"), X.slugify(term_of("lang")).alias("entidade_codigo"),
        F.when(F.col("lang") == "en", 15).otherwise(10).alias("k"),
        F.when(F.col("n") > 8, "qwen3_0_6b").otherwise("minilm_l12").alias("encoder"),
        F.timestamp_seconds(F.lit(T0) + F.col("n")).alias("treinado_em"),
        F.to_json(F.struct(X.slugify(term_of("lang")).alias("entidade_codigo"))).alias("parametros"),
        F.to_json(F.struct("n")).alias("metricas"), "lang", "n")


def empty_models(t):
    from murmurio.schemas import TABLES
    return t.spark.createDataFrame([], TABLES["modelo"])


@query("models.register", f"""
    SELECT source || '_' || {TERM_SLUG_SQL} || '__' || CASE WHEN count(*) > 8 THEN 'qwen3_0_6b'
        ELSE 'minilm_l12' END AS nome, CASE WHEN lang = 'en' THEN 'k15' ELSE 'k10' END AS versao,
        CASE WHEN lang = 'en' AND count(*) > 8 THEN 'vigente' ELSE 'arquivado' END AS status,
        '{{"n":' || count(*) || '}}' AS metricas
    FROM documents GROUP BY source, lang""")
def register(t):
    """Registered twice: the second run meets its own rows."""
    once = models.register(empty_models(t), runs(t))
    return models.register(once, runs(t)).select("nome", "versao", "status", "metricas")


@query("models.register_windowed", f"""
    SELECT source || '_' || {TERM_SLUG_SQL} || '__minilm_l12__2024-01-01' AS nome,
        'k10' AS versao, 'vigente' AS status, '2024-01-07' AS janela_fim
    FROM documents GROUP BY source, lang""")
def register_windowed(t):
    windowed = runs(t).withColumns({
        "k": F.lit(10), "encoder": F.lit("minilm_l12"), "janela_inicio": F.to_date(F.lit(EPOCH)),
        "janela_fim": F.date_add(F.to_date(F.lit(EPOCH)), 6)})
    return models.register_windowed(empty_models(t), windowed).select(
        "nome", "versao", "status", F.col("janela_fim").cast("string").alias("janela_fim"))


def _start_sql(x):
    return (f"CAST(DATE '{EPOCH}' + CAST(floor((CAST({x} AS DATE) - DATE '{EPOCH}') / 7.0) AS INT)"
            " * 7 AS DATE)")


CTE["model_rows"] = f"""
    SELECT fonte_codigo, entidade_codigo, {_start_sql('publicado_em')} AS janela_inicio,
        CAST(min(id) + 1 AS BIGINT) AS id FROM documento
    GROUP BY 1, 2, 3"""


def model_rows(t):
    from murmurio.functions import temporal as D

    found = t.documento().groupBy(
        "fonte_codigo", "entidade_codigo",
        D.period_start(F.to_date("publicado_em"), 7, EPOCH).alias("janela_inicio"))
    return found.agg((F.min("id") + 1).alias("id")).withColumns({
        "status": F.lit("vigente"),
        "parametros": F.to_json(F.struct("entidade_codigo"))}).drop("entidade_codigo")


@query("models.current", f"""
    SELECT d.id, m.id AS modelo_id, CAST(m.janela_inicio AS VARCHAR) AS janela_inicio
    FROM documento d JOIN model_rows m ON m.entidade_codigo = d.entidade_codigo
    AND m.janela_inicio = {_start_sql('d.coletado_em')} - 7""")
def current(t):
    """Each document goes to the model of the last closed period before its collection."""
    docs = t.documento().select("id", "fonte_codigo", "entidade_codigo", F.to_date(
        "coletado_em").alias("dia"))
    return models.current(docs, model_rows(t), "dia", 7, EPOCH).select(
        "id", "modelo_id", F.col("janela_inicio").cast("string").alias("janela_inicio"))


@query("models.of_entity", """
    SELECT id, CAST(janela_inicio AS VARCHAR) AS janela_inicio FROM model_rows
    WHERE entidade_codigo = 'ana_lima'""")
def models_of_entity(t):
    return models.of_entity(model_rows(t), "ana_lima").select(
        "id", F.col("janela_inicio").cast("string").alias("janela_inicio"))


@query("incremental.pending_sentiment", """
    SELECT id, texto FROM documento d WHERE texto IS NOT NULL AND tipo IN ('comentario', 'resposta')
    AND NOT EXISTS (SELECT 1 FROM sentimento s WHERE s.documento_id = d.id)""")
def pending_sentiment(t):
    return incremental.pending_sentiment(t.documento(), t.sentimento()).select("id", "texto")


@query("incremental.pending_sentiment_day", """
    SELECT id FROM documento d WHERE texto IS NOT NULL AND tipo IN ('comentario', 'resposta')
    AND coletado_em >= TIMESTAMP '2024-01-02' AND coletado_em < TIMESTAMP '2024-01-03'
    AND NOT EXISTS (SELECT 1 FROM sentimento s WHERE s.documento_id = d.id AND modelo_id = 130)""")
def pending_sentiment_day(t):
    return incremental.pending_sentiment(t.documento(), t.sentimento(), "2024-01-02",
                                         model_id=130).select("id")


@query("incremental.pending_topics", """
    SELECT id FROM documento d WHERE texto IS NOT NULL AND tipo = 'post'
    AND NOT EXISTS (SELECT 1 FROM topic_docs a WHERE a.vec_id = d.id AND a.numero <> -1)""")
def pending_topics(t):
    return incremental.pending_topics(t.documento(), bridge(t), topic_rows(t)).select("id")


@query("incremental.pending_topics_of_model", """
    SELECT id, CAST(CASE WHEN lang = 'en' THEN 7 ELSE 8 END AS BIGINT) AS modelo_id
    FROM documento d WHERE texto IS NOT NULL AND tipo = 'post'
    AND NOT EXISTS (SELECT 1 FROM topic_docs a WHERE a.vec_id = d.id AND a.numero <> -1
                    AND d.lang = 'en')""")
def pending_topics_of_model(t):
    docs = t.documento().withColumn("modelo_id", F.when(F.col("lang") == "en", 7).otherwise(8).cast(
        "bigint"))
    return incremental.pending_topics(docs, bridge(t), topic_rows(t), "model").select(
        "id", "modelo_id")


_chain, _source = [], "merged"
for _step, _expr in STEPS:
    _chain.append(f"{_step} AS (SELECT doc_id, {_expr} AS x FROM {_source})")
    _source = _step


@query("incremental.preprocess", f"""
    WITH merged AS (SELECT doc_id, coalesce(title, '') || ' ' || coalesce(selftext, '') || ' '
        || coalesce(body, '') || ' ' AS t FROM raw_reddit WHERE processed_text IS NULL),
    {", ".join(_chain)} SELECT doc_id, x AS processed_text, 1706745600 AS em FROM shortened""")
def preprocess_pending(t):
    """Processed text of the records that lack it; one of the columns does not exist."""
    out = incremental.preprocess_incremental(
        t.raw_reddit(), "doc_id", ["title", "selftext", "body", "inexistente"], STOPWORDS,
        "2024-02-01 00:00:00")
    return out.select("doc_id", "processed_text", F.unix_timestamp("preprocessed_at").alias("em"))


@query("incremental.after_clean", f"""
    SELECT doc_id, body FROM raw_reddit WHERE {strip_sql("regexp_replace(body, '[a-z]', '', 'g')")}
    <> ''""")
def after_clean(t):
    emptied = t.raw_reddit().withColumn("_limpo", F.regexp_replace("body", "[a-z]", ""))
    return incremental.after_clean(emptied, "_limpo").select("doc_id", "body")


@query("dedup.first_per_key", f"""
    SELECT canal, termo_busca, tipo, arg_min(id_nativo, id_mongo || id_nativo) AS id_nativo
    FROM norm_reddit GROUP BY canal, termo_busca, tipo""")
def first_of_key(t):
    docs = normalize.reddit(t.raw_reddit())
    return first_per_key(docs, ["canal", "termo_busca", "tipo"], [
        F.concat("id_mongo", "id_nativo")]).select("canal", "termo_busca", "tipo", "id_nativo")


@query("raw.union_variants", """
    SELECT _termo_busca, _tipo_documento, count(*) AS linhas FROM (
        SELECT _termo_busca, _tipo_documento FROM raw_reddit UNION ALL
        SELECT _termo_busca, 'post' FROM raw_reddit) GROUP BY 1, 2""")
def union_variants(t):
    """Posts and comments found under each spelling of a term, stored under the original term."""
    raw = t.raw_reddit()
    found = raw.withColumn("_variante", F.explode(F.slice(X.term_variants("_termo_busca"), 1, 1)))
    again = raw.withColumns({"_tipo_documento": F.lit("post"), "_variante": F.element_at(
        X.term_variants("_termo_busca"), -1)})
    return found.unionByName(again).groupBy("_termo_busca", "_tipo_documento").agg(
        F.count("*").alias("linhas"))


@query("incremental.unprocessed", """
    SELECT doc_id, _tipo_documento FROM raw_reddit WHERE processed_text IS NULL""")
def unprocessed(t):
    return incremental.unprocessed(t.raw_reddit()).select("doc_id", "_tipo_documento")
