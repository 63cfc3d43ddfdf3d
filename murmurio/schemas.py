"""Schemas of the raw collections and of the curated tables."""

from __future__ import annotations

RAW = {
    "reddit": """
        _id STRING, id STRING, created_utc STRING, title STRING, selftext STRING, body STRING,
        permalink STRING, score BIGINT, num_comments BIGINT, upvote_ratio DOUBLE,
        total_awards_received BIGINT, controversiality BIGINT, stickied BOOLEAN,
        distinguished STRING, over_18 BOOLEAN, link_flair_text STRING, _subreddit_busca STRING,
        _termo_busca STRING, _tipo_documento STRING, processed_text STRING,
        preprocessed_at TIMESTAMP""",
    "meta": """
        _id STRING, id STRING, page_id STRING, page_name STRING, ad_delivery_start_time STRING,
        ad_delivery_stop_time STRING, ad_creative_bodies ARRAY<STRING>,
        ad_creative_link_titles ARRAY<STRING>, spend STRING, impressions STRING,
        publisher_platforms ARRAY<STRING>, _entidade_busca STRING, processed_text STRING,
        preprocessed_at TIMESTAMP""",
    "youtube_videos": """
        _id STRING, videoId STRING, channelId STRING, channelTitle STRING, publishedAt STRING,
        title STRING, description STRING, tags STRING, categoryId STRING, duration STRING,
        is_short BOOLEAN, viewCount BIGINT, likeCount BIGINT, commentCount BIGINT,
        _entidade_busca STRING, processed_text STRING, preprocessed_at TIMESTAMP""",
    "youtube_comments": """
        _id STRING, commentId STRING, videoId STRING, text STRING, likeCount BIGINT,
        replyCount BIGINT, publishedAt STRING, authorChannelId STRING, channelTitle STRING,
        _entidade_busca STRING, processed_text STRING, preprocessed_at TIMESTAMP""",
}

# Responses of the video platform before they are flattened.
COMMENT_THREAD = """
    id STRING, snippet STRUCT<videoId: STRING, totalReplyCount: STRING, topLevelComment:
    STRUCT<snippet: STRUCT<textOriginal: STRING, likeCount: STRING, publishedAt: STRING,
    authorChannelId: STRUCT<value: STRING>>>>"""
VIDEO_ITEM = """
    id STRING, snippet STRUCT<channelId: STRING, channelTitle: STRING, publishedAt: STRING,
    title: STRING, description: STRING, tags: ARRAY<STRING>, categoryId: STRING>,
    statistics STRUCT<viewCount: STRING, likeCount: STRING, commentCount: STRING>,
    contentDetails STRUCT<duration: STRING>"""

# Key of a raw collection. A post is kept once per search term on purpose.
RAW_KEYS = {
    "reddit": ["id", "_tipo_documento", "_termo_busca"],
    "meta": ["id"],
    "youtube_videos": ["videoId"],
    "youtube_comments": ["commentId"],
}

TABLES = {
    "fonte": "codigo STRING, nome STRING, ativa BOOLEAN",
    "entidade": "codigo STRING, nome_exibicao STRING, partido STRING, foto STRING, ativa BOOLEAN,"
                " criado_em TIMESTAMP",
    "alvo_coleta": "id BIGINT, entidade_codigo STRING, fonte_codigo STRING, canal STRING,"
                   " rotulo STRING, termo_busca STRING, tipo STRING, usar_na_busca BOOLEAN,"
                   " ativo BOOLEAN",
    "alvo_coleta_estado": "alvo_coleta_id BIGINT, tipo_documento STRING, total_documentos BIGINT,"
                          " primeiro_publicado_em TIMESTAMP, ultimo_publicado_em TIMESTAMP",
    "documento": "id BIGINT, alvo_coleta_id BIGINT, id_nativo STRING, id_mongo STRING, tipo STRING,"
                 " url STRING, texto STRING, publicado_em TIMESTAMP, coletado_em TIMESTAMP,"
                 " metadados STRING",
    "modelo": "id BIGINT, tipo STRING, fonte_codigo STRING, nome STRING, versao STRING,"
              " janela_inicio DATE, janela_fim DATE, treinado_em TIMESTAMP, parametros STRING,"
              " metricas STRING, status STRING",
    "topico": "id BIGINT, modelo_id BIGINT, numero INT, rotulo STRING, revisado BOOLEAN,"
              " palavras_chave ARRAY<STRING>, tamanho BIGINT, descricao STRING",
    "sentimento": "documento_id BIGINT, modelo_id BIGINT, polaridade STRING",
    "documento_topico": "documento_id BIGINT, topico_id BIGINT",
    "candidato_hashtag": "fonte_codigo STRING, entidade_codigo STRING, hashtag STRING,"
                         " contagem BIGINT",
}

TABLE_KEYS = {
    "fonte": ["codigo"],
    "entidade": ["codigo"],
    "alvo_coleta": ["entidade_codigo", "fonte_codigo", "canal", "termo_busca"],
    "alvo_coleta_estado": ["alvo_coleta_id", "tipo_documento"],
    "documento": ["alvo_coleta_id", "id_nativo"],
    "modelo": ["tipo", "nome", "versao"],
    "topico": ["modelo_id", "numero"],
    "sentimento": ["documento_id", "modelo_id"],
    "documento_topico": ["documento_id", "topico_id"],
    "candidato_hashtag": ["fonte_codigo", "entidade_codigo", "hashtag"],
}
