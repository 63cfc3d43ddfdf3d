"""Registry, table access and the domain frames derived from the given tables.

Each domain frame exists twice: as a DataFrame (method of ``Tables``) and as the SQL of a common
table expression (``CTE``). ``with_frames`` puts the needed ones in front of a SQL query.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.session import configure, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Invented names that stand for the monitored entities, by language of the document.
TERMS = {"en": "Ana Lima", "de": "Zé Ramos", "es": "Íris Couto", "fr": "Otto Braga"}
T0 = 1704067200  # 2024-01-01 00:00:00 UTC, a Monday
EPOCH = "2024-01-01"


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` as a query, with its SQL twin."""
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_frames(sql)
        return fn

    return register


def with_frames(sql: str) -> str:
    """Prefix the common table expressions a query names, directly or through others."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in CTE:
            if re.search(rf"\b{name}\b", body) and name not in needed:
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    head = ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def term_of(lang):
    lang = F.col(lang) if isinstance(lang, str) else lang
    return F.element_at(F.create_map(*[F.lit(x) for p in TERMS.items() for x in p]), lang)


TERM_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TERMS.items()) + " END"
DECO_SQL = ("concat_ws(' ', text, '#' || source, '#' || lang, '#Eleição' || (n_chars % 97),"
            " '#t' || (n_chars % 31), 'http://ex.org/' || doc_id, '@u' || (doc_id % 7), 'fim')")


class Tables:
    """The given tables and the domain frames derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def texts(self) -> DataFrame:
        """The documents, over all cores, for work on their texts."""
        return spread(self.documents, "doc_id")

    def decorated(self) -> DataFrame:
        """Documents with hashtags, a link and a mention, which the given texts lack."""
        tail = [F.concat(F.lit("#"), "source"), F.concat(F.lit("#"), "lang"),
                F.concat(F.lit("#Eleição"), (F.col("n_chars") % 97).cast("string")),
                F.concat(F.lit("#t"), (F.col("n_chars") % 31).cast("string")),
                F.concat(F.lit("http://ex.org/"), F.col("doc_id").cast("string")),
                F.concat(F.lit("@u"), (F.col("doc_id") % 7).cast("string")), F.lit("fim")]
        return self.texts().withColumn("t", F.concat_ws(" ", "text", *tail))

    def raw_reddit(self) -> DataFrame:
        """Documents as posts and comments of a forum, with the defects raw data has."""
        d, n = F.col("doc_id"), F.col("n_chars")
        post = d % 3 == 0
        stamp = F.lit(T0) + (d * 977) % 2592000
        hex_id = F.concat(F.lower(F.lpad(F.hex(stamp), 8, "0")),
                          F.substring(F.md5(d.cast("string")), 1, 16))
        body = (F.when(n % 29 == 0, "[removed]").when(n % 31 == 0, "[Deleted]")
                .otherwise(F.col("text")))
        return self.texts().select(
            F.when(n % 37 == 0, "sem-id").otherwise(hex_id).alias("_id"),
            F.when(n % 41 != 0, F.concat(F.lit("d"), d.cast("string"))).alias("id"),
            F.when(n % 43 == 0, "ontem").otherwise((F.lit(T0) + (d * 601) % 2592000)
                                                   .cast("string")).alias("created_utc"),
            F.when(post, F.concat_ws(" ", "lang", "source")).alias("title"),
            F.when(post, F.col("text")).alias("selftext"),
            F.when(~post, body).alias("body"),
            F.when(n % 5 != 0, F.concat(F.lit("/r/"), "source", F.lit("/"), d.cast("string")))
            .alias("permalink"),
            (n % 1000).alias("score"),
            F.when(post, n % 17).alias("num_comments"),
            F.when(post, F.round((n % 100) / 100, 2)).alias("upvote_ratio"),
            (n % 3).alias("total_awards_received"),
            F.when(~post, n % 2).alias("controversiality"),
            (n % 7 == 0).alias("stickied"),
            F.lit(None).cast("string").alias("distinguished"),
            F.when(post, n % 13 == 0).alias("over_18"),
            F.when(post & (n % 2 == 0), F.col("lang")).alias("link_flair_text"),
            F.col("source").alias("_subreddit_busca"),
            term_of("lang").alias("_termo_busca"),
            F.when(post, "post").otherwise("comentario").alias("_tipo_documento"),
            F.when(n % 4 != 0, F.lower("text")).alias("processed_text"),
            "doc_id", "lang", "n_chars",
        )

    def entidade(self) -> DataFrame:
        """One entity per language; the first two are registered as active."""
        return self.documents.groupBy("lang").agg(F.max("n_chars").alias("n")).select(
            X.slugify(term_of("lang")).alias("codigo"), term_of("lang").alias("nome_exibicao"),
            F.lit(None).cast("string").alias("partido"), F.lit(None).cast("string").alias("foto"),
            (F.col("lang") < "es").alias("ativa"))

    def alvo(self) -> DataFrame:
        """Targets of the forum: channel x language, some pairs without one."""
        number = F.substring("source", 4, 9).cast("int")
        lang = F.expr(
            "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END")
        pairs = self.documents.select("source", "lang").distinct()
        known = pairs.where(~((F.col("lang") == "es") & F.col("source").startswith("src1")))
        return known.select(
            (number * 10 + lang).cast("bigint").alias("id"),
            X.slugify(term_of("lang")).alias("entidade_codigo"),
            F.lit("reddit").alias("fonte_codigo"), F.col("source").alias("canal"),
            F.lit(None).cast("string").alias("rotulo"), term_of("lang").alias("termo_busca"),
            F.lit("consulta").alias("tipo"), F.lit(True).alias("usar_na_busca"),
            F.lit(True).alias("ativo"))

    def documento(self) -> DataFrame:
        """Loaded documents: the raw ones of registered pairs, in the curated shape."""
        d = F.col("doc_id")
        number = F.substring("source", 4, 9).cast("int")
        lang = F.expr("CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END")
        return self.documents.select(
            d.alias("id"), (number * 10 + lang).cast("bigint").alias("alvo_coleta_id"),
            F.concat(F.lit("d"), d.cast("string")).alias("id_nativo"),
            F.element_at(F.array(F.lit("post"), F.lit("comentario"), F.lit("resposta")),
                         (d % 3 + 1).cast("int")).alias("tipo"),
            F.when(F.col("n_chars") % 19 != 0, F.col("text")).alias("texto"),
            F.timestamp_seconds(F.lit(T0) + (d * 601) % 2592000).alias("publicado_em"),
            F.timestamp_seconds(F.lit(T0) + (d * 977) % 2592000).alias("coletado_em"),
            F.lit("reddit").alias("fonte_codigo"),
            X.slugify(term_of("lang")).alias("entidade_codigo"), "lang", "source", "n_chars")

    def rotulado(self) -> DataFrame:
        """Documents with their class: negative when toxic, else positive or neutral by quality;
        without a label they are pending."""
        klass = (F.when(F.col("toxic").isNull(), "PENDENTE").when(F.col("toxic") == 1, "Negativo")
                 .when(F.col("quality") == 1, "Positivo").otherwise("Neutro"))
        return self.documents.join(self.labels, "doc_id", "left").select(
            "doc_id", F.col("text").alias("texto"), klass.alias("classificacao"))

    def sentimento(self) -> DataFrame:
        """Scores: the labelled documents under model 130."""
        from murmurio.operators import sentiment as S
        settled = S.drop_pending(self.rotulado())
        return settled.select(
            F.col("doc_id").alias("documento_id"), F.lit(130).cast("bigint").alias("modelo_id"),
            S.decode_polarity(S.encode_label("classificacao")).alias("polaridade"))

    def videos(self) -> DataFrame:
        """First turn of each conversation as a video; conversations opened by a system turn have
        no video."""
        c = F.col("conv_id")
        first = self.conversations.where((F.col("turn") == 0) & (F.col("role") != "system"))
        return first.select(
            F.concat(F.lit("5f"), F.lpad(F.hex(c), 22, "0")).alias("_id"),
            F.concat(F.lit("v"), c.cast("string")).alias("videoId"),
            F.concat(F.lit("UC"), (c % 9).cast("string")).alias("channelId"),
            F.when(c % 4 != 0, F.concat(F.lit("Canal "), (c % 9).cast("string")))
            .alias("channelTitle"),
            F.date_format(F.timestamp_seconds(F.lit(T0) + c * 3600),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.concat(F.lit(" Conversa "), c.cast("string")).alias("title"),
            F.col("text").alias("description"),
            F.lit(None).cast("string").alias("tags"), (c % 5).cast("string").alias("categoryId"),
            F.concat(F.lit("PT"), F.when(c % 3 == 0, F.lit("")).otherwise(F.lit("4M")),
                     (c % 60).cast("string"), F.lit("S")).alias("duration"),
            (c * 10).alias("viewCount"), c.alias("likeCount"), (c % 8).alias("commentCount"),
            self._conv_term().alias("_entidade_busca"), F.col("conv_id"))

    def _conv_term(self):
        return F.element_at(F.array(*[F.lit(v) for v in TERMS.values()]),
                            (F.col("conv_id") % 4 + 1).cast("int"))

    def comments(self) -> DataFrame:
        """Later turns of each conversation as comments on its video."""
        c, turn = F.col("conv_id"), F.col("turn")
        later = self.conversations.where(turn > 0)
        return later.select(
            F.concat(F.lit("5e"), F.lpad(F.hex(c * 100 + turn), 22, "0")).alias("_id"),
            F.concat_ws("_", F.concat(F.lit("c"), c.cast("string")), turn.cast("string"))
            .alias("commentId"),
            F.concat(F.lit("v"), c.cast("string")).alias("videoId"), "text",
            turn.alias("likeCount"), (turn % 2).alias("replyCount"),
            F.date_format(F.timestamp_seconds(F.lit(T0) + c * 3600 + turn * 60),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.concat(F.lit("u"), (c % 23).cast("string")).alias("authorChannelId"),
            F.when(turn % 2 == 0, F.lit("Canal próprio")).alias("channelTitle"),
            self._conv_term().alias("_entidade_busca"),
            F.lower("text").alias("processed_text"))

    def ads(self) -> DataFrame:
        """Web pages as ads."""
        p = F.col("page_id")
        day = F.timestamp_seconds(F.lit(T0) + p % 30 * 86400)
        owner = F.concat(F.lit("p"), (p % 6).cast("string"))
        return self.pages.select(
            F.concat(F.lit("5d"), F.lpad(F.hex(p), 22, "0")).alias("_id"),
            F.concat(F.lit("a"), p.cast("string")).alias("id"),
            F.when(p % 10 == 0, "").otherwise(owner).alias("page_id"),
            F.when(p % 4 != 0, F.concat(F.lit("Página "), (p % 6).cast("string")))
            .alias("page_name"),
            F.when(p % 2 == 0, F.date_format(day, "yyyy-MM-dd"))
            .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss+03:00"))
            .alias("ad_delivery_start_time"),
            F.lit(None).cast("string").alias("ad_delivery_stop_time"),
            F.array(F.col("url"), F.lit(" "), F.col("html"), F.lit(None).cast("string"))
            .alias("ad_creative_bodies"),
            F.array(F.col("url"), F.lit("")).alias("ad_creative_link_titles"),
            F.concat(F.lit('{"lower":'), (p % 100).cast("string"), F.lit("}")).alias("spend"),
            F.lit(None).cast("string").alias("impressions"),
            F.array(F.lit("facebook"), F.lit("instagram")).alias("publisher_platforms"),
            owner.alias("_entidade_busca"),
            F.when(p % 5 != 0, F.lower("url")).alias("processed_text"))

    def topic_docs(self) -> DataFrame:
        """Embedded documents; the cluster label is the topic and label 9 the outlier topic."""
        number = F.when(F.col("label") == 9, -1).otherwise(F.col("label")).cast("int")
        return self.embeddings.select("vec_id", "embedding", number.alias("numero"))

    def topic_texts(self) -> DataFrame:
        """All documents with their topic; one without a vector gets a topic by its length."""
        of = self.topic_docs().select(F.col("vec_id").alias("doc_id"), F.col("numero").alias("_n"))
        return self.texts().join(of, "doc_id", "left").select(
            "doc_id", "text", F.coalesce("_n", (F.col("n_chars") % 9).cast("int")).alias("numero"))


S = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NS = S.replace("[", "[^", 1)
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def tokens_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{S}+'), lambda tk: tk <> '')"


def slugify_sql(x: str) -> str:
    ascii_only = rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"
    return f"lower(trim(regexp_replace({ascii_only}, '[^a-zA-Z0-9]+', '_', 'g'), '_'))"


TERM_SLUG_SQL = slugify_sql(TERM_SQL)
ALVO_ID_SQL = ("CAST(CAST(substr(source, 4) AS INT) * 10 + CASE lang WHEN 'de' THEN 0 WHEN 'en' "
               "THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS BIGINT)")
CONV_TERM_SQL = ("CASE conv_id % 4 " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(TERMS.values())) + " END")


def ts_sql(seconds: str) -> str:
    """Epoch seconds as a plain UTC timestamp."""
    return f"make_timestamp(({seconds}) * 1000000)"


CTE = {
    "decorated": f"SELECT *, {DECO_SQL} AS t FROM documents",
    "raw_reddit": f"""
        SELECT CASE WHEN n_chars % 37 = 0 THEN 'sem-id' ELSE
                 lower(lpad(to_hex({T0} + (doc_id * 977) % 2592000), 8, '0'))
                 || substr(md5(CAST(doc_id AS VARCHAR)), 1, 16) END AS _id,
               CASE WHEN n_chars % 41 <> 0 THEN 'd' || doc_id END AS id,
               CASE WHEN n_chars % 43 = 0 THEN 'ontem'
                    ELSE CAST({T0} + (doc_id * 601) % 2592000 AS VARCHAR) END AS created_utc,
               CASE WHEN doc_id % 3 = 0 THEN lang || ' ' || source END AS title,
               CASE WHEN doc_id % 3 = 0 THEN text END AS selftext,
               CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN n_chars % 29 = 0 THEN '[removed]'
                    WHEN n_chars % 31 = 0 THEN '[Deleted]' ELSE text END END AS body,
               CASE WHEN n_chars % 5 <> 0 THEN '/r/' || source || '/' || doc_id END AS permalink,
               n_chars % 1000 AS score,
               source AS _subreddit_busca, {TERM_SQL} AS _termo_busca,
               CASE WHEN doc_id % 3 = 0 THEN 'post' ELSE 'comentario' END AS _tipo_documento,
               CASE WHEN n_chars % 4 <> 0 THEN lower(text) END AS processed_text,
               doc_id, lang, n_chars
        FROM documents""",
    "entidade": f"""
        SELECT {TERM_SLUG_SQL} AS codigo, {TERM_SQL} AS nome_exibicao, lang < 'es' AS ativa
        FROM documents GROUP BY lang""",
    "alvo": f"""
        SELECT DISTINCT {ALVO_ID_SQL} AS id, {TERM_SLUG_SQL} AS entidade_codigo,
               'reddit' AS fonte_codigo, source AS canal, {TERM_SQL} AS termo_busca
        FROM documents WHERE NOT (lang = 'es' AND source LIKE 'src1%')""",
    "documento": f"""
        SELECT doc_id AS id, {ALVO_ID_SQL} AS alvo_coleta_id, 'd' || doc_id AS id_nativo,
               CASE doc_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'comentario' ELSE 'resposta' END
                 AS tipo,
               CASE WHEN n_chars % 19 <> 0 THEN text END AS texto,
               {ts_sql(f"{T0} + (doc_id * 601) % 2592000")} AS publicado_em,
               {ts_sql(f"{T0} + (doc_id * 977) % 2592000")} AS coletado_em,
               'reddit' AS fonte_codigo, {TERM_SLUG_SQL} AS entidade_codigo, lang, source, n_chars
        FROM documents""",
    "rotulado": """
        SELECT d.doc_id, d.text AS texto,
               CASE WHEN l.toxic IS NULL THEN 'PENDENTE' WHEN l.toxic = 1 THEN 'Negativo'
                    WHEN l.quality = 1 THEN 'Positivo' ELSE 'Neutro' END AS classificacao
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "sentimento": """
        SELECT doc_id AS documento_id, CAST(130 AS BIGINT) AS modelo_id,
               CASE classificacao WHEN 'Negativo' THEN 'negativo' WHEN 'Neutro' THEN 'neutro'
                    ELSE 'positivo' END AS polaridade
        FROM rotulado WHERE classificacao <> 'PENDENTE'""",
    "videos": f"""
        SELECT '5f' || lpad(to_hex(conv_id), 22, '0') AS _id, 'v' || conv_id AS videoId,
               'UC' || (conv_id % 9) AS channelId,
               CASE WHEN conv_id % 4 <> 0 THEN 'Canal ' || (conv_id % 9) END AS channelTitle,
               strftime({ts_sql(f"{T0} + conv_id * 3600")}, '%Y-%m-%dT%H:%M:%SZ') AS publishedAt,
               ' Conversa ' || conv_id AS title, text AS description,
               'PT' || CASE WHEN conv_id % 3 = 0 THEN '' ELSE '4M' END || (conv_id % 60) || 'S'
                 AS duration,
               conv_id * 10 AS viewCount, conv_id AS likeCount, conv_id % 8 AS commentCount,
               CAST(conv_id % 5 AS VARCHAR) AS categoryId,
               {CONV_TERM_SQL} AS _entidade_busca, conv_id
        FROM conversations WHERE turn = 0 AND role <> 'system'""",
    "comments": f"""
        SELECT '5e' || lpad(to_hex(conv_id * 100 + turn), 22, '0') AS _id,
               'c' || conv_id || '_' || turn AS commentId, 'v' || conv_id AS videoId, text,
               turn AS likeCount, turn % 2 AS replyCount,
               strftime({ts_sql(f"{T0} + conv_id * 3600 + turn * 60")}, '%Y-%m-%dT%H:%M:%SZ')
                 AS publishedAt,
               'u' || (conv_id % 23) AS authorChannelId,
               CASE WHEN turn % 2 = 0 THEN 'Canal próprio' END AS channelTitle,
               {CONV_TERM_SQL} AS _entidade_busca, lower(text) AS processed_text
        FROM conversations WHERE turn > 0""",
    "ads": f"""
        SELECT 'a' || page_id AS id,
               CASE WHEN page_id % 10 = 0 THEN '' ELSE 'p' || (page_id % 6) END AS page_id,
               CASE WHEN page_id % 4 <> 0 THEN 'Página ' || (page_id % 6) END AS page_name,
               CASE WHEN page_id % 2 = 0
                    THEN strftime({ts_sql(f"{T0} + page_id % 30 * 86400")}, '%Y-%m-%d')
                    ELSE strftime({ts_sql(f"{T0} + page_id % 30 * 86400")},
                                  '%Y-%m-%dT%H:%M:%S+03:00') END AS ad_delivery_start_time,
               {T0} + page_id % 30 * 86400 - CASE WHEN page_id % 2 = 0 THEN 0 ELSE 10800 END
                 AS start_epoch,
               'p' || (page_id % 6) AS _entidade_busca, url, html,
               CASE WHEN page_id % 5 <> 0 THEN lower(url) END AS processed_text,
               '{{"lower":' || (page_id % 100) || '}}' AS spend
        FROM pages""",
    "topic_docs": """
        SELECT vec_id, embedding, CASE WHEN label = 9 THEN -1 ELSE label END AS numero
        FROM embeddings""",
    "topic_texts": """
        SELECT d.doc_id, d.text, coalesce(t.numero, CAST(d.n_chars % 9 AS INT)) AS numero
        FROM documents d LEFT JOIN topic_docs t ON d.doc_id = t.vec_id
        """,
}
