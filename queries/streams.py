"""Streaming jobs run to completion over the given tables; results are tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.operators import normalize, sentiment, upsert
from murmurio.session import scratch_path
from murmurio.sources import sinks
from murmurio.streaming import incremental as ST

from .base import CTE, EPOCH, T0, query
from .files import EXTRA
from .learning import letter_counts
from .loading import _start_sql, model_rows

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def finish(query_):
    query_.awaitTermination()
    if query_.exception() is not None:
        raise query_.exception()


def in_steps(t, start, parts=4):
    """The events arrive in steps, in time order. Every task writes its part of a step, and one run
    of the job works the step off."""
    path = scratch_path(t.spark, "eventos")
    ts = F.col("ts").cast("timestamp")
    step = F.floor(F.dayofmonth(ts) / (31 / parts)).cast("int")
    for i in range(parts):
        t.events.withColumn("ts", ts).where(step == i).write.mode("append").parquet(path)
        finish(start(ST.read_new(t.spark, path, EVENTS, "parquet")))


def appended_in_steps(t, job, schema):
    out, marks = scratch_path(t.spark, "saida"), scratch_path(t.spark, "marcas")
    cores = t.spark.sparkContext.defaultParallelism
    in_steps(t, lambda stream: ST.append_files(job(stream), out, marks, cores))
    return t.spark.read.schema(schema).parquet(out)


def appended(t, stream, schema):
    out = scratch_path(t.spark, "saida")
    cores = t.spark.sparkContext.defaultParallelism
    finish(ST.append_files(stream, out, scratch_path(t.spark, "marcas"), cores))
    return t.spark.read.schema(schema).parquet(out)


@query("streaming.daily_counts", """
    SELECT strftime(ts, '%Y-%m-%d') AS dia, event_type, count(*) AS documentos FROM events
    GROUP BY 1, 2 HAVING CAST(min(CAST(ts AS DATE)) + 1 AS TIMESTAMP) <=
        (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""")
def daily_counts(t):
    """Closed days only: the last day stays open."""
    out = appended_in_steps(t, lambda s: ST.daily_counts(s, "ts", ["event_type"]),
                            "dia date, event_type string, documentos bigint")
    return out.withColumn("dia", F.col("dia").cast("string"))


@query("streaming.closed_periods", f"""
    SELECT CAST({_start_sql('ts')} AS VARCHAR) AS inicio,
        CAST(CAST({_start_sql('ts')} + 6 AS DATE) AS VARCHAR) AS fim, event_type,
        count(*) AS documentos FROM events GROUP BY 1, 2, 3
    HAVING CAST(min({_start_sql('ts')}) + 7 AS TIMESTAMP) <=
        (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""")
def closed_periods(t):
    out = appended_in_steps(t, lambda s: ST.closed_periods(s, "ts", ["event_type"], 7, EPOCH),
                            "inicio date, fim date, event_type string, documentos bigint")
    return out.withColumns({c: F.col(c).cast("string") for c in ("inicio", "fim")})


@query("streaming.unique_within", "SELECT event_id, event_type FROM events")
def unique_within(t):
    """Every event arrives twice."""
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    return appended_in_steps(t, lambda s: ST.unique_within(
        s.withColumn("_vez", twice), ["event_id"], "ts", "2 days").select("event_id", "event_type"),
        "event_id bigint, event_type string")


@query("streaming.route", f"""
    SELECT e.event_id, m.id AS modelo_id FROM events e JOIN model_rows m
    ON m.entidade_codigo = CASE e.user_id % 4 WHEN 0 THEN 'ana_lima' WHEN 1 THEN 'ze_ramos'
        WHEN 2 THEN 'iris_couto' ELSE 'otto_braga' END
    AND m.janela_inicio = {_start_sql("e.ts - INTERVAL 3 HOUR")} - 7""")
def route(t):
    """Arriving documents -> model of the last closed period."""
    codes = F.array(*[F.lit(c) for c in ("ana_lima", "ze_ramos", "iris_couto", "otto_braga")])
    coded = ["event_id", "ts", F.lit("reddit").alias("fonte_codigo"),
             F.element_at(codes, (F.col("user_id") % 4 + 1).cast("int")).alias("entidade_codigo")]
    return appended_in_steps(t, lambda s: ST.route(s.select(*coded), model_rows(t), "ts", 7, EPOCH).select(
        "event_id", "modelo_id"), "event_id bigint, modelo_id bigint")


COMMENTS = "commentId string, videoId string, text string"


@query("streaming.enrich_comments", """
    SELECT c.commentId, coalesce(v.channelId, '<null>') AS channelId
    FROM comments c LEFT JOIN videos v USING (videoId)""")
def enrich_comments(t):
    """Comments and videos arrive in two halves; the second run sees the videos that came between."""
    inbox, table, root, marks = (scratch_path(t.spark, x) for x in ("comentarios", "videos", "canais", "marcas"))
    half = F.pmod(F.xxhash64("videoId"), F.lit(2))
    for i in range(2):
        t.videos().where(half == i).select("videoId", "channelId").write.mode("append").parquet(table)
        t.comments().where(half == i).select("commentId", "videoId", "text").write.mode("append").json(inbox)
        read = lambda: t.spark.read.schema("videoId string, channelId string").parquet(table)
        finish(ST.run_batches(ST.read_new(t.spark, inbox, COMMENTS), marks, ST.enrich_into(root, "canais", read)))
    return ST.read_inserted(t.spark, root, "canais", f"{COMMENTS}, channelId string").select(
        "commentId", F.coalesce("channelId", F.lit("<null>")).alias("channelId"))


@query("streaming.ingest", """
    SELECT r.id_nativo, r.tipo, r.publicado_em, r.texto,
        d.n_chars % 1000 + CASE WHEN d.doc_id % 5 = 0 THEN 1 ELSE 0 END AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY canal, termo_busca, id_nativo ORDER BY id_mongo)
            AS rn FROM norm_reddit) r JOIN documents d ON r.id_nativo = 'd' || d.doc_id WHERE rn = 1""")
def ingest(t):
    """New raw files -> documents, each key once, over two runs of the job; the metadata of a known
    document follows its last record."""
    from murmurio.schemas import RAW

    inbox, root, marks = (scratch_path(t.spark, x) for x in ("entrada", "documentos", "marcas"))
    keys = ["fonte", "canal", "termo_busca", "id_nativo"]
    schema = ("fonte string, canal string, termo_busca string, id_nativo string, id_mongo string,"
              " tipo string, url string, texto string, publicado_em timestamp,"
              " coletado_em timestamp, metadados string")
    posts = t.raw_reddit().where("_tipo_documento = 'post'")
    later = t.raw_reddit().withColumn("score", F.col("score") + (F.col("doc_id") % 5 == 0).cast("int"))
    for batch in (posts, later):
        batch.drop(*EXTRA).write.mode("append").json(inbox)
        stream = normalize.reddit(ST.read_new(t.spark, inbox, RAW["reddit"]))
        finish(ST.run_batches(stream, marks, ST.merge_new(root, "documento", schema, keys, ["id_mongo"],
                                                          "metadados")))
    docs = ST.read_latest(t.spark, root, "documento", schema, keys)
    return docs.select("id_nativo", "tipo", F.unix_timestamp("publicado_em").alias("publicado_em"),
                       F.coalesce("texto", F.lit("<null>")).alias("texto"),
                       F.get_json_object("metadados", "$.score").cast("bigint").alias("score"))


@query("streaming.upsert", """
    SELECT user_id, count(*) >= 0 AS existe, arg_max(event_type, event_id) AS ultimo FROM events
    GROUP BY user_id""")
def upsert_state(t):
    """Last event type per user after all batches."""
    root = scratch_path(t.spark, "estado")
    schema = "user_id bigint, ultimo string, existe boolean"
    marks = scratch_path(t.spark, "marcas")
    handle = ST.upsert_into(root, "usuario", schema, ["user_id"], ["ultimo"],
                            [F.desc("event_id")])
    in_steps(t, lambda s: ST.run_batches(s.select(
        "user_id", F.col("event_type").alias("ultimo"), "event_id", F.lit(True).alias("existe")),
        marks, handle))
    return ST.read_state(t.spark, root, "usuario", schema)


@query("streaming.target_state", """
    SELECT user_id AS alvo_coleta_id, event_type AS tipo_documento, count(*) AS total_documentos,
        epoch_us(min(ts)) AS primeiro, epoch_us(max(ts)) AS ultimo FROM events GROUP BY 1, 2""")
def target_state(t):
    root, marks = scratch_path(t.spark, "estado"), scratch_path(t.spark, "marcas")
    cores = t.spark.sparkContext.defaultParallelism
    in_steps(t, lambda s: ST.run_batches(ST.target_state(s.select(
        F.col("user_id").alias("alvo_coleta_id"), F.col("event_type").alias("tipo"), "ts"), "ts"), marks,
        ST.write_whole(root, "alvo_coleta_estado"), "complete", cores))
    state = ST.read_state(t.spark, root, "alvo_coleta_estado",
                          "alvo_coleta_id bigint, tipo_documento string, total_documentos bigint,"
                          " primeiro_publicado_em timestamp, ultimo_publicado_em timestamp")
    return state.select("alvo_coleta_id", "tipo_documento", "total_documentos",
                        F.unix_micros("primeiro_publicado_em").alias("primeiro"),
                        F.unix_micros("ultimo_publicado_em").alias("ultimo"))


@query("streaming.chained_scoring", """
    SELECT commentId AS id, CASE WHEN a >= e AND a >= o THEN 'negativo' WHEN e >= o THEN 'neutro'
        ELSE 'positivo' END AS polaridade FROM (SELECT commentId,
        len(text) - len(replace(text, 'a', '')) AS a, len(text) - len(replace(text, 'e', '')) AS e,
        len(text) - len(replace(text, 'o', '')) AS o FROM comments)""")
def chained_scoring(t):
    """A second job scores what the first one wrote."""
    inbox, loaded = scratch_path(t.spark, "entrada"), scratch_path(t.spark, "carregados")
    t.comments().select("commentId", "videoId", "text").repartition(2).write.json(inbox)
    first = ST.read_new(t.spark, inbox, COMMENTS)
    finish(ST.append_files(first, loaded, scratch_path(t.spark, "marcas")))
    second = ST.read_new(t.spark, loaded, COMMENTS, "parquet")
    numbered = second.select(F.xxhash64("commentId").alias("id"), F.col("text").alias("texto"))
    scored = appended(t, sentiment.score_with(numbered, letter_counts("aeo"), 130),
                      "documento_id bigint, modelo_id bigint, polaridade string")
    names = t.comments().select("commentId", F.xxhash64("commentId").alias("documento_id"))
    return scored.join(names, "documento_id").select(F.col("commentId").alias("id"), "polaridade")
