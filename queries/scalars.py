"""Dates, periods, JSON and vector functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import json as J
from murmurio.functions import temporal as D
from murmurio.functions import vectors as V
from murmurio.operators import sentiment as S

from .base import EPOCH, T0, query


@query("time.objectid_time", """
    SELECT doc_id, CASE WHEN regexp_full_match(_id, '[0-9a-fA-F]{24}') THEN
        CAST('0x' || substr(_id, 1, 8) AS BIGINT) ELSE -1 END AS segundos FROM raw_reddit""")
def objectid_time(t):
    return t.raw_reddit().select("doc_id", F.coalesce(
        F.unix_timestamp(D.objectid_time("_id")), F.lit(-1)).alias("segundos"))


@query("time.parse_iso", """
    SELECT event_id, epoch_us(CASE event_id % 4
          WHEN 0 THEN ts
          WHEN 1 THEN date_trunc('day', ts)
          WHEN 2 THEN date_trunc('second', ts) - INTERVAL 3 HOUR
          ELSE date_trunc('second', ts) END) AS micros,
        0 AS invalidas
    FROM events""")
def parse_iso(t):
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 4
    text = (F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(kind == 1, F.date_format(ts, "yyyy-MM-dd"))
            .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss+03:00"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    bad = F.concat(F.lit("em "), F.col("event_type"))
    return t.events.select(
        "event_id", F.unix_micros(D.parse_iso(text)).alias("micros"),
        F.when(D.parse_iso(bad).isNull(), 0).otherwise(1).alias("invalidas"))


@query("time.parse_epoch", """
    SELECT doc_id, coalesce(TRY_CAST(created_utc AS BIGINT), -1) AS segundos FROM raw_reddit""")
def parse_epoch(t):
    return t.raw_reddit().select("doc_id", F.coalesce(
        F.unix_timestamp(D.parse_epoch("created_utc")), F.lit(-1)).alias("segundos"))


@query("time.utc_day", """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS dia,
        CAST(CAST(ts - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS dia_local FROM events""")
def utc_day(t):
    ts = F.col("ts").cast("timestamp")
    return t.events.select("event_id", D.utc_day(ts).cast("string").alias("dia"),
                           D.local_day(ts).cast("string").alias("dia_local"))


@query("windows.period", f"""
    SELECT o_orderkey,
        CAST(CAST(DATE '{EPOCH}' + CAST(floor((CAST(o_orderdate AS DATE) - DATE '{EPOCH}') / 7.0)
            AS INT) * 7 AS DATE) AS VARCHAR) AS inicio,
        CAST(CAST(DATE '{EPOCH}' + (CAST(floor((CAST(o_orderdate AS DATE) - DATE '{EPOCH}') / 7.0)
            AS INT) - 1) * 7 AS DATE) AS VARCHAR) AS ultimo_fechado,
        (CAST(o_orderdate AS DATE) - DATE '{EPOCH}') % 7 = 0 AS fronteira
    FROM orders""")
def period(t):
    """Order dates lie before the epoch of the grid."""
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", D.period_start(day, 7, EPOCH).cast("string").alias("inicio"),
        D.last_closed_period(day, 7, EPOCH).cast("string").alias("ultimo_fechado"),
        D.is_period_boundary(day, 7, EPOCH).alias("fronteira"))


@query("windows.period_of_event", f"""
    SELECT event_id, CAST(CAST(DATE '{EPOCH}' + CAST(floor((CAST(ts - INTERVAL 3 HOUR AS DATE)
        - DATE '{EPOCH}') / 5.0) AS INT) * 5 AS DATE) AS VARCHAR) AS inicio FROM events""")
def period_of_event(t):
    local = D.local_day(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", D.period_start(local, 5, EPOCH).cast("string").alias(
        "inicio"))


@query("windows.period_end", """
    SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'F' THEN 6
        ELSE 0 END AS DATE) AS VARCHAR) AS fim,
        CAST(CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS VARCHAR) AS vespera FROM orders""")
def period_end(t):
    day = F.to_date("o_orderdate")
    weekly = F.col("o_orderstatus") == "F"
    return t.orders.select(
        "o_orderkey", D.window_end(day, weekly).cast("string").alias("fim"),
        D.previous_day("o_orderdate").cast("string").alias("vespera"))


@query("windows.monthly", """
    WITH span AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a,
                         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 80 AS INT) AS b FROM orders),
    cuts AS (SELECT o_orderkey, a, b, unnest(generate_series(date_trunc('month', a)::DATE, b,
                    INTERVAL 1 MONTH))::DATE AS m FROM span WHERE a < b)
    SELECT o_orderkey, CAST(epoch(greatest(m, a)) AS BIGINT) AS depois,
           CAST(epoch(least(CAST(m + INTERVAL 1 MONTH AS DATE), b)) AS BIGINT) AS antes
    FROM cuts WHERE greatest(m, a) < least(CAST(m + INTERVAL 1 MONTH AS DATE), b)""")
def monthly(t):
    start = F.to_date("o_orderdate")
    end = F.date_add(start, (F.col("o_orderkey") % 80).cast("int"))
    return t.orders.select("o_orderkey", F.explode(D.month_windows(start, end)).alias("j")).select(
        "o_orderkey", F.col("j.after").alias("depois"), F.col("j.before").alias("antes"))


@query("windows.slices", """
    SELECT CAST(CAST(date_trunc('hour', ts) AS DATE) AS VARCHAR) AS dia,
        CAST(extract('hour' FROM ts) AS INT) AS hora, count(*) AS eventos
    FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
       OR extract('hour' FROM ts) = 0
    GROUP BY 1, 2""")
def slices(t):
    ts = F.col("ts").cast("timestamp")
    today = t.events.agg(F.max(F.to_date("ts"))).first()[0]
    return t.events.where(D.slice_is_due(ts, F.lit(today))).groupBy(
        F.to_date(ts).cast("string").alias("dia"), F.hour(ts).alias("hora")
    ).agg(F.count("*").alias("eventos"))


@query("windows.clip", """
    SELECT commentId, publishedAt FROM comments
    WHERE publishedAt BETWEEN '2024-01-03T00:00:00Z' AND '2024-01-09T23:59:59Z'""")
def clip(t):
    return t.comments().where(D.in_iso_window("publishedAt", "2024-01-03", "2024-01-09")).select(
        "commentId", "publishedAt")


@query("windows.on_day", """
    SELECT event_id, ts <= TIMESTAMP '2024-01-10 23:59:59' AS segundos_inteiros FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""")
def on_day(t):
    whole = D.on_day("ts", "2024-01-10", "whole_seconds")
    return t.events.where(D.on_day("ts", "2024-01-10")).select(
        "event_id", whole.alias("segundos_inteiros"))


@query("videos.is_short", """
    SELECT videoId, NOT contains(duration, 'M') AND NOT contains(duration, 'H') AS curto
    FROM videos""")
def is_short(t):
    return t.videos().select("videoId", D.is_short_video("duration").alias("curto"))


@query("json.metadata", """
    SELECT event_id, '{"valor":' || CAST(value AS VARCHAR) || ',"tipo":"' || event_type
        || '","nulo":null}' AS metadados,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def metadata(t):
    packed = J.metadata_json(valor="value", tipo="event_type", nulo=F.lit(None).cast("string"))
    return t.events.select("event_id", packed.alias("metadados"),
                           F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("json.field_equals", """
    SELECT event_type, count(*) AS eventos FROM events
    WHERE json_extract_string(props, '$.k') = '7' GROUP BY event_type""")
def field_equals(t):
    return t.events.where(J.field_equals("props", "k", "7")).groupBy("event_type").agg(
        F.count("*").alias("eventos"))


@query("json.present_fields", """
    SELECT event_type, CAST(sum(len(json_keys(props))) AS BIGINT) AS campos FROM events
    GROUP BY event_type""")
def present_fields(t):
    return t.events.groupBy("event_type").agg(
        F.sum(F.size(J.present_fields("props"))).cast("bigint").alias("campos"))


@query("vectors.softmax", """
    WITH l AS (SELECT vec_id, [CAST(embedding[1] AS DOUBLE), CAST(embedding[2] AS DOUBLE),
                               CAST(embedding[3] AS DOUBLE)] AS z FROM embeddings),
    e AS (SELECT vec_id, z, list_transform(z, lambda x: exp(x - list_max(z))) AS w FROM l)
    SELECT vec_id, round(list_max(w) / list_sum(w), 6) AS confianca,
        CASE list_position(z, list_max(z)) WHEN 1 THEN 'negativo' WHEN 2 THEN 'neutro'
             ELSE 'positivo' END AS polaridade FROM e""")
def softmax(t):
    logits = F.slice("embedding", 1, 3).cast("array<double>")
    return t.embeddings.select("vec_id", F.round(S.confidence_of(logits), 6).alias("confianca"),
                               S.polarity_of(logits).alias("polaridade"))


_CENTROID_SQL = """
    center AS (SELECT label, list(media ORDER BY pos) AS c FROM (
        SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS media
        FROM embeddings, generate_series(1, 64) AS g(pos) GROUP BY label, pos) GROUP BY label)"""


@query("vectors.distance", f"""
    WITH {_CENTROID_SQL}
    SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), c), 6) AS l2,
           round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c), 6) AS cosseno
    FROM embeddings JOIN center USING (label)""")
def distance(t):
    from murmurio.operators import topics as T

    centers = T.centroids(t.embeddings, "embedding", "label")
    return t.embeddings.join(T.sized(centers), "label").select(
        "vec_id", F.round(V.l2_distance("embedding", "centroide"), 6).alias("l2"),
        F.round(V.cosine_similarity("embedding", "centroide"), 6).alias("cosseno"))


@query("labels.encode", """
    SELECT doc_id, CASE classificacao WHEN 'Negativo' THEN 0 WHEN 'Neutro' THEN 1 WHEN 'Positivo'
        THEN 2 ELSE -1 END AS classe, CASE classificacao WHEN 'Negativo' THEN 'negativo' WHEN
        'Neutro' THEN 'neutro' WHEN 'Positivo' THEN 'positivo' ELSE '<null>' END AS polaridade
    FROM rotulado""")
def encode(t):
    code = S.encode_label("classificacao")
    return t.rotulado().select("doc_id", F.coalesce(code, F.lit(-1)).alias("classe"),
                               F.coalesce(S.decode_polarity(code), F.lit("<null>")).alias(
                                   "polaridade"))


@query("labels.pending", """
    SELECT classificacao, count(*) AS documentos,
        (SELECT count(*) FROM rotulado WHERE classificacao = 'PENDENTE') AS pendentes
    FROM rotulado WHERE classificacao <> 'PENDENTE' GROUP BY classificacao""")
def pending(t):
    labelled = t.rotulado()
    # one row
    count = F.broadcast(S.pending_count(labelled).withColumn("_um", F.lit(1)))
    return S.drop_pending(labelled).groupBy("classificacao").agg(
        F.count("*").alias("documentos"), F.max(F.lit(1)).alias("_um")).join(count, "_um").drop("_um")
