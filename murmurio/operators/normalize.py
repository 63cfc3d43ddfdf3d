"""Raw records of each network -> one document shape.

Every function returns ``fonte, canal, termo_busca, id_nativo, id_mongo, tipo, url, texto,
publicado_em, coletado_em, metadados``; ``resolve.targets`` then replaces the channel and the term
by the collection target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as D
from ..functions import text as X
from ..functions.json import metadata_json, nested

COLUMNS = ["fonte", "canal", "termo_busca", "id_nativo", "id_mongo", "tipo", "url", "texto",
           "publicado_em", "coletado_em", "metadados"]


def _documents(raw: DataFrame, **cols: Column) -> DataFrame:
    cols = {
        "id_mongo": F.col("_id"),
        "coletado_em": D.objectid_time("_id"),
        "url": F.lit(None).cast("string"),
        **cols,
    }
    out = raw.select(*[cols[c].alias(c) for c in COLUMNS])
    named = X.blank_to_null("id_nativo").isNotNull() & F.col("publicado_em").isNotNull()
    clean = ["id_nativo", "url", "texto"]
    return out.where(named).withColumns({c: X.strip_nul(c) for c in clean})


def reddit(raw: DataFrame) -> DataFrame:
    is_post = F.coalesce(F.col("_tipo_documento") == "post", F.lit(False))
    return _documents(
        raw,
        fonte=F.lit("reddit"),
        canal=F.col("_subreddit_busca"),
        termo_busca=F.col("_termo_busca"),
        id_nativo=F.col("id"),
        tipo=F.when(is_post, "post").otherwise("comentario"),
        url=X.permalink_url("permalink"),
        texto=X.join_text("title", "selftext", "body"),
        publicado_em=D.parse_epoch("created_utc"),
        metadados=metadata_json(**{c: c for c in (
            "score", "num_comments", "upvote_ratio", "total_awards_received", "controversiality",
            "stickied", "distinguished", "over_18", "link_flair_text")}),
    )


def yt_videos(raw: DataFrame) -> DataFrame:
    return _documents(
        raw,
        fonte=F.lit("youtube"),
        canal=F.col("channelId"),
        termo_busca=F.col("_entidade_busca"),
        id_nativo=F.col("videoId"),
        tipo=F.lit("video"),
        url=X.watch_url("videoId"),
        texto=X.join_text("title", "description"),
        publicado_em=D.parse_iso("publishedAt"),
        metadados=metadata_json(**{c: c for c in (
            "viewCount", "likeCount", "commentCount", "channelTitle", "tags", "categoryId")}),
    )


def yt_comments(raw: DataFrame) -> DataFrame:
    """Needs the channel of the comment's video in ``channelId`` (``resolve.comment_channel``)."""
    return _documents(
        raw,
        fonte=F.lit("youtube"),
        canal=F.col("channelId"),
        termo_busca=F.col("_entidade_busca"),
        id_nativo=F.col("commentId"),
        tipo=F.lit("comentario"),
        texto=X.join_text("text"),
        publicado_em=D.parse_iso("publishedAt"),
        metadados=metadata_json(**{c: c for c in ("likeCount", "replyCount", "authorChannelId")}),
    )


def ads(raw: DataFrame) -> DataFrame:
    """Ads; the bodies are an array or a single text."""
    listed = dict(raw.dtypes)["ad_creative_bodies"].startswith("array")
    bodies = X.join_text_list if listed else X.join_text
    return _documents(
        raw,
        fonte=F.lit("meta"),
        canal=F.coalesce(X.blank_to_null("page_id"), F.col("_entidade_busca")),
        termo_busca=F.lit(""),
        id_nativo=F.col("id"),
        tipo=F.lit("anuncio"),
        texto=bodies("ad_creative_bodies"),
        publicado_em=D.parse_iso("ad_delivery_start_time"),
        metadados=metadata_json(spend=nested("spend"), impressions=nested("impressions"), **{
            c: c for c in ("page_name", "ad_delivery_stop_time", "ad_creative_link_titles",
                           "publisher_platforms")}),
    )


def select_sources(frames: dict[str, list[DataFrame]], fonte: DataFrame, alvo: DataFrame,
                   chosen: list[str] | None = None) -> DataFrame:
    """Union of the chosen sources; a source must be registered and own a target."""
    parts = [df for name, dfs in frames.items() if chosen is None or name in chosen for df in dfs]
    union = reduce(DataFrame.unionByName, parts)
    registered = fonte.select(F.col("codigo").alias("fonte"))
    targeted = alvo.select(F.col("fonte_codigo").alias("fonte")).distinct()
    return union.join(registered, "fonte", "left_semi").join(targeted, "fonte", "left_semi")


def _count(c: str) -> Column:
    return F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))


def flatten_threads(items: DataFrame, term: Column | str) -> DataFrame:
    """Comment-thread responses -> raw comments."""
    top = "snippet.topLevelComment.snippet"
    return items.select(
        F.col("id").alias("commentId"),
        F.col("snippet.videoId").alias("videoId"),
        F.col(f"{top}.textOriginal").alias("text"),
        _count(f"{top}.likeCount").alias("likeCount"),
        _count("snippet.totalReplyCount").alias("replyCount"),
        F.col(f"{top}.publishedAt").alias("publishedAt"),
        F.col(f"{top}.authorChannelId.value").alias("authorChannelId"),
        (F.lit(term) if isinstance(term, str) else term).alias("_entidade_busca"),
    )


def flatten_videos(items: DataFrame, term: Column | str) -> DataFrame:
    """Video responses -> raw videos."""
    duration = F.col("contentDetails.duration")
    return items.select(
        F.col("id").alias("videoId"),
        *[F.col(f"snippet.{c}").alias(c)
          for c in ("channelId", "channelTitle", "publishedAt", "title", "description")],
        X.join_tags("snippet.tags").alias("tags"),
        F.col("snippet.categoryId").alias("categoryId"),
        duration.alias("duration"),
        D.is_short_video(duration).alias("is_short"),
        *[_count(f"statistics.{c}").alias(c) for c in ("viewCount", "likeCount", "commentCount")],
        (F.lit(term) if isinstance(term, str) else term).alias("_entidade_busca"),
    )


def stamp_search(raw: DataFrame, **context: str) -> DataFrame:
    """Stamp the search a batch came from, e.g. ``_subreddit_busca``, ``_termo_busca``."""
    return raw.withColumns({name: F.lit(value) for name, value in context.items()})
