"""Raw collections -> documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalize, resolve
from ..operators.skew import first_per_key
from ..operators.upsert import surrogate_id, update_cols
from ..schemas import TABLE_KEYS
from ..session import materialize
from ..sources.raw import read_raw
from ..sources.sinks import read_partitioned, read_table, replace_partitions

KEY = TABLE_KEYS["documento"]
COLLECTIONS = {"youtube": ["youtube_videos", "youtube_comments"], "reddit": ["reddit"],
               "meta": ["meta"]}


def normalized(spark: SparkSession, raw_root: str, sources: list[str], limit: int | None = None,
               read=read_raw) -> dict[str, list[DataFrame]]:
    """Documents of each source before their targets are known."""
    def raw(name: str) -> DataFrame:
        return read(spark, f"{raw_root}/{name}", name, limit=limit, order=["_id"])

    def youtube() -> list[DataFrame]:
        # channels come from all videos, also under a limit
        channels = read(spark, f"{raw_root}/youtube_videos", "youtube_videos",
                        columns=["videoId", "channelId"])
        comments = resolve.comment_channel(raw("youtube_comments"), channels)
        return [normalize.yt_videos(raw("youtube_videos")), normalize.yt_comments(comments)]

    loaders = {"youtube": youtube, "reddit": lambda: [normalize.reddit(raw("reddit"))],
               "meta": lambda: [normalize.ads(raw("meta"))]}
    return {name: loaders[name]() for name in sources}


def incoming(spark: SparkSession, raw_root: str, root: str, sources: list[str] | None = None,
             limit: int | None = None) -> DataFrame:
    """New state of the documents found in the raw collections, one row per key."""
    alvo = resolve.assert_unique(read_table(spark, root, "alvo_coleta"))
    frames = normalized(spark, raw_root, sources or list(COLLECTIONS), limit)
    docs = normalize.select_sources(frames, read_table(spark, root, "fonte"), alvo, sources)
    unique = first_per_key(resolve.targets(docs, alvo), KEY, ["id_mongo"])
    return unique.withColumns({"id": surrogate_id(*KEY),
                               "mes": F.date_format("publicado_em", "yyyy-MM")})


def run(spark: SparkSession, raw_root: str, root: str, sources: list[str] | None = None,
        limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Upsert by (target, native id): new documents are added, of known ones only the metadata
    follows the raw data. Returns the documents found.

    Stored documents are kept by month of publication. Finding the known keys reads key columns
    alone; only months that hold a known key or get a new document are rewritten.
    """
    found = materialize(incoming(spark, raw_root, root, sources, limit), "entrada")
    if dry_run:
        return found
    stored = read_partitioned(spark, root, "documento")
    known = stored.select(*KEY, "mes").join(found.select(*KEY), KEY, "left_semi")
    # one row per month
    months = [r.mes for r in known.select("mes").unionByName(found.select("mes")).distinct()
              .collect()]
    merged = update_cols(stored.where(F.col("mes").isin(months)), found, KEY, ["metadados"],
                         ["id_mongo"])
    replace_partitions(merged, root, "documento")
    return found
