"""Completeness report, hashtags, sentiment scores and annotation forms."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (evaluation, hashtags, incremental, monitor, resolve, sampling, sentiment)
from ..operators.upsert import insert_ignore, update_cols
from ..schemas import TABLE_KEYS
from ..session import materialize
from ..sources import sinks
from ..sources.raw import read_by_path, read_labels, read_raw


def audit(spark: SparkSession, raw_root: str, alvo: DataFrame,
          with_term: bool = True) -> DataFrame:
    """Audit records of all collections; key columns only are read.

    Video targets carry a search term. ``with_term=False`` looks them up without one, as the
    report once did; no present target is found that way.
    """
    def raw(name: str, *columns: str) -> DataFrame:
        return read_raw(spark, f"{raw_root}/{name}", name, presence=True,
                        columns=["_id", "campos", *columns])

    empty = F.lit("")
    term = F.col("_entidade_busca") if with_term else empty
    forum = raw("reddit", "id", "_subreddit_busca", "_termo_busca").withColumns({
        "fonte": F.lit("reddit"), "canal": F.col("_subreddit_busca"),
        "termo_busca": F.col("_termo_busca"), "_nativo": F.col("id")})
    ads = raw("meta", "id", "page_id", "_entidade_busca").withColumns({
        "fonte": F.lit("meta"), "termo_busca": empty, "_nativo": F.col("id"),
        "canal": F.coalesce(F.nullif("page_id", empty), "_entidade_busca")})
    videos = raw("youtube_videos", "videoId", "channelId", "_entidade_busca")
    comments = resolve.comment_channel(
        raw("youtube_comments", "commentId", "videoId", "_entidade_busca"),
        videos.where(F.col("channelId").isNotNull()))
    parts = [forum, ads]
    for df, key in ((videos, "videoId"), (comments, "commentId")):
        parts.append(df.withColumns({"fonte": F.lit("youtube"), "canal": F.col("channelId"),
                                     "termo_busca": term, "_nativo": F.col(key)}))
    records = [monitor.audit_records(resolve.with_fallback(
        p.select("_id", "campos", "fonte", "canal", "termo_busca", "_nativo"), alvo),
        "_nativo") for p in parts]
    out = records[0]
    for r in records[1:]:
        out = out.unionByName(r)
    return out


def completeness(spark: SparkSession, raw_root: str, root: str, generated_at: str,
                 with_term: bool = True) -> tuple[str, DataFrame, DataFrame]:
    """(Markdown, summary per source, counts per day and source)."""
    alvo = sinks.read_table(spark, root, "alvo_coleta")
    # narrow rows that feed three aggregates
    records = materialize(audit(spark, raw_root, alvo, with_term), "auditoria")
    loaded = resolve.loaded_keys(sinks.read_partitioned(spark, root, "documento"), alvo)
    sources = sinks.read_table(spark, root, "fonte").select(F.col("codigo").alias("fonte"))
    report, daily = monitor.report(records, loaded, sources), monitor.daily_counts(records)
    return sinks.completeness_markdown(report, daily, generated_at), report, daily


def load_hashtags(spark: SparkSession, corpora: str, root: str, n: int = 50) -> DataFrame:
    """Parquet corpora -> top hashtags per source and entity."""
    counts = hashtags.count(read_by_path(spark, corpora), "text_raw")
    name = "candidato_hashtag"
    return sinks.write_table(
        update_cols(sinks.read_table(spark, root, name), hashtags.top(counts, n), TABLE_KEYS[name],
                    ["contagem"], ["hashtag"]), root, name)


def train_sentiment(spark: SparkSession, labels: str, out: str) -> DataFrame:
    """Cross-validate, fit on everything, save the model; returns the scores' summary."""
    row_id = F.xxhash64("texto", "classificacao")
    table = sentiment.training_table(read_labels(spark, labels)).withColumn("linha", row_id)
    table = materialize(table.where(F.col("classe").isNotNull()), "rotulos")
    scores = evaluation.fold_scores(sentiment.cross_validate(table, "linha"))
    sentiment.fit(table).write().overwrite().save(out)
    return evaluation.summary(scores)


def score_sentiment(spark: SparkSession, root: str, model: str | object, model_id: int,
                    day: str | None = None, day_mode: str = "half_open") -> DataFrame:
    """Score comments that have no score yet, of one day or of all history. ``model`` is the path
    of a saved model or a function from a batch of texts to logits."""
    stored = sinks.read_table(spark, root, "sentimento")
    pending = incremental.pending_sentiment(sinks.read_partitioned(spark, root, "documento"),
                                            stored, day, day_mode)
    if callable(model):
        fresh = sentiment.score_with(pending, model, model_id)
    else:
        fresh = sentiment.score(PipelineModel.load(model), pending, model_id)
    key = TABLE_KEYS["sentimento"]
    return sinks.write_table(insert_ignore(stored, materialize(fresh, "notas"), key,
                                           ["polaridade"]), root, "sentimento")


def annotation_forms(spark: SparkSession, raw_root: str, out: str, per_network: int = 500,
                     forms: int = 10, networks=("reddit", "youtube"), seed: int = 42) -> None:
    """One CSV of balanced forms per network."""
    steps = {
        "reddit": ("reddit", sampling.valid_reddit_comments, sampling.reddit_records),
        "youtube": ("youtube_comments", sampling.valid_youtube_comments, sampling.youtube_records),
    }
    for network in networks:
        collection, valid, records = steps[network]
        raw = read_raw(spark, f"{raw_root}/{collection}", collection)
        drawn = materialize(sampling.sample_n(records(valid(raw)), "id_origem", per_network, seed),
                            "amostra")
        items = sampling.assign_forms(drawn, "id_origem", forms, seed)
        sinks.write_csv(items.orderBy("item_id"), f"{out}/{network}_comentarios_para_forms",
                        sampling.FORM_COLUMNS)


def refresh_state(spark: SparkSession, root: str) -> DataFrame:
    """Checkpoint per target and document type."""
    docs = sinks.read_partitioned(spark, root, "documento")
    return sinks.write_table(monitor.target_state(docs), root, "alvo_coleta_estado")
