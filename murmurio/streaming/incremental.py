"""The two-hourly jobs as Structured Streaming queries.

Every function takes a streaming frame and returns one, or starts a query with
``trigger(availableNow=True)``: it works off what has arrived and stops, to be started again by the
next run. Progress lives in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import temporal as D
from ..operators import models, upsert
from ..operators.skew import first_per_key

DAY_DELAY = "2 hours"


def read_new(spark: SparkSession, path: str, schema: str, fmt: str = "json",
             files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """New files of a folder as a stream; the schema is given."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def _start(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a query. A stateful query keeps the number of state partitions it was first started
    with for the life of its checkpoint, so it is given on its own, sized to the state."""
    if state_partitions is None:
        return writer.start()
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(name, usual)


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                mode: str = "append", state_partitions: int | None = None) -> StreamingQuery:
    """Hand what has arrived to ``handle(batch, batch_id)``. A batch may come again after a
    failure, with the same id, and may be empty."""
    writer = (stream.writeStream.outputMode(mode).foreachBatch(handle)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    return _start(writer, stream.sparkSession, state_partitions)


def append_files(stream: DataFrame, path: str, checkpoint: str,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Append the stream to Parquet files, each row exactly once."""
    writer = (stream.writeStream.format("parquet").option("path", path).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    return _start(writer, stream.sparkSession, state_partitions)


def version_path(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/lote={batch_id:09d}"


def latest_version(spark: SparkSession, root: str, name: str, before: int | None = None):
    """Path of the last complete state (below a batch id), or None."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/lote=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    ids = [int(s.getPath().getParent().getName().split("=")[1]) for s in found]
    ids = [i for i in ids if before is None or i < before]
    return version_path(root, name, max(ids)) if ids else None


def read_state(spark: SparkSession, root: str, name: str, schema: str,
               before: int | None = None) -> DataFrame:
    path = latest_version(spark, root, name, before)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def upsert_into(root: str, name: str, schema: str, keys: Sequence[str], update: Sequence[str],
                order: Sequence[Column | str]) -> Callable[[DataFrame, int], None]:
    """Batch handler: the state of a small table after each batch.

    The state after batch n is computed from the one before n and written under n, so a batch that
    comes again gives the same state again.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        state = read_state(batch.sparkSession, root, name, schema, batch_id)
        merged = upsert.update_cols(state, batch, keys, update, order)
        merged.write.mode("overwrite").parquet(version_path(root, name, batch_id))

    return handle


def insert_new(root: str, name: str, schema: str, keys: Sequence[str],
               order: Sequence[Column | str]) -> Callable[[DataFrame, int], None]:
    """Batch handler: append the rows whose key is in no earlier batch.

    Each batch writes its own folder; only the key columns of the earlier ones are read. The cost
    grows with the keys, not with the rows.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = read_inserted(spark, root, name, schema).where(F.col("lote") < batch_id)
        fresh = first_per_key(batch, keys, order).join(known.select(*keys), list(keys),
                                                       "left_anti")
        fresh.write.mode("overwrite").parquet(version_path(root, name, batch_id))

    return handle


def merge_new(root: str, name: str, schema: str, keys: Sequence[str], order: Sequence[Column | str],
              follows: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: append the rows whose key is new or whose column ``follows`` has changed.

    Nothing stored is rewritten; ``read_latest`` takes the last version of each key. Of the earlier
    batches only the keys and that column are read.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_inserted(spark, root, name, schema).where(F.col("lote") < batch_id)
        known = first_per_key(earlier.select(*keys, F.md5(follows).alias("_antes"), "lote"), keys,
                              [F.desc("lote")]).drop("lote").withColumn("_sabido", F.lit(True))
        joined = first_per_key(batch, keys, order).join(known, list(keys), "left")
        changed = F.col("_sabido").isNull() | ~F.md5(follows).eqNullSafe(F.col("_antes"))
        joined.where(changed).select(*batch.columns).write.mode("overwrite").parquet(
            version_path(root, name, batch_id))

    return handle


def read_latest(spark: SparkSession, root: str, name: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The last version of each key that ``merge_new`` has written."""
    return first_per_key(read_inserted(spark, root, name, schema), keys, [F.desc("lote")]).drop("lote")


def read_inserted(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """All batches of ``insert_new`` with their number in ``lote``."""
    if latest_version(spark, root, name) is None:
        return spark.createDataFrame([], f"{schema}, lote int")
    return spark.read.schema(f"{schema}, lote int").parquet(f"{root}/{name}")


def unique_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key among those that arrive within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_counts(stream: DataFrame, ts: str, by: Sequence[str],
                 delay: str = DAY_DELAY) -> DataFrame:
    """Rows per UTC day; a day is emitted once it is closed."""
    return (stream.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("_w"), *by).agg(F.count("*").alias("documentos"))
            .select(F.to_date("_w.start").alias("dia"), *by, "documentos"))


def closed_periods(stream: DataFrame, ts: str, by: Sequence[str], days: int, epoch: str,
                   delay: str = DAY_DELAY) -> DataFrame:
    """Rows per period of the grid; only closed periods are emitted."""
    from datetime import date

    offset = (date.fromisoformat(epoch) - date(1970, 1, 1)).days % days
    window = F.window(ts, f"{days} days", f"{days} days", f"{offset} days")
    return (stream.withWatermark(ts, delay).groupBy(window.alias("_w"), *by)
            .agg(F.count("*").alias("documentos"))
            .select(F.to_date("_w.start").alias("inicio"),
                    F.date_sub(F.to_date("_w.end"), 1).alias("fim"), *by, "documentos"))


def route(stream: DataFrame, model_rows: DataFrame, ts: str, days: int, epoch: str) -> DataFrame:
    """Every document, late or not, goes to the model of the last closed period before the local
    day of ``ts``."""
    dated = stream.withColumn("_dia", D.local_day(ts))
    return models.current(dated, model_rows, "_dia", days, epoch).drop("_dia")


def enrich_comments(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Channel of each comment from the table of videos. As a stream's join it uses the videos that
    are there when the query starts; ``enrich_into`` reads them in every batch."""
    channels = first_per_key(videos.where(F.col("videoId").isNotNull()).select(
        "videoId", "channelId"), ["videoId"], ["channelId"])
    return comments.join(channels, "videoId", "left")


def enrich_into(root: str, name: str, read_videos: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Batch handler: comments with their channel, from the videos stored when the batch runs."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        enrich_comments(batch, read_videos()).write.mode("overwrite").parquet(
            version_path(root, name, batch_id))

    return handle


def target_state(stream: DataFrame, ts: str) -> DataFrame:
    """Running checkpoint per target and document type, for output mode complete or update."""
    return stream.groupBy("alvo_coleta_id", F.col("tipo").alias("tipo_documento")).agg(
        F.count("*").alias("total_documentos"), F.min(ts).alias("primeiro_publicado_em"),
        F.max(ts).alias("ultimo_publicado_em"))


def write_whole(root: str, name: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for output mode complete: the whole result under the batch id."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(version_path(root, name, batch_id))

    return handle
