"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # every timestamp of the data model is UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may go without it; it gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="murmurio-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in the application's own part of it."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/murmurio/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Used where a frame feeds several later jobs: the lineage is cut by files that survive the
    loss of an executor, and Spark knows the real size of what it reads back.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def spread(df: DataFrame, *keys: str, per_core: int = 64 * 1024 * 1024) -> DataFrame:
    """Spread a table that is too small to keep all cores busy.

    A small file is one task however many cores there are; for costly text work it is worth a
    shuffle. A table that fills the cores by itself is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) >= cores * per_core:
        return df
    return df.repartition(cores, *keys)
