"""Readers of raw collections, labelled comments and word lists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.wordlists import COLLECTION_SOURCE
from ..schemas import RAW

CORRUPT = "_corrupt_record"
# read as they are, then brought to the type of the schema
_LOOSE = re.compile(r"(\w+) (BIGINT|ARRAY<STRING>)(?=\s*(?:,|$))")


def _settled(df: DataFrame, schema: str) -> DataFrame:
    """Whole numbers also from 3.0 or '3', lists of texts also from a single text."""
    for name, kind in _LOOSE.findall(schema):
        value = F.col(name)
        if kind == "BIGINT":
            number = F.try_variant_get(value, "$", "string").try_cast("decimal(38,9)")
            out = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("bigint")
        else:
            listed = F.try_variant_get(value, "$", "array<string>")
            single = F.try_variant_get(value, "$", "string")
            is_list = F.schema_of_variant(value).startswith("ARRAY")
            out = F.when(is_list, listed).when(single.isNotNull(), F.array(single))
        df = df.withColumn(name, out)
    return df


def read_raw(spark: SparkSession, path: str, collection: str | None = None,
             where: Column | str | None = None, columns: Sequence[str] | None = None,
             limit: int | None = None, order: Sequence[str] = (),
             schema: str | None = None, presence: bool = False) -> DataFrame:
    """A collection of JSON records, one per line.

    The schema is given, never inferred; a line that is no JSON keeps its text in
    ``_corrupt_record``. ``presence`` adds ``campos``, the names of the fields a record holds,
    which tells an absent field from a null one. ``limit`` needs an ``order`` to be repeatable.
    A whole number may be written 3.0 or '3', and a list of texts may be a single text.
    """
    wanted = schema or RAW[collection]
    schema = _LOOSE.sub(r"\1 VARIANT", wanted)
    if presence:
        lines = spark.read.text(path)
        parsed = F.from_json("value", f"{schema}, {CORRUPT} STRING",
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        df = lines.select(parsed.alias("r"), J.present_fields("value").alias("campos")).select(
            "r.*", "campos")
    else:
        df = (spark.read.schema(f"{schema}, {CORRUPT} STRING")
              .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    df = _settled(df, wanted)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    if limit is not None:
        df = (df.orderBy(*order) if order else df).limit(limit)
    return df


def file_path() -> Column:
    """Decoded path of the file a row came from."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_by_path(spark: SparkSession, root: str, columns: Sequence[str] = ("text_raw",)) -> DataFrame:
    """``<root>/<collection>/<entity>.parquet`` as one frame with the source and the entity.

    Unknown collections are left out before any row is read: only known folders are listed.
    """
    sources = F.create_map(*[F.lit(x) for p in COLLECTION_SOURCE.items() for x in p])
    known = "{" + ",".join(COLLECTION_SOURCE) + "}"
    df = spark.read.parquet(f"{root}/{known}/*.parquet")
    have = [c for c in columns if c in df.columns]
    path = file_path()
    return df.select(
        F.element_at(sources, F.regexp_extract(path, r"([^/]+)/[^/]+\.parquet(?:/[^/]*)?$", 1))
        .alias("fonte_codigo"),
        F.regexp_extract(path, r"([^/]+)\.parquet(?:/[^/]*)?$", 1).alias("entidade_codigo"),
        *have,
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Annotated comments (texto, classificacao); quotes are doubled, texts may span lines."""
    return (spark.read.schema("texto STRING, classificacao STRING")
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """A word list, one per line; blank lines are skipped."""
    from ..functions.text import strip

    return spark.read.text(path).select(strip("value").alias("palavra")).where("palavra <> ''")
