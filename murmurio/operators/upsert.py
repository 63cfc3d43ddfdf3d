"""Keyed writes as pure functions: (current rows, incoming rows) -> new rows.

Plain files take no MERGE, so a write is the new state of the table. Both sides are brought to one
row per key before they meet, which leaves no key for a join to be skewed on. Empty input on
either side is fine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import first_per_key


def surrogate_id(*cols: Column | str) -> Column:
    """Stable stand-in for an auto-increment id, derived from the natural key."""
    return F.xxhash64(*cols)


def _packed(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    rest = [F.col(c) for c in df.columns if c not in keys]
    return df.select(*keys, F.struct(F.lit(True).alias("_row"), *rest).alias(name))


def fresh_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
               order: Sequence[Column | str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, the first of each key."""
    unique = first_per_key(incoming, keys, order)
    return unique.join(target.select(*keys), list(keys), "left_anti")


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str]) -> DataFrame:
    """Stored rows win; new keys are added."""
    fresh = fresh_rows(target, incoming, keys, order)
    return target.unionByName(fresh.select(*[c for c in target.columns if c in fresh.columns]),
                              allowMissingColumns=True)


def update_cols(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                update: Sequence[str], order: Sequence[Column | str],
                keep_when: str | None = None, guarded: Sequence[str] = ()) -> DataFrame:
    """New keys are added; of stored rows only the ``update`` columns take the incoming value.

    ``guarded`` columns stay as stored where the stored flag ``keep_when`` is true.
    """
    unique = first_per_key(incoming, keys, order)
    joined = _packed(target, keys, "_old").join(_packed(unique, keys, "_new"), list(keys), "full")
    old, new = F.col("_old"), F.col("_new")
    is_old, is_new = old["_row"].isNotNull(), new["_row"].isNotNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in unique.columns:
            return old[name].alias(name)
        if name not in update:
            return F.when(is_old, old[name]).otherwise(new[name]).alias(name)
        overwrite = is_new
        if name in guarded:
            overwrite = is_new & ~F.coalesce(old[keep_when], F.lit(False))
        return F.when(overwrite, new[name]).otherwise(old[name]).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def upsert_topics(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Words and size always follow the last run; a reviewed label and its text stay."""
    return update_cols(
        target, incoming, ["modelo_id", "numero"],
        ["palavras_chave", "tamanho", "rotulo", "descricao"], ["numero"],
        keep_when="revisado", guarded=["rotulo", "descricao"],
    )


def merge_fields(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str], present: str | None = None) -> DataFrame:
    """Field-wise merge: fields an incoming row holds overwrite, absent ones stay.

    ``present`` names an array column with the fields a row holds, so that an explicit null can
    overwrite; without it a null counts as absent. Rows of one key are applied in ``order``.
    """
    fields = [c for c in target.columns if c not in keys]
    rank = F.struct(*order)

    def holds(name: str) -> Column:
        return F.array_contains(present, name) if present else F.col(name).isNotNull()

    last = incoming.groupBy(*keys).agg(*[
        F.max_by(F.struct(F.col(c).alias("v")), F.when(holds(c), rank)).alias(c)
        for c in fields if c in incoming.columns
    ])
    joined = _packed(target, keys, "_old").join(_packed(last, keys, "_new"), list(keys), "full")
    new = F.col("_new")

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in last.columns:
            return F.col("_old")[name].alias(name)
        return F.when(new[name].isNotNull(), new[name]["v"]).otherwise(F.col("_old")[name]).alias(
            name)

    return joined.select(*[value(c) for c in target.columns])


def merge_counts(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys a field merge adds and keys it meets."""
    unique = incoming.select(*keys).distinct()
    known = target.select(*keys).withColumn("_known", F.lit(True))
    return unique.join(known, list(keys), "left").agg(
        F.count_if(F.col("_known").isNull()).alias("inseridos"),
        F.count_if(F.col("_known").isNotNull()).alias("atualizados"),
    )


def insert_counts(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows an insert adds and rows it drops as duplicates (stored or in the batch)."""
    per_key = incoming.groupBy(*keys).agg(F.count("*").alias("_n"))
    known = target.select(*keys).withColumn("_known", F.lit(True))
    added = F.when(F.col("_known").isNull(), 1).otherwise(0)
    return per_key.join(known, list(keys), "left").agg(
        F.coalesce(F.sum(added), F.lit(0)).cast("bigint").alias("inseridos"),
        F.coalesce(F.sum(F.col("_n") - added), F.lit(0)).cast("bigint").alias("duplicados"),
    )


def update_photos(entities: DataFrame, files: DataFrame) -> DataFrame:
    """Photo path of each entity from a file listing (codigo, arquivo, modificado_em)."""
    return update_cols(
        entities, photo_paths(files).join(entities.select("codigo"), "codigo", "left_semi"),
        ["codigo"], ["foto"], ["foto"],
    )


def photo_paths(files: DataFrame, prefix: str = "/fotos/") -> DataFrame:
    """``/fotos/<file>?v=<modification time>``: the version lets browsers refetch a new file."""
    version = F.unix_timestamp("modificado_em").cast("string")
    return files.select(
        "codigo", F.concat(F.lit(prefix), F.col("arquivo"), F.lit("?v="), version).alias("foto")
    )


def unmatched_photos(entities: DataFrame, files: DataFrame) -> DataFrame:
    return files.join(entities.select("codigo"), "codigo", "left_anti")
