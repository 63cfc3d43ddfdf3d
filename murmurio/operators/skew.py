"""Joins and ranks that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import estimated_bytes, materialize

HOT_SHARE = 0.001
HOT_ROWS = 10_000
SALTS = 64


def sized(df: DataFrame) -> DataFrame:
    """A join side whose size Spark can rely on.

    Spark broadcasts a side below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it.
    Of a frame derived from a large input it only has a guess far too high, so such a frame is
    written out once and read back: the files tell its true size, and it is computed once.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df if estimated_bytes(df) <= limit else materialize(df, "lado")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE,
             least: int = HOT_ROWS) -> list:
    """Keys that own more than ``share`` and ``least`` of the rows (null included), in one pass.

    By arithmetic there are fewer than 1 / share such keys, so looking at that many of the most
    frequent keys misses none.
    """
    seen = Observation()
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).observe(
        seen, F.sum("_n").alias("total"))
    top = counts.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    floor = max(share * (seen.get["total"] or 0), least)
    return [tuple(r[k] for k in keys) for r in top if r["_n"] > floor]


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: Sequence[str],
                how: str = "left", salts: int = SALTS, hot: list | None = None,
                least: int = HOT_ROWS) -> DataFrame:
    """Equi-join whose hot keys on the left are spread over ``salts`` sub-keys.

    Only rows of hot keys are copied on the right side; without a hot key it is a plain join.
    ``row_id`` are columns that tell left rows apart: the salt is a hash of them, so a recomputed
    task gives a row the same salt again. Rows with a null key match nothing and are spread too.
    """
    keys = list(keys)
    hot = hot_keys(left, keys, least=least) if hot is None else hot
    if not hot:
        return left.join(right, keys, how)
    named = [k for k in hot if None not in k]
    kinds = dict(left.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    # fewer than 1 / share rows, see hot_keys
    marked = F.broadcast(left.sparkSession.createDataFrame(named, schema).withColumn(
        "_hot", F.lit(True)))
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int")
    salted = left.join(marked, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | null_key, spread).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    copied = right.join(marked, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Every map task keeps one row per key before the shuffle (window group limit), so a key with
    many copies costs no more than the others.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
                rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key; ``rank`` names an output column for the position."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank or "_rank", F.row_number().over(w)).where(
        F.col(rank or "_rank") <= n
    )
    return ranked if rank else ranked.drop("_rank")


def draw_key(seed: int | str, *cols: Column | str) -> Column:
    """Reproducible random order: a digest of the seed and the row's id."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def draw_rank(df: DataFrame, seed: int | str, row_id: str, by: Sequence[str] = (),
              name: str = "posicao", digits: int = 4) -> DataFrame:
    """1-based rank of every row in the random order, over all rows or per group.

    Rows without an id are drawn by all their columns, so they do not share one place in the order.

    A plain window over a handful of groups would sort each group in one task. Here the leading
    hex digits of the digest cut the order into 16^digits even buckets; the rank is the number of
    rows in earlier buckets plus the rank inside the bucket.
    """
    row = F.when(F.col(row_id).isNull(), F.to_json(F.struct(*df.columns))).otherwise(
        F.col(row_id).cast("string"))
    drawn = df.withColumn("_draw", draw_key(seed, row)).withColumn(
        "_bucket", F.substring("_draw", 1, digits)
    )
    bucket = [*by, "_bucket"]
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # 16^digits rows per group at most
    offsets = (
        drawn.groupBy(*bucket).agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(*bucket).orderBy("_draw", row_id))
    return (
        drawn.withColumn("_inside", inside)
        .join(sized(offsets), bucket)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_draw", "_bucket", "_before", "_inside")
    )
