"""Class weights, folds and scores of a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import draw_rank


def class_weights(df: DataFrame, label: str = "classe") -> DataFrame:
    """Balanced weight per class: n / (number of classes x n of the class)."""
    # one row per class
    everything = Window.partitionBy(F.lit(1))
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    balanced = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counts.withColumn("peso", balanced)


def kfold(df: DataFrame, row_id: str, label: str = "classe", folds: int = 5,
          seed: int = 42) -> DataFrame:
    """Stratified folds 1..n: within a class the sizes differ by one at most."""
    ranked = draw_rank(df, seed, row_id, by=[label], name="_r")
    return ranked.withColumn("fold", (F.pmod(F.col("_r") - 1, F.lit(folds)) + 1).cast("int")).drop(
        "_r")


def confusion(df: DataFrame, label: str = "classe", predicted: str = "previsto") -> DataFrame:
    return df.groupBy("fold", label, predicted).agg(F.count("*").alias("n"))


def fold_scores(df: DataFrame, label: str = "classe", predicted: str = "previsto") -> DataFrame:
    """Macro F1 and accuracy per fold, over the classes that occur in either column."""
    cells = confusion(df, label, predicted)
    hit = F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0)
    true_side = cells.select("fold", F.col(label).alias("c"), "n", F.lit(0).alias("p"),
                             hit.alias("tp"))
    pred_side = cells.select("fold", F.col(predicted).alias("c"), F.lit(0).alias("n"),
                             F.col("n").alias("p"), F.lit(0).alias("tp"))
    per_class = true_side.unionByName(pred_side).groupBy("fold", "c").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    f1 = 2.0 * F.col("tp") / (F.col("n") + F.col("p"))
    return per_class.groupBy("fold").agg(
        F.avg(f1).alias("f1_macro"), (F.sum("tp") / F.sum("n")).alias("acuracia"))


def summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation over the folds."""
    return scores.agg(
        F.avg("f1_macro").alias("f1_medio"), F.stddev_pop("f1_macro").alias("f1_desvio"),
        F.avg("acuracia").alias("acuracia_media"),
        F.stddev_pop("acuracia").alias("acuracia_desvio"))
