"""Sentiment: training table, baseline classifier, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.wordlists import LABEL_CODES, PENDING_LABEL, POLARITIES
from . import evaluation
from .skew import sized


def encode_label(c: Column | str) -> Column:
    """Class name -> 0, 1, 2; unknown -> null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.create_map(*[F.lit(x) for p in LABEL_CODES.items() for x in p]), c)


def decode_polarity(c: Column | str) -> Column:
    """0, 1, 2 -> polarity; unknown -> null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.create_map(*[F.lit(x) for p in enumerate(POLARITIES) for x in p]),
                        c.cast("int"))


def drop_pending(labelled: DataFrame, label: str = "classificacao") -> DataFrame:
    return labelled.where(F.col(label).isNull() | (F.col(label) != PENDING_LABEL))


def pending_count(labelled: DataFrame, label: str = "classificacao") -> DataFrame:
    return labelled.agg(F.count_if(F.col(label) == PENDING_LABEL).alias("pendentes"))


def training_table(labelled: DataFrame, text: str = "texto",
                   label: str = "classificacao") -> DataFrame:
    """Settled comments with the cleaned text and the class code."""
    return drop_pending(labelled, label).withColumns({
        "texto_limpo": X.classifier_text(text), "classe": encode_label(label)})


def _features(df: DataFrame) -> DataFrame:
    words = X.tokens(F.lower(F.coalesce("texto_limpo", F.lit(""))))
    return df.withColumn("_palavras", words)


def _hashing(features: int) -> HashingTF:
    return HashingTF(inputCol="_palavras", outputCol="_tf", numFeatures=features)


def _fit(table: DataFrame, first: list) -> PipelineModel:
    """The steps up to the hashed words, if the table lacks them, then the classifier."""
    weights = evaluation.class_weights(table).select("classe", "peso")
    ready = table.join(sized(weights), "classe").withColumn("classe", F.col("classe").cast("double"))
    steps = [
        *first,
        IDF(inputCol="_tf", outputCol="_x"),
        LogisticRegression(featuresCol="_x", labelCol="classe", weightCol="peso",
                           predictionCol="previsto", rawPredictionCol="_bruto",
                           probabilityCol="_p", maxIter=20, regParam=0.01,
                           family="multinomial"),
    ]
    return Pipeline(stages=steps).fit(ready)


def fit(table: DataFrame, features: int = 1 << 16, seed: int = 42) -> PipelineModel:
    """Weighted multinomial baseline on hashed tf-idf; rows without a class are left out."""
    return _fit(_features(table.where(F.col("classe").isNotNull())), [_hashing(features)])


def _predicted(model: PipelineModel, ready: DataFrame) -> DataFrame:
    drop = ["_palavras", "_tf", "_x", "_bruto", "_p"]
    return model.transform(ready).drop(*drop).withColumn(
        "previsto", F.col("previsto").cast("int"))


def predict(model: PipelineModel, table: DataFrame) -> DataFrame:
    return _predicted(model, _features(table))


def cross_validate(table: DataFrame, row_id: str, folds: int = 5, seed: int = 42,
                   features: int = 1 << 16) -> DataFrame:
    """Out-of-fold predictions: every fold is predicted by a model of the others.

    The texts are taken apart once; the folds' models read the hashed words.
    """
    from ..session import materialize

    known = materialize(table.where(F.col("classe").isNotNull()), "conhecidos")
    drawn = evaluation.kfold(known, row_id, "classe", folds, seed)
    split = materialize(_hashing(features).transform(_features(drawn)).drop("_palavras"), "folds")
    parts = []
    for fold in range(1, folds + 1):
        model = _fit(split.where(F.col("fold") != fold).drop("fold"), [])
        parts.append(_predicted(model, split.where(F.col("fold") == fold)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def polarity_of(logits: Column | str) -> Column:
    """Most likely polarity of a row of logits."""
    return decode_polarity(V.argmax(logits))


def confidence_of(logits: Column | str) -> Column:
    return F.array_max(V.softmax(logits))


def score(model: PipelineModel, pending: DataFrame, model_id: int) -> DataFrame:
    """(documento_id, modelo_id, polaridade) of pending documents."""
    ready = pending.withColumn("texto_limpo", X.classifier_text("texto"))
    return predict(model, ready).select(
        F.col("id").alias("documento_id"), F.lit(model_id).cast("bigint").alias("modelo_id"),
        decode_polarity("previsto").alias("polaridade"))


def score_with(pending: DataFrame, logits: Callable[[pd.Series], list], model_id: int,
               batch: int = 32) -> DataFrame:
    """The same with any scorer that maps a batch of texts to rows of three logits."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start:start + batch]
                rows = [list(map(float, r)) for r in logits(part["texto"])]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "logits": rows})

    scored = pending.select("id", "texto").mapInPandas(run, "id bigint, logits array<double>")
    return scored.select(
        F.col("id").alias("documento_id"), F.lit(model_id).cast("bigint").alias("modelo_id"),
        polarity_of("logits").alias("polaridade"))
