"""Vectors as array<float|double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _bound, _col


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2_distance(a: Column | str, b: Column | str) -> Column:
    def squared(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(_sum(F.zip_with(_col(a), _col(b), squared)))


def l2_norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_col(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def normalized(a: Column | str) -> Column:
    """Unit vector; a null vector stays as it is. The norm is computed once per row."""
    return _bound(l2_norm(a), lambda norm: F.transform(
        _col(a), lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double"))))


def softmax(logits: Column | str) -> Column:
    logits = _col(logits)
    powers = _bound(F.array_max(logits), lambda top: F.transform(
        logits, lambda x: F.exp(x - top)))
    return _bound(powers, lambda p: _bound(_sum(p), lambda total: F.transform(
        p, lambda x: x / total)))


def argmax(values: Column | str) -> Column:
    """Zero-based position of the first maximum."""
    values = _col(values)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
