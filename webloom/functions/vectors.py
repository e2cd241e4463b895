"""Vector and matrix expressions over array columns or K parallel columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.fixed_values import CLIP_BOUND


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two numeric arrays of equal length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 when a norm is 0."""
    return cosine_of(dot(a, b), norm(a) * norm(b))


def cosine_of(product: Column, norms: Column) -> Column:
    return F.when(norms > 0, product / norms).otherwise(F.lit(0.0))


def dot_columns(a: list[Column], b: list[Column]) -> Column:
    """Sum of products over parallel columns; stays inside generated code."""
    return reduce(lambda total, xy: total + xy, [x * y for x, y in zip(a, b)])


def clip(value: Column, bound: float = CLIP_BOUND) -> Column:
    return F.least(F.greatest(value, F.lit(-bound)), F.lit(bound))


def start_value(identifier: Column, k: int, scale: float) -> Column:
    """Small reproducible start value of factor ``k``, in [0, scale)."""
    return F.pmod(identifier * 31 + (k + 1) * 17, F.lit(97)) / F.lit(97.0) * F.lit(scale)


def has_nan(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.isnan(c) for c in columns])


def as_percent(share: Column, digits: int = 2) -> Column:
    return F.round(share * 100, digits)
