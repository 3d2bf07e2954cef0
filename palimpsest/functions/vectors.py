"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: added to a norm, so that a zero vector scores 0.
NORM_FLOOR = 1e-10


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a)) + F.lit(NORM_FLOOR)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))
