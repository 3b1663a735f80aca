"""Vector expressions for single rows. Batch search is in ``operators.vector``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null when either vector has no length."""
    scale = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.try_divide(dot(a, b), scale)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - cosine_similarity(a, b)


def vector_literal(vector: Column) -> Column:
    """Array to the text form ``[a,b,…]``."""
    return F.concat(F.lit("["), F.array_join(vector.cast("array<string>"), ","), F.lit("]"))


def parse_vector(text: Column) -> Column:
    """Text form back to an array."""
    return F.from_json(text, "array<float>")
