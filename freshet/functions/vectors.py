"""Vector arithmetic on ARRAY<FLOAT> columns, in double precision and in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 when one of them is zero."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def similarity(a: Column, b: Column) -> Column:
    """Cosine on the 0..1 scale of vector search scores."""
    return (cosine(a, b) + 1) / 2
