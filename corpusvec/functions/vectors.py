"""Column expressions over arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product; the longer array's tail is ignored."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two double arrays, 0.0 when either has no length."""
    return cosine_from(dot(a, b), norm(a), norm(b))


def cosine_from(dot_product: Column, norm_a: Column, norm_b: Column) -> Column:
    """The same from parts, for callers that keep norms in a column."""
    return F.when((norm_a == 0) | (norm_b == 0), F.lit(0.0)).otherwise(
        dot_product / (norm_a * norm_b)
    )
