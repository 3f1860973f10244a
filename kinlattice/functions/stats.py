"""Statistics as column expressions (MTH-01 to MTH-04)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """MTH-01: ``struct(low, high)`` of the Wilson score interval within [0, 1]; (0, 0) without cases."""
    k, n = k.cast("double"), n.cast("double")
    n, zz = F.when(n > 0, n), F.lit(z * z)
    p = k / n
    d, c = 1 + zz / n, p + zz / (2 * n)
    h = F.lit(z) * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    edge = lambda x: F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x / d)), F.lit(0.0))
    none = n.isNull()
    return F.struct(F.when(none, 0.0).otherwise(edge(c - h)).alias("low"), F.when(none, 0.0).otherwise(edge(c + h)).alias("high"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """MTH-02: null where one is a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def ratio(a: Column, b: Column, digits: int = 2) -> Column:
    """MTH-04: rounded a / b, null where b is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """AGG-17: per cent, rounded."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)
