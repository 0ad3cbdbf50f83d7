"""Vector arithmetic over array columns, accumulated in 64-bit floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vec), F.lit(0.0), lambda s, x: s + x * x))


def _once(value: Column, use) -> Column:
    """`use(value)` with the value computed once a row: named inside a lambda, an expression is computed for each element."""
    return F.transform(F.array(value), use)[0]


def l2_normalize(vec: Column) -> Column:
    """Unit vector; the zero vector is returned unchanged."""
    def scaled(v: Column) -> Column:
        return _once(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))

    return _once(as_doubles(vec), scaled)


def ema_step(current: Column, product: Column, alpha: Column) -> Column:
    """One taste update: blend, then normalise. No prior: the normalised product; alpha 0: unchanged."""
    blended = F.zip_with(as_doubles(current), as_doubles(product), lambda v, p: v * (1 - alpha) + p * alpha)
    return (F.when(current.isNull(), l2_normalize(product))
            .when(alpha == 0, as_doubles(current))
            .otherwise(l2_normalize(blended)))


def knn_score(a: Column, b: Column) -> Column:
    """Cosine similarity moved to 0..1."""
    n = norm(a) * norm(b)
    return F.when(n > 0, (1 + dot(a, b) / n) / 2)


def has_vector(vec: Column, dims: int) -> Column:
    """Is the vector present and of the expected length?"""
    return F.coalesce(F.size(vec) == dims, F.lit(False))
