"""Vector functions on array columns, evaluated in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vec: Column) -> Column:
    return F.sqrt(
        F.aggregate(as_doubles(vec), F.lit(0.0), lambda acc, x: acc + x * x)
    )


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle; 0.0 if either vector has no length."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(inner_product(a, b) / norms)


def l2_normalize(vec: Column) -> Column:
    """Unit-length copy; a zero vector stays as it is."""
    norm = l2_norm(vec)
    return F.when(norm == 0, as_doubles(vec)).otherwise(
        F.transform(as_doubles(vec), lambda x: x / norm)
    )


def has_dim(vec: Column, dim: int) -> Column:
    """Whether a complete vector of ``dim`` numbers is there; never null."""
    return F.coalesce(
        (F.size(vec) == dim) & ~F.exists(vec, lambda x: x.isNull()), F.lit(False)
    )
