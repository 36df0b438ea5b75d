"""Vectors as arrays: validation and similarity, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def valid(v: Column, dim: int | None = None) -> Column:
    """True for vectors of finite components that are not empty nor all zero (and of length dim, if given)."""
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine if dim is None else fine & (F.size(v) == dim), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 for null, empty, unequal lengths or zero norm."""
    fine = a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)) & (F.size(a) > 0)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(fine & (size > 0), dot(a, b) / size).otherwise(F.lit(0.0))
