"""Dense vectors in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product; null where a length differs (the zip pads with null)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector divided by its length; a zero vector stays as it is. The length is taken once, not per element."""
    return F.zip_with(a, F.array_repeat(norm(a), F.size(a)), lambda x, n: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def correlation(a: Column, b: Column) -> Column:
    """Normalised cross-correlation; 0 for arrays of different, no, or constant content."""
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, y: s + y) / F.size(v)
    centre = lambda v: F.zip_with(v, F.array_repeat(mean(v), F.size(v)), lambda x, m: x.cast("double") - m)
    ca, cb = centre(a), centre(b)
    n = norm(ca) * norm(cb)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (n >= 1e-6), dot(ca, cb) / n).otherwise(F.lit(0.0))
