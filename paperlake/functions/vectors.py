"""Vector arithmetic on ARRAY columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when either side is NULL or a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def squared_distance(a: Column, b: Column) -> Column:
    diffs = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x * x)


def literal_vector(values) -> Column:
    return F.lit([float(v) for v in values])
