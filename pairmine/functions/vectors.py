"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: smallest norm a vector is divided by.
EPSILON = 1e-12


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    squares = F.aggregate(
        a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.greatest(F.sqrt(squares), F.lit(EPSILON))


def cosine(a: Column, b: Column) -> Column:
    """Dot product of the normalised vectors; null unless both are there and equally long."""
    return F.when(F.size(a) == F.size(b), dot(a, b) / (norm(a) * norm(b)))
