"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores equal to this many places are ties. Summation order differs between engines,
# batches and partitions in the last bits; without this, copies of one document would be
# ordered by noise instead of by id.
TIE_PLACES = 9


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    )


def unit(vector: Column) -> Column:
    """The vector at length one; NULL for a zero vector.

    The norm goes in as a repeated array so that it is worked out once per row, not once
    per component.
    """
    length = norm(vector)
    scaled = F.zip_with(vector, F.array_repeat(length, F.size(vector)), lambda x, n: x / n)
    return F.when(length > 0, scaled)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL, never NaN, when either vector is zero or missing."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def concat_vectors(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def tie_score(score: Column) -> Column:
    """The score as ranking sees it."""
    return F.round(score, TIE_PLACES)
