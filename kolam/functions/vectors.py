"""Cosine similarity of array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kolam.functions.names import as_col


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(as_col(a), F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 where a vector has no length; null where one is null."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0)))


def unit(a) -> Column:
    """The vector at length 1, so that later cosines are plain products; a vector of no length stays as it is."""
    n = norm(a)
    return F.transform(as_col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def first_near(vector, kept, threshold: float) -> Column:
    """The position (from 0) of the first of an array of vectors with a cosine of at least the threshold; -1 if there is none."""
    vector = as_col(vector)
    hits = F.transform(as_col(kept), lambda k: cosine(vector, k) >= threshold)
    return (F.array_position(hits, F.lit(True)) - 1).cast("int")
