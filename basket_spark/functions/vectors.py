"""Expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at length 1; null for a zero vector. The length is an element of an array, so that it is computed once and
    not for each place."""
    return F.get(F.transform(F.filter(F.array(norm(a)), lambda n: n > 0), lambda n: F.transform(a, lambda x: x.cast("double") / n)), F.lit(0))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 minus the cosine; null with a zero vector."""
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))


def rogers_tanimoto(a: Column, b: Column) -> Column:
    """2R / (n + R) for R mismatches of two 0/1 vectors of length n; a missing vector counts as zeros."""
    n = F.coalesce(F.size(a), F.size(b))
    zeros = F.array_repeat(F.lit(0), n)
    wrong = F.aggregate(F.zip_with(F.coalesce(a, zeros), F.coalesce(b, zeros), lambda x, y: (x != y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(2 * wrong, n + wrong)
