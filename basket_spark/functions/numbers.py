"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def harmonic_mean(a: Column, b: Column) -> Column:
    return F.try_divide(2 * a * b, a + b)


def geometric_mean(a: Column, b: Column) -> Column:
    return F.sqrt(a * b)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum of value times weight over the sum of weights."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def first_match(rules: list[tuple[Column, Column | str | float | None]], default: Column | str | float | None = None) -> Column:
    """Value of the first rule whose condition is true; null conditions are false."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(default) if out is None else out.otherwise(default)


def band(value: Column, steps: list[tuple[float, float]], below: float) -> Column:
    """The number of the highest step whose lower bound ``value`` reaches, ``below`` under the first."""
    return first_match([(value >= bound, F.lit(x)) for bound, x in sorted(steps, reverse=True)], F.lit(below))
