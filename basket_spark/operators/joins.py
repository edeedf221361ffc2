"""Joins that need more than an equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import first_row


def not_in(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """SQL's NOT IN: a null among the others leaves no row, and a null in ``column`` leaves its row only if there are no
    others. For keys without nulls ``left_anti`` is the same and needs no broadcast."""
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE `{column}` NOT IN (SELECT `{other}` FROM {{others}})", df=df, others=others)


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the one column that both have; raises if it isn't one."""
    common = [c for c in a.columns if c in b.columns]
    if len(common) != 1:
        raise ValueError(f"the frames must share one column, not {common}")
    return a.join(b, common[0], how)


def as_of(states: DataFrame, by: list[str], period: str, until: Column | int) -> DataFrame:
    """Last state of each key up to a period; ties go to the first by all columns."""
    order = [F.desc(period), *(F.asc(c) for c in states.columns if c not in (*by, period))]
    return first_row(states.where(F.col(period) <= until), by, order)


def covered_days(spans: DataFrame, key: str, start: str, end: str, name: str = "day") -> DataFrame:
    """Distinct (key, day) of all spans, both ends included."""
    days = spans.where(F.col(start) <= F.col(end)).select(key, F.explode(F.sequence(start, end)).alias(name))
    return days.distinct()


def union_of_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()
