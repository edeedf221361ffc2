"""What an incremental load adds to its target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_row
from .shared import spread
from .tables import without_slice


def new_by_id(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose id the target hasn't, one for each id (the least by all columns), without null ids.

    The source is dealt out and sorted by id once, for the least rows and for the join.
    """
    least = first_row(spread(source.where(F.col(key).isNotNull()), key), [key], [F.asc_nulls_last(c) for c in source.columns if c != key] or [F.lit(1)])
    return least.join(target.select(key), key, "left_anti").select(source.columns)


def from_last_date(source: DataFrame, target: DataFrame, date: str, key: str) -> DataFrame:
    """The target after a load from its last date on: rows of that date are replaced, later ones added.

    Of the source one row for each (date, id) (the least by all columns), without null dates; an empty target takes all.
    """
    last = F.broadcast(target.agg(F.max(date).alias("__last")))
    fresh = source.where(F.col(date).isNotNull()).crossJoin(last).where(F.col("__last").isNull() | (F.col(date) >= F.col("__last"))).drop("__last")
    fresh = first_row(fresh, [date, key], [F.asc_nulls_last(c) for c in source.columns if c not in (date, key)] or [F.lit(1)])
    kept = without_slice(target.crossJoin(last), F.col(date) == F.col("__last")).drop("__last")
    return kept.unionByName(fresh.select(source.columns))


def after_watermark(source: DataFrame, target: DataFrame, date: str, default: str = "1900-01-01") -> DataFrame:
    """Source rows later than the target's last date."""
    last = F.broadcast(target.agg(F.coalesce(F.max(date), F.lit(default).cast(source.schema[date].dataType)).alias("__last")))
    return source.crossJoin(last).where(F.col(date) > F.col("__last")).drop("__last")


def new_by_composite_key(source: DataFrame, target: DataFrame, keys: list[str], date: str, days: int, today: str, **same: str) -> DataFrame:
    """Rows whose key the target hasn't among its rows of the last ``days`` days (and of the given column values).

    Keys compare as text joined by a pipe, nulls as nothing.
    """
    recent = target.where(F.col(date) >= F.date_sub(F.lit(today).cast("date"), days))
    for column, value in same.items():
        recent = recent.where(F.col(column) == value)
    joined = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return source.withColumn("__k", joined).join(recent.select(joined.alias("__k")).distinct(), "__k", "left_anti").select(source.columns)
