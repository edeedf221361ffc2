"""Aggregations over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .quantiles import join_group, percentiles


def exclude_self_ratio(df: DataFrame, by: list[str], value: str, weight: str, name: str, few: bool = False) -> DataFrame:
    """``df`` with the weighted mean of ``value`` over the other rows of the group; 0 if they weigh nothing.

    Sums are aggregated and joined back, so a large group isn't sorted in one task; with ``few`` groups they go to every task.
    """
    sums = df.groupBy(*by).agg(F.sum(F.col(value) * F.col(weight)).alias("__v"), F.sum(weight).alias("__w"))
    own = F.coalesce(F.col(value) * F.col(weight), F.lit(0.0))
    rest = F.col("__w") - F.coalesce(F.col(weight), F.lit(0.0))
    return df.join(F.broadcast(sums) if few else sums, by).withColumn(name, F.when(F.abs(rest) > 1e-9 * F.abs(F.col("__w")), (F.col("__v") - own) / rest).otherwise(0.0)).drop("__v", "__w")


def percentile_trim(df: DataFrame, by: list[str], value: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies within the exact low and high percentiles of their group, both included."""
    bounds = percentiles(df, by, F.col(value), [low, high], "__b")
    return join_group(df, bounds, by).where(F.col(value).between(F.get("__b", F.lit(0)), F.get("__b", F.lit(1)))).drop("__b")


def slope(y: str | Column, t: str | Column) -> Column:
    """Aggregate: least-squares slope of y over t; null with fewer than two rows or one value of t."""
    y, t = (F.col(x) if isinstance(x, str) else x for x in (y, t))
    both = y.isNotNull() & t.isNotNull()
    n = F.count_if(both)
    sum_ = lambda x: F.sum(F.when(both, x).cast("double"))
    top = n * sum_(t * y) - sum_(t) * sum_(y)
    bottom = n * sum_(t * t) - sum_(t) * sum_(t)
    return F.when(bottom != 0, top / bottom)


def pivot_flags(df: DataFrame, key: str, period: str, periods: list[int], names: list[str]) -> DataFrame:
    """One row for each key with a 0/1 column for each period, 1 if the key has a row in it."""
    return df.where(F.col(period).isin(periods)).groupBy(key).agg(*[F.max((F.col(period) == p).cast("int")).alias(n) for p, n in zip(periods, names, strict=True)])


def min_max(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with the value scaled to 0..1 over all rows; 0 if all are alike."""
    ends = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return df.crossJoin(F.broadcast(ends)).withColumn(name, F.coalesce(F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))).drop("__lo", "__hi")


def with_group(df: DataFrame, by: list[str], **aggregates: Column) -> DataFrame:
    """``df`` with aggregates of each row's group, joined back."""
    return df.join(df.groupBy(*by).agg(*[a.alias(n) for n, a in aggregates.items()]), by)


def first_of(columns: list[str]) -> Column:
    """First value that isn't null."""
    return F.coalesce(*columns)


def mean_of_first(columns: list[str], k: int) -> Column:
    """Mean of the first k values that aren't null; null without any."""
    head = F.slice(F.filter(F.array(*columns), lambda x: x.isNotNull()), 1, k)
    return F.try_divide(F.aggregate(head, F.lit(0.0), lambda s, x: s + x), F.size(head))


def running_share(df: DataFrame, by: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with the share of the group's total that the rows up to this one make."""
    w = Window.partitionBy(*by)
    return df.withColumn(name, F.sum(value).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) / F.sum(value).over(w))


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """(keys, name, value): a row for each of the columns that isn't null."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def described(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, n, mean, stddev, least, q25, median, q75, most) of the values that aren't null."""
    x = F.col(value).cast("double")
    plain = df.where(x.isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"), F.min(x).alias("least"), F.max(x).alias("most"))
    cuts = percentiles(df, by, x, [0.25, 0.5, 0.75], "__q")
    return join_group(plain, cuts, by).select(*by, "n", "mean", "stddev", "least", *[F.get("__q", F.lit(i)).alias(c) for i, c in enumerate(("q25", "median", "q75"))], "most")


def rolling_distinct(df: DataFrame, by: list[str], period: Column, value: Column, windows: list[int]) -> DataFrame:
    """(by, period, distinct_w for each w of ``windows``): exact numbers of distinct values of the last w periods, that one
    included, for each period from a group's first on, as far as any row goes.

    ``period`` and ``value`` are whole numbers; nulls don't count. The facts are read once: bitmaps of each period (4 KB for
    each 32,768 numbers in use) are united for every window, so windows cost no further pass and no lists of values.
    """
    rows = df.select(*by, period.cast("int").alias("__p"), value.cast("long").alias("__v")).where("__p IS NOT NULL AND __v IS NOT NULL")
    bits = rows.groupBy(*by, "__p", F.bitmap_bucket_number("__v").alias("__b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__v")).alias("__bits"))
    bits = stored(bits, "bitmaps")
    last = F.broadcast(bits.agg(F.max("__p").alias("__last")))  # one row
    reach = F.explode(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for w in windows for i in range(w)])).alias("__e")
    sent = bits.crossJoin(last).select(*by, "__p", "__b", "__bits", "__last", reach).withColumn("__at", F.col("__p") + F.col("__e.i")).where("__at <= __last")
    united = sent.groupBy(*by, "__at", F.col("__e.w").alias("__w"), "__b").agg(F.bitmap_count(F.bitmap_or_agg("__bits")).alias("__n"))
    counts = [F.coalesce(F.sum(F.when(F.col("__w") == w, F.col("__n"))), F.lit(0)).cast("long").alias(f"distinct_{w}") for w in windows]
    return united.groupBy(*by, F.col("__at").alias("period")).agg(*counts)
