"""Ranks, top rows of groups, and caps."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def with_rank(df: DataFrame, by: list[str], order: list[Column], name: str = "rank", kind: str = "row_number") -> DataFrame:
    """``df`` with a rank within groups: row_number (give an order that is total), rank or dense_rank."""
    ranks = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}
    if kind not in ranks:
        raise ValueError(f"kind must be one of {sorted(ranks)}")
    return df.withColumn(name, ranks[kind]().over(Window.partitionBy(*by).orderBy(*order)))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int | Column, name: str = "rank") -> DataFrame:
    """The first k rows of each group, with their rank. Spark keeps k rows a task before it shuffles."""
    return with_rank(df, by, order, name).where(F.col(name) <= k)


def first_row(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the order."""
    return top_k(df, by, order, 1, "__first").drop("__first")


def sequential_caps(df: DataFrame, order: list[Column], caps: list[tuple[list[str], int | Column]]) -> DataFrame:
    """Caps one after the other: each counts, in the order, only the rows that the caps before it left."""
    for i, (by, most) in enumerate(caps):
        df = top_k(df, by, order, most, f"__cap{i}").drop(f"__cap{i}")
    return df


def bottom_then_order(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The last k rows of each group in ascending order of the columns."""
    return top_k(df, by, [F.desc(c) for c in order], k, "__last").drop("__last")


def global_rank(df: DataFrame, keys: dict[str, str], name: str = "rank", kind: str = "row_number") -> DataFrame:
    """``df`` with a rank over all rows by ``keys`` (column: "asc" or "desc"), without a window over the whole table.

    ``dense_rank`` and ``rank`` rank the distinct keys, so a key of very many rows is one row while it is ranked; the ranks are
    then joined to the rows. ``row_number`` orders ties by the other columns, ascending; rows alike in all columns are ranked
    once and take consecutive numbers. Nulls stand where Spark's orders put them: first ascending, last descending.

    The keys go to ranges with sampled bounds, are numbered within their range, and what lies in the ranges before is added.
    The driver sees two counts of each range.
    """
    if kind not in ("row_number", "rank", "dense_rank"):
        raise ValueError("kind must be row_number, rank or dense_rank")
    if wrong := {k: v for k, v in keys.items() if v not in ("asc", "desc")}:
        raise ValueError(f"keys are asc or desc, not {wrong}")
    spark, whole = df.sparkSession, kind == "row_number"
    order = [getattr(F, way)(F.col(f"`{k}`")) for k, way in keys.items()]
    columns = list(keys)
    if whole:
        columns += [c for c in df.columns if c not in keys]
        order += [F.asc(f"`{c}`") for c in df.columns if c not in keys]
    quoted = [f"`{c}`" for c in columns]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.groupBy(*quoted).agg(F.count("*").alias("__rows")).repartitionByRange(parts, *order)
    ranged = stored(ranged.withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in ranged.groupBy("__part").agg(F.count("*"), F.sum("__rows")).collect())
    step = 1 if kind == "dense_rank" else 2
    before = list(accumulate((s[step] for s in sizes), initial=0))
    offsets = spark.createDataFrame([(s[0], b) for s, b in zip(sizes, before, strict=False)], "__part int, __before long")
    window = Window.partitionBy("__part").orderBy(*order)
    own = F.row_number().over(window) if kind == "dense_rank" else F.sum("__rows").over(window) - F.col("__rows") + 1
    ranked = ranged.join(F.broadcast(offsets), "__part").withColumn(name, (F.col("__before") + own).cast("long"))
    if whole:
        copies = F.explode(F.sequence(F.lit(0), F.col("__rows") - 1))
        return ranked.select(*quoted, F.col(f"`{name}`").alias("__rank"), copies.alias("__copy")).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__rank") + F.col("__copy")).alias(name))
    ranked = stored(ranked.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(columns)], name), "ranks")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(columns)]
    for more in same[1:]:
        same[0] = same[0] & more
    return df.join(ranked, same[0]).drop(*[f"__k{i}" for i in range(len(columns))])
