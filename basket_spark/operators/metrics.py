"""Quality of ranked recommendation lists: (query_id, ranking, ground_truth); a null ranking is relevant but not listed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _checked(k: int) -> None:
    if k < 1:
        raise ValueError("k must be 1 or more")


def precision_at_k(lists: DataFrame, k: int) -> DataFrame:
    """(query_id, precision): relevant share of the rows ranked up to k; queries without such rows are absent."""
    _checked(k)
    return lists.where(F.col("ranking") <= k).groupBy("query_id").agg((F.sum("ground_truth") / F.count("*")).alias("precision"))


def recall_at_k(lists: DataFrame, k: int) -> DataFrame:
    """(query_id, recall): share of the query's relevant rows that are ranked up to k."""
    _checked(k)
    both = lists.groupBy("query_id").agg(F.sum(F.when(F.col("ranking") <= k, F.col("ground_truth"))).alias("found"), F.sum("ground_truth").alias("all"))
    return both.where("found IS NOT NULL").select("query_id", F.try_divide("found", "all").alias("recall"))


def average_precision_at_k(lists: DataFrame, k: int) -> DataFrame:
    """(query_id, ap): sum over relevant ranks up to k of the precision there, over all relevant rows; null without any."""
    _checked(k)
    w = Window.partitionBy("query_id").orderBy("ranking").rowsBetween(Window.unboundedPreceding, 0)
    at = lists.where(F.col("ranking") <= k).withColumn("p", F.sum("ground_truth").over(w) / F.count("*").over(w))
    hits = at.groupBy("query_id").agg(F.sum(F.col("p") * F.col("ground_truth")).alias("hits"))
    total = lists.groupBy("query_id").agg(F.sum("ground_truth").alias("all"))
    return total.join(hits, "query_id", "left").select("query_id", F.try_divide(F.coalesce("hits", F.lit(0.0)), "all").alias("ap"))
