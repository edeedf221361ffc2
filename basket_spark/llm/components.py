"""Connected components of an edge table by alternating large and small stars, each step written to the shared folder.

Least neighbours are aggregated (in parts before the shuffle) and written before they are joined: the join then has two
plain shuffles under it, so that Spark splits the neighbours of a node with very many of them over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import remove, stored_at


EDGES_PER_FILE = 100_000


def _large_star(edges: DataFrame, written: list[str]) -> DataFrame:
    """Every neighbour above a node moves to the least of the node and its neighbours. ``written`` gets the folder of the
    least ones."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least, path = stored_at(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    written.append(path)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame, written: list[str]) -> DataFrame:
    """A node and its neighbours below it move to the least of them. ``written`` as above."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least, path = stored_at(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    written.append(path)
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).where("a != b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that can be reached, for every node of an edge that isn't itself the least.

    Null ends and loops are left out. It is done when every edge leads from a node of one edge to one that has none of its
    own. Only counts of the edges come to the driver; few edges are kept in few files.
    """
    down = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    spark = edges.sparkSession
    now, path = stored_at(down, "edges")
    while True:
        n, nodes = now.agg(F.count("*"), F.count_distinct("a")).first()
        if n == nodes and now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        parts = max(1, n // EDGES_PER_FILE)
        old = [path]
        now, path = stored_at(_small_star(_large_star(now, old), old).coalesce(parts), "stars")
        remove(spark, *old)  # what the step started from and went through
