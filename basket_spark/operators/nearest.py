"""The nearest rows by cosine, exact, without all pairs.

The right side is cut into clusters around some of its own vectors. A left row first meets the clusters nearest to it, as
many as hold enough rows; its k-th best so far then rules out every cluster whose vectors must all lie further away,
since angles keep the triangle inequality: none of a cluster is nearer than the angle to its centre less its radius. Only
what is left is met in the second step. Large clusters are cut into blocks that are met one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..sources.shared import stored
from .ranking import top_k
from .similarity import BLOCK_ROWS, matrix, nearest

#: At most so many clusters: their centres go to every task.
CLUSTERS = 512
#: Distances are compared with so much room, for what rounding takes away.
ROOM = 2e-6


def _angles(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(v @ centres.T, -1, 1))


def _units(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key).alias("k"), vx.unit(F.col(vector)).alias("v")).where("v IS NOT NULL")


class Clusters:
    """Centres, the largest angle of a row of each, and how many rows each has."""

    def __init__(self, centres: np.ndarray, radius: np.ndarray, size: np.ndarray) -> None:
        self.centres, self.radius, self.size = centres, radius, size

    def first(self, v: np.ndarray, top: int) -> list[list[int]]:
        """For each row the clusters nearest to it that hold ``top`` rows together (all, if all hold fewer)."""
        order = np.argsort(_angles(v, self.centres), 1, kind="stable")
        enough = (np.cumsum(self.size[order], 1) < top).sum(1) + 1
        return [o[:n].tolist() for o, n in zip(order, enough, strict=True)]

    def others(self, v: np.ndarray, worst: np.ndarray, first: list[list[int]]) -> list[list[int]]:
        """For each row the other clusters that may hold a row nearer than its k-th best so far."""
        least = np.maximum(_angles(v, self.centres) - self.radius, 0)
        open_ = 1 - np.cos(least) <= worst[:, None] + ROOM
        return [np.setdiff1d(np.flatnonzero(o), f).tolist() for o, f in zip(open_, first, strict=True)]


def _clustered(right: DataFrame, clusters: int) -> tuple[DataFrame, Clusters]:
    """The rows (k, v, cluster, block), and the clusters, around rows drawn by a hash of their key."""
    spark = right.sparkSession
    centres = right.orderBy(F.xxhash64("k"), "k").limit(clusters).select("v").toArrow()
    centres = matrix(centres["v"]) if centres.num_rows else np.zeros((0, 1))
    shared = spark.sparkContext.broadcast(centres)
    kind = right.schema["k"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angle = _angles(matrix(pa.chunked_array([batch["v"]])), shared.value) if batch.num_rows else np.zeros((0, 1))
            at = angle.argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch["k"], batch["v"], pa.array(at), pa.array(angle[np.arange(len(at)), at])], ["k", "v", "cluster", "angle"])

    placed = stored(right.mapInArrow(place, f"k {kind}, v array<double>, cluster int, angle double"), "clusters")
    radius, size = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in placed.groupBy("cluster").agg(F.max("angle").alias("a"), F.count("*").alias("n")).collect():  # a row a cluster
        radius[r.cluster], size[r.cluster] = r.a, r.n
    blocks = np.maximum(1, -(-size // BLOCK_ROWS)).tolist() or [1]
    n = F.get(F.array(*map(F.lit, blocks)), F.col("cluster"))
    return placed.select("k", "v", "cluster", F.pmod(F.xxhash64("k"), n).cast("int").alias("block")), Clusters(centres, radius, size)


def nearest_rows(left: DataFrame, right: DataFrame, left_id: str, right_id: str, top: int, left_vector: str = "embedding", right_vector: str = "embedding", digits: int = 6, clusters: int | None = None, report: dict | None = None) -> DataFrame:
    """(left_id, right_id, distance) of the ``top`` nearest rows of ``right`` of each row of ``left``, ties to the lesser right
    id: what ``cosine_pairs`` with ``top`` gives.

    Ids should be distinct. Rows with a zero or null vector are left out. ``report`` gets how many of the pairs of a left row
    and a cluster there are (``pairs``) and how many were met (``met``), which costs a count.
    """
    left, right = _units(left, left_id, left_vector), stored(_units(right, right_id, right_vector), "right")
    n = right.count()
    rows, found = _clustered(right, clusters or min(CLUSTERS, max(1, int(n**0.5))))
    spark = left.sparkSession
    shared = spark.sparkContext.broadcast(found)
    kind, kind2 = left.schema["k"].dataType.simpleString(), right.schema["k"].dataType.simpleString()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.first(matrix(pa.chunked_array([batch["v"]])), top) if batch.num_rows and len(shared.value.size) else [[]] * batch.num_rows
            yield batch.append_column("first", pa.array(own, pa.list_(pa.int32())))

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = shared.value.others(matrix(pa.chunked_array([batch["v"]])), batch["worst"].to_numpy(), batch["first"].to_pylist()) if batch.num_rows and len(shared.value.size) else [[]] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch["k"], batch["v"], pa.array(more, pa.list_(pa.int32()))], ["k", "v", "more"])

    def multiply(one: pa.Table, two: pa.Table) -> pa.Table:
        out = []
        for start in range(0, one.num_rows if two.num_rows else 0, 512):
            part = one.slice(start, 512)
            distance = np.round(1 - matrix(part["v"]) @ matrix(two["v"]).T, digits) + 0.0
            i, j = nearest(distance, None, top)
            out.append(pa.table({"a": part["k"].take(pa.array(i)), "b": two["k"].take(pa.array(j)), "distance": distance[i, j]}))
        return pa.concat_tables(out) if out else pa.table({"a": one["k"].slice(0, 0), "b": two["k"].slice(0, 0), "distance": pa.array([], pa.float64())})

    blocks = stored(rows.select("cluster", "block").distinct(), "blocks")

    def meet(asked: DataFrame) -> DataFrame:
        """Of (k, v, cluster) the nearest of each block; a left row goes to every block of its cluster."""
        sent = asked.join(F.broadcast(blocks), "cluster")  # clusters and their blocks: n / BLOCK_ROWS + CLUSTERS rows at most
        pairs = sent.groupBy("cluster", "block").cogroup(rows.groupBy("cluster", "block")).applyInArrow(multiply, f"a {kind}, b {kind2}, distance double")
        return top_k(pairs, ["a"], [F.asc("distance"), F.asc("b")], top, "n")

    started = stored(left.mapInArrow(begin, f"k {kind}, v array<double>, first array<int>"), "started")
    best = stored(meet(started.select("k", "v", F.explode("first").alias("cluster"))), "best")
    worst = best.groupBy("a").agg(F.when(F.count("*") >= top, F.max("distance")).otherwise(3.0).alias("worst"))
    asked = started.join(worst, started["k"] == worst["a"], "left").select("k", "v", "first", F.coalesce("worst", F.lit(3.0)).alias("worst"))
    more = stored(asked.mapInArrow(go_on, f"k {kind}, v array<double>, more array<int>"), "more")
    if report is not None:
        met = started.agg(F.sum(F.size("first"))).first()[0], more.agg(F.sum(F.size("more"))).first()[0]
        report.update(pairs=started.count() * len(found.size), met=sum(x or 0 for x in met))
    again = meet(more.select("k", "v", F.explode("more").alias("cluster")))
    both = top_k(best.drop("n").union(again.drop("n")), ["a"], [F.asc("distance"), F.asc("b")], top, "n").drop("n")
    return both.toDF(left_id, right_id if right_id != left_id else f"{right_id}_2", "distance")
