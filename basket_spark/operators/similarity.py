"""Vectors and names: distances, TF-IDF, means, recommendations by distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from .joins import natural_join
from .ranking import first_row, top_k

#: A block holds about so many rows; two of them meet in a task, a strip of the one at a time. Few rows are cut into
#: smaller blocks, as many as there are tasks.
BLOCK_ROWS, LEAST_ROWS = 16_384, 1024
#: A strip has so many rows that about so many pairs are held at a time.
STRIP_PAIRS = 1 << 20


def in_blocks(left: DataFrame, right: DataFrame, left_id: str, right_id: str, compute: Callable[[pa.Table, object], pa.Table], schema: str, by: str | None = None, rows: int = BLOCK_ROWS, *, right_rows: int | None = None, right_block: str | None = None, prepare: Callable[[pa.Table], object] | None = None, strip: int | None = None) -> DataFrame:
    """What ``compute`` makes of each pair of blocks of ``left`` and ``right``, of a group of ``by`` if given.

    Both sides are cut into blocks of about ``rows`` (``right_rows``) rows by a hash of their ids, so ids should be distinct;
    the right one by ``right_block`` if given, whose values then stay whole. Each block is sent to the tasks of all blocks of
    the other side that it meets; a task holds two blocks and what ``compute`` makes of a strip of the left one, which leaves
    the task before the next strip is begun. ``prepare`` makes something else of a right block, once; ``strip`` gives the rows
    of a strip where not all pairs are held. Null groups meet nothing.
    """
    keys, tasks = [by] if by else [], left.sparkSession.sparkContext.defaultParallelism

    def blocks(df: DataFrame, name: str, rows: int, least: int = 1) -> DataFrame:
        n, all_ = F.col("__n"), df.agg(F.count("*").alias("__all"))
        share = F.ceil(least * n / F.col("__all"))  # a group makes as many blocks as its part of the rows, not as there are tasks
        counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).crossJoin(F.broadcast(all_))
        return counts.select(*keys, F.greatest(F.ceil(n / rows), F.least(F.ceil(n / LEAST_ROWS), share)).cast("int").alias(name))

    def in_strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[str, list[pa.RecordBatch]] = {"__one": [], "__two": []}
        for batch in batches:
            for side, parts in sides.items():
                if len(own := batch.column(side).drop_null()):
                    parts.append(pa.RecordBatch.from_struct_array(own))
        if not sides["__one"] or not sides["__two"]:
            return
        one, two = (pa.Table.from_batches(parts).combine_chunks() for parts in sides.values())
        size = strip or max(1, STRIP_PAIRS // two.num_rows)
        met = prepare(two) if prepare else two
        for start in range(0, one.num_rows, size):
            yield from compute(one.slice(start, size).combine_chunks(), met).to_batches()

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, by) if by else a.crossJoin(F.broadcast(b))  # without groups one row of counts

    sizes = join(blocks(left, "__nl", rows, tasks), blocks(right, "__nr", right_rows or rows)).where("__nl > 0 AND __nr > 0")
    place = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    groups = [*keys, "__i", "__j"]
    whole = lambda df: F.struct(*[F.col(c) for c in df.columns])
    one = join(left.withColumn("__row", whole(left)), sizes).select(*keys, place(left_id, "__nl").alias("__i"), each("__nr").alias("__j"), F.col("__row").alias("__one"))
    two = join(right.withColumn("__row", whole(right)), sizes).select(*keys, place(right_block or right_id, "__nr").alias("__j"), each("__nl").alias("__i"), F.col("__row").alias("__two"))
    return one.unionByName(two, allowMissingColumns=True).groupBy(*groups).applyInArrow(in_strips, schema)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of arrays of one length as rows of a matrix."""
    flat = column.combine_chunks()
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(flat), -1)


def nearest(distance: np.ndarray, below: float | None, top: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the distances below a bound and among the ``top`` least of their row, ties included."""
    kept = np.isfinite(distance) if below is None else distance < below
    if top is not None and distance.shape[1] > top:
        kept &= distance <= np.partition(distance, top - 1, axis=1)[:, top - 1 : top]
    return np.nonzero(kept)


def room(dimensions: int) -> float:
    """What a product of unit vectors in single precision may be off by."""
    return (dimensions + 4) * 2.0**-24


def dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of the rows i of a and j of b, a part of them at a time."""
    out = np.empty(len(i))
    for start in range(0, len(i), BLOCK_ROWS):
        at = slice(start, start + BLOCK_ROWS)
        np.einsum("nd,nd->n", a[i[at]], b[j[at]], out=out[at])
    return out


def nearest_vectors(one: np.ndarray, two: np.ndarray, single: np.ndarray, below: float | None, top: int | None, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance): the pairs of unit vectors below a bound and among the ``top`` nearest of their row, ties included.

    What may be among the ``top`` is found in single precision (``single`` is ``two``), with room for what that may be off
    by, and only these are multiplied again.
    """
    if top is None or len(two) <= top:
        distance = np.round(1 - one @ two.T, digits) + 0.0
        i, j = nearest(distance, below, top)
        return i, j, distance[i, j]
    rough = one.astype(np.float32) @ single.T
    slack = 10.0**-digits + 2 * room(one.shape[1])
    kept = np.isfinite(rough) if below is None else rough > np.float32(1 - below - slack)
    full = np.flatnonzero(np.count_nonzero(kept, 1) > top)
    if len(full):
        own = rough[full]
        worst = -np.partition(-own, top - 1, 1)[:, top - 1 : top]
        kept[full] &= own >= worst - np.float32(slack)
    i, j = np.nonzero(kept)
    distance = np.round(1 - dots(one, two, i, j), digits) + 0.0
    if below is not None:
        i, j, distance = (x[distance < below] for x in (i, j, distance))
    return i, j, distance


def cosine_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_vector: str = "embedding", right_vector: str = "embedding", below: float | None = None, top: int | None = None, digits: int = 6) -> DataFrame:
    """(left_id, right_id, distance) of the pairs of rows nearer than ``below``, and of the ``top`` nearest of each row of
    ``left``; one of the two must be given. Ties go to the lesser right id. Distances are rounded to ``digits``.

    Blocks of both sides are multiplied on the executors. Rows with a zero or null vector are left out.
    """
    if below is None and top is None:
        raise ValueError("give a bound or a number of nearest rows")
    left = left.select(F.col(left_id).alias("a"), vx.unit(F.col(left_vector)).alias("v")).where("v IS NOT NULL")
    right = right.select(F.col(right_id).alias("b"), vx.unit(F.col(right_vector)).alias("v")).where("v IS NOT NULL")

    def multiply(one: pa.Table, two: tuple[pa.ChunkedArray, np.ndarray, np.ndarray]) -> pa.Table:
        ids, v, single = two
        i, j, distance = nearest_vectors(matrix(one["v"]), v, single, below, top, digits)
        return pa.table({"a": one["a"].take(pa.array(i)), "b": ids.take(pa.array(j)), "distance": distance})

    def prepare(two: pa.Table) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray]:
        v = matrix(two["v"])
        return two["b"], v, v.astype(np.float32)

    kinds = f"a {left.schema['a'].dataType.simpleString()}, b {right.schema['b'].dataType.simpleString()}, distance double"
    pairs = in_blocks(left, right, "a", "b", multiply, kinds, prepare=prepare)
    if top is not None:
        pairs = top_k(pairs, ["a"], [F.asc("distance"), F.asc("b")], top, "__n").drop("__n")
    return pairs.toDF(left_id, right_id if right_id != left_id else f"{right_id}_2", "distance")


def nearest_flags(df: DataFrame, key: str, flags: str, by: str, top: int) -> DataFrame:
    """(a, b, distance): of each row the ``top`` other rows of its group of the least Rogers-Tanimoto distance, ties by key.

    ``flags`` are 0/1 arrays of one length; null ones count as zeros.
    """
    width = F.max(F.size(flags)).alias("__w")
    rows = df.crossJoin(F.broadcast(df.agg(width))).select(by, F.col(key).alias("k"), F.coalesce(flags, F.array_repeat(F.lit(0), F.col("__w"))).alias("f"))

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return pa.table({"a": one["k"].slice(0, 0), "b": two["k"].slice(0, 0), "distance": pa.array([], pa.float64())})
        distance = np.round(rogers_tanimoto(matrix(one["f"]), matrix(two["f"])), 6)
        distance[same(one["k"], two["k"])] = np.inf
        i, j = nearest(distance, None, top)
        return pa.table({"a": one["k"].take(pa.array(i)), "b": two["k"].take(pa.array(j)), "distance": distance[i, j]})

    kind = rows.schema["k"].dataType.simpleString()
    pairs = in_blocks(rows, rows, "k", "k", compare, f"a {kind}, b {kind}, distance double", by)
    return top_k(pairs, ["a"], [F.asc("distance"), F.asc("b")], top, "__n").drop("__n")


def rogers_tanimoto(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2R / (n + R) for the R mismatches of all pairs of rows of two 0/1 matrices of n columns."""
    wrong = a.sum(1)[:, None] + b.sum(1)[None] - 2 * a @ b.T
    return 2 * wrong / (a.shape[1] + wrong)


def same(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """Which pairs of values of two columns are equal; nulls are equal."""
    codes = pa.chunked_array([*a.chunks, *b.chunks], a.type).combine_chunks().dictionary_encode("encode").indices.to_numpy()
    return codes[: len(a)][:, None] == codes[len(a) :][None]


def filter_recommendations(recommendations: DataFrame, allowed: DataFrame, ranking: str, n: int, largest: bool = False) -> DataFrame:
    """The recommendations that ``allowed`` has under the one common column, the first n of each other key by ranking."""
    common = [c for c in recommendations.columns if c in allowed.columns]
    joined = natural_join(recommendations, allowed.select(common).distinct())
    keys = [c for c in recommendations.columns if c not in (ranking, *common)]
    order = F.desc(ranking) if largest else F.asc(ranking)
    return top_k(joined, keys, [order, *(F.asc(c) for c in common)], n).select(recommendations.columns)


def tf_idf(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, weight): term counts times ln((1+n)/(1+df))+1, at length 1 for each document.

    Tokens are lower-case runs of two word characters or more; documents without any are absent.
    """
    tokens = docs.select(key, F.explode(tx.word_tokens(F.col(text))).alias("token"))
    tf = tokens.groupBy(key, "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n"))
    raw = tf.join(df, "token").crossJoin(F.broadcast(n)).select(key, "token", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    length = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return raw.join(length, key).select(key, "token", (F.col("w") / F.col("length")).alias("weight"))


def _sums(df: DataFrame, vector: str, weight: Column) -> list[Column]:
    """Aggregates: the weighted sum of each place of the vectors. As many as the first vector has places; sums of a task are
    combined before they are shuffled, and no row is made for a place."""
    first = df.where(F.col(vector).isNotNull()).select(F.size(vector)).first()
    return [F.sum(F.get(vector, F.lit(i)).cast("double") * weight) for i in range(first[0] if first else 0)]


def mean_vectors(df: DataFrame, by: str, vector: str, weight: Column | None = None) -> DataFrame:
    """(by, embedding): the mean of the group's vectors, or the weighted sum over the sum of weights. Null vectors don't count."""
    w = F.lit(1.0) if weight is None else weight
    rows = df.where(F.col(vector).isNotNull())
    return rows.groupBy(by).agg(F.array(*[x / F.sum(w) for x in _sums(df, vector, w)]).cast("array<double>").alias("embedding"))


def customer_vectors(lines: DataFrame, embeddings: DataFrame, customer: str, sku: str, score: Column) -> DataFrame:
    """(customer, embedding): sum over the customer's products of vector times score, over how many products there are.

    ``lines`` has a row for each (customer, product), ``embeddings`` one for each product.
    """
    rows = embeddings.where("embedding IS NOT NULL")
    joined = lines.select(customer, sku, score.alias("__s")).join(rows, sku)
    return joined.groupBy(customer).agg(F.array(*[x / F.count("*") for x in _sums(rows, "embedding", F.col("__s"))]).cast("array<double>").alias("embedding"))


def canonical_code(products: DataFrame, sku: str, unit: str, code: str, main: str) -> DataFrame:
    """One code of each product and unit: the main one if there is any, else the least."""
    return first_row(products, [sku, unit], [F.when(F.col(main) == "X", 0).otherwise(1), F.asc(code)])
