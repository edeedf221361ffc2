"""Meetings of blocks: what a task holds, and that it is all there."""

import numpy as np
import pyarrow as pa
from basket_spark.functions import vectors as vx
from basket_spark.operators import similarity
from pyspark.sql import functions as F


def test_a_strip_leaves_before_the_next_is_begun(spark, monkeypatch):
    """No call sees more pairs than a strip has, whatever the blocks; strips were of 512 rows and were held together."""
    monkeypatch.setattr(similarity, "STRIP_PAIRS", 3000)

    def sizes(one: pa.Table, two: pa.Table) -> pa.Table:
        return pa.table({"one": [one.num_rows], "two": [two.num_rows]})

    left, right = spark.range(700).withColumnRenamed("id", "k"), spark.range(900).withColumnRenamed("id", "other")
    got = similarity.in_blocks(left, right, "k", "other", sizes, "one long, two long").collect()
    assert sum(r.one * r.two for r in got) == 700 * 900
    assert max(r.one * r.two for r in got) <= 3000


def test_pairs_of_several_strips_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(similarity, "STRIP_PAIRS", 200)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "k int, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = {(i, j) for i, j in zip(*np.nonzero(np.round(1 - u @ u.T, 6) < 0.8), strict=True)}
    got = similarity.cosine_pairs(df, df.withColumnRenamed("k", "other"), "k", "other", below=0.8).collect()
    assert {(r.k, r.other) for r in got} == want and len(got) == len(want)


def test_length_of_a_vector_is_computed_once(spark):
    """It was an expression inside the lambda, so it was computed for each place: 2,000 places took 2,000 times as long."""
    df = spark.range(40).select(F.array(*[F.rand(i) + F.lit(i) for i in range(3)]).alias("v"), F.transform(F.sequence(F.lit(1), F.lit(20000)), lambda x: x.cast("double")).alias("w"))
    row = df.select(vx.unit(F.col("v")).alias("u"), vx.unit(F.col("w")).alias("z"), vx.unit(F.array(F.lit(0.0))).alias("none"), vx.unit(F.lit(None).cast("array<double>")).alias("null")).collect()[0]
    assert abs(sum(x * x for x in row.u) - 1) < 1e-12 and abs(sum(x * x for x in row.z) - 1) < 1e-9
    assert row.none is None and row.null is None
