"""Nearest rows with clusters ruled out, against the product of all pairs."""

import numpy as np
import pytest
from basket_spark.operators import nearest, similarity


def frames(spark, centres, seed, n=300, m=900, d=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d)) * 4
    v = lambda k: [[float(x) for x in r] for r in middle[rng.integers(0, centres, k)] + rng.normal(size=(k, d)) * 0.3]
    left = [*enumerate(v(n)), (9000, [0.0] * d), (9001, None)]
    right = [*((i * 3, x) for i, x in enumerate(v(m))), (9000, None), (9002, [0.0] * d)]
    right += [(10_000 + i, right[0][1]) for i in range(40)]  # ties
    return spark.createDataFrame(left, "k int, embedding array<double>").repartition(3), spark.createDataFrame(right, "other int, embedding array<double>").repartition(4)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("centres", "seed"), [(12, 1), (1, 2)])
def test_the_same_as_all_pairs(spark, centres, seed, monkeypatch):
    left, right = frames(spark, centres, seed)
    want = rows(similarity.cosine_pairs(left, right, "k", "other", top=7))
    report = {}
    assert rows(nearest.nearest_rows(left, right, "k", "other", 7, report=report)) == want
    assert report["pairs"] == 300 * 30
    if centres > 1:  # where there are clusters most are ruled out
        assert report["met"] < 0.4 * report["pairs"]
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 20)
    assert rows(nearest.nearest_rows(left, right, "k", "other", 7, clusters=5)) == want


def test_few_rows(spark):
    left, right = frames(spark, 3, 4)
    few = right.where("other < 12")
    assert rows(nearest.nearest_rows(left, few, "k", "other", 50)) == rows(similarity.cosine_pairs(left, few, "k", "other", top=50))
    assert nearest.nearest_rows(left, right.limit(0), "k", "other", 5).count() == 0
    assert nearest.nearest_rows(left.limit(0), right, "k", "other", 5).count() == 0


def test_cosines_of_sparse_terms(spark, monkeypatch):
    """By an inverted index, in parts of any size, against a dense product; a substitute's score by its terms alone."""
    import pyarrow as pa
    from basket_spark.plans import substitutes

    rng = np.random.default_rng(6)

    def vectors(n):
        out = []
        for _ in range(n):
            w = {f"t{i}": float(x) for i, x in zip(rng.choice(30, rng.integers(1, 9), replace=False), rng.random(9), strict=False)}
            norm = sum(x * x for x in w.values()) ** 0.5
            out.append([{"token": t, "weight": x / norm} for t, x in sorted(w.items())])
        return out

    kind = pa.list_(pa.struct([("token", pa.string()), ("weight", pa.float64())]))
    one, two = vectors(40), vectors(25)
    dense = np.array([[1 - sum(x["weight"] * y["weight"] for x in a for y in b if x["token"] == y["token"]) for b in two] for a in one])
    column = lambda rows: pa.chunked_array([pa.array(rows[:7], kind), pa.array(rows[7:], kind)])
    for size in (1 << 20, 5):
        monkeypatch.setattr(substitutes, "MEETINGS", size)
        assert np.allclose(substitutes._cosine_of_terms(column(one), column(two)), dense)
    assert np.allclose(substitutes._cosine_of_terms(column([]), column(two)), np.zeros((0, 25)))
    assert np.allclose(substitutes._cosine_of_terms(column(one), column([[] for _ in range(3)])), 1)
    names = ["red apple box", "red apple bag", "green pear", "pear green box", "apple"]
    p = spark.createDataFrame([(i, "c", [1.0, 0.0], [0], "u", None, 1.0, n) for i, n in enumerate(names)], "ean int, category string, embedding array<double>, flags array<int>, unit string, container string, price_index double, nm string")
    terms = substitutes.name_terms(p)
    got = {(r.ean, r.substitute): r.score for r in substitutes.substitutes(p.join(terms, "ean"), None, {"tfidf": 1.0}).collect()}
    by = {r.ean: {t.token: t.weight for t in r.terms} for r in terms.collect()}
    assert got == {(a, b): pytest.approx(1 - sum(w * by[b].get(t, 0) for t, w in by[a].items()), abs=1e-6) for a in by for b in by if a != b}
