"""K-means in one dimension against all cuts, the rules of brand classes against a plain reading of them, global ranks."""

from itertools import combinations

import numpy as np
import pytest
from basket_spark.operators import kmeans, ranking
from basket_spark.plans import allocation, pricing, sophistication
from pyspark.sql import functions as F


def all_cuts(x, n, k):
    """The best cuts of sorted distinct values by trying all of them; of equal costs the lowest from the top."""
    found = []
    for cuts in combinations(range(1, len(x)), k - 1):
        runs = [np.arange(a, b) for a, b in zip([0, *cuts], [*cuts, len(x)], strict=True)]
        cost = sum((n[r] * (x[r] - np.average(x[r], weights=n[r])) ** 2).sum() for r in runs)
        found.append((cost / n.sum() / (x[-1] - x[0]) ** 2, cuts[::-1]))
    least = min(c for c, _ in found)
    return list(min(cuts for c, cuts in found if c <= least + 1e-12)[::-1])


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_cuts_are_the_best(k):
    rng = np.random.default_rng(k)
    for i in range(60):
        m = int(rng.integers(k + 1, 13))
        x = np.sort(rng.choice(30, m, replace=False)).astype(float) if i % 2 else np.sort(rng.lognormal(0, 1, m))
        n = rng.integers(1, 5, m).astype(float)
        assert kmeans.best_cuts(x, n, k) == all_cuts(x, n, k)
    assert kmeans.best_cuts(np.arange(k, dtype=float), np.ones(k), k) == list(range(1, k))


def test_steps_would_end_elsewhere():
    """Long-tailed values, where Lloyd's steps from quantiles are far from done after five."""
    x = np.sort(np.random.default_rng(0).lognormal(0, 1, 20_000))
    c = np.quantile(x, [1 / 6, 1 / 2, 5 / 6])
    for _ in range(5):
        c = np.array([x[np.abs(x[:, None] - c).argmin(1) == i].mean() for i in range(3)])
    cost = lambda c: (np.abs(x[:, None] - c).min(1) ** 2).sum()
    starts = [0, *kmeans.best_cuts(x, np.ones(len(x)), 3)]
    best = np.add.reduceat(x, starts) / np.diff([*starts, len(x)])
    assert cost(best) < 0.95 * cost(c)


def test_groups_of_any_kind(spark):
    rng = np.random.default_rng(7)
    rows = [(g, float(v)) for g in ("a", "b", None) for v in rng.gamma(2, 1, 300)] + [("c", 4.0)] * 5 + [("d", None), ("e", 1.0), ("e", 2.0), ("a", None)]
    got = kmeans.kmeans_1d(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    assert len(got) == len(rows)
    for g in ("a", "b"):
        own = sorted((r.v, r.cluster) for r in got if r.g == g and r.v is not None)
        x = np.array([v for v, _ in own])
        cuts = kmeans.best_cuts(x, np.ones(len(x)), 3)
        assert [k for _, k in own] == [sum(i >= c for c in cuts) for i in range(len(x))]
    assert {r.cluster for r in got if r.v is None} == {None}
    assert {r.cluster for r in got if r.g == "c"} == {0}
    assert sorted((r.v, r.cluster) for r in got if r.g == "e") == [(1.0, 0), (2.0, 1)]


def test_values_beyond_the_percentiles_dont_form_clusters(spark):
    x = [0.0] + [1.0] * 20 + [5.0] * 20 + [9.0] * 20 + [1000.0]
    got = kmeans.kmeans_1d(spark.createDataFrame([(v,) for v in x], "v double"), [], "v", trim=(0.01, 0.99))
    assert {(r.v, r.cluster) for r in got.collect()} == {(0.0, 0), (1.0, 0), (5.0, 1), (9.0, 2), (1000.0, 2)}


def test_large_groups_fall_into_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(0, 1, 3000), rng.normal(10, 1, 3000), rng.normal(30, 2, 3000)))
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    want = np.array(kmeans.centres_1d(df, [], "v", 3).first().centres)
    monkeypatch.setattr(kmeans, "EXACT", 500)
    assert np.allclose(kmeans.centres_1d(df, [], "v", 3).first().centres, want, atol=0.02)


def brand_class(values, min_sep=0.04, k=3):
    """The class of each value of a category by the rules, one after the other; None without classes."""
    if len(values) < 3:
        return [None] * len(values)
    x = np.array(values)
    logs = np.log(x[x > 0])
    odd = False
    if len(logs) >= 4:
        q1, q3 = np.quantile(logs, [0.25, 0.75])
        odd = bool(((logs < q1 - 1.5 * (q3 - q1)) | (logs > q3 + 1.5 * (q3 - q1))).any())
    lo, hi = np.quantile(x, [0.05, 0.95])
    fit = x[(x > lo) & (x < hi)] if odd else x
    for clusters in (3, 2):
        u, n = np.unique(fit, return_counts=True)
        if len(u) < clusters:
            continue
        starts = all_cuts(u, n.astype(float), clusters)
        runs = [np.repeat(u[a:b], n[a:b]) for a, b in zip([0, *starts], [*starts, len(u)], strict=True)]
        medians, centres = [np.median(r) for r in runs], np.array([r.mean() for r in runs])
        if not all((b - a) / a >= min_sep for a, b in zip(medians, medians[1:], strict=False)):
            continue
        place = [int(np.abs(v - centres).argmin()) for v in values]
        if clusters == 3:
            return [p + 1 for p in place]
        return [p + 2 for p in place] if len(runs[0]) >= len(runs[1]) else [p + 1 for p in place]
    return [None] * len(values)


def test_brand_classes(spark):
    rng, groups = np.random.default_rng(11), {}
    groups["far"] = [1.0, 1.01, 1.02, 2.0, 2.02, 3.0, 3.01]
    groups["larger is cheap"] = [1.0, 1.0, 1.01, 1.5, 1.5]
    groups["larger is dear"] = [1.0, 1.0, 1.5, 1.51, 1.5]
    groups["as many"] = [1.0, 1.0, 1.5, 1.5]
    groups["near"] = [1.0, 1.001, 1.002, 1.003]
    groups["one value"] = [1.0] * 6
    groups["few"] = [1.0, 5.0]
    groups["outlier"] = [*(1.0 + i / 50 for i in range(30)), 50.0, 0.01]
    groups["outlier of a small one"] = [1.0, 1.1, 9.0]
    for i in range(12):
        groups[f"random {i}"] = [float(v) for v in rng.lognormal(0, rng.choice([0.02, 0.1, 0.5, 1.5]), rng.integers(3, 20))]
    rows = [(g, i, v) for g, own in groups.items() for i, v in enumerate(own)] + [("few", 9, None)]
    got = kmeans.adaptive_kmeans(spark.createDataFrame(rows, "category string, i int, v double"), ["category"], "v")
    got = {(r.category, r.i): r.cluster for r in got.collect()}
    assert len(got) == len(rows)
    for g, own in groups.items():
        assert [got[g, i] for i in range(len(own))] == brand_class(own), g
    assert got["few", 9] is None
    assert [got["larger is cheap", i] for i in range(5)] == [2, 2, 2, 3, 3]
    assert [got["larger is dear", i] for i in range(5)] == [1, 1, 2, 2, 2]
    assert [got["near", i] for i in range(4)] == [None] * 4


def test_brand_segments_are_named(spark):
    rows = [("c", f"b{i}", v) for i, v in enumerate([1.0, 1.0, 2.0, 3.0, 3.0])] + [("d", "own", 1.0), ("d", "other", 2.0)]
    got = sophistication.brand_segments(spark.createDataFrame(rows, "category string, brand string, hm_pu_ppum double"), own="own")
    assert {(r.category, r.brand): r.segment for r in got.collect()} == {("c", "b0"): "ECONOMY", ("c", "b1"): "ECONOMY", ("c", "b2"): "MAINSTREAM", ("c", "b3"): "PREMIUM", ("c", "b4"): "PREMIUM", ("d", "own"): "MPES", ("d", "other"): "UNCLASSIFIED"}


def test_forced_roles(spark):
    sales = spark.createDataFrame([(i, "c", f"f{i}", float(i)) for i in range(1, 13)], "ean int, category string, family string, value double")
    plain = {r.ean: r.role for r in pricing.product_sensitivity(sales, high_categories=0, all_categories=0).collect()}
    by_hand = spark.createDataFrame([(1, "KVI"), (12, "BKG"), (2, None), (3, "KVI"), (3, "KCI"), (99, "KVI")], "ean int, role string")
    got = {r.ean: r.role for r in pricing.product_sensitivity(sales, high_categories=0, all_categories=0, forced_roles=by_hand).collect()}
    assert (plain[1], plain[12]) == ("BKG", "KVI")
    assert got == plain | {1: "KVI", 12: "BKG", 3: "KCI"}


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank"])
def test_global_ranks(spark, kind):
    rng = np.random.default_rng(2)
    rows = [(int(a), None if b == 5 else int(b), "x") for a, b in rng.integers(0, 6, (400, 2))] + [(3, 3, "x")] * 200 + [(None, 1, "y"), (None, 1, "y")]
    df = spark.createDataFrame(rows, "a int, b int, `odd name` string").repartition(7)
    got = ranking.global_rank(df, {"a": "desc", "b": "asc"}, "n", kind)
    assert got.columns == ["a", "b", "odd name", "n"]
    key = lambda r: ((r[0] is None, -(r[0] or 0)), (r[1] is not None, r[1] or 0))  # noqa: E731  nulls last descending, first ascending
    ordered = sorted(rows, key=key)
    numbers = {"row_number": list(range(1, len(rows) + 1)), "rank": [1 + sum(key(o) < key(r) for o in ordered) for r in ordered], "dense_rank": [1 + len({key(o) for o in ordered if key(o) < key(r)}) for r in ordered]}[kind]
    found = sorted(((*r[:2], r.n) for r in got.collect()), key=lambda r: r[2])
    assert found == [(*r[:2], n) for r, n in zip(ordered, numbers, strict=True)]


def test_global_rank_has_no_window_of_all_rows(spark):
    df = spark.range(1000).selectExpr("id % 7 AS a", "id")
    for kind in ("row_number", "dense_rank"):
        plan = ranking.global_rank(df, {"a": "asc"}, "n", kind)._jdf.queryExecution().toString()
        assert "SinglePartition" not in plan
    assert ranking.global_rank(df.limit(0), {"a": "asc"}).count() == 0
    with pytest.raises(ValueError, match="asc or desc"):
        ranking.global_rank(df, {"a": "up"})


def test_equally_often_bought_products_come_by_distance(spark):
    """Dense ranks leave the order of what was bought as often to the distance, not to the code."""
    rows = [("c", ean, sub, sub, dist, n, rank, 1) for ean, sub, dist, n, rank in ((1, "s1", 0.9, 3, 1), (2, "s2", 0.1, 3, 1), (3, "s3", 0.5, 2, 2), (4, "s4", 0.05, 2, 2))]
    df = spark.createDataFrame(rows, "customer_key string, ean int, sub_category string, category string, distance double, n_purchases int, relevance_ean int, relevance_group int")
    got = allocation.personalized_products(df).orderBy("relevance").collect()
    assert [r.ean for r in got] == [2, 1, 4, 3]


def test_ranks_of_purchases_are_dense(spark):
    from basket_spark import queries_allocation as q

    d = "/root/testdata/sf0.001"
    near = q._candidates(spark, d, q._this_month(spark, d)).where(F.col("relevance_ean").isNotNull())
    by = near.groupBy("customer_key", "n_purchases").agg(F.count_distinct("relevance_ean").alias("ranks"), F.count("*").alias("n"))
    assert by.agg(F.max("ranks"), F.max("n")).first()[0] == 1
    assert by.agg(F.max("n")).first()[0] > 1


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_centres_of_large_groups_are_those_of_all_values(spark, monkeypatch, k):
    """values of groups beyond a size fell into cells that weren't cut, so the centres came out elsewhere."""
    rng = np.random.default_rng(k)
    groups = {"a": rng.gamma(2, 1, 900), "b": np.round(rng.normal(0, 1, 700), 2), "c": np.concatenate((rng.normal(0, 1e-6, 300), rng.normal(5, 1e-6, 200), [900.0])), None: rng.random(800), "d": np.arange(60.0)}
    rows = [(g, float(v)) for g, own in groups.items() for v in own]
    df = spark.createDataFrame(rows, "g string, v double")
    monkeypatch.setattr(kmeans, "EXACT", 40)
    monkeypatch.setattr(kmeans, "CELLS", 16)
    got = {r.g: r.centres for r in kmeans.centres_1d(df, ["g"], "v", k).collect()}
    assert set(got) == set(groups)
    for g, own in groups.items():
        x, n = np.unique(own, return_counts=True)
        starts = [0, *kmeans.best_cuts(x, n.astype(float), k)]
        assert got[g] == pytest.approx((np.add.reduceat(x * n, starts) / np.add.reduceat(n, starts)).tolist(), rel=1e-12)
    x = np.sort([v for _, v in rows])
    (whole,) = kmeans.centres_1d(df.select("v"), [], "v", k).collect()
    x, n = np.unique(x, return_counts=True)
    starts = [0, *kmeans.best_cuts(x, n.astype(float), k)]
    assert whole.centres == pytest.approx((np.add.reduceat(x * n, starts) / np.add.reduceat(n, starts)).tolist(), rel=1e-12)


def test_no_cut_of_least_cost_is_closed():
    rng = np.random.default_rng(6)
    for i in range(40):
        x, k = np.sort(rng.lognormal(0, 1, 60)), 2 + i % 3
        cell = np.minimum((x - x[0]) / (x[-1] - x[0]) * 12, 11).astype(int)
        w, z = np.full(60, 1 / 60), (x - x[0]) / (x[-1] - x[0])
        own = np.unique(cell, return_inverse=True)[1]
        may = kmeans._open(kmeans._Runs(*(np.bincount(own, v) for v in (w, w * z, w * z * z))), k)
        assert all(may[own[c - 1]] and may[own[c]] for c in kmeans.best_cuts(x, np.ones(60), k))
