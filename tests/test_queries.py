"""Every query with SQL against DuckDB on the smallest tables; the others for their properties."""

import math
from pathlib import Path

import duckdb
import pytest
from basket_spark import queries_allocation, queries_pricing, retail

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return v


@pytest.mark.parametrize("name", sorted(retail.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = retail.all_queries()[name](spark, DIR)
    result = duck.execute(retail.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(norm(r[columns.index(c)]) for c in df.columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(map(norm, r)) for r in df.collect()), key=repr) == want


def test_personalized_products_keep_their_caps(spark):
    rows = queries_allocation.personalized_products(spark, DIR).collect()
    by = {}
    for r in rows:
        by.setdefault(r.customer_key, []).append(r)
    assert rows
    for own in by.values():
        assert sorted(r.relevance for r in own) == list(range(1, len(own) + 1))
        assert len(own) <= 35
        assert len({r.ean for r in own}) == len(own)
        for column, most in (("sub_category", 1), ("category", 3)):
            values = [getattr(r, column) for r in own if r.origin == 0]
            assert all(values.count(v) <= most for v in values)


def test_own_brand_injection(spark):
    rows = queries_allocation.own_brand_injection(spark, DIR).collect()
    by = {}
    for r in rows:
        by.setdefault(r.customer_key, []).append(r)
    for own in by.values():
        assert {r.relevance for r in own} == set(range(1, len({r.relevance for r in own}) + 1))  # dense: equal places stay equal
        assert len({r.ean for r in own}) == len(own)
        assert sum(r.injected for r in own) <= 5


@pytest.mark.parametrize("name", ["product_elasticity", "w2v_neighbours"])
def test_others_give_rows(spark, name):
    assert retail.all_queries()[name](spark, DIR).limit(1).count() == 1


def test_elasticities_are_those_of_a_plain_fit(spark):
    """Each product by itself with numpy, from the features as rows."""
    import numpy as np
    from basket_spark.plans import pricing

    features = queries_pricing._features(spark, "/root/testdata/sf0.01", "ELASTICITY").where("ean % 40 = 7")
    got = {r.ean: r for r in pricing.product_elasticity(features, least_days=9).collect()}
    by = {}
    for r in features.where("price > 0 AND quantity > 0").collect():
        by.setdefault(r.ean, []).append(r)
    assert set(got) == set(by)
    fitted = 0
    for ean, rows in by.items():
        kept = [r for r in rows if r.quantity >= np.mean([x.quantity for x in rows]) / 10]
        if len(kept) < 9:
            assert (got[ean].elasticity, got[ean].status, got[ean].n) == (None, pricing.INFEASIBLE, None)
            continue
        names = [f"weekday_{k}" for k in range(1, 7)] + ["year_2000", "year_2001", "slow_day", *pricing.MODEL_HOLIDAYS, "promo", "others_change"]
        columns = [[r[n] for r in kept] for n in names]
        december = [r["month_12"] for r in kept]
        terms = [c for n, c in zip(names, columns, strict=True) if len(set(c)) > 1 and not (n.startswith("year_") and c == december)]
        days = {m: {r.date for r in kept if r.date.month == m} for m in range(1, 13)}
        if all(len(d) >= 5 for d in days.values()):
            terms += [[r[f"month_{m}"] for r in kept] for m in range(2, 13)]
        terms += [[r[n] for r in kept] for n in ("top1", "top3") if all(r[n] is not None for r in kept)]
        x = np.column_stack([np.ones(len(kept)), np.log([r.price for r in kept]), *terms]).astype(float)
        y = np.log([r.quantity for r in kept])
        order = sorted({r.date for r in kept})
        root = np.sqrt([order.index(r.date) + 1 for r in kept])
        beta = np.linalg.pinv(x * root[:, None]) @ (y * root)
        near = np.mean([abs(r.price / np.mean([z.price for z in rows]) - 1) <= 0.05 for r in rows])
        assert got[ean].n == len(kept)
        if near > 0.9:
            assert got[ean].status == pricing.FLAT
        elif abs(beta[1]) > 1e-6:
            assert got[ean].status == ("own" if beta[1] < 0 else pricing.POSITIVE)
            assert beta[1] > 0 or got[ean].elasticity == pytest.approx(beta[1], abs=0.0051)
            fitted += 1
    assert fitted > 3


def test_customers_and_products_of_all_ids_meet(spark):
    near = queries_allocation._near(spark, DIR, queries_allocation._customers(spark, DIR))
    keys = near.selectExpr("customer_key % 10 AS c", "ean % 5 AS e").distinct().collect()
    assert len({r.c for r in keys}) > 5
    assert {r.e for r in keys} == {0, 1, 2, 3, 4}


def test_own_brand_recommended_and_not_bought_goes(spark):
    from basket_spark import binding

    pairs = lambda df: {(r.customer_key, r.ean) for r in df.select("customer_key", "ean").collect()}
    bought = pairs(binding.sales(spark, DIR).where("transaction_date >= DATE '2001-06-01'"))
    stale = pairs(queries_allocation._own_brand(spark, DIR, "2001-06-01")) - bought
    assert stale & pairs(queries_allocation._own_brand(spark, DIR, binding.ON_DATE))
    assert not stale & pairs(queries_allocation.own_brand_injection(spark, DIR).where("injected"))


def test_neighbours_have_the_products_own_ids(spark, monkeypatch):
    """On the next size, which has more products than 200; in several blocks, with the production parameters."""
    from basket_spark.operators import skipgram

    seen = []
    train = skipgram.train
    monkeypatch.setattr(skipgram, "train", lambda *a, **k: seen.append(a) or train(*a[:3], 1, *a[4:], **k, blocks=2))  # an epoch will do for the ids
    rows = queries_allocation.w2v_neighbours(spark, "/root/testdata/sf0.01").select("sku").distinct().collect()
    assert max(int(r.sku) for r in rows) >= 200
    assert seen[0][2:8] == (100, 10, 100, 5, 20, -0.5)
