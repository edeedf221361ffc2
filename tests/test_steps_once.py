"""Steps that several parts of a query read are computed once, and no list is longer than it need be."""

from basket_spark import queries, queries_allocation
from basket_spark.plans import usuals
from basket_spark.sources import shared
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def test_own_brand_has_one_substitute_a_product(spark, monkeypatch):
    """Every own-brand product of a sub-category was joined to every product of it."""
    seen = []
    monkeypatch.setattr(usuals, "own_brand_candidates", lambda usual, products, substitutes, own: seen.append(substitutes))
    queries_allocation._own_brand(spark, DIR, queries._usuals(spark, DIR))
    assert seen[0].groupBy("ean").agg(F.count("*").alias("n")).where("n > 1").count() == 0


def test_daily_sales_are_written_once(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(queries, "stored", lambda df, label: labels.append(label) or shared.stored(df, label))
    plan = queries._monthly(spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert labels == ["daily"] and "lineitem" not in plan
