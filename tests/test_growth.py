"""What a step sends, holds and writes doesn't grow faster than its input; each finding's query by the plan or the rows of it."""

import pyarrow as pa
from basket_spark import queries_pricing
from basket_spark.operators import similarity
from basket_spark.plans import ingests, pricing, usuals
from basket_spark.sources import incremental, shared
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.01"


def test_calendar_flags_are_not_sent_to_the_fit(spark):
    """sixty columns of flags went to a task for each product. Also a product's days may lie in several batches."""
    features = queries_pricing._features(spark, DIR, "ELASTICITY").where("ean % 40 = 7").localCheckpoint()
    whole = {tuple(r) for r in pricing.product_elasticity(features, 6).collect()}
    flags = [c for c in features.columns if c.startswith(("weekday_", "month_"))] + pricing.MODEL_HOLIDAYS
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert {tuple(r) for r in pricing.product_elasticity(features.drop(*flags), 6).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r[0] for r in whole}) == len(whole) > 3


def test_what_is_known_of_a_product_is_written_not_its_days(spark, monkeypatch):
    """The sales were joined and shuffled for each step that reads them."""
    labels = []
    monkeypatch.setattr(queries_pricing, "stored", lambda df, label: labels.append(label) or shared.stored(df, label))
    plan = queries_pricing._matrix(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert labels == ["sold", "known"] and "lineitem" not in plan


def test_groups_share_the_blocks(spark):
    """Each of many groups was cut into as many blocks as there are tasks, and the other side sent to all of them."""
    tasks = spark.sparkContext.defaultParallelism
    df = spark.range(16 * 2 * similarity.LEAST_ROWS).select("id", (F.col("id") % 16).alias("g"))
    compute = lambda one, two: pa.table({"i": pa.array([one.num_rows], pa.int64())})
    met = similarity.in_blocks(df, df, "id", "id", compute, "i long", "g", strip=1 << 20)
    assert met.count() <= tasks + 16
    assert met.agg(F.sum("i")).first()[0] == df.count()


def test_months_before_need_no_copies(spark):
    """every month was sent to the three after it and joined back."""
    rows = [(1, "2000-01-10", 2.0), (1, "2000-02-10", 4.0), (1, "2000-04-10", 6.0), (1, "2000-08-10", 1.0), (1, None, 9.0), (2, "2000-02-10", 5.0)]
    daily = spark.createDataFrame(rows, "ean long, day string, price double").withColumn("date", F.to_date("day"))
    out = pricing.previous_months_price(daily)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.ean, r.month): (r.previous_price, r.change) for r in out.collect()}
    month = lambda m: 2000 * 12 + m
    assert got == {(1, None): (None, None), (1, month(1)): (None, None), (1, month(2)): (2.0, 1.0), (1, month(4)): (3.0, 1.0), (1, month(8)): (None, None), (2, month(2)): (None, None)}


def test_new_ids_are_dealt_out_and_sorted_once(spark):
    """the source was sorted for the join and again for the least rows, in as few tasks as hold 64 MB of compressed rows."""
    source = spark.range(400).selectExpr("id % 200 AS k", "id AS v")
    out = incremental.new_by_id(source.union(source), source.where("k < 50").hint("merge"), "k")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count(" Sort [") == 2  # one of either side
    assert sorted(tuple(r) for r in out.collect()) == [(k, k) for k in range(50, 200)]


def test_availability_is_dealt_out_before_it_is_combined(spark):
    """each task combined what it read, few rows of which have a group in common, and few tasks did the rest."""
    rows = [("2000-01-01", "a-1", 1, True), ("2000-01-01", "a-2", 1, False), ("2000-01-01", "a", 2, True), ("2000-01-02", "a", 1, None), ("2000-01-02", None, 1, True), ("2000-01-02", "x" * 19, 1, True), ("2000-01-01", "b", None, False)]
    out = ingests.catalog_availability({"one": spark.createDataFrame(rows, "date string, ref_id string, store_id long, available boolean")})
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {(r.date, r.ref_id, r.store_id): (r.inweb, r.store_banner) for r in out.collect()}
    assert got == {("2000-01-01", "a", 1): (0.5, "one"), ("2000-01-01", "a", 2): (1.0, "one"), ("2000-01-02", "a", 1): (None, "one"), ("2000-01-01", "b", None): (0.0, "one")}


def test_scores_are_dealt_out_once(spark):
    """lines were combined three times, the first in the task that had sorted them for a join."""
    rows = [(1, 7, 100, "2001-06-25"), (1, 7, 100, "2001-06-25"), (1, 7, 101, "2001-06-26"), (1, 8, 101, "2001-06-18"), (None, 7, 102, "2001-06-30")]
    sales = spark.createDataFrame(rows, "customer_key long, ean long, txn_key long, day string").withColumn("transaction_date", F.to_date("day"))
    out = usuals.recency_score(sales, "2001-07-01")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
    assert {(r.customer_key, r.ean): r.score for r in out.collect()} == {(1, 7): 2.0, (1, 8): 0.63093, (None, 7): 1.0}


def test_days_go_along_with_their_months(spark, monkeypatch):
    """F8: daily sales were shuffled for the price, the value, the first month and the last join of each product and month."""
    seen = []
    monkeypatch.setattr(pricing, "stored", lambda df, label: seen.append((label, df)) or shared.stored(df, label))
    days = [(e, "s" if e < 3 else "t", f"2000-{m:02}-{d:02}", float(e + m), float(m)) for e in (1, 2, 3) for m in range(1, 7) for d in (1, 15)] + [(None, "s", "2000-05-01", 1.0, 1.0), (1, "s", None, 1.0, 1.0)]
    daily = spark.createDataFrame(days, "ean long, sub_category string, day string, price double, value double").withColumn("date", F.to_date("day")).drop("day")
    out = pricing.regression_features(daily)
    assert [label for label, _ in seen] == ["monthly"]
    assert seen[0][1]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
    got = {(r.ean, str(r.date)): (r.previous_price, r.change, r.others_change) for r in out.collect()}
    assert len(got) == 3 * 3 * 2
    for (e, day), (before, change, others) in got.items():
        m = int(day[5:7])
        want = {x: sum(x + k for k in range(m - 3, m)) / 3 for x in (1, 2, 3)}
        assert m > 3 and abs(before - want[e]) < 1e-9 and abs(change - (e + m - want[e]) / want[e]) < 1e-9
        assert abs(others - (0 if e == 3 else (3 - e + m - want[3 - e]) / want[3 - e])) < 1e-9
