"""Purchase cycles as a stream against those of all purchases at once, whatever the batches."""

import numpy as np
import pytest
from basket_spark.plans import cards
from basket_spark.streaming import cycles
from pyspark.sql import functions as F

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(PROVIDER)


@pytest.mark.parametrize("parts", [1, 4])
def test_the_same_in_any_batches(rocks, tmp_path, parts):
    rng = np.random.default_rng(parts)
    start = np.datetime64("2001-01-01")
    days = np.sort(rng.integers(0, 200, 150))
    rows = [(int(c), str(start + np.timedelta64(int(d), "D")), i, True) for i, (c, d) in enumerate(zip(rng.integers(0, 25, 150), days, strict=True))] + [(99, "2001-02-01", 900, True)]
    df = rocks.createDataFrame(rows, "customer_key long, day string, basket_key long, by_card boolean").withColumn("transaction_date", F.to_date("day"))
    want = {r.customer_key: r.cycle for r in cards.purchase_cycle(df, "2001-06-01", "2001-12-01").collect()}
    for i in range(parts):
        part = df.where(f"basket_key % {parts} = {i}") if parts == 1 else df.where((F.col("basket_key") * parts / 150).cast("int") == i) if i < parts - 1 else df.where((F.col("basket_key") * parts / 150).cast("int") >= i)
        part.select("customer_key", F.col("transaction_date").cast("timestamp").alias("ts"), "basket_key").write.parquet(f"{tmp_path}/in/{i}")
        stream = rocks.readStream.schema("customer_key long, ts timestamp, basket_key long").parquet(f"{tmp_path}/in/*")
        cycles.write_last_two(stream, "customer_key", "ts", "basket_key", f"{tmp_path}/out", f"{tmp_path}/check", delay="400 days").awaitTermination()
    assert {r.customer_key: r.cycle for r in cycles.cycles(rocks, f"{tmp_path}/out", "2001-06-01").collect()} == want


def test_keys_are_forgotten(rocks, tmp_path):
    """A key that the watermark is ``days`` past has no state: its next purchase is a first one."""
    for i, (key, day) in enumerate([(1, "2001-01-01"), (2, "2001-06-01"), (2, "2001-06-02"), (1, "2001-07-01")]):
        rocks.createDataFrame([(key, day, i)], "k long, d string, i long").select("k", F.to_timestamp("d").alias("ts"), "i").write.parquet(f"{tmp_path}/in/{i}")
        stream = rocks.readStream.schema("k long, ts timestamp, i long").parquet(f"{tmp_path}/in/*")
        cycles.write_last_two(stream, "k", "ts", "i", f"{tmp_path}/out", f"{tmp_path}/check", delay="1 day", days=30).awaitTermination()
    got = {r.customer_key: r.cycle for r in cycles.cycles(rocks, f"{tmp_path}/out", "2001-01-01").collect()}
    assert got == {1: 500, 2: 1}


def test_neighbouring_keys_share_a_state(rocks, tmp_path):
    """every customer had a state and a timer of its own, each fetched and written by calls of its own."""
    rows = rocks.range(640).selectExpr("id AS k", "explode(array(3, 1, 2, 3)) AS d").selectExpr("k", "timestamp_seconds(86400 * (10000 + d * (1 + k % 5))) AS ts", "10 * k + d AS i")
    rows.write.parquet(f"{tmp_path}/in")
    stream = rocks.readStream.schema("k long, ts timestamp, i long").parquet(f"{tmp_path}/in")
    query = cycles.write_last_two(stream, "k", "ts", "i", f"{tmp_path}/out", f"{tmp_path}/check")
    query.awaitTermination()
    assert 0 < query.lastProgress.stateOperators[0].numRowsTotal < 640
    assert {r.customer_key: r.cycle for r in cycles.cycles(rocks, f"{tmp_path}/out", "1990-01-01").collect()} == {k: 1 + k % 5 for k in range(640)}
