"""Gates in the load itself, slices, distinct counts by bitmaps, final windows."""

import datetime as dt
import uuid

import numpy as np
import pytest
from basket_spark.operators import aggregates
from basket_spark.sources import quality, tables
from basket_spark.streaming import push_events
from pyspark.sql import functions as F


def spec_of(df, by=()):
    return tables.TableSpec(f"default.t_{uuid.uuid4().hex}", df.schema, list(by))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_load_that_passes_its_gates(spark):
    df = spark.createDataFrame([(i, f"n{i}", None) for i in range(50)], "id int, name string, note string")
    spec = spec_of(df)
    assert quality.gated_load(df, spec, ["id"], ["name"]) == 50
    assert rows(spark.table(spec.name)) == rows(df)
    assert quality.gated_load(df.where("id < 3"), spec, ["id"], []) == 3
    assert spark.table(spec.name).count() == 3
    more = df.withColumn("id", F.col("id") + 100)
    assert quality.gated_load(more, spec, ["id"], [], if_exists="append") == 50
    assert spark.table(spec.name).count() == 53


@pytest.mark.parametrize(("bad", "says"), [([(1, "a"), (1, "b")], "more than once"), ([(1, None)], "nulls: {'name': 1}"), ([(None, "a"), (None, "b")], "nulls: {'id': 2}"), ([], "0 rows, not 1"), ([(1, "a"), (1, "a")], "more than once")])
def test_a_failing_gate_leaves_the_table(spark, bad, says):
    good = spark.createDataFrame([(7, "x")], "id int, name string")
    spec = spec_of(good)
    quality.gated_load(good, spec, ["id"], ["name"])
    with pytest.raises(ValueError, match=says):
        quality.gated_load(spark.createDataFrame(bad, good.schema), spec, ["id"], ["name"])
    assert rows(spark.table(spec.name)) == [(7, "x")]
    with pytest.raises(ValueError, match="columns missing"):
        quality.gated_load(good.drop("name"), spec, ["id"], [])


def test_the_source_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(count, "id long")
    quality.gated_load(df, spec_of(df), ["id"], [])
    assert seen.value == 1000


def test_slices(spark):
    df = spark.createDataFrame([(i, y, "old") for i in range(30) for y in (1, 2, 3)], "id int, year int, what string")
    new = df.where("year = 2 AND id < 5").withColumn("what", F.lit("new"))
    for by, where in (([], "year IN (2, 3)"), (["year"], "year IN (2, 3)"), (["year"], "year IN (2, 3) AND what <> 'x'"), (["year"], "year > 1")):
        spec = spec_of(df, by)
        tables.write_table(df, spec, "append")
        for _ in range(2):
            tables.overwrite_slice(new, spec, where)
            assert rows(spark.table(spec.name).select(df.columns)) == rows(df.where("year = 1").union(new))
        tables.overwrite_slice(new.limit(0), spec, where)
        assert rows(spark.table(spec.name).select(df.columns)) == rows(df.where("year = 1"))
    names = {t.name for t in spark.catalog.listTables("default")}
    assert not [n for n in names if "_new_" in n or "_old_" in n]


def test_partitions_that_stay_are_not_written(spark):
    import os

    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, part int")
    spec = spec_of(df, ["part"])
    tables.write_table(df, spec, "append")
    at = spark.sql(f"DESCRIBE EXTENDED {spec.name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    files = lambda: {p: sorted(os.listdir(f"{at}/part={p}")) for p in (0, 1)}
    before = files()
    tables.overwrite_slice(df.where("part = 2").limit(1), spec, "part = 2")
    assert files() == before
    assert spark.table(spec.name).where("part = 2").count() == 1


def test_rolling_distinct(spark):
    rng = np.random.default_rng(8)
    data = [(str(g), int(p), int(v)) for g, p, v in zip(rng.choice(["a", "b"], 3000), rng.integers(5, 30, 3000), rng.choice([*range(1, 60), 32768, 32769, 10**9, -4, 0], 3000), strict=True) if not (g == "b" and 10 < p < 20)]
    data += [("c", 7, None), ("c", None, 3), (None, 9, 1), ("d", 29, 5)]
    df = spark.createDataFrame(data, "g string, p int, v long")
    windows = [1, 3, 12]
    got = {(r.g, r.period): [r[f"distinct_{w}"] for w in windows] for r in aggregates.rolling_distinct(df, ["g"], F.col("p"), F.col("v"), windows).collect()}
    known = [(g, p, v) for g, p, v in data if p is not None and v is not None]
    last = max(p for _, p, _ in known)
    want = {}
    for g in {g for g, *_ in known}:
        for at in range(min(p for x, p, _ in known if x == g), last + 1):
            counts = [len({v for x, p, v in known if x == g and at - w < p <= at}) for w in windows]
            if any(counts):
                want[g, at] = counts
    assert got == want


def test_final_windows_are_written_once(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    for i, hours in enumerate(([0, 1, 2], [2, 3, 4], [9])):
        rows_ = [(i * 100 + k, start + dt.timedelta(hours=h, minutes=m), "x") for k, (h, m) in enumerate((h, m) for h in hours for m in (5, 25))]
        spark.createDataFrame(rows_, "id int, ts timestamp, kind string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        events = push_events.read_events(spark, f"{tmp_path}/in/*", "id int, ts timestamp, kind string")
        push_events.write_final_counts(push_events.windowed_counts(events, "ts", "kind"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = {(r.window_start.hour, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(0, 2), (1, 2), (2, 4), (3, 2), (4, 2)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
