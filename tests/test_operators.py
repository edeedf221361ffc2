"""Small cases with results worked out by hand."""

import datetime as dt

import numpy as np
import pytest
from basket_spark.functions import dates, text
from basket_spark.functions import vectors as vx
from basket_spark.operators import aggregates, joins, kmeans, metrics, quantiles, ranking, regression, similarity
from basket_spark.plans import cards, customers, pricing, substitutes
from basket_spark.sources import incremental, quality, readers, sheets, tables
from basket_spark.streaming import push_events
from pyspark.sql import functions as F


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_months(spark):
    assert dates.first_of_window(202003, 5) == 201911
    row = spark.sql("SELECT 202401 AS m, DATE '2024-01-07' AS sun, DATE '2024-01-08' AS mon").select(dates.add_months(F.col("m"), -2).alias("a"), dates.iso_week_difference(F.col("mon"), F.col("sun")).alias("w"), dates.staged_timestamp(F.lit("Jan  2 2024  3:04PM")).alias("t"), dates.us_timestamp(F.lit("1/2/2024 03:04:05 PM")).alias("u"), dates.us_timestamp(F.lit("x")).alias("n")).first()
    assert tuple(row) == (202311, 1, dt.datetime(2024, 1, 2, 15, 4), dt.datetime(2024, 1, 2, 15, 4, 5), None)


def test_text(spark):
    df = spark.createDataFrame([("  ¡Piña Colada!  500ml ",), ("---",), (None,)], "t string")
    assert [r[0] for r in df.select(text.normalize_text(F.col("t"))).collect()] == ["pina_colada_500ml", None, None]
    assert [r[0] for r in df.select(text.split_tokens(F.col("t"))).collect()][:2] == ["¡ pi a colada ! 500 ml", "---"]
    assert df.select(text.normalize_text(F.col("t"), first_word=True)).first()[0] == "pina"
    nested = spark.sql("SELECT named_struct('who', 'x', 'at', named_struct('place', named_struct('row', 7), 'day', 2)) AS s").select("s.*")
    assert text.flatten(nested).first().asDict() == {"who": "x", "at_place_row": 7, "at_day": 2}


def test_vectors(spark):
    df = spark.createDataFrame([([1, 0, 1], [1, 0, 1]), ([1, 1, 1], [0, 0, 0]), ([0, 0, 0], [0, 0, 0]), ([1, 0, 0], None)], "a array<int>, b array<int>")
    assert [round(r[0], 6) for r in df.select(vx.rogers_tanimoto(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, 0.0, 0.5]
    assert [None if r[0] is None else round(r[0], 6) for r in df.limit(3).select(vx.cosine_distance(F.col("a"), F.col("b"))).collect()] == [0.0, None, None]


def test_not_in_with_nulls(spark):
    a, none = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([], "o int")
    assert values(joins.not_in(a, "k", spark.createDataFrame([(1,)], "o int"), "o"), "k") == [(2,)]
    assert joins.not_in(a, "k", spark.createDataFrame([(1,), (None,)], "o int"), "o").count() == 0
    assert joins.not_in(a, "k", none, "o").count() == 3
    with pytest.raises(ValueError, match="share one column"):
        joins.natural_join(a, none)


def test_sequential_caps(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "x", 2), (1, "b", "x", 3), (1, "c", "y", 4)], "c int, s string, t string, d int")
    got = ranking.sequential_caps(df, [F.asc("d")], [(["c", "s"], 1), (["c", "t"], 1), (["c"], 2)])
    assert values(got, "d") == [(1,), (4,)]


def test_aggregates(spark):
    df = spark.createDataFrame([("g", 1.0, 10.0), ("g", 3.0, 30.0), ("h", 5.0, 2.0)], "g string, v double, w double")
    assert values(aggregates.exclude_self_ratio(df, ["g"], "v", "w", "o"), "v", "o") == [(1.0, 3.0), (3.0, 1.0), (5.0, 0.0)]
    assert df.agg(aggregates.slope("w", "v")).first()[0] == pytest.approx(-2)
    assert df.where("g = 'h'").agg(aggregates.slope("w", "v")).first()[0] is None


def test_kmeans(spark):
    rows = [("a", float(x)) for x in (1, 2, 3, 50, 51, 52, 100, 101, 102)] + [("b", 7.0), ("b", 7.0), ("b", None)]
    got = kmeans.kmeans_1d(spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    assert [r.cluster for r in sorted(got.where("g = 'a'").collect(), key=lambda r: r.v)] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert values(got.where("g = 'b'"), "cluster") == [(0,), (0,), (None,)]


def test_percentiles(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.lognormal(0, 3, 20000)] + [("b", float(x)) for x in rng.integers(0, 3, 900)] + [("c", 1.5), ("d", None), ("e", 1.0), ("e", 2.0)]
    df, probes = spark.createDataFrame(rows, "g string, x double").repartition(5), [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]
    got = {r.g: r.p for r in quantiles.percentiles(df, ["g"], F.col("x"), probes).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    for g, p in got.items():
        assert np.allclose(p, np.quantile([x for k, x in rows if k == g], probes), rtol=1e-12)
    assert np.allclose(quantiles.percentiles(df, [], F.col("x"), probes).first().p, np.quantile([x for _, x in rows if x is not None], probes), rtol=1e-12)


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    left = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=4)]) for i in range(40)] + [(90, [0.0] * 4), (91, None)], "k int, embedding array<double>")
    right = left.withColumnRenamed("k", "other")
    with pytest.raises(ValueError, match="bound"):
        similarity.cosine_pairs(left, right, "k", "other")
    want = values(similarity.cosine_pairs(left, right, "k", "other", below=0.7), "k", "other", "distance")
    near = values(similarity.cosine_pairs(left, right, "k", "other", top=3), "k", "other")
    assert len(near) == 120
    monkeypatch.setattr(similarity.in_blocks, "__defaults__", (None, 7))
    assert values(similarity.cosine_pairs(left, right, "k", "other", below=0.7), "k", "other", "distance") == want
    assert values(similarity.cosine_pairs(left, right, "k", "other", top=3), "k", "other") == near
    flags = spark.createDataFrame([(i, i % 3, [int(v) for v in rng.integers(0, 2, 6)]) for i in range(30)] + [(99, None, [1] * 6)], "k int, g int, f array<int>")
    got = values(similarity.nearest_flags(flags, "k", "f", "g", 2), "a", "b", "distance")
    rows = {r.k: r for r in flags.collect() if r.g is not None}
    for k, r in rows.items():
        wrong = {o: sum(x != y for x, y in zip(r.f, s.f, strict=True)) for o, s in rows.items() if s.g == r.g and o != k}
        order = sorted((round(2 * w / (6 + w), 6), o) for o, w in wrong.items())[:2]
        assert sorted((d, o) for a, o, d in got if a == k) == order


def test_substitutes_with_names(spark):
    rows = [(1, "c", [1.0, 0.0], [1, 0], "UN", None, 1.0, "Red Apple 1kg"), (2, "c", [1.0, 0.1], [1, 0], "UN", "box", 1.1, "red apple 2 kg"), (3, "c", [0.0, 1.0], None, "KG", "box", 2.0, "green pear"), (4, "d", [1.0, 0.0], [1, 1], "UN", "box", 1.0, "red apple"), (5, "c", [1.0, 0.0], [1, 1], "UN", "box", 1.0, "--")]
    p = spark.createDataFrame(rows, "ean int, category string, embedding array<double>, flags array<int>, unit string, container string, price_index double, nm string")
    plain = substitutes.substitutes(p)
    assert {(r.ean, r.substitute) for r in plain.collect()} == {(a, b) for a in (1, 2, 3, 5) for b in (1, 2, 3, 5) if a != b}
    named = p.join(substitutes.name_terms(p), "ean", "left")
    got = values(substitutes.substitutes(named, 1, {"tfidf": 1.0}), "ean", "substitute")
    assert got[:2] == [(1, 2), (2, 1)]
    assert all(5 not in x for x in got)
    assert values(substitutes.substitute_vectors(plain.where("ean = 1")), "ean", "substitutes")[0][0] == 1


def test_features_in_order(spark):
    assert pricing.feature_window("2001-07-01", "ELASTICITY") == (dt.date(1999, 2, 1), dt.date(2001, 6, 30))
    assert pricing.feature_window("2001-07-15", "FORECAST") == (dt.date(1999, 2, 15), dt.date(2001, 7, 14))
    with pytest.raises(ValueError, match="FORECAST"):
        pricing.feature_window("2001-07-15", "OTHER")
    d = dt.date
    daily = spark.createDataFrame([(1, "UN", d(2024, 1, 1), 5.0, 9.0), (1, "UN", d(2024, 1, 2), 2.0, 9.0), (2, "KG", d(2024, 1, 2), 0.5, 9.0), (3, "UN", d(2023, 1, 2), 9.0, 9.0), (4, "UN", d(2023, 1, 1), 9.0, 9.0), (5, "UN", d(2024, 1, 2), 9.0, 2e6)], "ean int, unit string, date date, quantity double, price double")
    assert values(pricing.sold_lately(daily), "ean", "quantity") == [(1, 5.0), (2, 0.5), (3, 9.0)]
    assert [dates.easter_sunday(y).isoformat() for y in (1999, 2000, 2001, 2024, 2026)] == ["1999-04-04", "2000-04-23", "2001-04-15", "2024-03-31", "2026-04-05"]
    assert (d(2024, 3, 29), "viernes_santo", "feriado") in dates.holidays(range(2023, 2027))
    assert (d(2023, 6, 21), "20_junio", "feriado") in dates.holidays(range(2023, 2027))


def test_least_squares(spark):
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(200, 2)), rng.uniform(1, 2, 200)
    y = 2 + x @ [3, -1] + rng.normal(size=200) / 10
    rows = [("g", *map(float, r)) for r in np.column_stack([y, x, w])] + [("one", 1.0, 1.0, 1.0, 1.0)]
    got = {r.k: r for r in regression.weighted_least_squares(spark.createDataFrame(rows, "k string, y double, a double, b double, w double"), "k", "y", ["a", "b"], "w").collect()}
    root = np.sqrt(w)[:, None]
    want = np.linalg.lstsq(np.column_stack([np.ones(200), x]) * root, y * root[:, 0], rcond=None)[0]
    assert np.allclose([got["g"].intercept, *got["g"].coefficients], want)
    assert got["g"].r2 > 0.99
    assert got["one"].intercept is None


def test_metrics(spark):
    lists = spark.createDataFrame([(1, 1, 1), (1, 2, 0), (1, 3, 1), (1, None, 1), (2, 1, 0), (3, None, 1)], "query_id int, ranking int, ground_truth int")
    assert values(metrics.precision_at_k(lists, 2), "query_id", "precision") == [(1, 0.5), (2, 0.0)]
    assert values(metrics.recall_at_k(lists, 3), "query_id", "recall") == [(1, pytest.approx(2 / 3)), (2, None)]
    assert values(metrics.average_precision_at_k(lists, 3), "query_id", "ap") == [(1, pytest.approx((1 + 2 / 3) / 3)), (2, None), (3, 0.0)]
    with pytest.raises(ValueError, match="1 or more"):
        metrics.precision_at_k(lists, 0)


def test_lifecycle_branches(spark):
    p = 100
    active = {"new": [1], "second": [1, 2], "three": [1, 2, 3], "gone": [4], "back": [1], "lost": [], "rare": [1, 3], "grow": [1, 2, 3, 4], "never": [3]}
    spend = spark.createDataFrame([(k, p - i, 20000.0 * (5 - i) if k == "grow" else 20000.0) for k, v in active.items() for i in v], "customer_key string, period int, spend double")
    before = {"second": "nuevo1", "three": "nuevo2", "gone": "estable", "back": "fugado", "lost": "esporadico", "rare": "crecimiento", "grow": "estable", "never": "sin estado"}
    previous = spark.createDataFrame([(k, p - 1, v) for k, v in before.items()] + [("new", p - 2, "estable")], "customer_key string, period int, status string")
    got = {r.customer_key: r.status for r in customers.lifecycle_status(spend, p, previous).collect()}
    assert got == {"new": "nuevo1", "second": "nuevo2", "three": got["three"], "gone": "fugado", "back": "recuperado", "lost": "fugado", "rare": "esporadico", "grow": "crecimiento"}
    assert got["three"] in ("crecimiento", "estable", "decrecimiento")
    first = {r.customer_key: r.status for r in customers.lifecycle_status(spend, p).collect()}
    assert first["new"] == "nuevo1"
    assert "gone" not in first


def test_card_transitions(spark):
    rows = [("grow", 50.0, 10), ("grow", 1.0, 400), ("grow", 50.0, 400), ("reward", 50.0, 10), ("reward", 50.0, 400), ("reward", 0.0, 400), ("reward", 1.0, 400), ("retain", 1.0, 1), ("lapsed", 0.0, 1), ("never_activated", 0.0, 1), ("sin_estado", 0.0, 1), ("sin_estado", 1.0, 1)]
    df = spark.createDataFrame([(i, *r, 40.0, 60, None, 10, False) for i, r in enumerate(rows)] + [(90, "onboard", 0.0, 1, 40.0, 60, None, 10, False), (91, "onboard", 0.0, 1, 40.0, 60, None, 29, False), (92, "onboard", 0.0, 1, 40.0, 60, dt.date(2024, 1, 1), 29, False), (93, "grow", 50.0, 1, 40.0, 60, None, 1, True)], "i int, status string, sow double, cycle int, sow_expected double, cycle_expected int, state_date date, days int, closed boolean")
    got = [r.new_status for r in cards.next_status(df).orderBy("i").collect()]
    assert got == ["reward", "retain", "grow", "reward", "retain", "retain", "grow", "grow", "lapsed", "never_activated", "onboard", "grow", "onboard", "never_activated", "grow", "closed"]


def test_card_validity_touches(spark):
    d = dt.date
    spans = spark.createDataFrame([(1, 10, d(2024, 1, 1), d(2024, 2, 1)), (1, 11, d(2024, 2, 1), None)], "customer_key int, card_id int, subscription_date date, closed_date date")
    bought = spark.createDataFrame([(1, 1, d(2024, 1, 31)), (2, 1, d(2024, 2, 1)), (3, 1, d(2023, 12, 31))], "basket_key int, customer_key int, transaction_date date")
    assert values(cards.card_of_purchase(bought, spans), "basket_key", "card_id") == [(1, 10), (2, 11)]


def test_contagion_levels(spark):
    p = spark.createDataFrame([(1, "s1", "c1", 1.0, 10.0, -2.0), (2, "s1", "c1", 1.0, 5.0, None), (3, "s2", "c1", 1.0, 5.0, None), (4, "s9", "c9", 1.0, 5.0, None), (5, "s1", "c1", 1.0, 1.0, -20.0), (6, "s1", "c1", 9.0, 5.0, None)], "ean int, sub_category string, category string, weight double, sales double, elasticity double")
    s = spark.createDataFrame([(6, 5, 1, 1)], "ean int, substitute int, month int, relevance int")
    assert values(pricing.contagion(p, s), "ean", "elasticity", "source") == [(1, -2.0, "own"), (2, -2.0, "sub_category"), (3, -2.0, "category"), (4, -1.0, "default"), (5, -8.0, "own"), (6, -8.0, "substitute")]


def test_insert_only_merge(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    target = spark.createDataFrame([(1, "z"), (None, "z")], "k int, v string")
    new = tables.insert_only_merge(source, target, ["k"])
    assert values(new, "k", "v") == [(2, "b"), (None, "c")]
    assert tables.insert_only_merge(source.where("k IS NOT NULL"), target.union(new), ["k"]).count() == 0
    with pytest.raises(Exception, match="key twice"):
        tables.insert_only_merge(source.union(source), target, ["k"]).collect()


def test_incremental(spark):
    source = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "x")], "k int, v string")
    assert values(incremental.new_by_id(source, spark.createDataFrame([(2,)], "k int"), "k"), "k", "v") == [(1, "a")]
    d = dt.date
    src = spark.createDataFrame([(d(2024, 1, 2), 1, "new"), (d(2024, 1, 3), 2, "new"), (d(2024, 1, 1), 3, "old"), (None, 4, "x")], "date date, k int, v string")
    tgt = spark.createDataFrame([(d(2024, 1, 1), 3, "kept"), (d(2024, 1, 2), 1, "stale")], "date date, k int, v string")
    assert values(incremental.from_last_date(src, tgt, "date", "k"), "k", "v") == [(1, "new"), (2, "new"), (3, "kept")]
    assert incremental.from_last_date(src, tgt.limit(0), "date", "k").count() == 3
    assert values(incremental.after_watermark(src, tgt, "date"), "k") == [(2,)]


def test_tables(spark):
    spec = tables.TableSpec.from_json({"schema": "default", "table": "t_spec", "columns": [{"name": "a", "field_type": "INTEGER", "mode": "REQUIRED"}, {"name": "day", "field_type": "DATE"}, {"name": "x", "field_type": "FLOAT"}], "time_partitioning": {"field": "day"}})
    with pytest.raises(ValueError, match="not both"):
        tables.TableSpec.from_json({"schema": "s", "table": "t", "columns": [], "time_partitioning": {"field": "a"}, "range_partitioning": {"field": "a"}})
    spark.sql("DROP TABLE IF EXISTS t_spec")
    spec.create(spark)
    with pytest.raises(ValueError, match="exists"):
        spec.create(spark)
    rows = spark.sql("SELECT '1' AS a, 2.5 AS x, DATE '2024-01-01' AS day UNION ALL SELECT '2', NULL, DATE '2024-01-02'")
    tables.write_table(rows, spec, "append")
    tables.overwrite_slice(spark.sql("SELECT 9 AS a, 1.0 AS x, DATE '2024-01-01' AS day"), spec, "x > 2")
    assert values(spark.table("t_spec"), "a", "x") == [(2, None), (9, 1.0)]
    tables.overwrite_partitions(spark.sql("SELECT 7 AS a, 1.0 AS x, DATE '2024-01-02' AS day"), spec)
    assert values(spark.table("t_spec"), "a") == [(7,), (9,)]
    assert tables.drop_old_partitions(spark, "t_spec", "day", "2024-01-02") == 1
    with pytest.raises(Exception, match="required"):
        tables.write_table(spark.sql("SELECT NULL AS a, 1.0 AS x, DATE '2024-01-01' AS day"), spec, "append")
    spark.sql("DROP TABLE t_spec")


def test_gates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    for gate in (lambda: quality.assert_unique(df, ["k"]), lambda: quality.assert_no_nulls(df), lambda: quality.assert_columns(df, ["z"]), lambda: quality.assert_loaded(1, 1, 3)):
        with pytest.raises(ValueError, match=r"more than once|nulls|missing|make"):
            gate()


def test_sheets_and_staging(spark, tmp_path):
    sheet = spark.createDataFrame([(0, "head", None), (1, "a|b", "nan"), (2, None, "1"), (3, "c", "2")], "row_no int, x string, y string")
    got = sheets.clean_sheet(sheet, ["n", "z", "v"], skip_rows=1 - 1, insert={"z": 0}, drop_null_on="n", nan_as_zero=("v",))
    assert values(got, "n", "z", "v") == [("ab", "0", "0"), ("c", "0", "2")]
    marked = spark.createDataFrame([(1, "x", "y"), (2, "PERSONALIZADAS", None), (3, "name", "week"), (4, "a", "1"), (5, "b", "2")], "row_no int, p string, q string")
    assert values(sheets.campaign_calendar(marked, "PERSONALIZADAS", "p", 40, 3, 2024), "name", "week", "internal_cycle") == [("a", "1", 41), ("b", "2", 42)]
    (tmp_path / "f.csv").write_bytes("a|b\n1|ñ\n".encode("utf-16"))
    assert values(readers.read_csv(spark, str(tmp_path / "f.csv"), "|", "UTF-16"), "a", "b") == [("1", "ñ")]


def test_stream(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_events")
    path = str(tmp_path / "in")
    rows = spark.sql("SELECT CAST(id % 50 AS INT) AS k, TIMESTAMP '2024-01-01' + make_interval(0,0,0,0,0,0,id) AS ts FROM range(100)")
    rows.write.parquet(path)
    for _ in range(2):
        events = push_events.distinct_events(push_events.read_events(spark, path, "k int, ts timestamp"), ["k"], "ts")
        q = push_events.write_new_events(events, "t_events", ["k"], str(tmp_path / f"cp{_}"))
        q.awaitTermination(120)
        assert spark.table("t_events").count() == 50
    spark.sql("DROP TABLE t_events")


def test_stored_results_can_be_cleared(spark):
    from pathlib import Path

    from basket_spark.sources import shared

    frame, path = shared.stored_at(spark.range(5), "probe")
    assert frame.count() == 5
    assert path.startswith(shared.work_dir(spark))
    shared.remove(spark, path)
    assert not Path(path.removeprefix("file:")).exists()


def test_database(spark, tmp_path):
    """A query over JDBC, in one part and in several, from the database that comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.createDataFrame([(i, f"n{i}") for i in range(40)], "k int, v string").write.format("jdbc").option("url", url).option("dbtable", "t").save()
    whole = readers.read_database(spark, url, "SELECT * FROM t")
    parts = readers.read_database(spark, url, "SELECT * FROM t", "k", ("0", "40"), 4)
    assert parts.rdd.getNumPartitions() == 4
    assert values(whole, "k", "v") == values(parts, "k", "v")
    assert whole.count() == 40
