"""Spans that hold days, against every fact with every span."""

import datetime as dt

import numpy as np
import pytest
from basket_spark.operators import intervals
from pyspark.sql import functions as F

D = dt.date


def made(spark, seed):
    rng = np.random.default_rng(seed)
    day = lambda lo, hi: D(2001, 1, 1) + dt.timedelta(int(rng.integers(lo, hi)))
    facts = [(i, f"k{rng.integers(0, 4)}", day(0, 120)) for i in range(300)] + [(900, None, day(0, 9)), (901, "k1", None), (902, "none", day(0, 9)), (1, "k0", day(0, 120))]
    spans = []
    for i in range(60):
        start = day(0, 110)
        spans.append((f"k{rng.integers(0, 4)}", start, start + dt.timedelta(int(rng.integers(-2, 40))), int(rng.integers(0, 3)), i))
    spans += [("k0", D(2001, 2, 1), D(2100, 1, 1), 9, 100), ("k1", D(1900, 1, 1), D(2001, 3, 1), 0, 101), ("k2", None, D(2001, 2, 2), 1, 102), ("k2", D(2001, 2, 2), None, 1, 103), (None, D(2001, 1, 1), D(2002, 1, 1), 1, 104), ("k3", D(2001, 1, 5), D(2001, 1, 6), None, 105), ("k3", D(2001, 1, 5), D(2001, 1, 5), 1, 106)]
    return facts, spans, spark.createDataFrame(facts, "id int, k string, day date"), spark.createDataFrame(spans, "k string, s date, e date, prio int, span int")


@pytest.mark.parametrize("seed", [1, 2])
def test_flags(spark, seed):
    facts, spans, f, s = made(spark, seed)
    holds = lambda k, d: any(k is not None and d is not None and k == x and a is not None and b is not None and a <= d <= b for x, a, b, *_ in spans)
    got = intervals.covered_flag(f, s, "k", "day", "s", "e", "held")
    assert got.columns == ["id", "k", "day", "held"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((*r, holds(*r[1:]))) for r in facts)


@pytest.mark.parametrize("order", [["s", "span"], ["prio", "span"], ["span"]])
def test_the_first_span_that_holds(spark, order):
    facts, spans, f, s = made(spark, 3)
    at = [["k", "s", "e", "prio", "span"].index(c) for c in order]
    least = (D(1, 1, 1), D(1, 1, 1))
    key = lambda r: [(r[i] is not None, r[i] if r[i] is not None else (least[0] if i in (1, 2) else 0)) for i in at]
    want = []
    for r in facts:
        held = [x for x in spans if None not in (r[1], r[2], x[1], x[2]) and x[0] == r[1] and x[1] <= r[2] < x[2]]
        if held:
            want.append((*r, *max(held, key=key)[1:]))
    got = intervals.interval_join_latest(f, s, "k", "day", "s", "e", order)
    assert got.columns == ["id", "k", "day", "s", "e", "prio", "span"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_runs_of_days(spark):
    """The runs are disjoint, make up the span, and are few."""
    rng = np.random.default_rng(5)
    ends = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 1 << 20, 40), rng.integers(0, 40_000, 40), strict=True)] + [(0, 1 << 20), (5, 5)]
    df = spark.createDataFrame(ends, "a long, b long").select("a", "b", intervals._nodes(F.col("a"), F.col("b")).alias("n"))
    for r in df.collect():
        runs = sorted((x.i << x.level, (x.i + 1) << x.level) for x in r.n)
        assert len(runs) <= 40
        assert sum(b - a for a, b in runs) == max(0, r.b - r.a)
        assert all(one[1] == two[0] for one, two in zip(runs, runs[1:], strict=False))
        assert not runs or (runs[0][0], runs[-1][1]) == (r.a, r.b)


def test_open_ended_spans_cost_few_rows(spark):
    spans = spark.range(50).selectExpr("id % 5 AS k", "date_add(DATE '2001-01-01', CAST(id AS int)) AS s", "DATE '2100-01-01' AS e", "id AS span")
    steps = intervals.steps_of_best(spans, "k", "s", "e", ["s", "span"])
    assert steps.count() == 55  # a step for each start, and one for the common end of each key
    assert steps.where("__best IS NULL").count() == 5


def test_no_spans_and_no_facts(spark):
    _, _, f, s = made(spark, 4)
    assert intervals.covered_flag(f, s.limit(0), "k", "day", "s", "e", "held").where("held").count() == 0
    assert intervals.covered_flag(f, s.limit(0), "k", "day", "s", "e", "held").count() == f.count()
    assert intervals.interval_join_latest(f, s.limit(0), "k", "day", "s", "e", ["s"]).count() == 0
    assert intervals.interval_join_latest(f.limit(0), s, "k", "day", "s", "e", ["s"]).count() == 0
