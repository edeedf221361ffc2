"""Facts and spans of days: which span holds a fact's day, by sweeps over each key's days.

Facts are looked up by their distinct (key, day), so what a sweep sorts for one key is no longer than the calendar, however
many facts the key has; the answers are then joined to the facts, written first so that Spark splits a hot key. A span costs
a row where it starts and one where it ends, not one a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Days count from 2^19 days before 1970, so that they fit 20 bits for some 1,400 years on either side.
LEVELS, _ZERO = 20, 1 << 19


def _number(day: Column) -> Column:
    return (F.unix_date(day.cast("date")) + _ZERO).cast("long")


def _answered(facts: DataFrame, answers: DataFrame, key: str, date: str, how: str) -> DataFrame:
    """``facts`` with the columns that ``answers`` has for their key and day (``__key``, ``__day``)."""
    answers = stored(answers, "answers")
    return facts.join(answers, (F.col(key) == F.col("__key")) & (_number(F.col(date)) == F.col("__day")), how).drop("__key", "__day")


def _asked(facts: DataFrame, key: str, date: str) -> DataFrame:
    return facts.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(F.col(key).alias("__key"), _number(F.col(date)).alias("__day")).distinct()


def covered_flag(facts: DataFrame, spans: DataFrame, key: str, date: str, start: str, end: str, name: str) -> DataFrame:
    """``facts`` with whether a span of its key holds its date, both ends included.

    A running count of starts less ends over the key's days. Spans with a null end or that end before they start hold
    nothing; facts without key or date are held by none.
    """
    s = spans.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end))).select(F.col(key).alias("__key"), _number(F.col(start)).alias("a"), (_number(F.col(end)) + 1).alias("b"))
    ends = s.select("__key", F.explode(F.array(F.struct(F.col("a").alias("d"), F.lit(1).alias("n")), F.struct(F.col("b").alias("d"), F.lit(-1).alias("n")))).alias("e"))
    events = ends.groupBy("__key", F.col("e.d").alias("__day")).agg(F.sum("e.n").alias("n")).withColumn("asked", F.lit(False))
    days = events.unionByName(_asked(facts, key, date).withColumns({"n": F.lit(0).cast("long"), "asked": F.lit(True)}))
    upto = Window.partitionBy("__key").orderBy("__day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = days.withColumn("n", F.sum("n").over(upto)).where("asked AND n > 0").select("__key", "__day", F.lit(True).alias("__held"))
    return _answered(facts, held, key, date, "left").withColumn(name, F.coalesce("__held", F.lit(False))).drop("__held")


def _nodes(a: Column, b: Column) -> Column:
    """The runs of 2^level days that make up [a, b), two of each level at most: structs of level and number."""
    found = []
    for level in range(LEVELS + 1):
        first, last = F.shiftright(a + ((1 << level) - 1), level), F.shiftright(b, level)
        node = lambda i, level=level: F.struct(F.lit(level).alias("level"), i.alias("i"))
        found += [F.when((first < last) & (first % 2 == 1), node(first)), F.when((first < last) & (last % 2 == 1), node(last - 1))]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _contested(spans: DataFrame) -> DataFrame:
    """Steps of spans (__key, a, b, row) that overlap: a span is put down at the runs of 2^k days that it is made of, some
    dozens at most; each run keeps its best, and a day asks the runs that hold it."""
    best = spans.select("__key", "row", F.explode(_nodes(F.col("a"), F.col("b"))).alias("node")).groupBy("__key", "node").agg(F.max("row").alias("row"))
    days = spans.select("__key", F.explode(F.array("a", "b")).alias("__day")).distinct()
    runs = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright("__day", level).alias("i")) for level in range(LEVELS + 1)])
    asked = days.select("__key", "__day", F.explode(runs).alias("node"))
    return asked.join(stored(best, "runs"), ["__key", "node"], "left").select("__key", "__day", "row")


def steps_of_best(spans: DataFrame, key: str, start: str, end: str, order: list[str]) -> DataFrame:
    """(__key, __day, __best): from each day on which spans of a key start or end, the span that is first from there on, by
    the largest values of ``order``; null where none holds. Starts are included, ends not.

    A span that overlaps no other of its key is a step where it starts and another where it ends; only the others compete.
    Spans are windowed and aggregated, never collected by key.
    """
    others = [c for c in spans.columns if c not in (key, *order)]
    row = F.struct(*[F.col(f"`{c}`") for c in (*order, *others)])
    s = spans.where(F.col(key).isNotNull() & (F.col(start) < F.col(end))).select(F.col(key).alias("__key"), _number(F.col(start)).alias("a"), _number(F.col(end)).alias("b"), row.alias("row"))
    by_start = Window.partitionBy("__key").orderBy("a", "b")
    before = F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.lead("a").over(by_start)
    s = stored(s.withColumn("alone", F.coalesce(before <= F.col("a"), F.lit(True)) & F.coalesce(after >= F.col("b"), F.lit(True))), "spans")
    two = F.array(F.struct(F.col("a").alias("day"), F.col("row")), F.struct(F.col("b").alias("day"), F.lit(None).cast(s.schema["row"].dataType).alias("row")))
    steps = s.where("alone").select("__key", F.explode(two).alias("step")).select("__key", F.col("step.day").alias("__day"), "step.row")
    overlapping = s.where("NOT alone")
    if not overlapping.isEmpty():
        steps = steps.union(_contested(overlapping))
    return steps.groupBy("__key", "__day").agg(F.max("row").alias("__best"))


def interval_join_latest(facts: DataFrame, spans: DataFrame, key: str, date: str, start: str, end: str, order: list[str]) -> DataFrame:
    """Each fact with the one span of its key that holds its date (start included, end not): of several the one with the
    largest values of ``order``, nulls least, then of the other columns in their order. Facts that no span holds are left out.

    The spans become steps (see ``steps_of_best``); a sweep carries the last step to the days of the facts. The columns
    are those of the facts, then those of the spans without the key.
    """
    steps = steps_of_best(spans, key, start, end, order)
    some = F.struct(F.col("__best").alias("row"))  # a step without a span is a step too
    days = steps.select("__key", "__day", some.alias("step"), F.lit(False).alias("asked"))
    days = days.unionByName(_asked(facts, key, date).withColumns({"step": F.lit(None).cast(days.schema["step"].dataType), "asked": F.lit(True)}))
    upto = Window.partitionBy("__key").orderBy("__day", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = days.withColumn("step", F.last("step", True).over(upto)).where("asked AND step.row IS NOT NULL").select("__key", "__day", F.col("step.row").alias("__row"))
    kept = [F.col(f"__row.`{c}`").alias(c) for c in spans.columns if c != key]
    return _answered(facts, found, key, date, "inner").select(*[F.col(f"`{c}`") for c in facts.columns], *kept)
