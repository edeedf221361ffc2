"""Calendar expressions: periods as numbers, month arithmetic, ISO weeks, tolerant parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def period_index(date: Column, unit: str = "month") -> Column:
    """Consecutive number of the month (year*12+month), quarter (year*4+quarter) or year that a date is in."""
    parts = {"month": (12, F.month), "quarter": (4, F.quarter)}
    if unit == "year":
        return F.year(date).cast("int")
    if unit not in parts:
        raise ValueError(f"unit must be month, quarter or year, not {unit!r}")
    n, part = parts[unit]
    return (F.year(date) * n + part(date)).cast("int")


def year_month(date: Column) -> Column:
    """YYYYMM as a number."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def add_months(year_month_: Column, n: int | Column) -> Column:
    """YYYYMM moved by n months."""
    index = F.floor(year_month_ / 100) * 12 + year_month_ % 100 - 1 + n
    return (F.floor(index / 12) * 100 + F.pmod(index, F.lit(12)) + 1).cast("int")


def first_of_window(year_month_: int, n: int) -> int:
    """First month of the n months that end with this one: 202407 and 12 give 202308."""
    index = year_month_ // 100 * 12 + year_month_ % 100 - n
    return index // 12 * 100 + index % 12 + 1


def iso_week_difference(later: Column, earlier: Column) -> Column:
    """Number of Mondays after ``earlier`` up to ``later``."""
    return (F.datediff(F.date_trunc("week", later), F.date_trunc("week", earlier)) / 7).cast("int")


def iso_year_week(date: Column) -> Column:
    """Year of the ISO week times 100 plus the week."""
    return (F.extract(F.lit("YEAROFWEEK"), date) * 100 + F.weekofyear(date)).cast("int")


def is_month_start(date: Column) -> Column:
    return F.dayofmonth(date) == 1


def is_month_end(date: Column) -> Column:
    return F.last_day(date) == date


def us_timestamp(text: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM`` as a timestamp, null where it isn't one."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy h:mm:ss a"))


def staged_timestamp(text: Column) -> Column:
    """``Jan  2 2024  3:04PM`` with any number of blanks as a timestamp, null where it isn't one."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), r"\s+", " "), F.lit("MMM d yyyy h:mma"))


def weekday_flags(date: Column) -> list[Column]:
    """One 0/1 column for each weekday from Monday on, ``weekday_0`` to ``weekday_6``."""
    return [(F.weekday(date) == k).cast("int").alias(f"weekday_{k}") for k in range(7)]


def calendar_flags(date: Column, years: list[int]) -> list[Column]:
    """0/1 columns for weekdays (``weekday_0`` is Monday), months (``month_1``) and the given years (``year_2000``)."""
    months = [(F.month(date) == m).cast("int").alias(f"month_{m}") for m in range(1, 13)]
    return [*weekday_flags(date), *months, *[(F.year(date) == y).cast("int").alias(f"year_{y}") for y in years]]


def easter_sunday(year: int) -> dt.date:
    """By the anonymous Gregorian rule."""
    a, (b, c) = year % 19, divmod(year, 100)
    d, e = divmod(b, 4)
    h = (19 * a + b - d - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    i, k = divmod(c, 4)
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = (a + 11 * h + 22 * m) // 451
    month, day = divmod(h + m - 7 * n + 114, 31)
    return dt.date(year, month, day + 1)


# Days of the year that stand alone in the model, and what groups they belong to.
UNWAIVABLE, HOLIDAY, EVE = "feriado_irrenunciable", "feriado", "pre_feriado"
FIXED_DAYS = [
    ("1_enero", 1, 1, UNWAIVABLE), ("30_abril", 4, 30, EVE), ("1_mayo", 5, 1, UNWAIVABLE), ("20_mayo", 5, 20, EVE), ("21_mayo", 5, 21, HOLIDAY),
    ("15_julio", 7, 15, EVE), ("16_julio", 7, 16, HOLIDAY), ("14_agosto", 8, 14, EVE), ("15_agosto", 8, 15, HOLIDAY),
    ("14_septiembre", 9, 14, EVE), ("15_septiembre", 9, 15, EVE), ("16_septiembre", 9, 16, EVE), ("17_septiembre", 9, 17, EVE), ("18_septiembre", 9, 18, UNWAIVABLE), ("19_septiembre", 9, 19, UNWAIVABLE),
    ("pre_halloween", 10, 30, EVE), ("halloween", 10, 31, HOLIDAY), ("pre_navidad", 12, 23, EVE), ("navidad", 12, 24, EVE), ("25_diciembre", 12, 25, UNWAIVABLE), ("pre_ano_nuevo", 12, 30, EVE), ("ano_nuevo", 12, 31, EVE),
]
HOLIDAY_GROUPS = [UNWAIVABLE, HOLIDAY, EVE]


def holidays(years: range) -> list[tuple[dt.date, str, str]]:
    """(date, name, group) of each holiday of the years: the fixed days, the two before Easter, and that of the winter
    solstice (20 June in leap years and the ones after, else 21) with its eve."""
    out = []
    for y in years:
        easter, solstice = easter_sunday(y), dt.date(y, 6, 20 if y % 4 < 2 else 21)
        out += [(dt.date(y, m, d), name, group) for name, m, d, group in FIXED_DAYS]
        out += [(easter - dt.timedelta(3), "jueves_santo", EVE), (easter - dt.timedelta(2), "viernes_santo", HOLIDAY), (solstice - dt.timedelta(1), "19_junio", EVE), (solstice, "20_junio", HOLIDAY)]
    return out


def holiday_names() -> list[str]:
    return [name for _, name, _ in holidays(range(2000, 2001))]


def with_holidays(df: DataFrame, date: str, years: range) -> DataFrame:
    """``df`` with a 0/1 column for each holiday and each group of holidays. The table of holidays, some thirty a year, is
    broadcast; dates outside the years have none."""
    spark: SparkSession = df.sparkSession
    dim = spark.createDataFrame(holidays(years), "__d date, __name string, __group string")
    dim = dim.groupBy("__d").agg(F.collect_set("__name").alias("__names"), F.collect_set("__group").alias("__groups"))
    flag = lambda c, x: F.coalesce(F.array_contains(c, x), F.lit(False)).cast("int").alias(x)
    flags = [flag("__names", n) for n in holiday_names()] + [flag("__groups", g) for g in HOLIDAY_GROUPS]
    return df.join(F.broadcast(dim), F.col(date) == F.col("__d"), "left").select(*[F.col(c) for c in df.columns], *flags)


def recency(weeks: Column, mode: str = "dcg") -> Column:
    """Divisor for something that many weeks ago: log2(2 + weeks), or its inverse for ``literal``."""
    if mode not in ("dcg", "literal"):
        raise ValueError("mode must be dcg or literal")
    value = F.log2(weeks + 2)
    return value if mode == "dcg" else 1 / value
