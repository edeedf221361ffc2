"""Customer activity: spend by period, lifecycle status, membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import period_index
from ..functions.numbers import first_match
from ..operators.aggregates import pivot_flags, slope
from ..operators.ranking import first_row
from ..sources.shared import stored

# Relative growth of a trend, and the names of states.
GROWTH = 0.15
NO_STATUS, NEW_TO_BASE = "sin estado", "no_existia"
TREND = ("crecimiento", "estable", "decrecimiento", "esporadico")


def customer_period_spend(baskets: DataFrame, excluded: DataFrame | None = None, only: DataFrame | None = None, unit: str = "month") -> DataFrame:
    """(customer_key, period, spend, n_baskets) over the baskets, without the excluded ones or of the given ones only.

    ``excluded`` and ``only`` have the baskets' key.
    """
    if excluded is not None:
        baskets = baskets.join(excluded.select("basket_key").distinct(), "basket_key", "left_anti")
    if only is not None:
        baskets = baskets.join(only.select("basket_key").distinct(), "basket_key", "left_semi")
    return baskets.groupBy("customer_key", period_index(F.col("transaction_date"), unit).alias("period")).agg(F.sum("basket_value").alias("spend"), F.count_distinct("basket_key").alias("n_baskets"))


def with_trend_score(spend: DataFrame, least: float) -> DataFrame:
    """Rows of that spend at least, with z: log1p of the spend less log1p of the period's mean."""
    kept = spend.where(F.col("spend") >= least)
    base = kept.groupBy("period").agg(F.avg("spend").alias("baseline"))
    return kept.join(F.broadcast(base), "period").withColumn("z", F.log1p("spend") - F.log1p("baseline")).drop("baseline")


def _proposal(prev: Column, first_run: bool) -> Column:
    a1, a2, a3, a4 = (F.col(f"a{i}") == 1 for i in range(1, 5))
    act3, act4 = F.col("a1") + F.col("a2") + F.col("a3"), F.col("a1") + F.col("a2") + F.col("a3") + F.col("a4")
    if first_run:
        return F.when(a1, "nuevo1").otherwise(NO_STATUS)
    gone = ~a1 & ~a2
    return first_match([
        (prev.isin(NO_STATUS, NEW_TO_BASE) & a1, "nuevo1"),
        (prev == "nuevo1", "nuevo2"),
        ((prev == "nuevo2") & (act3 <= 1), NO_STATUS),
        ((prev == "nuevo2") & (act3 == 2), "esporadico"),
        (prev == "nuevo2", "GRR"),
        (prev.isin(*TREND) & (act4 >= 3), "GRR"),
        (prev.isin(*TREND) & gone, "fugado"),
        (prev.isin(*TREND), "esporadico"),
        ((prev == "fugado") & a1 & ~a2 & ~a3 & ~a4, "recuperado"),
        ((prev == "fugado") & (act4 == 0), NO_STATUS),
        ((prev == "fugado") & gone, "fugado"),
        (prev == "fugado", "esporadico"),
        (prev == "recuperado", "esporadico"),
    ], NO_STATUS)


def lifecycle_status(spend: DataFrame, period: int, previous: DataFrame | None = None, least: float = 10_000.0, growth: float = GROWTH) -> DataFrame:
    """(customer_key, period, status, previous_status, slope, rate) for the execution period.

    ``spend``: (customer_key, period, spend); ``previous``: (customer_key, period, status) of earlier runs, of which the
    last counts. Customers active in the four periods before, and previous ones with a status. Who buys in most of the
    periods gets a trend from the slope of z. Customers that had no status and get none are left out.
    """
    scored = with_trend_score(spend, least).where(F.col("period").between(period - 4, period - 1))
    flags = pivot_flags(scored, "customer_key", "period", [period - i for i in range(1, 5)], [f"a{i}" for i in range(1, 5)])
    trend = scored.groupBy("customer_key").agg(slope("z", F.col("period") - F.lit(period - 4)).alias("slope"), F.count("*").alias("n"))
    universe = flags.join(trend, "customer_key")
    previous = None if previous is None else stored(previous, "status")
    if previous is None:
        universe = universe.withColumn("previous_status", F.lit(NEW_TO_BASE))
    else:
        last = previous.join(F.broadcast(previous.agg(F.max("period").alias("period"))), "period").select("customer_key", F.coalesce("status", F.lit(NO_STATUS)).alias("previous_status"))
        universe = universe.join(last, "customer_key", "full").where(F.col("a1").isNotNull() | (F.col("previous_status") != NO_STATUS))
        universe = universe.fillna(0, [f"a{i}" for i in range(1, 5)]).fillna(NEW_TO_BASE, ["previous_status"])
    proposed = universe.withColumn("proposal", _proposal(F.col("previous_status"), previous is None))
    rate = F.expm1("slope")
    trending = F.col("proposal") == "GRR"
    status = first_match([(~trending, F.col("proposal")), (F.coalesce(F.col("n"), F.lit(0)) < 2, F.lit("ERROR")), (F.col("slope").isNull(), F.lit("ERROR")), (rate >= growth, F.lit("crecimiento")), (rate <= -growth, F.lit("decrecimiento"))], F.lit("estable"))
    out = proposed.select("customer_key", F.lit(period).alias("period"), status.alias("status"), "previous_status", F.when(trending, F.col("slope")).alias("slope"), F.when(trending, rate).alias("rate"))
    return out.where(~((F.col("status") == NO_STATUS) & F.col("previous_status").isin(NO_STATUS, NEW_TO_BASE)))


def latest_membership(memberships: DataFrame, on_date: str) -> DataFrame:
    """The last membership of each customer that is active on the date."""
    day = F.lit(on_date).cast("date")
    active = memberships.where((F.col("start_date") <= day) & (F.col("end_date").isNull() | (F.col("end_date") >= day)) & (F.col("inactive_date").isNull() | (F.col("inactive_date") > day)))
    return first_row(active, ["customer_key"], [F.desc("start_date"), F.asc("membership_id")])


def with_membership(status: DataFrame, memberships: DataFrame, on_date: str) -> DataFrame:
    """``status`` with whether the customer is a member on the date: Si or No."""
    members = latest_membership(memberships, on_date).select("customer_key", F.lit("Si").alias("membership"))
    return status.join(members, "customer_key", "left").fillna("No", ["membership"])


def share_of_rows(df: DataFrame, column: str) -> DataFrame:
    """(column, n, share) of each value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
