"""Payment cards: validity, purchases, share of wallet, purchase cycle, lifecycle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import year_month
from ..functions.numbers import band, first_match
from ..operators.intervals import interval_join_latest
from ..operators.joins import as_of

# Fixed value: the end of what doesn't end.
OPEN_ENDED = "2100-01-01"
# Credit limit that counts, and the cycle of those who don't buy.
LEAST_LIMIT = 30_000
NO_CYCLE = 500
# Credit limit from which, share of wallet and purchase cycle that are expected.
WALLET_BANDS = [(30_000, 10), (50_000, 9), (100_000, 21), (150_000, 26), (200_000, 29), (300_000, 36), (600_000, 47)]
CYCLE_BANDS = [(30_000, 60), (50_000, 55), (100_000, 41), (150_000, 35), (200_000, 30), (300_000, 24), (600_000, 12)]


def closed_date(cards: DataFrame) -> DataFrame:
    """``cards`` with ``closed_date`` from the termination date and the month after the last status (``last_period``,
    YYYYMM); the status wins unless the termination is earlier. Cards that know neither closed when subscribed."""
    after = F.add_months(F.to_date(F.col("last_period").cast("string"), "yyyyMM"), 1)
    end, has_end, has_after = F.col("termination_date"), F.col("termination_date").isNotNull(), F.col("last_period").isNotNull()
    rules = [
        (has_end & has_after & (year_month(end) > year_month(after)), after),
        (has_end & has_after & (year_month(end) < year_month(after)), end),
        (~has_end & has_after, after),
        (~has_end & ~has_after, F.col("subscription_date")),
        (has_end & ~has_after & (year_month(end) > year_month(F.col("subscription_date"))), F.col("subscription_date")),
    ]
    return cards.withColumn("closed_date", first_match(rules, end))


def last_known_status(statuses: DataFrame, until: int, least_limit: float = LEAST_LIMIT) -> DataFrame:
    """The last status (card_id, period, credit_limit) of each card up to a period, among those of that limit at least."""
    return as_of(statuses.where(F.col("credit_limit") >= least_limit), ["card_id"], "period", until)


def card_of_purchase(purchases: DataFrame, cards: DataFrame) -> DataFrame:
    """Each purchase with the customer's card that was valid, the last subscribed one."""
    spans = cards.select("customer_key", "card_id", "subscription_date", F.coalesce("closed_date", F.lit(OPEN_ENDED).cast("date")).alias("closed_date"))
    return interval_join_latest(purchases, spans, "customer_key", "transaction_date", "subscription_date", "closed_date", ["subscription_date", "card_id"])


def share_of_wallet(purchases: DataFrame) -> DataFrame:
    """(customer_key, sow): percent of the spend that was paid by card, rounded; ``by_card`` marks those purchases."""
    paid = F.coalesce(F.sum(F.when(F.col("by_card"), F.col("amount"))), F.lit(0.0))
    return purchases.groupBy("customer_key").agg(F.coalesce(F.round(F.try_divide(100 * paid, F.sum("amount"))), F.lit(0.0)).alias("sow"))


def purchase_cycle(purchases: DataFrame, start: str, end: str) -> DataFrame:
    """(customer_key, cycle): days between the last two card purchases before ``end``, if the last is in the period."""
    dated = purchases.where("by_card").where(F.col("transaction_date") < F.lit(end).cast("date")).select("customer_key", "transaction_date", "basket_key")
    w = Window.partitionBy("customer_key").orderBy("transaction_date", "basket_key")
    last = dated.withColumn("before", F.lag("transaction_date", 1).over(w)).groupBy("customer_key").agg(F.max_by(F.struct("transaction_date", "before"), F.struct("transaction_date", "basket_key")).alias("l"))
    days = F.datediff("l.transaction_date", "l.before")
    return last.select("customer_key", F.coalesce(F.when(F.col("l.transaction_date") >= F.lit(start).cast("date"), days), F.lit(NO_CYCLE)).alias("cycle"))


def with_thresholds(cards: DataFrame) -> DataFrame:
    """``cards`` with the share of wallet and the cycle that their credit limit lets expect."""
    return cards.withColumn("sow_expected", band(F.col("credit_limit"), WALLET_BANDS, 0)).withColumn("cycle_expected", band(F.col("credit_limit"), CYCLE_BANDS, NO_CYCLE))


def next_status(cards: DataFrame) -> DataFrame:
    """``cards`` (status, sow, sow_expected, cycle, cycle_expected, state_date, days, closed) with ``new_status``."""
    status, sow, often = F.col("status"), F.col("sow"), F.col("cycle") <= F.col("cycle_expected")
    much = sow >= F.col("sow_expected")
    active = F.col("state_date").isNotNull()
    rules = [
        (F.col("closed"), "closed"),
        ((status == "grow") & much & often, "reward"),
        ((status == "grow") & ~much & ~often, "retain"),
        (status == "grow", "grow"),
        ((status == "reward") & much & often, "reward"),
        ((status == "reward") & ~often & (much | (sow == 0)), "retain"),
        (status == "reward", "grow"),
        (status.isin("retain", "lapsed") & (sow > 0), "grow"),
        (status.isin("retain", "lapsed"), "lapsed"),
        ((status == "never_activated") & (sow > 0), "grow"),
        (status == "never_activated", "never_activated"),
        ((status == "onboard") & ~active & (F.col("days") <= 28), "onboard"),
        ((status == "onboard") & ~active, "never_activated"),
        (status == "onboard", "grow"),
        ((status == "sin_estado") & (sow > 0), "grow"),
        (status == "sin_estado", "onboard"),
    ]
    return cards.withColumn("new_status", first_match([(c, F.lit(v)) for c, v in rules], F.lit("sin_estado")))


def state_date(cards: DataFrame, since: str, until: str) -> DataFrame:
    """``cards`` with the date their activation counts from: the first purchase within a year after subscription for
    cards of ``since`` on whose activation isn't known or lies before it, none for later purchases."""
    new, act, first = F.col("subscription_date") >= F.lit(since).cast("date"), F.col("activation_date"), F.col("first_purchase")
    end, soon = F.lit(until).cast("date"), F.datediff("first_purchase", "subscription_date") <= 365
    inside = act.isNotNull() & (act >= F.lit(since).cast("date")) & (act < end)
    rules = [
        (new & (act >= end), act),
        (new & inside & (act == first), act),
        (new & inside & (first.isNull() | soon), F.coalesce(first, act)),
        (new & inside & ~soon, F.lit(None).cast("date")),
        (new & act.isNull() & soon, first),
    ]
    return cards.withColumn("state_date", first_match(rules, act))


def first_status(cards: DataFrame) -> DataFrame:
    """``cards`` (subscribed_now, active, days, closed) with ``new_status`` where no status is known from before."""
    rules = [(F.col("closed"), "closed"), (F.col("active"), "grow"), (F.col("subscribed_now"), "onboard"), (F.col("days") <= 28, "onboard")]
    return cards.withColumn("new_status", first_match([(c, F.lit(v)) for c, v in rules], F.lit("never_activated")))


def card_lifecycle(cards: DataFrame, statuses: DataFrame, purchases: DataFrame, period: int, since: str, previous: DataFrame | None = None, months: int = 6) -> DataFrame:
    """(customer_key, card_id, status, period) of the cards that were open in the month ``period`` (YYYYMM).

    ``cards``: customer_key, card_id, subscription_date, activation_date, termination_date, last_period; ``statuses``:
    card_id, period, credit_limit; ``purchases``: basket_key, customer_key, transaction_date, amount, by_card (whether paid
    by a card of the house); ``previous``: the result for the month before, none in the first run.

    Cards' closing dates come from terminations and statuses; a missing activation is the first purchase by the card within
    a year. Cards of which no credit status is known have no row unless they close in the month. Shares of wallet and
    purchase cycles look ``months`` back.
    """
    start = dt.date(period // 100, period % 100, 1)
    end = (start + dt.timedelta(31)).replace(day=1)
    first_day, next_month, last_day = F.lit(start), F.lit(end), F.lit(end - dt.timedelta(1))
    known = closed_date(cards).select("customer_key", "card_id", "subscription_date", "activation_date", "closed_date")
    bought = purchases.where(F.col("transaction_date") < next_month)
    by_card = card_of_purchase(bought.where("by_card"), known).groupBy("card_id").agg(F.min("transaction_date").alias("first_purchase"))
    open_ = known.where((F.col("subscription_date") < next_month) & (F.col("closed_date").isNull() | (F.col("closed_date") >= first_day) | (F.col("subscription_date") >= first_day)))
    soon = F.datediff("first_purchase", "subscription_date") <= 365
    rows = open_.join(by_card, "card_id", "left").withColumn("activation_date", F.coalesce("activation_date", F.when(soon, F.col("first_purchase"))))
    rows = state_date(rows, since, end.isoformat())
    rows = rows.withColumn("state_date", F.when(F.col("state_date") < next_month, F.col("state_date")))
    rows = rows.withColumns({
        "closed": F.coalesce((F.col("closed_date") >= first_day) & (F.col("closed_date") < next_month), F.lit(False)),
        "days": F.when(F.col("state_date").isNull(), F.datediff(last_day, "subscription_date")).otherwise(0),
        "active": F.col("state_date").isNotNull(), "subscribed_now": F.col("subscription_date") >= first_day,
    })
    if previous is None:
        done = first_status(rows)
    else:
        limits = last_known_status(statuses, period).select("card_id", "credit_limit")
        window = bought.where(F.col("transaction_date") >= F.add_months(first_day, 1 - months))
        rows = rows.join(limits, "card_id", "left").where("closed OR credit_limit IS NOT NULL")
        rows = rows.join(share_of_wallet(window), "customer_key", "left").join(purchase_cycle(bought, start.isoformat(), end.isoformat()), "customer_key", "left").fillna(0, ["sow"]).fillna(NO_CYCLE, ["cycle"])
        rows = rows.join(previous.select("card_id", "status"), "card_id", "left").fillna("sin_estado", ["status"])
        done = next_status(with_thresholds(rows))
    return done.select("customer_key", "card_id", F.col("new_status").alias("status"), F.lit(period).alias("period"))
