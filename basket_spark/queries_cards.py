"""Queries of the card lifecycle from raw cards to states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binding as b
from .plans import cards
from .queries import _bands_sql, _purchases
from .registry import query
from .sources.shared import stored

FIRST, NEXT, SINCE = 200105, 200106, "1999-01-01"

_RAW = """
, rc AS (SELECT customer_key, card_id, subscription_date, credit_limit, CASE customer_key % 3 WHEN 0 THEN subscription_date + 20 WHEN 2 THEN subscription_date + CAST(customer_key % 500 AS INTEGER) END AS activation_date, closed_date AS termination_date,
  CASE WHEN customer_key % 7 = 0 THEN 200105 WHEN customer_key % 5 = 0 THEN 200101 WHEN customer_key % 11 <> 0 THEN 200107 END AS last_period FROM cards),
ra AS (SELECT *, CAST(make_date(last_period // 100, last_period % 100, 1) + INTERVAL 1 MONTH AS DATE) AS after_ FROM rc),
kc AS (SELECT * EXCLUDE (after_), CASE WHEN termination_date IS NOT NULL AND last_period IS NOT NULL AND date_trunc('month', termination_date) > after_ THEN after_ WHEN termination_date IS NOT NULL AND last_period IS NOT NULL AND date_trunc('month', termination_date) < after_ THEN termination_date
  WHEN termination_date IS NULL AND last_period IS NOT NULL THEN after_ WHEN termination_date IS NULL THEN subscription_date WHEN last_period IS NULL AND date_trunc('month', termination_date) > date_trunc('month', subscription_date) THEN subscription_date ELSE termination_date END AS closed FROM ra)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    c, k = b.cards(spark, d), F.col("customer_key")
    activation = F.when(k % 3 == 0, F.date_add("subscription_date", 20)).when(k % 3 == 2, F.date_add("subscription_date", (k % 500).cast("int")))
    last = F.when(k % 7 == 0, 200105).when(k % 5 == 0, 200101).when(k % 11 != 0, 200107)
    return c.select("customer_key", "card_id", "subscription_date", "credit_limit", activation.alias("activation_date"), F.col("closed_date").alias("termination_date"), last.alias("last_period"))


@query(f"{_RAW} SELECT card_id, closed AS closed_date FROM kc")
def card_closed_dates(spark, d):
    return cards.closed_date(_raw(spark, d)).select("card_id", "closed_date")


def _states_sql(p: str, period: int) -> str:
    """CTE ``{p}r``: the cards open in the month with their state date, whether they close in it, and days."""
    start = f"DATE '{period // 100}-{period % 100:02d}-01'"
    end = f"({start} + INTERVAL 1 MONTH)"
    return f"""
, {p}b AS (SELECT basket_key, customer_key, transaction_date, basket_value AS amount, channel IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS by_card FROM orders_ WHERE transaction_date < {end}),
{p}f AS (SELECT card_id, min(transaction_date) AS first FROM (SELECT p.basket_key, p.transaction_date, card_id, row_number() OVER (PARTITION BY basket_key ORDER BY subscription_date DESC, card_id DESC) AS i FROM {p}b p JOIN kc ON p.customer_key = kc.customer_key AND transaction_date >= subscription_date AND transaction_date < coalesce(closed, DATE '2100-01-01') WHERE by_card) WHERE i = 1 GROUP BY 1),
{p}o AS (SELECT kc.* REPLACE (coalesce(activation_date, CASE WHEN first - subscription_date <= 365 THEN first END) AS activation_date), first FROM kc LEFT JOIN {p}f USING (card_id) WHERE subscription_date < {end} AND (closed IS NULL OR closed >= {start} OR subscription_date >= {start})),
{p}s AS (SELECT *, CASE WHEN subscription_date >= DATE '{SINCE}' AND activation_date >= {end} THEN activation_date WHEN subscription_date >= DATE '{SINCE}' AND activation_date >= DATE '{SINCE}' AND (first IS NULL OR activation_date = first) THEN activation_date
  WHEN subscription_date >= DATE '{SINCE}' AND activation_date >= DATE '{SINCE}' AND first - subscription_date <= 365 THEN first WHEN subscription_date >= DATE '{SINCE}' AND activation_date >= DATE '{SINCE}' THEN NULL
  WHEN subscription_date >= DATE '{SINCE}' AND activation_date IS NULL AND first - subscription_date <= 365 THEN first ELSE activation_date END AS sd FROM {p}o),
{p}r AS (SELECT * REPLACE (CASE WHEN sd < {end} THEN sd END AS sd), coalesce(closed >= {start} AND closed < {end}, false) AS closing, CASE WHEN sd < {end} THEN 0 ELSE CAST({end} AS DATE) - 1 - subscription_date END AS days FROM {p}s)"""


_FIRST = f"""{_RAW}{_states_sql('f', FIRST)}, first_run AS (SELECT customer_key, card_id, CASE WHEN closing THEN 'closed' WHEN sd IS NOT NULL THEN 'grow' WHEN subscription_date >= DATE '2001-05-01' OR days <= 28 THEN 'onboard' ELSE 'never_activated' END AS status, {FIRST} AS period FROM fr)"""


def _statuses(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("card_id", F.explode(F.array(F.lit(200103), F.lit(200106))).alias("period"), "credit_limit")


def _paid(spark: SparkSession, d: str) -> DataFrame:
    return _purchases(spark, d).withColumn("by_card", F.col("channel").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query(f"{_FIRST} SELECT * FROM first_run")
def card_lifecycle_first(spark, d):
    return cards.card_lifecycle(_raw(spark, d), _statuses(spark, d), _paid(spark, d), FIRST, SINCE)


@query(f"""{_FIRST}{_states_sql('n', NEXT)}
, sow AS (SELECT customer_key, coalesce(round(100 * coalesce(sum(amount) FILTER (by_card), 0) / sum(amount)), 0) AS sow FROM nb WHERE transaction_date >= DATE '2001-01-01' GROUP BY 1),
cyc AS (SELECT customer_key, coalesce(CASE WHEN last >= DATE '2001-06-01' THEN last - before END, 500) AS cycle FROM (SELECT customer_key, transaction_date AS last, lag(transaction_date) OVER w AS before, row_number() OVER (PARTITION BY customer_key ORDER BY transaction_date DESC, basket_key DESC) AS i FROM nb WHERE by_card WINDOW w AS (PARTITION BY customer_key ORDER BY transaction_date, basket_key)) WHERE i = 1),
st AS (SELECT n.*, coalesce(sow, 0) AS sow, coalesce(cycle, 500) AS cycle, coalesce(f.status, 'sin_estado') AS status, {_bands_sql(cards.WALLET_BANDS, 0)} AS sow_e, {_bands_sql(cards.CYCLE_BANDS, 500)} AS cyc_e FROM nr n LEFT JOIN sow USING (customer_key) LEFT JOIN cyc USING (customer_key) LEFT JOIN (SELECT card_id, status FROM first_run) f USING (card_id) WHERE closing OR credit_limit >= 30000)
SELECT customer_key, card_id, CASE WHEN closing THEN 'closed'
  WHEN status = 'grow' THEN CASE WHEN sow >= sow_e AND cycle <= cyc_e THEN 'reward' WHEN sow < sow_e AND cycle > cyc_e THEN 'retain' ELSE 'grow' END
  WHEN status = 'reward' THEN CASE WHEN sow >= sow_e AND cycle <= cyc_e THEN 'reward' WHEN cycle > cyc_e AND (sow >= sow_e OR sow = 0) THEN 'retain' ELSE 'grow' END
  WHEN status IN ('retain', 'lapsed') THEN CASE WHEN sow > 0 THEN 'grow' ELSE 'lapsed' END WHEN status = 'never_activated' THEN CASE WHEN sow > 0 THEN 'grow' ELSE 'never_activated' END
  WHEN status = 'onboard' THEN CASE WHEN sd IS NOT NULL THEN 'grow' WHEN days <= 28 THEN 'onboard' ELSE 'never_activated' END
  WHEN status = 'sin_estado' THEN CASE WHEN sow > 0 THEN 'grow' ELSE 'onboard' END ELSE 'sin_estado' END AS status, {NEXT} AS period FROM st""")
def card_lifecycle_next(spark, d):
    c, s, p = stored(_raw(spark, d), "cards"), _statuses(spark, d), _paid(spark, d)
    before = stored(cards.card_lifecycle(c, s, p, FIRST, SINCE), "lifecycle")
    return cards.card_lifecycle(c, s, p, NEXT, SINCE, before)
