"""Queries that apply the operators and jobs to the tables of a folder, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binding as b
from .binding import ON_DATE
from .functions import dates, text
from .functions import vectors as vx
from .operators import aggregates, intervals, joins, kmeans, metrics, nearest, ranking, regression, similarity
from .plans import cards, customers, embeddings, ingests, pricing, sophistication, substitutes, usuals
from .registry import query
from .registry import rounded as _r
from .sources import incremental, readers, sheets, tables
from .sources.shared import stored

# Customers

_USUALS = """,
lines AS (SELECT * FROM sales WHERE transaction_date >= DATE '2001-07-01' - INTERVAL 24 MONTH AND transaction_date < DATE '2001-07-01' AND basket_key NOT IN (SELECT basket_key FROM delivery)),
regular AS (SELECT customer_key FROM lines GROUP BY 1 HAVING count(DISTINCT year(transaction_date) * 12 + month(transaction_date)) >= 2),
weekly AS (SELECT customer_key, ean, datediff('week', transaction_date, DATE '2001-07-01') AS weeks, count(DISTINCT txn_key) AS n FROM lines WHERE customer_key IN (SELECT customer_key FROM regular) GROUP BY 1, 2, 3),
scores AS (SELECT customer_key, ean, round(sum(n / log2(weeks + 2)), 6) AS score FROM weekly GROUP BY 1, 2),
caps AS (SELECT customer_key, CASE WHEN max(basket_quantity) <= 30 THEN 30 WHEN max(basket_quantity) <= 50 THEN 50 ELSE 100 END AS cap FROM baskets WHERE transaction_date >= DATE '2001-07-01' - INTERVAL 24 MONTH AND transaction_date < DATE '2001-07-01' GROUP BY 1),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY customer_key ORDER BY score DESC, ean) AS INTEGER) AS relevance FROM scores),
usual AS (SELECT customer_key, ean, score, relevance FROM ranked LEFT JOIN caps USING (customer_key) WHERE relevance <= coalesce(cap, 30))"""


def _usuals(spark: SparkSession, d: str, on_date: str = ON_DATE) -> DataFrame:
    return usuals.usuals(b.sales(spark, d), b.baskets(spark, d), b.delivery(spark, d), on_date, months=24, filter_months=24)


@query(f"{_USUALS} SELECT * FROM usual")
def usuals_ranked(spark, d):
    return _usuals(spark, d)


@query(f"{_USUALS} SELECT customer_key, CAST(count(*) AS BIGINT) AS n, max(relevance) AS last FROM usual GROUP BY 1")
def usuals_capped(spark, d):
    return _usuals(spark, d).groupBy("customer_key").agg(F.count("*").alias("n"), F.max("relevance").alias("last"))


_SPEND = """, spend AS (SELECT customer_key, CAST(year(transaction_date) * 4 + quarter(transaction_date) AS INTEGER) AS period, sum(basket_value) AS spend, count(DISTINCT basket_key) AS n_baskets FROM orders_ WHERE basket_key NOT IN (SELECT basket_key FROM delivery) GROUP BY 1, 2)"""
_PERIOD = 2001 * 4 + 3


def _spend(spark: SparkSession, d: str) -> DataFrame:
    return customers.customer_period_spend(b.orders(spark, d), b.delivery(spark, d), unit="quarter")


@query(f"{_SPEND} SELECT customer_key, period, round(spend, 2) AS spend, n_baskets FROM spend")
def customer_period_spend(spark, d):
    return _spend(spark, d).select("customer_key", "period", *_r("spend", digits=2), "n_baskets")


@query(", spend AS (SELECT customer_key, CAST(year(transaction_date) * 12 + month(transaction_date) AS INTEGER) AS period, sum(basket_value) AS spend, count(DISTINCT basket_key) AS n_baskets FROM orders_ WHERE channel = '2-HIGH' GROUP BY 1, 2) SELECT customer_key, period, round(spend, 2) AS spend, n_baskets FROM spend")
def ecommerce_period_spend(spark, d):
    only = b.orders(spark, d).where("channel = '2-HIGH'").select("basket_key")
    return customers.customer_period_spend(b.orders(spark, d), only=only).select("customer_key", "period", *_r("spend", digits=2), "n_baskets")


def _lifecycle_sql(period: int, previous: str | None, prefix: str) -> str:
    flags = ", ".join(f"max(CASE WHEN period = {period - i} THEN 1 ELSE 0 END) AS a{i}" for i in range(1, 5))
    base = f"""
{prefix}z AS (SELECT customer_key, period, ln(1 + spend) - ln(1 + avg(spend) OVER (PARTITION BY period)) AS z FROM spend WHERE spend >= 10000),
{prefix}f AS (SELECT customer_key, {flags}, count(*) AS n, regr_slope(z, period - {period - 4}) AS slope FROM {prefix}z WHERE period BETWEEN {period - 4} AND {period - 1} GROUP BY 1),"""
    if previous is None:
        base += f"{prefix}u AS (SELECT *, 'no_existia' AS p FROM {prefix}f), {prefix}q AS (SELECT *, CASE WHEN a1 = 1 THEN 'nuevo1' ELSE 'sin estado' END AS g FROM {prefix}u),"
    else:
        base += f"""{prefix}u AS (SELECT coalesce(f.customer_key, v.customer_key) AS customer_key, coalesce(a1, 0) AS a1, coalesce(a2, 0) AS a2, coalesce(a3, 0) AS a3, coalesce(a4, 0) AS a4, n, f.slope, coalesce(v.status, 'no_existia') AS p
  FROM {prefix}f f FULL JOIN {previous} v ON f.customer_key = v.customer_key WHERE f.customer_key IS NOT NULL OR v.status <> 'sin estado'),
{prefix}q AS (SELECT *, CASE WHEN p IN ('sin estado', 'no_existia') AND a1 = 1 THEN 'nuevo1' WHEN p = 'nuevo1' THEN 'nuevo2'
  WHEN p = 'nuevo2' THEN CASE WHEN a1 + a2 + a3 <= 1 THEN 'sin estado' WHEN a1 + a2 + a3 = 2 THEN 'esporadico' ELSE 'GRR' END
  WHEN p IN ('crecimiento', 'estable', 'decrecimiento', 'esporadico') THEN CASE WHEN a1 + a2 + a3 + a4 >= 3 THEN 'GRR' WHEN a1 + a2 = 0 THEN 'fugado' ELSE 'esporadico' END
  WHEN p = 'fugado' THEN CASE WHEN a1 = 1 AND a2 + a3 + a4 = 0 THEN 'recuperado' WHEN a1 + a2 + a3 + a4 = 0 THEN 'sin estado' WHEN a1 + a2 = 0 THEN 'fugado' ELSE 'esporadico' END
  WHEN p = 'recuperado' THEN 'esporadico' ELSE 'sin estado' END AS g FROM {prefix}u),"""
    return base + f"""
{prefix}s AS (SELECT customer_key, CASE WHEN g <> 'GRR' THEN g WHEN coalesce(n, 0) < 2 OR slope IS NULL THEN 'ERROR' WHEN exp(slope) - 1 >= 0.15 THEN 'crecimiento' WHEN exp(slope) - 1 <= -0.15 THEN 'decrecimiento' ELSE 'estable' END AS status,
  p AS previous_status, CASE WHEN g = 'GRR' THEN slope END AS slope, CASE WHEN g = 'GRR' THEN exp(slope) - 1 END AS rate FROM {prefix}q),
{prefix}o AS (SELECT * FROM {prefix}s WHERE NOT (status = 'sin estado' AND previous_status IN ('sin estado', 'no_existia')))"""


def _lifecycle(spark: SparkSession, d: str, runs: int) -> DataFrame:
    spend, previous = _spend(spark, d), None
    for k in range(runs - 1, -1, -1):
        previous = customers.lifecycle_status(spend, _PERIOD - k, previous)
    return previous.select("customer_key", "status", "previous_status", *_r("slope", "rate"))


def _lifecycle_query(runs: int) -> str:
    parts = [_lifecycle_sql(_PERIOD - k, f"r{runs - 1 - k - 1}o" if k < runs - 1 else None, f"r{runs - 1 - k}") for k in range(runs - 1, -1, -1)]
    return f"{_SPEND},{','.join(parts)} SELECT customer_key, status, previous_status, round(slope, 6) AS slope, round(rate, 6) AS rate FROM r{runs - 1}o"


@query(" SELECT channel, CAST(count(*) AS BIGINT) AS n, count(*) / sum(count(*)) OVER () AS share FROM orders_ GROUP BY 1")
def share_of_channels(spark, d):
    return customers.share_of_rows(b.orders(spark, d), "channel")


@query(_lifecycle_query(1))
def lifecycle_first(spark, d):
    return _lifecycle(spark, d, 1)


@query(_lifecycle_query(3))
def lifecycle_next(spark, d):
    return _lifecycle(spark, d, 3)


@query(_lifecycle_query(5))
def lifecycle_trend(spark, d):
    return _lifecycle(spark, d, 5)


@query("""
, m AS (SELECT o_custkey AS customer_key, o_orderkey AS membership_id, CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS end_date FROM orders WHERE o_orderpriority = '3-MEDIUM'),
a AS (SELECT DISTINCT customer_key FROM m WHERE start_date <= DATE '2001-07-01' AND end_date >= DATE '2001-07-01')
SELECT c_custkey AS customer_key, CASE WHEN a.customer_key IS NULL THEN 'No' ELSE 'Si' END AS membership FROM customer LEFT JOIN a ON c_custkey = a.customer_key""")
def latest_membership_flag(spark, d):
    o = b.orders(spark, d).where("channel = '3-MEDIUM'")
    m = o.select("customer_key", F.col("basket_key").alias("membership_id"), F.col("transaction_date").alias("start_date"), F.add_months("transaction_date", 12).alias("end_date"), F.lit(None).cast("date").alias("inactive_date"))
    return customers.with_membership(b.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key")), m, ON_DATE)


# Cards

_ASSIGNED = """
, purchase AS (SELECT basket_key, customer_key, transaction_date, basket_value AS amount, channel FROM orders_),
assigned AS (SELECT * FROM (SELECT p.*, card_id, credit_limit, row_number() OVER (PARTITION BY basket_key ORDER BY subscription_date DESC, card_id DESC) AS i FROM purchase p JOIN cards c ON p.customer_key = c.customer_key AND transaction_date >= subscription_date AND transaction_date < coalesce(closed_date, DATE '2100-01-01')) WHERE i = 1),
by_card AS (SELECT p.*, (a.basket_key IS NOT NULL AND p.channel IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS by_card FROM purchase p LEFT JOIN assigned a USING (basket_key))"""


def _purchases(spark: SparkSession, d: str) -> DataFrame:
    return b.orders(spark, d).withColumnRenamed("basket_value", "amount")


def _by_card(spark: SparkSession, d: str) -> DataFrame:
    p = _purchases(spark, d)
    mine = cards.card_of_purchase(p, b.cards(spark, d)).select("basket_key", F.lit(True).alias("has"))
    return p.join(mine, "basket_key", "left").withColumn("by_card", F.coalesce("has", F.lit(False)) & F.col("channel").isin("1-URGENT", "2-HIGH", "3-MEDIUM")).drop("has")


@query(f"{_ASSIGNED} SELECT basket_key, customer_key, card_id, transaction_date FROM assigned")
def card_purchase_assign(spark, d):
    return cards.card_of_purchase(_purchases(spark, d), b.cards(spark, d)).select("basket_key", "customer_key", "card_id", "transaction_date")


_SOW = "SELECT customer_key, coalesce(round(100 * coalesce(sum(amount) FILTER (by_card), 0) / sum(amount)), 0) AS sow FROM by_card GROUP BY 1"
_CYCLE = """SELECT customer_key, CAST(coalesce(CASE WHEN last >= DATE '2001-01-01' THEN last - before END, 500) AS INTEGER) AS cycle FROM (
  SELECT customer_key, transaction_date AS last, lag(transaction_date) OVER w AS before, row_number() OVER (PARTITION BY customer_key ORDER BY transaction_date DESC, basket_key DESC) AS i FROM by_card WHERE by_card AND transaction_date < DATE '2001-07-01' WINDOW w AS (PARTITION BY customer_key ORDER BY transaction_date, basket_key)) WHERE i = 1"""


@query(f"{_ASSIGNED} {_SOW}")
def share_of_wallet(spark, d):
    return cards.share_of_wallet(_by_card(spark, d))


@query(f"{_ASSIGNED} {_CYCLE}")
def purchase_cycle(spark, d):
    return cards.purchase_cycle(_by_card(spark, d), "2001-01-01", ON_DATE)


def _bands_sql(steps: list[tuple[int, int]], below: int) -> str:
    return "CASE " + " ".join(f"WHEN credit_limit >= {bound} THEN {x}" for bound, x in sorted(steps, reverse=True)) + f" ELSE {below} END"


@query(f"""{_ASSIGNED}, sow AS ({_SOW}), cyc AS ({_CYCLE}), st AS (
 SELECT c.card_id, CASE c.customer_key % 6 WHEN 0 THEN 'grow' WHEN 1 THEN 'reward' WHEN 2 THEN 'retain' WHEN 3 THEN 'onboard' WHEN 4 THEN 'never_activated' ELSE 'sin_estado' END AS status, coalesce(sow, 0) AS sow, coalesce(cycle, 500) AS cycle,
  {_bands_sql(cards.WALLET_BANDS, 0)} AS sow_e, {_bands_sql(cards.CYCLE_BANDS, 500)} AS cyc_e, CASE WHEN c.customer_key % 4 > 0 THEN subscription_date END AS state_date, DATE '2001-07-01' - subscription_date AS days, coalesce(closed_date <= DATE '2001-07-01', false) AS closed
 FROM cards c LEFT JOIN sow USING (customer_key) LEFT JOIN cyc USING (customer_key))
SELECT card_id, status, CASE WHEN closed THEN 'closed'
  WHEN status = 'grow' THEN CASE WHEN sow >= sow_e AND cycle <= cyc_e THEN 'reward' WHEN sow < sow_e AND cycle > cyc_e THEN 'retain' ELSE 'grow' END
  WHEN status = 'reward' THEN CASE WHEN sow >= sow_e AND cycle <= cyc_e THEN 'reward' WHEN cycle > cyc_e AND (sow >= sow_e OR sow = 0) THEN 'retain' ELSE 'grow' END
  WHEN status = 'retain' THEN CASE WHEN sow > 0 THEN 'grow' ELSE 'lapsed' END WHEN status = 'never_activated' THEN CASE WHEN sow > 0 THEN 'grow' ELSE 'never_activated' END
  WHEN status = 'onboard' THEN CASE WHEN state_date IS NOT NULL THEN 'grow' WHEN days <= 28 THEN 'onboard' ELSE 'never_activated' END
  WHEN sow > 0 THEN 'grow' ELSE 'onboard' END AS new_status FROM st""")
def card_status_next(spark, d):
    bought = _by_card(spark, d)
    day = F.lit(ON_DATE).cast("date")
    names = F.array(*[F.lit(x) for x in ("grow", "reward", "retain", "onboard", "never_activated", "sin_estado")])
    c = b.cards(spark, d).join(cards.share_of_wallet(bought), "customer_key", "left").join(cards.purchase_cycle(bought, "2001-01-01", ON_DATE), "customer_key", "left").fillna(0, ["sow"]).fillna(500, ["cycle"])
    c = c.withColumns({"status": F.get(names, (F.col("customer_key") % 6).cast("int")), "state_date": F.when(F.col("customer_key") % 4 > 0, F.col("subscription_date")), "days": F.datediff(day, "subscription_date"), "closed": F.coalesce(F.col("closed_date") <= day, F.lit(False))})
    return cards.next_status(cards.with_thresholds(c)).select("card_id", "status", "new_status")


@query(", st AS (SELECT c_custkey AS card_id, q AS period, CAST(floor(abs(c_acctbal)) * 10 + q AS DOUBLE) AS credit_limit FROM customer, range(1, 6) t(q)) SELECT card_id, CAST(max(period) AS INTEGER) AS period, max_by(credit_limit, period) AS credit_limit FROM st WHERE credit_limit >= 30000 AND period <= 4 GROUP BY 1")
def last_known_status(spark, d):
    c = b.table(spark, d, "customer").select(F.col("c_custkey").alias("card_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("period"), "c_acctbal")
    return cards.last_known_status(c.select("card_id", "period", (F.floor(F.abs("c_acctbal")) * 10 + F.col("period")).cast("double").alias("credit_limit")), 4)


# Joins and sets

@query(" SELECT basket_key, customer_key FROM orders_ WHERE customer_key IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join(spark, d):
    return b.orders(spark, d).join(b.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_key")), "customer_key", "left_semi").select("basket_key", "customer_key")


@query(" SELECT o.basket_key, o.customer_key FROM orders_ o LEFT JOIN delivery USING (basket_key) WHERE delivery.basket_key IS NULL")
def anti_join(spark, d):
    return b.orders(spark, d).join(b.delivery(spark, d), "basket_key", "left_anti").select("basket_key", "customer_key")


@query(" SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN customer_key % 2 = 0 THEN customer_key ELSE -1 END FROM orders_)")
def not_in_join(spark, d):
    keys = b.orders(spark, d).select(F.when(F.col("customer_key") % 2 == 0, F.col("customer_key")).otherwise(-1).alias("k")).distinct()
    return joins.not_in(b.table(spark, d, "customer").select("c_custkey"), "c_custkey", keys, "k")


@query(" SELECT c_custkey AS customer_key, CAST(count(basket_key) AS BIGINT) AS n FROM customer LEFT JOIN orders_ ON c_custkey = customer_key AND transaction_date >= DATE '2001-01-01' GROUP BY 1")
def left_filtered_join(spark, d):
    late = b.orders(spark, d).where("transaction_date >= DATE '2001-01-01'")
    return b.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key")).join(late, "customer_key", "left").groupBy("customer_key").agg(F.count("basket_key").alias("n"))


@query(" SELECT a.basket_key AS order_id, o.ean AS original, a.ean AS substitute FROM sales a JOIN sales o ON a.basket_key = o.basket_key AND o.line_no = a.line_no - 1 WHERE a.transaction_type = 'R'")
def self_substitution(spark, d):
    lines = b.sales(spark, d).select(F.col("basket_key").alias("order_id"), "line_no", "ean", F.when(F.col("transaction_type") == "R", F.col("line_no") - 1).alias("replaces"))
    return ingests.order_substitutions(lines)


@query(" SELECT coalesce(c_custkey, s_suppkey) AS key, c_custkey IS NOT NULL AS left_side, s_suppkey IS NOT NULL AS right_side FROM customer FULL JOIN supplier ON c_custkey = s_suppkey + 5")
def full_outer_union_keys(spark, d):
    c, s = b.table(spark, d, "customer").select("c_custkey"), b.table(spark, d, "supplier").select("s_suppkey")
    return c.join(s, c.c_custkey == s.s_suppkey + 5, "full").select(F.coalesce("c_custkey", "s_suppkey").alias("key"), F.col("c_custkey").isNotNull().alias("left_side"), F.col("s_suppkey").isNotNull().alias("right_side"))


@query(" SELECT DISTINCT customer_key FROM (SELECT customer_key FROM orders_ WHERE channel = '1-URGENT' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def union_of_keys(spark, d):
    return joins.union_of_keys(b.orders(spark, d).where("channel = '1-URGENT'"), b.table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("customer_key")), "customer_key")


@query(", promo AS (SELECT p_partkey AS ean, DATE '1997-01-01' + CAST(p_partkey % 700 AS INTEGER) AS s, DATE '1997-01-01' + CAST(p_partkey % 700 + 200 AS INTEGER) AS e FROM part) SELECT ean, date, EXISTS (SELECT 1 FROM promo p WHERE p.ean = daily.ean AND date BETWEEN s AND e) AS promo FROM daily")
def promo_day_flag(spark, d):
    start = F.date_add(F.lit("1997-01-01").cast("date"), (F.col("ean") % 700).cast("int"))
    promo = b.products(spark, d).select("ean", start.alias("s"), F.date_add(start, 200).alias("e"))
    return intervals.covered_flag(b.daily(spark, d).select("ean", "date"), promo, "ean", "date", "s", "e", "promo")


# Ranks and aggregates

@query(" SELECT customer_key, CAST(dense_rank() OVER (ORDER BY customer_key) AS BIGINT) AS customer_index, txn_key, CAST(dense_rank() OVER (ORDER BY transaction_date DESC, store_id) AS BIGINT) AS visit_index FROM sales")
def customer_index(spark, d):
    """Customers and the days of stores numbered over the whole table, as batches of customers are cut from it."""
    rows = b.sales(spark, d).select("customer_key", "txn_key", "transaction_date", "store_id")
    rows = ranking.global_rank(rows, {"customer_key": "asc"}, "customer_index", "dense_rank")
    return ranking.global_rank(rows, {"transaction_date": "desc", "store_id": "asc"}, "visit_index", "dense_rank").select("customer_key", "customer_index", "txn_key", "visit_index")


_MONTHS = """
, m AS (SELECT DISTINCT category, 12 * year(transaction_date) + month(transaction_date) AS p, customer_key FROM sales JOIN products USING (ean)),
per_ AS (SELECT category, unnest(range(min(p), (SELECT max(p) + 1 FROM m))) AS period FROM m GROUP BY 1)"""


@query(f"{_MONTHS} SELECT category, CAST(period AS INTEGER) AS period, " + ", ".join(f"(SELECT count(DISTINCT customer_key) FROM m WHERE m.category = per_.category AND p BETWEEN period - {w - 1} AND period) AS distinct_{w}" for w in (1, 6, 12)) + " FROM per_")
def rolling_customers(spark, d):
    """Different customers of a category in the last 1, 6 and 12 months."""
    rows = b.sales(spark, d).join(b.products(spark, d), "ean")
    month = 12 * F.year("transaction_date") + F.month("transaction_date")
    return aggregates.rolling_distinct(rows, ["category"], month, F.col("customer_key"), [1, 6, 12])


@query(" SELECT basket_key, CAST(row_number() OVER (ORDER BY basket_value DESC, basket_key) AS BIGINT) AS place FROM orders_")
def basket_places(spark, d):
    rows = b.orders(spark, d).select("basket_key", "basket_value")
    return ranking.global_rank(rows, {"basket_value": "desc", "basket_key": "asc"}, "place").select("basket_key", "place")


@query(" SELECT sub_category, unit, ean FROM (SELECT *, row_number() OVER (PARTITION BY sub_category, unit ORDER BY CASE WHEN brand = 'Brand#7' THEN 0 ELSE 1 END, ean) AS i FROM products) WHERE i = 1")
def canonical_ean(spark, d):
    p = b.products(spark, d).withColumn("main", F.when(F.col("brand") == "Brand#7", "X"))
    return similarity.canonical_code(p, "sub_category", "unit", "ean", "main").select("sub_category", "unit", "ean")


@query(" SELECT ean, category, CAST(dense_rank() OVER (PARTITION BY category ORDER BY weight DESC) AS INTEGER) AS place FROM products")
def dense_rank_groups(spark, d):
    return ranking.with_rank(b.products(spark, d), ["category"], [F.desc("weight")], "place", "dense_rank").select("ean", "category", "place")


@query(" SELECT basket_key, line_no, ean FROM (SELECT *, row_number() OVER (PARTITION BY basket_key ORDER BY value DESC, line_no) AS i FROM sales) WHERE i <= 2")
def top_lines(spark, d):
    return ranking.top_k(b.sales(spark, d), ["basket_key"], [F.desc("value"), F.asc("line_no")], 2).select("basket_key", "line_no", "ean")


_MONTHLY = """
, monthly AS (SELECT ean, CAST(year(date) * 12 + month(date) AS INTEGER) AS month, avg(price) AS price FROM daily GROUP BY 1, 2),
prev AS (SELECT m.ean, m.month, avg(p.price) AS previous_price FROM monthly m JOIN monthly p ON m.ean = p.ean AND p.month BETWEEN m.month - 3 AND m.month - 1 GROUP BY 1, 2),
changes AS (SELECT m.ean, m.month, m.price, previous_price, (m.price - previous_price) / previous_price AS change FROM monthly m LEFT JOIN prev USING (ean, month))"""


@query(f"{_MONTHLY} SELECT ean, month, round(price, 7) AS price, round(previous_price, 7) AS previous_price, round(change, 7) AS change FROM changes")
def prev_three_months(spark, d):
    return pricing.previous_months_price(b.daily(spark, d)).select("ean", "month", *_r("price", "previous_price", "change", digits=7))


_VALUED = """
, value_ AS (SELECT ean, sub_category, CAST(year(date) * 12 + month(date) AS INTEGER) AS month, sum(value) AS value FROM daily GROUP BY 1, 2, 3),
firsts AS (SELECT ean, min(month) AS first FROM changes GROUP BY 1), cut AS (SELECT max(month) AS cut FROM (SELECT DISTINCT month FROM changes ORDER BY 1 LIMIT 3)),
kept AS (SELECT c.ean, c.month, previous_price, coalesce(change, 0) AS change, sub_category, value FROM changes c JOIN value_ USING (ean, month) JOIN firsts USING (ean), cut WHERE month > cut AND month > first),
others AS (SELECT *, CASE WHEN abs(sum(value) OVER w - value) > 1e-9 * abs(sum(value) OVER w) THEN (sum(change * value) OVER w - change * value) / (sum(value) OVER w - value) ELSE 0 END AS others_change FROM kept WINDOW w AS (PARTITION BY sub_category, month))"""


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    daily = stored(b.daily(spark, d), "daily")  # read by three steps
    value = daily.groupBy("ean", "sub_category", dates.period_index(F.col("date")).alias("month")).agg(F.sum("value").alias("value"))
    return pricing.without_cold_start(pricing.previous_months_price(daily).join(value, ["ean", "month"])).fillna(0.0, ["change"])


@query(f"{_MONTHLY} {_VALUED} SELECT ean, month, sub_category, round(change, 7) + 0.0 AS change, round(others_change, 7) + 0.0 AS others_change FROM others")
def exclude_self_change(spark, d):
    return pricing.change_of_others(_monthly(spark, d)).select("ean", "month", "sub_category", *[(F.round(c, 7) + 0.0).alias(c) for c in ("change", "others_change")])


@query(f"{_MONTHLY} {_VALUED} SELECT d.ean, d.date, round(previous_price, 7) AS previous_price, round(change, 7) + 0.0 AS change, round(others_change, 7) + 0.0 AS others_change, CAST(isodow(d.date) = 1 AS INTEGER) AS weekday_0, CAST(isodow(d.date) = 7 AS INTEGER) AS weekday_6 FROM daily d JOIN others o ON d.ean = o.ean AND year(d.date) * 12 + month(d.date) = o.month")
def regression_features(spark, d):
    return pricing.regression_features(b.daily(spark, d)).select("ean", "date", *[(F.round(c, 7) + 0.0).alias(c) for c in ("previous_price", "change", "others_change")], "weekday_0", "weekday_6")


@query(", t AS (SELECT ean, nullif(weight % 3, 0) AS a, nullif(weight % 4, 0) AS b, nullif(weight % 5, 0) AS c, nullif(weight % 7, 0) AS d, nullif(weight % 11, 0) AS e FROM products) SELECT ean, coalesce(a, b, c, d, e) AS first_one, list_avg(list_filter([a, b, c, d, e], lambda x: x IS NOT NULL)[1:3]) AS mean_three FROM t")
def first_of_five(spark, d):
    cols = ["a", "b", "c", "d", "e"]
    t = b.products(spark, d).select("ean", *[F.nullif(F.col("weight") % n, F.lit(0)).alias(c) for c, n in zip(cols, (3, 4, 5, 7, 11), strict=True)])
    return t.select("ean", aggregates.first_of(cols).alias("first_one"), aggregates.mean_of_first(cols, 3).alias("mean_three"))


@query(f""", days AS (SELECT category, date, isodow(date) AS wd, sum(value) AS total FROM daily GROUP BY 1, 2), means AS (SELECT category, wd, avg(total) AS mean FROM days GROUP BY 1, 2)
SELECT category, date, round(total / mean, 4) AS proportion, CASE {' '.join(f"WHEN total >= {n} * mean THEN '{x}'" for n, x in pricing.MULTIPLIERS)} ELSE 'x0.5' END AS multiplier FROM days JOIN means USING (category, wd)""")
def day_multiplier(spark, d):
    return pricing.day_multiplier(b.daily(spark, d)).select("category", "date", *_r("proportion", digits=4), "multiplier")


@query(", b AS (SELECT category, quantile_cont(CAST(value AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(value AS DOUBLE), 0.95) AS hi FROM daily GROUP BY 1) SELECT category, CAST(count(*) AS BIGINT) AS n, round(min(value), 4) AS least, round(max(value), 4) AS most FROM daily JOIN b USING (category) WHERE value BETWEEN lo AND hi GROUP BY 1")
def percentile_trim(spark, d):
    kept = aggregates.percentile_trim(b.daily(spark, d), ["category"], "value", 0.05, 0.95)
    return kept.groupBy("category").agg(F.count("*").alias("n"), F.round(F.min("value"), 4).alias("least"), F.round(F.max("value"), 4).alias("most"))


@query(f"{_SPEND} SELECT customer_key, {', '.join(f'CAST(max(CASE WHEN period = {_PERIOD - i} THEN 1 ELSE 0 END) AS INTEGER) AS q{i}' for i in range(1, 5))} FROM spend WHERE period BETWEEN {_PERIOD - 4} AND {_PERIOD - 1} GROUP BY 1")
def pivot_activity(spark, d):
    return aggregates.pivot_flags(_spend(spark, d), "customer_key", "period", [_PERIOD - i for i in range(1, 5)], [f"q{i}" for i in range(1, 5)])


_CENTS = f"{_SPEND}, c AS (SELECT customer_key, period - {_PERIOD} AS t, round(spend * 100) AS y FROM spend)"


@query(f"{_CENTS} SELECT customer_key, round((count(*) * sum(t * y) - sum(t) * sum(y)) / nullif(count(*) * sum(t * t) - sum(t) * sum(t), 0), 0) AS slope, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY 1")
def spend_slope(spark, d):
    """In whole cents, so that the sums are exact in any order and a half is one half."""
    cents = _spend(spark, d).withColumn("cents", F.round(F.col("spend") * 100))
    return cents.groupBy("customer_key").agg(aggregates.slope("cents", F.col("period") - _PERIOD).alias("slope"), F.count("*").alias("n")).select("customer_key", *_r("slope", digits=0), "n")


def _score_sql(by: str) -> str:
    return f"""
, lines AS (SELECT * FROM sales JOIN products USING (ean)), kept AS (SELECT {by} FROM lines GROUP BY ALL HAVING count(*) >= 3),
i AS (SELECT {by}, quantity, value, value / quantity / avg(value / quantity) OVER w AS pu, value / (weight * quantity) / avg(value / (weight * quantity)) OVER w AS ppum FROM lines JOIN kept USING ({by}) WHERE weight > 0 WINDOW w AS (PARTITION BY sub_category || ' - ' || unit)),
parts AS (SELECT {by}, sum(pu * quantity) / sum(quantity) AS a, sum(ppum * quantity) / sum(quantity) AS b, sum(value) AS total_value FROM i GROUP BY {by}),
scores AS (SELECT {by}, 2 * a * b / (a + b) AS hm_pu_ppum, total_value FROM parts)"""


def _score(spark: SparkSession, d: str, by: list[str]) -> DataFrame:
    return sophistication.sophistication_score(b.sales(spark, d), b.products(spark, d), by)


@query(f"{_score_sql('customer_key, category')} SELECT customer_key, category, round(hm_pu_ppum, 5) AS hm_pu_ppum, round(total_value, 2) AS total_value FROM scores")
def weighted_harmonic_score(spark, d):
    return _score(spark, d, ["customer_key", "category"]).select("customer_key", "category", *_r("hm_pu_ppum", digits=5), *_r("total_value", digits=2))


@query(f"{_score_sql('category, brand')} SELECT category, brand, round(hm_pu_ppum, 5) AS hm_pu_ppum, round(total_value, 2) AS total_value FROM scores")
def sophistication_by_brand(spark, d):
    return _score(spark, d, ["category", "brand"]).select("category", "brand", *_r("hm_pu_ppum", digits=5), *_r("total_value", digits=2))


# Vectors and names

_DOT = "list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"
_COS = f"1 - {_DOT} / (sqrt(list_sum(list_transform(a.embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) * sqrt(list_sum(list_transform(b.embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))))"


@query(f", p AS (SELECT a.vec_id AS a, b.vec_id AS b, {_COS} AS distance FROM embeddings a, embeddings b WHERE b.vec_id % 20 = 0) SELECT a AS vec_id, b AS query_id, round(distance, 4) + 0.0 AS distance FROM p WHERE distance < 1 - 1e-9")
def cosine_pairs(spark, d):
    e = b.table(spark, d, "embeddings")
    return similarity.cosine_pairs(e, e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), "vec_id", "query_id", below=1 - 1e-9, digits=12).select("vec_id", "query_id", (F.round("distance", 4) + 0.0).alias("distance"))


@query(f", p AS (SELECT b.vec_id AS query_id, a.vec_id, round({_COS}, 6) + 0.0 AS distance FROM embeddings a, embeddings b WHERE b.vec_id % 20 = 0) SELECT query_id, vec_id, distance FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= 10")
def nearest_vectors(spark, d):
    """The ten nearest vectors of those with an id divisible by 20, by clusters that are ruled out."""
    e = b.table(spark, d, "embeddings")
    return nearest.nearest_rows(e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), e, "query_id", "vec_id", 10)


@query(", r AS (SELECT customer_key, ean, CAST(max(quantity) AS DOUBLE) AS ranking FROM sales GROUP BY 1, 2), j AS (SELECT r.*, row_number() OVER (PARTITION BY customer_key ORDER BY ranking DESC, ean) AS i FROM r JOIN (SELECT DISTINCT ean FROM products WHERE category = 'ECONOMY') USING (ean)) SELECT customer_key, ean, ranking FROM j WHERE i <= 3")
def filtered_recommendations(spark, d):
    r = b.sales(spark, d).groupBy("customer_key", "ean").agg(F.max("quantity").alias("ranking"))
    return similarity.filter_recommendations(r, b.products(spark, d).where("category = 'ECONOMY'").select("ean", "brand"), "ranking", 3, largest=True)


@query(", f AS (SELECT vec_id, label, list_transform(embedding[1:19], lambda v: CAST(v > 0.1 AS INTEGER)) AS f FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, CAST(list_sum(list_transform(list_zip(a.f, b.f), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS DOUBLE) AS r FROM f a JOIN f b ON a.label = b.label AND a.vec_id <> b.vec_id), q AS (SELECT a, b, round(2 * r / (19 + r), 6) AS distance FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS i FROM q) SELECT a, b, distance FROM k WHERE i <= 10")
def rogers_tanimoto_pairs(spark, d):
    f = b.table(spark, d, "embeddings").select("vec_id", "label", F.transform(F.slice("embedding", 1, 19), lambda v: (v > 0.1).cast("int")).alias("f"))
    return similarity.nearest_flags(f, "vec_id", "f", "label", 10)


@query(r"""
, tok AS (SELECT ean, unnest(regexp_extract_all(lower(nm), '\b\w\w+\b')) AS token FROM products), tf AS (SELECT ean, token, count(*) AS tf FROM tok GROUP BY 1, 2), df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT ean, token, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df USING (token), (SELECT CAST(count(*) AS DOUBLE) AS n FROM products))
SELECT ean, token, round(w / sqrt(sum(w * w) OVER (PARTITION BY ean)), 6) AS weight FROM w""")
def tfidf_terms(spark, d):
    return similarity.tf_idf(b.products(spark, d), "ean", "nm").select("ean", "token", *_r("weight"))


@query(""", m AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM (SELECT label, unnest(embedding) AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
e AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS w FROM embeddings) SELECT vec_id, round(1 - list_dot_product(v, w) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(w, w))), 6) + 0.0 AS distance FROM e JOIN m USING (label)""")
def distance_to_mean(spark, d):
    e = b.table(spark, d, "embeddings")
    means = similarity.mean_vectors(e, "label", "embedding").withColumnRenamed("embedding", "mean")
    return e.join(means, "label").select("vec_id", (F.round(vx.cosine_distance(F.col("embedding"), F.col("mean")), 6) + 0.0).alias("distance"))


@query(" SELECT label, i, round(avg(CAST(x AS DOUBLE)), 5) AS x FROM (SELECT label, unnest(embedding) AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY 1, 2")
def mean_vectors(spark, d):
    m = similarity.mean_vectors(b.table(spark, d, "embeddings"), "label", "embedding")
    return m.select("label", F.posexplode("embedding").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), *_r("x", digits=5))


@query("""
, per AS (SELECT customer_key, ean AS sku, count(DISTINCT txn_key) AS freq, datediff('week', max(transaction_date), DATE '2001-07-01') AS weeks FROM sales WHERE transaction_date >= DATE '2000-07-01' AND transaction_date < DATE '2001-07-01' GROUP BY 1, 2),
long AS (SELECT customer_key, sku, freq / log2(weeks + 2) AS s, unnest(embedding) AS x, unnest(range(64)) AS i FROM per JOIN embeddings ON sku = vec_id)
SELECT customer_key, i, round(sum(x * s) / count(DISTINCT sku), 4) AS x FROM long GROUP BY 1, 2""")
def customer_vectors(spark, d):
    e = b.table(spark, d, "embeddings").select(F.col("vec_id").alias("sku"), "embedding")
    v = embeddings.customer_embeddings(b.sales(spark, d), e, ON_DATE)
    return v.select("customer_key", F.posexplode("embedding").alias("i", "x")).select("customer_key", F.col("i").cast("long").alias("i"), *_r("x", digits=4))


_SUBSTITUTES = f"""
, e AS (SELECT label AS category, vec_id AS ean, embedding, list_transform(embedding[1:19], lambda v: CAST(v > 0.1 AS INTEGER)) AS f, CAST(vec_id % 3 AS VARCHAR) AS container, 1 + (vec_id % 10) / 10 AS price_index FROM embeddings),
p AS (SELECT a.category, a.ean, b.ean AS substitute, 0.8 * ({_COS}) + 0.095 * 2 * r / (19 + r) + 0.095 * abs(a.price_index - b.price_index) + 0.01 * CAST(a.container = b.container AS INTEGER) AS score
  FROM (SELECT * FROM e) a JOIN e b ON a.category = b.category AND a.ean <> b.ean, LATERAL (SELECT CAST(list_sum(list_transform(list_zip(a.f, b.f), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS DOUBLE) AS r)),
ranked AS (SELECT category, ean, substitute, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY ean ORDER BY round(score, 6), substitute) AS INTEGER) AS substitution_rank FROM p)"""


def _substitutes(spark: SparkSession, d: str) -> DataFrame:
    e = b.table(spark, d, "embeddings").select(F.col("label").alias("category"), F.col("vec_id").alias("ean"), "embedding", F.transform(F.slice("embedding", 1, 19), lambda v: (v > 0.1).cast("int")).alias("flags"), F.lit("UN").alias("unit"), (F.col("vec_id") % 3).cast("string").alias("container"), (1 + (F.col("vec_id") % 10) / 10).alias("price_index"))
    return substitutes.substitutes(e, 5)


@query(f"{_SUBSTITUTES} SELECT category, ean, substitute, score, substitution_rank FROM ranked WHERE substitution_rank <= 5")
def substitutes_rank(spark, d):
    return _substitutes(spark, d).select("category", "ean", "substitute", "score", "substitution_rank")


@query(r""" SELECT p_partkey AS ean, nullif(regexp_replace(regexp_replace(lower(p_name), '^\W+|\W+$', '', 'g'), '\W+', '_', 'g'), '') AS normal, array_to_string(regexp_extract_all(lower(p_name), '([a-z]+|\d+|[^\w\s]+)', 1), ' ') AS tokens, lpad(CAST(p_partkey AS VARCHAR), 18, '0') || '-UN' AS key FROM part""")
def text_normalise(spark, d):
    n = F.col("nm")
    return b.products(spark, d).select("ean", text.normalize_text(n).alias("normal"), text.split_tokens(n).alias("tokens"), text.sku_key(F.col("sku"), F.col("unit")).alias("key"))


# Recommendation metrics: a document's relevance as found by its neighbours' labels

_LISTS = ", lists AS (SELECT CAST(doc_id % 40 AS BIGINT) AS query_id, CASE WHEN doc_id % 7 < 5 THEN CAST(row_number() OVER (PARTITION BY doc_id % 40, doc_id % 7 < 5 ORDER BY doc_id) AS INTEGER) END AS ranking, CAST(quality AS INTEGER) AS ground_truth FROM labels)"


def _lists(spark: SparkSession, d: str) -> DataFrame:
    rows = b.table(spark, d, "labels").select("doc_id", (F.col("doc_id") % 40).alias("query_id"), (F.col("doc_id") % 7 < 5).alias("listed"), F.col("quality").alias("ground_truth"))
    ranked = ranking.with_rank(rows, ["query_id", "listed"], [F.asc("doc_id")], "ranking")
    return ranked.select("query_id", F.when(F.col("listed"), F.col("ranking")).alias("ranking"), "ground_truth")


@query(f"{_LISTS} SELECT query_id, round(sum(ground_truth) / count(*), 6) AS precision FROM lists WHERE ranking <= 5 GROUP BY 1")
def precision_at_k(spark, d):
    return metrics.precision_at_k(_lists(spark, d), 5).select("query_id", *_r("precision"))


@query(f"{_LISTS} SELECT query_id, round(sum(ground_truth) FILTER (ranking <= 5) / nullif(sum(ground_truth), 0), 6) AS recall FROM lists GROUP BY 1 HAVING count(ranking) FILTER (ranking <= 5) > 0")
def recall_at_k(spark, d):
    return metrics.recall_at_k(_lists(spark, d), 5).select("query_id", *_r("recall"))


@query(f"{_LISTS}, p AS (SELECT *, sum(ground_truth) OVER w / count(*) OVER w AS p FROM lists WHERE ranking <= 5 WINDOW w AS (PARTITION BY query_id ORDER BY ranking)), h AS (SELECT query_id, sum(p * ground_truth) AS h FROM p GROUP BY 1) SELECT query_id, round(coalesce(any_value(h), 0) / nullif(sum(ground_truth), 0), 6) AS ap FROM lists LEFT JOIN h USING (query_id) GROUP BY 1")
def ap_at_k(spark, d):
    return metrics.average_precision_at_k(_lists(spark, d), 5).select("query_id", *_r("ap"))


# Pricing

_REGRESSION = """, w AS (SELECT category, 1.0 * (date - DATE '1990-01-01') AS w, CAST(price AS DOUBLE) AS x, CAST(quantity AS DOUBLE) AS y FROM daily), s AS (SELECT category, count(*) AS n, sum(w) AS sw, sum(w*x) AS sx, sum(w*y) AS sy, sum(w*x*x) AS sxx, sum(w*x*y) AS sxy FROM w GROUP BY 1)"""


@query(f"{_REGRESSION} SELECT category, CAST(n AS BIGINT) AS n, round((sw*sxy - sx*sy) / (sw*sxx - sx*sx), 5) AS slope FROM s")
def weighted_regression(spark, d):
    rows = b.daily(spark, d).withColumn("w", F.datediff("date", F.lit("1990-01-01").cast("date")).cast("double"))
    fit = regression.weighted_least_squares(rows, "category", "quantity", ["price"], "w")
    return fit.select("category", "n", F.round(F.get("coefficients", F.lit(0)), 5).alias("slope"))


# Published lists

@query(f"{_USUALS} SELECT DATE '2001-07-01' AS date, customer_key, md5(CAST(customer_key AS VARCHAR)) AS hash_string, sku AS sku_product, ean, relevance, CAST(3 AS INTEGER) AS store_banner, lpad(CAST(sku AS VARCHAR), 18, '0') || '-UN' AS vtexrefid FROM usual JOIN products USING (ean)")
def publish_ranked(spark, d):
    return usuals.publish_ranked(_usuals(spark, d), b.products(spark, d), 3, ON_DATE)


# Ingests

@query(" SELECT store_id, transaction_date AS date, store_banner, CAST(count(*) AS BIGINT) AS requested, CAST(count(*) FILTER (transaction_type <> 'R' AND line_no % 7 <> 0) AS BIGINT) AS completed, count(*) FILTER (transaction_type <> 'R' AND line_no % 7 <> 0) / count(*) AS found_rate FROM sales LEFT JOIN stores USING (store_id) GROUP BY 1, 2, 3")
def found_rate(spark, d):
    lines = b.sales(spark, d).select("store_id", F.col("transaction_date").alias("date"), (F.col("transaction_type") != "R").cast("int").alias("state"), (F.col("line_no") % 7 == 0).alias("substituted"))
    return ingests.found_rate(lines, b.stores(spark, d), ["store_id", "date"])


@query(", c AS (SELECT transaction_date AS date, CAST(ean AS VARCHAR) || '-UN' AS ref_id, store_id, quantity > 25 AS available, store_id % 2 AS k FROM sales) SELECT date, regexp_replace(ref_id, '-.*', '') AS ref_id, store_id, CASE k WHEN 0 THEN 'one' ELSE 'two' END AS store_banner, avg(CAST(available AS DOUBLE)) AS inweb FROM c GROUP BY ALL")
def catalog_availability(spark, d):
    c = b.sales(spark, d).select(F.col("transaction_date").alias("date"), F.concat(F.col("ean").cast("string"), F.lit("-UN")).alias("ref_id"), "store_id", (F.col("quantity") > 25).alias("available"))
    return ingests.catalog_availability({"one": c.where("store_id % 2 = 0"), "two": c.where("store_id % 2 = 1")})


@query(" SELECT basket_key, customer_key, basket_value FROM orders_ WHERE basket_key NOT IN (SELECT basket_key FROM orders_ WHERE transaction_date < DATE '1999-01-01')")
def incremental_by_id(spark, d):
    o = b.orders(spark, d).select("basket_key", "customer_key", "basket_value", "transaction_date")
    return incremental.new_by_id(o.union(o), o.where("transaction_date < DATE '1999-01-01'"), "basket_key").drop("transaction_date")


@query(", t AS (SELECT * FROM orders_ WHERE transaction_date <= DATE '1999-01-01'), m AS (SELECT max(transaction_date) AS m FROM t) SELECT basket_key, transaction_date, -1.0 AS basket_value FROM t, m WHERE transaction_date < m UNION ALL SELECT basket_key, transaction_date, basket_value FROM orders_, m WHERE transaction_date >= m")
def incremental_by_date(spark, d):
    o = b.orders(spark, d).select("basket_key", "transaction_date", "basket_value")
    return incremental.from_last_date(o, o.where("transaction_date <= DATE '1999-01-01'").withColumn("basket_value", F.lit(-1.0)), "transaction_date", "basket_key")


@query(", t AS (SELECT * FROM orders_ WHERE transaction_date <= DATE '1999-01-01') SELECT basket_key, transaction_date FROM orders_ WHERE transaction_date > (SELECT max(transaction_date) FROM t)")
def incremental_after_watermark(spark, d):
    o = b.orders(spark, d).select("basket_key", "transaction_date")
    return incremental.after_watermark(o, o.where("transaction_date <= DATE '1999-01-01'"), "transaction_date")


@query(" SELECT event_id, user_id, event_type FROM events WHERE event_id % 3 <> 0")
def insert_only_merge(spark, d):
    e = b.table(spark, d, "events").select("event_id", "user_id", "event_type")
    return tables.insert_only_merge(e, e.where("event_id % 3 = 0"), ["event_id", "user_id"])


@query(" SELECT basket_key, channel FROM orders_ WHERE NOT coalesce(nullif(channel, '3-MEDIUM') = '5-LOW', false) UNION ALL SELECT basket_key, 'new' FROM orders_ WHERE channel = '5-LOW'")
def slice_overwrite(spark, d):
    o = b.orders(spark, d).select("basket_key", "channel")
    kept = tables.without_slice(o, F.nullif(F.col("channel"), F.lit("3-MEDIUM")) == "5-LOW")
    return kept.unionByName(o.where("channel = '5-LOW'").withColumn("channel", F.lit("new")))


@query(", s AS (SELECT event_id, ' ' || CAST(value AS VARCHAR) || ' ' AS v, CASE WHEN event_id % 5 = 0 THEN '  ' ELSE CAST(user_id AS VARCHAR) || CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '' END END AS u, strftime(ts, '%Y-%m-%d') AS d FROM events) SELECT event_id, try_cast(nullif(trim(v), '') AS DOUBLE) AS v, try_cast(nullif(trim(u), '') AS BIGINT) AS u, try_cast(nullif(trim(d), '') AS DATE) AS d FROM s")
def typed_staging(spark, d):
    e = b.table(spark, d, "events")
    user = F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.concat(F.col("user_id").cast("string"), F.when(F.col("event_id") % 7 == 0, "x").otherwise("")))
    s = e.select(F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")).alias("v"), user.alias("u"), F.date_format("ts", "yyyy-MM-dd").alias("d"))
    return readers.typed(s, {"event_id": "INTEGER", "v": "FLOAT", "u": "INTEGER", "d": "DATE"})


@query(" SELECT CAST(c_custkey AS BIGINT) AS row_no, replace(c_name, '#', '') AS name, '0' AS zero, CASE WHEN c_custkey % 4 = 0 THEN '0' ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer WHERE c_custkey > 5")
def clean_sheet(spark, d):
    sheet = b.table(spark, d, "customer").select(F.col("c_custkey").alias("row_no"), F.col("c_name").alias("x1"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).cast("string").alias("x2"))
    return sheets.clean_sheet(sheet, ["name", "zero", "nation"], skip_rows=5, insert={"zero": 0}, drop_null_on="name", strip=("#",), nan_as_zero=("nation",))


@query(", w AS (SELECT store_id, CAST(datediff('week', DATE '1994-12-26', transaction_date) AS INTEGER) AS week, sum(value) AS value FROM sales GROUP BY 1, 2) SELECT a.store_id, a.week, round(a.value, 2) AS value, round(p.value, 2) AS previous_week, round(y.value, 2) AS previous_year, round((a.value - p.value) / p.value, 4) + 0.0 AS pop, round((a.value - y.value) / y.value, 4) + 0.0 AS yoy FROM w a LEFT JOIN w p ON a.store_id = p.store_id AND p.week = a.week - 1 LEFT JOIN w y ON a.store_id = y.store_id AND y.week = a.week - 52")
def period_comparison(spark, d):
    s = b.sales(spark, d).select("store_id", dates.iso_week_difference(F.col("transaction_date"), F.lit("1994-12-26").cast("date")).alias("week"), "value")
    return ingests.period_comparison(s, ["store_id"], "value").select("store_id", "week", *_r("value", "previous_week", "previous_year", digits=2), *[(F.round(c, 4) + 0.0).alias(c) for c in ("pop", "yoy")])


@query(" SELECT basket_key, CAST(isoyear(transaction_date) * 100 + weekofyear(transaction_date) AS INTEGER) AS iso_week, CAST(year(transaction_date) * 100 + month(transaction_date) AS INTEGER) AS ym, CAST((CAST(date_trunc('week', DATE '2001-07-01') AS DATE) - CAST(date_trunc('week', transaction_date) AS DATE)) // 7 AS INTEGER) AS weeks, transaction_date = last_day(transaction_date) AS month_end, day(transaction_date) = 1 AS month_start, CAST(year(transaction_date - INTERVAL 5 MONTH) * 100 + month(transaction_date - INTERVAL 5 MONTH) AS INTEGER) AS five_before FROM orders_")
def calendar(spark, d):
    t = F.col("transaction_date")
    return b.orders(spark, d).select("basket_key", dates.iso_year_week(t).alias("iso_week"), dates.year_month(t).alias("ym"), dates.iso_week_difference(F.lit(ON_DATE).cast("date"), t).alias("weeks"), dates.is_month_end(t).alias("month_end"), dates.is_month_start(t).alias("month_start"), dates.add_months(dates.year_month(t), -5).alias("five_before"))


@query(" SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (CAST(props->>'k' AS BIGINT) > 50) AS BIGINT) AS high FROM events GROUP BY 1")
def flattened_events(spark, d):
    e = b.table(spark, d, "events").select("event_type", F.from_json("props", "k bigint").alias("props"))
    return text.flatten(e).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("props_k") > 50).alias("high"))
