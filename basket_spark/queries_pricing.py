"""Queries of price sophistication, sensitivity, elasticity and the features that models are fitted to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binding as b
from .binding import ON_DATE
from .functions import dates
from .operators import kmeans
from .plans import pricing, sophistication
from .queries import _SUBSTITUTES, _score, _score_sql, _substitutes
from .registry import query, rounded, zeroed
from .sources.shared import stored

# Segments by k-means


NEAREST = "CAST(list_position(list_transform(c, lambda m: abs(x_ - m)), list_min(list_transform(c, lambda m: abs(x_ - m)))) - 1 AS INTEGER)"


def kmeans_sql(p: str, source: str, by: str | None, value: str, k: int, low: float = 0.0, high: float = 1.0) -> str:
    """CTEs named with ``p``: ``{p}out`` is ``source`` with ``cluster``, ``{p}c`` the centres of each group. All cuts of the
    sorted values into k (2 or 3) runs are tried, by prefix sums; of the best ones, to 1e-12, the lowest from the top."""
    g = by or "g_"
    trimmed = [f"x_ > q[1]"] * (low > 0) + ["x_ < q[2]"] * (high < 1)  # noqa: F541
    cost = lambda a, z: f"({z}.sq - {a}.sq - ({z}.s - {a}.s) * ({z}.s - {a}.s) / ({z}.w - {a}.w))"
    ends = ["a", "b", "e"][3 - k :]  # the cuts, then the end; the row before the first is z
    joins = " ".join(f"JOIN {p}r {t} ON {t}.g = z.g AND {t}.r > {prev}.r" for prev, t in zip(["z", *ends], ends, strict=False))
    total = " + ".join(cost(a, z) for a, z in zip(["z", *ends], ends, strict=False))
    case = " ".join(f"WHEN r <= {c} THEN {i}" for i, c in enumerate(ends[:-1]))
    return f""", {p}x AS (SELECT *, CAST({value} AS DOUBLE) AS x_{', 1 AS g_' if by is None else ''} FROM {source}), {p}q AS (SELECT {g}, quantile_cont(x_, [{low}, {high}]) AS q FROM {p}x WHERE x_ IS NOT NULL GROUP BY 1),
{p}v AS (SELECT {g} AS g, x_, count(*) AS n FROM {p}x JOIN {p}q USING ({g}) WHERE x_ IS NOT NULL{''.join(f' AND {t}' for t in trimmed)} GROUP BY 1, 2),
{p}z AS (SELECT g, x_, n, n / sum(n) OVER g AS w, coalesce((x_ - min(x_) OVER g) / nullif(max(x_) OVER g - min(x_) OVER g, 0), 0) AS z, row_number() OVER (PARTITION BY g ORDER BY x_) AS r, count(*) OVER g AS m FROM {p}v WINDOW g AS (PARTITION BY g)),
{p}r AS (SELECT g, r, m, sum(w) OVER u AS w, sum(w * z) OVER u AS s, sum(w * z * z) OVER u AS sq FROM {p}z WINDOW u AS (PARTITION BY g ORDER BY r) UNION ALL SELECT DISTINCT g, 0, m, 0, 0, 0 FROM {p}z),
{p}t AS (SELECT z.g, {", ".join(f"{c}.r AS {c}" for c in ends[:-1])}, {total} AS cost FROM {p}r z {joins} WHERE z.r = 0 AND e.r = e.m AND e.m > {k}),
{p}b AS (SELECT * FROM (SELECT *, min(cost) OVER (PARTITION BY g) AS best FROM {p}t) WHERE cost <= best + 1e-12 QUALIFY row_number() OVER (PARTITION BY g ORDER BY {", ".join(reversed(ends[:-1]))}) = 1),
{p}c AS (SELECT g AS {g}, list(c ORDER BY c) AS c FROM (SELECT g, sum(x_ * n) / sum(n) AS c FROM {p}z LEFT JOIN {p}b USING (g) GROUP BY g, CASE WHEN m <= {k} THEN r {case} ELSE {k} END) GROUP BY 1),
{p}out AS (SELECT * EXCLUDE (c, q), CASE WHEN x_ IS NULL THEN NULL {'WHEN x_ <= q[1] THEN 0 ' if low > 0 else ''}{f'WHEN x_ >= q[2] THEN {k - 1} ' if high < 1 else ''}ELSE {NEAREST} END AS cluster FROM {p}x JOIN {p}q USING ({g}) LEFT JOIN {p}c USING ({g}))"""


@query(f"{kmeans_sql('k', 'products', 'category', 'weight', 3)} SELECT category, cluster, CAST(count(*) AS BIGINT) AS n, min(x_) AS least, max(x_) AS most FROM kout GROUP BY 1, 2")
def kmeans_segments(spark, d):
    out = kmeans.kmeans_1d(b.products(spark, d).withColumn("x", F.col("weight").cast("double")), ["category"], "x", 3)
    return out.groupBy("category", "cluster").agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))


_CUSTOMERS = f"""{_score_sql('customer_key, category')}
, clean AS (SELECT s.* FROM (SELECT *, avg(hm_pu_ppum) OVER (PARTITION BY category) AS m FROM scores) s WHERE hm_pu_ppum <= 10 * m QUALIFY count(*) OVER (PARTITION BY category) >= 10),
cv AS (SELECT category, stddev_samp(hm_pu_ppum) / avg(hm_pu_ppum) AS cv, quantile_cont(hm_pu_ppum, [0.05, 0.95]) AS q FROM clean GROUP BY 1),
ratio AS (SELECT *, least(greatest(coalesce(cv / (SELECT avg(cv) FROM cv), 1.0), 0.5), 2.0) AS ratio FROM cv),
idx AS (SELECT customer_key, total_value * ratio AS w, 1 + 2 * least(greatest(coalesce((hm_pu_ppum - q[1]) / nullif(q[2] - q[1], 0), 0.0), 0.0), 1.0) AS i FROM clean JOIN ratio USING (category)),
cust AS (SELECT customer_key, sum(i * w) / sum(w) AS index, count(*) AS n_categories FROM idx GROUP BY 1), many AS (SELECT * FROM cust WHERE n_categories >= 3)
{kmeans_sql('s', 'many', None, 'index', 3, 0.05, 0.95)}
, ends AS (SELECT cluster, min(index) AS lo, max(index) AS hi FROM sout GROUP BY 1), cuts AS (SELECT (a.hi + z.lo) / 2 AS cut FROM ends a JOIN ends z ON a.cluster + 1 = z.cluster)"""


@query(f"{_CUSTOMERS} SELECT customer_key, round(index, 6) AS index, n_categories, cluster AS segment FROM sout UNION ALL SELECT customer_key, round(index, 6), n_categories, CAST((SELECT count(*) FROM cuts WHERE cut < index) AS INTEGER) FROM cust WHERE n_categories < 3")
def customer_segments(spark, d):
    return sophistication.customer_segments(_score(spark, d, ["customer_key", "category"]), least_rows=10).select("customer_key", *rounded("index"), "n_categories", "segment")


_BRANDS = f"""{_score_sql('category, brand')}
, logs AS (SELECT category, quantile_cont(ln(hm_pu_ppum), [0.25, 0.75]) AS q, count(*) AS n FROM scores WHERE hm_pu_ppum > 0 GROUP BY 1),
odd AS (SELECT DISTINCT category FROM scores JOIN logs USING (category) WHERE n >= 4 AND hm_pu_ppum > 0 AND (ln(hm_pu_ppum) < q[1] - 1.5 * (q[2] - q[1]) OR ln(hm_pu_ppum) > q[2] + 1.5 * (q[2] - q[1]))),
whole AS (SELECT category, quantile_cont(hm_pu_ppum, [0.05, 0.95]) AS q FROM scores GROUP BY 1 HAVING count(hm_pu_ppum) >= 3),
fit AS (SELECT s.category, hm_pu_ppum AS v FROM scores s JOIN whole w USING (category) LEFT JOIN odd o ON o.category = s.category WHERE o.category IS NULL OR (hm_pu_ppum > w.q[1] AND hm_pu_ppum < w.q[2]))
{kmeans_sql('t', 'fit', 'category', 'v', 3)}{kmeans_sql('u', 'fit', 'category', 'v', 2)}
, med AS (SELECT 3 AS k, category, cluster, median(v) AS m, count(*) AS n FROM tout GROUP BY 1, 2, 3 UNION ALL SELECT 2, category, cluster, median(v), count(*) FROM uout GROUP BY 1, 2, 3),
apart AS (SELECT k, category, max(n) FILTER (cluster = 0) >= max(n) FILTER (cluster = 1) AS low FROM (SELECT *, (lead(m) OVER (PARTITION BY k, category ORDER BY cluster) - m) / m AS gap FROM med) GROUP BY 1, 2 HAVING count(*) = k AND min(gap) >= 0.04),
pick AS (SELECT category, brand, hm_pu_ppum, CASE WHEN three.k = 3 THEN 1 + (SELECT {NEAREST} FROM (SELECT tc.c, hm_pu_ppum AS x_)) WHEN two.k = 2 THEN (SELECT {NEAREST} FROM (SELECT uc.c, hm_pu_ppum AS x_)) + CASE WHEN two.low THEN 2 ELSE 1 END END AS s
  FROM scores LEFT JOIN (SELECT * FROM apart WHERE k = 3) three USING (category) LEFT JOIN tc USING (category) LEFT JOIN (SELECT * FROM apart WHERE k = 2) two USING (category) LEFT JOIN uc USING (category))"""


@query(f"{_BRANDS} SELECT category, brand, round(hm_pu_ppum, 5) AS hm_pu_ppum, CASE WHEN brand = 'Brand#7' THEN 'MPES' ELSE coalesce(['ECONOMY', 'MAINSTREAM', 'PREMIUM'][s], 'UNCLASSIFIED') END AS segment FROM pick")
def brand_segments(spark, d):
    return sophistication.brand_segments(_score(spark, d, ["category", "brand"]), own="Brand#7").select("category", "brand", *rounded("hm_pu_ppum", digits=5), "segment")


def _by_product(spark: SparkSession, d: str, sales: DataFrame | None = None) -> DataFrame:
    sales = b.sales(spark, d) if sales is None else sales
    return sales.join(b.products(spark, d), "ean").groupBy("ean", F.col("sub_category").alias("category"), F.concat_ws("/", "sub_category", "brand").alias("family")).agg(F.sum("value").alias("value"))


_SENSITIVITY = f"""
, per AS (SELECT ean, sub_category AS cat, sub_category || '/' || brand AS family, sum(value) AS value FROM sales JOIN products USING (ean) GROUP BY 1, 2, 3),
shares AS (SELECT *, sum(value) OVER (PARTITION BY cat) AS cat_value, sum(value) OVER () AS all_value FROM per), raw AS (SELECT *, sqrt(value / cat_value * (cat_value / all_value)) AS raw FROM shares),
fam AS (SELECT *, max((raw - lo) / (hi - lo)) OVER (PARTITION BY family) AS index FROM raw, (SELECT min(raw) AS lo, max(raw) AS hi FROM raw))
{kmeans_sql('n', 'fam', None, 'index', 3)}
, place AS (SELECT cat, row_number() OVER (ORDER BY max(cat_value) DESC, cat) AS cat_rank FROM fam GROUP BY 1 QUALIFY cat_rank <= 8),
forced AS (SELECT DISTINCT family FROM (SELECT n.*, cat_rank, row_number() OVER (PARTITION BY cat ORDER BY index DESC, value DESC, ean) AS i FROM nout n JOIN place USING (cat)) WHERE i <= CASE WHEN cat_rank <= 4 THEN 3 ELSE 2 END),
sens AS (SELECT ean, cat, family, index, CASE WHEN f.family IS NOT NULL THEN 2 ELSE cluster END AS cluster FROM nout LEFT JOIN forced f USING (family)),
roles AS (SELECT *, CASE cluster WHEN 0 THEN 'BKG' WHEN 1 THEN 'KCI' ELSE 'KVI' END AS role FROM sens)"""


def _sensitivity(spark: SparkSession, d: str, forced_roles: DataFrame | None = None, sales: DataFrame | None = None) -> DataFrame:
    return pricing.product_sensitivity(_by_product(spark, d, sales), high_categories=4, all_categories=8, forced_roles=forced_roles)


@query(f"{_SENSITIVITY} SELECT ean, cat AS category, family, round(index, 6) AS index, cluster, role FROM roles")
def sensitivity_class(spark, d):
    return _sensitivity(spark, d).select("ean", "category", "family", *rounded("index"), "cluster", "role")


#: The list of forced roles: the largest packs and the smallest.
_FORCED = ", by_hand AS (SELECT p_partkey AS ean, CASE p_size WHEN 50 THEN 'KVI' ELSE 'BKG' END AS by_hand FROM part WHERE p_size IN (1, 50))"


@query(f"{_SENSITIVITY}{_FORCED} SELECT ean, cat AS category, family, round(index, 6) AS index, cluster, coalesce(by_hand, role) AS role FROM roles LEFT JOIN by_hand USING (ean)")
def sensitivity_forced(spark, d):
    part = b.table(spark, d, "part").where("p_size IN (1, 50)")
    forced = part.select(F.col("p_partkey").alias("ean"), F.when(F.col("p_size") == 50, "KVI").otherwise("BKG").alias("role"))
    return _sensitivity(spark, d, forced).select("ean", "category", "family", *rounded("index"), "cluster", "role")


# Elasticity

_OWN = """
, d0 AS (SELECT *, avg(quantity) OVER (PARTITION BY ean) AS mq FROM daily WHERE price > 0 AND quantity > 0),
d1 AS (SELECT ean, ln(price) AS x, ln(quantity) AS y, CAST(row_number() OVER (PARTITION BY ean ORDER BY date) AS DOUBLE) AS w FROM d0 WHERE quantity >= mq / 10),
fits AS (SELECT ean, count(*) AS n, (sum(w) * sum(w*x*y) - sum(w*x) * sum(w*y)) / nullif(sum(w) * sum(w*x*x) - sum(w*x) * sum(w*x), 0) AS slope FROM d1 GROUP BY 1 HAVING count(*) >= 10),
own AS (SELECT ean, n, CASE WHEN slope < 0 THEN slope END AS elasticity FROM fits)"""


@query(f"{_OWN} SELECT ean, round(elasticity, 4) AS elasticity, n FROM own")
def elasticity_wls(spark, d):
    return pricing.elasticity(b.daily(spark, d), least_days=10).select("ean", *rounded("elasticity", digits=4), "n")


_CONTAGION = f"""{_OWN}{_SUBSTITUTES}
, known AS (SELECT ean, sub_category, category, CAST(weight AS DOUBLE) AS weight, total AS sales, elasticity FROM products JOIN (SELECT ean, round(sum(value), 2) AS total FROM sales GROUP BY 1) USING (ean) LEFT JOIN own USING (ean)),
subs AS (SELECT r.ean, r.substitute, m.month, r.substitution_rank AS relevance FROM ranked r JOIN (SELECT DISTINCT ean AS substitute, year(date) * 12 + month(date) AS month FROM daily) m USING (substitute) WHERE substitution_rank <= 5),
points AS (SELECT ean, substitute, sum(CASE relevance WHEN 1 THEN 5 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 2 ELSE 1 END) AS points FROM subs WHERE month IN (SELECT DISTINCT month FROM subs ORDER BY 1 DESC LIMIT 24) GROUP BY 1, 2),
e1 AS (SELECT ean, e FROM (SELECT k.ean, o.elasticity AS e, row_number() OVER (PARTITION BY k.ean ORDER BY points DESC, abs(k.weight - o.weight), substitute) AS i FROM known k JOIN points p USING (ean) JOIN known o ON o.ean = substitute AND o.elasticity IS NOT NULL WHERE k.elasticity IS NULL) WHERE i = 1),
s1 AS (SELECT k.*, coalesce(elasticity, e) AS e, CASE WHEN elasticity IS NOT NULL THEN 'own' WHEN e IS NOT NULL THEN 'substitute' END AS source FROM known k LEFT JOIN e1 USING (ean)),
b2 AS (SELECT sub_category, e FROM (SELECT *, row_number() OVER (PARTITION BY sub_category ORDER BY sales DESC, ean) AS i FROM s1 WHERE e IS NOT NULL) WHERE i = 1),
s2 AS (SELECT s1.* REPLACE (coalesce(s1.e, b2.e) AS e, coalesce(source, CASE WHEN b2.e IS NOT NULL THEN 'sub_category' END) AS source) FROM s1 LEFT JOIN b2 USING (sub_category)),
b3 AS (SELECT category, e FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sales DESC, ean) AS i FROM s2 WHERE e IS NOT NULL) WHERE i = 1),
contagion AS (SELECT ean, greatest(coalesce(s2.e, b3.e, -1.0), -8.0) AS elasticity, coalesce(source, CASE WHEN b3.e IS NOT NULL THEN 'category' END, 'default') AS source FROM s2 LEFT JOIN b3 USING (category))"""


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    """(ean, relevance, substitute) of the first five substitutes."""
    return _substitutes(spark, d).select("ean", F.col("substitution_rank").alias("relevance"), "substitute")


def _sold(spark: SparkSession, d: str) -> DataFrame:
    """(ean, value, months, elasticity) of each product, what all later steps need of the sales; written once, since days are
    many times as many."""
    daily = b.daily(spark, d)
    months = F.collect_set(dates.period_index(F.col("date"))).alias("months")
    own = pricing.elasticity(daily, least_days=10).select("ean", "elasticity")
    return stored(daily.groupBy("ean").agg(F.sum("value").alias("value"), months).join(own, "ean", "left"), "sold")


def _contagion(spark: SparkSession, d: str, sold: DataFrame | None = None) -> DataFrame:
    sold = _sold(spark, d) if sold is None else sold
    known = b.products(spark, d).join(sold, "ean").select("ean", "sub_category", "category", F.col("weight").cast("double").alias("weight"), F.round("value", 2).alias("sales"), "elasticity")
    months = sold.select(F.col("ean").alias("substitute"), F.explode("months").alias("month"))
    return pricing.contagion(stored(known, "known"), _ranked(spark, d).join(months, "substitute"))


@query(f"{_CONTAGION} SELECT ean, round(elasticity, 4) AS elasticity, source FROM contagion")
def elasticity_contagion(spark, d):
    return _contagion(spark, d).select("ean", *rounded("elasticity", digits=4), "source")


_CLASSES = f"{_CONTAGION}{kmeans_sql('e', 'contagion', None, 'elasticity', 2, 0.01, 0.99)}, classes AS (SELECT ean, elasticity, CASE cluster WHEN 0 THEN 'high' ELSE 'low' END AS cls FROM eout)"


@query(f"{_CLASSES} SELECT ean, round(elasticity, 4) AS elasticity, cls AS elasticity_class FROM classes")
def elasticity_classes(spark, d):
    return pricing.elasticity_class(_contagion(spark, d)).select("ean", *rounded("elasticity", digits=4), "elasticity_class")


_MATRIX = f"{_CLASSES}{_SENSITIVITY}, totals AS (SELECT ean, sum(value) AS sales FROM sales GROUP BY 1), matrix AS (SELECT c.ean, elasticity, cls AS elasticity_class, role, sales, CASE WHEN role = 'BKG' THEN CASE cls WHEN 'high' THEN 'Hi-Lo' ELSE 'Margin' END WHEN cls = 'low' THEN 'EDLP' WHEN role IS NOT NULL THEN 'Low-Lower' ELSE 'Otro' END AS segment FROM classes c LEFT JOIN roles USING (ean) LEFT JOIN totals USING (ean))"


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    sold = _sold(spark, d)
    return pricing.balance_matrix(pricing.elasticity_class(_contagion(spark, d, sold)), _sensitivity(spark, d, sales=sold), sold)


@query(f"{_MATRIX} SELECT ean, round(elasticity, 4) AS elasticity, elasticity_class, role, round(sales, 2) AS sales, segment FROM matrix")
def balance_matrix(spark, d):
    return _matrix(spark, d).select("ean", *rounded("elasticity", digits=4), "elasticity_class", "role", *rounded("sales", digits=2), "segment")


# Features

_UNITS = """
, uproducts AS (SELECT ean, sub_category, category, weight, CASE WHEN weight % 5 = 0 THEN 'KG' ELSE 'UN' END AS unit, 1 + weight % 2 AS sales_unit FROM products),
udaily AS (SELECT ean, sub_category, category, unit, transaction_date AS date, sum(value) AS value, sum(CASE WHEN unit = 'KG' THEN quantity * 0.75 ELSE quantity / sales_unit END) AS quantity, sum(value) / sum(CASE WHEN unit = 'KG' THEN quantity * 0.75 ELSE quantity / sales_unit END) AS price FROM sales JOIN uproducts USING (ean) GROUP BY 1, 2, 3, 4, 5)"""


def _products(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth size is sold by weight, every other one in pairs."""
    return b.products(spark, d).withColumn("unit", F.when(F.col("weight") % 5 == 0, "KG").otherwise("UN")).withColumn("sales_unit", 1 + F.col("weight") % 2)


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return pricing.daily_sales(b.sales(spark, d).withColumn("weight_sold", F.col("quantity") * 0.75), _products(spark, d))


@query(f"{_UNITS} SELECT ean, unit, date, round(value, 2) AS value, round(quantity, 4) AS quantity, round(price, 7) AS price FROM udaily")
def daily_sales_by_unit(spark, d):
    return _daily(spark, d).select("ean", "unit", "date", *rounded("value", digits=2), *rounded("quantity", digits=4), *rounded("price", digits=7))


_LATELY = """, plausible AS (SELECT * FROM {0} WHERE price < 1e6 AND (quantity >= 3 OR (unit = 'KG' AND quantity > 0))), lately AS (SELECT * FROM plausible JOIN (SELECT ean FROM plausible GROUP BY 1 HAVING max(date) >= (SELECT max(date) FROM plausible) - INTERVAL 12 MONTH) USING (ean))"""


@query(f"{_UNITS}{_LATELY.format('udaily')} SELECT ean, unit, date, round(quantity, 4) AS quantity FROM lately")
def rows_of_products_sold_lately(spark, d):
    return pricing.sold_lately(_daily(spark, d)).select("ean", "unit", "date", *rounded("quantity", digits=4))


@query(" SELECT ean FROM (SELECT ean, quantity >= avg(quantity) OVER (PARTITION BY ean) / 10 AS enough FROM daily) WHERE enough GROUP BY 1 HAVING count(*) >= 25")
def feasible_products(spark, d):
    return pricing.feasible(b.daily(spark, d), 25)


@query(" SELECT ean, round(100 * avg(CAST(near AS DOUBLE)), 2) > 40 AS low_variability FROM (SELECT ean, price BETWEEN 0.95 * avg(price) OVER (PARTITION BY ean) AND 1.05 * avg(price) OVER (PARTITION BY ean) AS near FROM daily) GROUP BY 1")
def low_price_variability(spark, d):
    return pricing.low_price_variability(b.daily(spark, d), share=0.4)


_EASTER = """
, years AS (SELECT CAST(y AS INTEGER) AS y FROM range(1994, 2003) t(y)), ea AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
eb AS (SELECT *, b // 4 AS d, b % 4 AS e, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM ea), ec AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS m FROM eb),
ed AS (SELECT *, (h + m - 7 * ((a + 11 * h + 22 * m) // 451) + 114) AS o FROM ec), easter AS (SELECT y, make_date(y, CAST(o // 31 AS INTEGER), CAST(o % 31 + 1 AS INTEGER)) AS easter FROM ed),
hol AS (SELECT easter - 3 AS d, 'jueves_santo' AS name, 'pre_feriado' AS grp FROM easter UNION ALL SELECT easter - 2, 'viernes_santo', 'feriado' FROM easter
 UNION ALL SELECT make_date(y, 6, CASE WHEN y % 4 < 2 THEN 20 ELSE 21 END), '20_junio', 'feriado' FROM years UNION ALL SELECT make_date(y, 6, CASE WHEN y % 4 < 2 THEN 19 ELSE 20 END), '19_junio', 'pre_feriado' FROM years
 UNION ALL SELECT make_date(y, m, dd), name, grp FROM years, (VALUES """ + ", ".join(f"({m}, {day}, '{name}', '{group}')" for name, m, day, group in dates.FIXED_DAYS) + """) f(m, dd, name, grp))"""
_NAMED = ["viernes_santo", "20_junio", "18_septiembre", "navidad", *dates.HOLIDAY_GROUPS]


def _flags_sql(date: str) -> str:
    return ", ".join(f"CAST(EXISTS (SELECT 1 FROM hol WHERE hol.d = {date} AND ({'grp' if n in dates.HOLIDAY_GROUPS else 'name'} = '{n}')) AS INTEGER) AS \"{n}\"" for n in _NAMED)


@query(f"{_EASTER} SELECT transaction_date AS date, CAST(count(*) AS BIGINT) AS n, {_flags_sql('transaction_date')} FROM orders_ GROUP BY 1")
def holiday_flags(spark, d):
    days = b.orders(spark, d).groupBy(F.col("transaction_date").alias("date")).agg(F.count("*").alias("n"))
    return dates.with_holidays(days, "date", range(1994, 2003)).select("date", "n", *_NAMED)


@query(" SELECT basket_key, " + ", ".join(f"CAST(isodow(transaction_date) = {k + 1} AS INTEGER) AS weekday_{k}" for k in range(7)) + ", " + ", ".join(f"CAST(month(transaction_date) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13)) + ", " + ", ".join(f"CAST(year(transaction_date) = {y} AS INTEGER) AS year_{y}" for y in (1999, 2000)) + " FROM orders_")
def calendar_dummies(spark, d):
    return b.orders(spark, d).select("basket_key", *dates.calendar_flags(F.col("transaction_date"), [1999, 2000]))


_BEST = """
, bs AS (SELECT ean, month, relevance, substitute FROM (SELECT s.ean, m.month, s.substitution_rank AS relevance, s.substitute, row_number() OVER (PARTITION BY s.ean, m.month, s.substitution_rank ORDER BY abs(o.weight - z.weight), s.substitute) AS i
  FROM (SELECT * FROM ranked WHERE substitution_rank <= 5) s JOIN products o ON o.ean = s.ean JOIN products z ON z.ean = s.substitute JOIN (SELECT DISTINCT ean, year(date) * 12 + month(date) AS month FROM {0}) m ON m.ean = s.substitute) WHERE i = 1)"""


@query(f"{_SUBSTITUTES}{_BEST.format('daily')} SELECT ean, CAST(month AS INTEGER) AS month, relevance, substitute FROM bs")
def best_substitutes(spark, d):
    months = b.daily(spark, d).select("ean", dates.period_index(F.col("date")).alias("month"))
    return pricing.best_substitute(_ranked(spark, d), b.products(spark, d), months)


def _promotions(spark: SparkSession, d: str) -> DataFrame:
    start = F.date_add(F.lit("1999-01-01").cast("date"), (F.col("weight") * 17 % 700).cast("int"))
    return b.products(spark, d).select("ean", start.alias("start"), F.date_add(start, 200).alias("end"))


def _features_sql(use: str) -> str:
    first, last = pricing.feature_window(ON_DATE, use)
    return f"""{_UNITS}{_SUBSTITUTES}{_EASTER}
, win AS (SELECT *, year(date) * 12 + month(date) AS month FROM udaily WHERE date BETWEEN DATE '{first}' AND DATE '{last}'), w0 AS (SELECT * FROM win WHERE price < 1e6 AND quantity > 0),
mo AS (SELECT ean, month, avg(price) AS price FROM w0 GROUP BY 1, 2), pv AS (SELECT m.ean, m.month, avg(p.price) AS previous_price FROM mo m JOIN mo p ON m.ean = p.ean AND p.month BETWEEN m.month - 3 AND m.month - 1 GROUP BY 1, 2),
ch AS (SELECT mo.ean, mo.month, previous_price, coalesce((mo.price - previous_price) / previous_price, 0) AS change, v.sub_category, v.value FROM mo LEFT JOIN pv USING (ean, month) JOIN (SELECT ean, sub_category, month, sum(value) AS value FROM w0 GROUP BY 1, 2, 3) v USING (ean, month) WHERE mo.month > (SELECT max(month) FROM (SELECT DISTINCT month FROM mo ORDER BY 1 LIMIT 3))),
oc AS (SELECT ean, month, previous_price, change, CASE WHEN abs(sum(value) OVER g - value) > 1e-9 * abs(sum(value) OVER g) THEN (sum(change * value) OVER g - change * value) / (sum(value) OVER g - value) ELSE 0 END AS others_change FROM ch WINDOW g AS (PARTITION BY sub_category, month)),
r1 AS (SELECT * FROM w0 JOIN oc USING (ean, month)){_BEST.format('r1')}
, sc AS (SELECT a.ean, a.date, relevance, z.change FROM r1 a JOIN bs ON bs.ean = a.ean AND bs.month = a.month JOIN r1 z ON z.ean = bs.substitute AND z.date = a.date),
tp AS (SELECT ean, date, round(arg_min(change, relevance), 2) AS top1, CASE WHEN count(*) >= 3 THEN round(list_sum(list(change ORDER BY relevance)[1:3]) / 3, 2) END AS top3 FROM sc GROUP BY 1, 2),
dy AS (SELECT category, date, total / avg(total) OVER (PARTITION BY category, isodow(date)) AS proportion FROM (SELECT category, date, sum(value) AS total FROM win GROUP BY 1, 2)),
promo AS (SELECT ean, DATE '1999-01-01' + CAST(weight * 17 % 700 AS INTEGER) AS s FROM products),
r2 AS (SELECT r1.*, top1, top3, proportion, CAST(proportion < 0.5 AS INTEGER) AS slow_day, CAST(date BETWEEN s AND s + 200 AS INTEGER) AS promo FROM r1 LEFT JOIN tp USING (ean, date) JOIN dy USING (category, date) JOIN promo USING (ean)){_LATELY.format('r2')}
, done AS (SELECT * FROM lately QUALIFY month > min(month) OVER (PARTITION BY ean))
SELECT ean, date, unit, round(quantity, 4) AS quantity, round(price, 7) AS price, round(proportion, 6) AS proportion, slow_day, round(previous_price, 7) AS previous_price, round(change, 6) + 0.0 AS change, round(others_change, 6) + 0.0 AS others_change, top1 + 0.0 AS top1, top3 + 0.0 AS top3, promo, CAST(isodow(date) = 7 AS INTEGER) AS weekday_6, CAST(month(date) = 12 AS INTEGER) AS month_12, CAST(year(date) = 2000 AS INTEGER) AS year_2000, {_flags_sql('done.date')} FROM done"""


def _features(spark: SparkSession, d: str, use: str) -> DataFrame:
    return pricing.processed_features(_daily(spark, d), b.products(spark, d), _ranked(spark, d), _promotions(spark, d), ON_DATE, use)


def _shown(df: DataFrame) -> DataFrame:
    return df.select("ean", "date", "unit", *rounded("quantity", digits=4), *rounded("price", digits=7), *rounded("proportion"), "slow_day", *rounded("previous_price", digits=7), *zeroed("change", "others_change"), *zeroed("top1", "top3", digits=2), "promo", "weekday_6", "month_12", "year_2000", *_NAMED)


@query(_features_sql("ELASTICITY"))
def features_for_elasticity(spark, d):
    return _shown(_features(spark, d, "ELASTICITY"))


@query(_features_sql("FORECAST"))
def features_for_forecast(spark, d):
    return _shown(_features(spark, d, "FORECAST"))


@query()
def product_elasticity(spark, d):
    return pricing.product_elasticity(_features(spark, d, "ELASTICITY"), least_days=6)
