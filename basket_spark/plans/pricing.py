"""Pricing: daily features, sensitivity classes, elasticity and the balance matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import calendar_flags, holidays, period_index, weekday_flags, with_holidays
from ..functions.numbers import first_match, geometric_mean
from ..operators.aggregates import exclude_self_ratio, min_max, with_group
from ..operators.intervals import covered_flag
from ..operators.kmeans import kmeans_1d
from ..operators.ranking import first_row, top_k, with_rank
from ..operators.regression import weighted_least_squares
from ..sources.shared import spread, stored

FLOOR, DEFAULT = -8.0, -1.0
# From how many times the weekday's mean which class.
MULTIPLIERS = [(6.0, "x6"), (5.0, "x5"), (4.0, "x4"), (3.0, "x3"), (2.0, "x2"), (1.5, "x1.5"), (0.5, "x1")]
# Points of a substitute by its relevance.
POINTS = {1: 5, 2: 4, 3: 3, 4: 2}


def daily_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """(ean, sub_category, category, unit, date, value, quantity, price): kilograms where the unit is one, else sold units."""
    lines = sales.join(products.select("ean", "sub_category", "category", "unit", "sales_unit"), "ean")
    amount = F.when(F.col("unit").isin("KG", "KGV"), F.col("weight_sold")).otherwise(F.try_divide("quantity", "sales_unit"))
    daily = lines.groupBy("ean", "sub_category", "category", "unit", F.col("transaction_date").alias("date")).agg(F.sum("value").alias("value"), F.sum(amount).alias("quantity"))
    return daily.withColumn("price", F.try_divide("value", "quantity"))


def day_multiplier(daily: DataFrame) -> DataFrame:
    """(category, date, proportion, multiplier): a category's sales of a day over its mean of that weekday, and its class."""
    days = daily.groupBy("category", "date").agg(F.sum("value").alias("total")).withColumn("weekday", F.weekday("date"))
    means = days.groupBy("category", "weekday").agg(F.avg("total").alias("mean"))
    joined = days.join(means, ["category", "weekday"])
    return joined.select("category", "date", (F.col("total") / F.col("mean")).alias("proportion"), first_match([(F.col("total") >= n * F.col("mean"), F.lit(name)) for n, name in MULTIPLIERS], F.lit("x0.5")).alias("multiplier"))


def previous_months_price(daily: DataFrame, months: int = 3) -> DataFrame:
    """(ean, month, price, previous_price, change): the month's mean price, the mean of the months before that there are,
    and the relative change; null without any."""
    monthly = daily.groupBy("ean", period_index(F.col("date")).alias("month")).agg(F.avg("price").alias("price"))
    before = F.avg("price").over(Window.partitionBy("ean").orderBy("month").rangeBetween(-months, -1))
    monthly = monthly.withColumn("previous_price", F.when(F.col("month").isNotNull(), before))
    return monthly.withColumn("change", F.try_divide(F.col("price") - F.col("previous_price"), F.col("previous_price")))


def without_cold_start(monthly: DataFrame, oldest: int = 3) -> DataFrame:
    """Without the oldest months of all, and without each product's first month."""
    months = monthly.select("month").distinct()
    cut = F.broadcast(months.orderBy("month").limit(oldest).agg(F.max("month").alias("__cut")))
    firsts = monthly.groupBy("ean").agg(F.min("month").alias("__first"))
    return monthly.crossJoin(cut).join(firsts, "ean").where((F.col("month") > F.coalesce("__cut", F.lit(0))) & (F.col("month") > F.col("__first"))).drop("__cut", "__first")


def change_of_others(monthly: DataFrame) -> DataFrame:
    """(…, others_change): the price change of the other products of the sub-category and month, weighted by value."""
    return exclude_self_ratio(monthly, ["sub_category", "month"], "change", "value", "others_change")


def best_substitute(substitutes: DataFrame, products: DataFrame, months: DataFrame) -> DataFrame:
    """(ean, month, relevance, substitute): of each relevance the substitute sold that month whose weight is nearest."""
    own, other = products.select("ean", F.col("weight").alias("own_weight")), products.select(F.col("ean").alias("substitute"), F.col("weight").alias("other_weight"))
    sold = months.select(F.col("ean").alias("substitute"), "month").distinct()
    pairs = substitutes.join(own, "ean").join(other, "substitute").join(sold, "substitute").dropna(subset=["own_weight", "other_weight"])
    return first_row(pairs, ["ean", "month", "relevance"], [F.abs(F.col("own_weight") - F.col("other_weight")), F.asc("substitute")]).select("ean", "month", "relevance", "substitute")


def sold_lately(daily: DataFrame, most_price: float = 1e6, least_quantity: float = 3.0) -> DataFrame:
    """Rows of a plausible price and of enough units (kilograms: any amount), of products that such rows show sold within a
    year of the last date."""
    enough = (F.col("quantity") >= least_quantity) | (F.col("unit").isin("KG", "KGV") & (F.col("quantity") > 0))
    rows = daily.where((F.col("price") < most_price) & enough)
    last = F.broadcast(rows.agg(F.max("date").alias("__last")))
    alive = rows.groupBy("ean").agg(F.max("date").alias("__own")).crossJoin(last).where(F.col("__own") >= F.add_months("__last", -12)).select("ean")
    return rows.join(alive, "ean", "left_semi")


def feature_window(on_date: str, use: str, months: int = 29) -> tuple[dt.date, dt.date]:
    """First and last day of the rows: whole months before the date's for ``ELASTICITY``, up to the day before for
    ``FORECAST``."""
    day = dt.date.fromisoformat(on_date)
    if use not in ("ELASTICITY", "FORECAST"):
        raise ValueError("use must be ELASTICITY or FORECAST")
    last = (day.replace(day=1) if use == "ELASTICITY" else day) - dt.timedelta(1)
    index = last.year * 12 + last.month - 1 - months + (use == "ELASTICITY")
    first = dt.date(index // 12, index % 12 + 1, 1)
    if use == "ELASTICITY":
        return first, last
    end_of_first = (first.replace(day=28) + dt.timedelta(4)).replace(day=1) - dt.timedelta(1)
    return first.replace(day=min(last.day, end_of_first.day)) + dt.timedelta(1), last


def substitute_changes(rows: DataFrame, best: DataFrame) -> DataFrame:
    """(ean, date, top1, top3): the price change of the first substitute that is sold that day, by relevance, and the mean of
    the first three (null with fewer). ``rows``: ean, month, date, change; ``best``: that of ``best_substitute``."""
    asked = rows.select("ean", "month", "date").join(best, ["ean", "month"])
    sold = asked.join(rows.select(F.col("ean").alias("substitute"), "date", "change"), ["substitute", "date"]).where("change IS NOT NULL")
    changes = F.transform(F.array_sort(F.collect_list(F.struct("relevance", "change"))), lambda s: s["change"])
    three = F.when(F.size("c") >= 3, F.aggregate(F.slice("c", 1, 3), F.lit(0.0), lambda s, x: s + x) / 3)
    return sold.groupBy("ean", "date").agg(changes.alias("c")).select("ean", "date", F.round(F.get("c", F.lit(0)), 2).alias("top1"), F.round(three, 2).alias("top3"))


def processed_features(daily: DataFrame, products: DataFrame, substitutes: DataFrame, promotions: DataFrame, on_date: str, use: str = "ELASTICITY", months: int = 29) -> DataFrame:
    """The daily rows that models of demand are fitted to: (ean, category, sub_category, unit, date, month, value, quantity,
    price, proportion, slow_day, previous_price, change, others_change, top1, top3, promo) and calendar and holiday flags.

    In order: the window of ``use``; price changes against the three months before; without the three oldest months;
    changes of the other products and of the nearest substitutes (``substitutes``: ean, relevance 1 to 5, substitute); days
    under promotion (``promotions``: ean, start, end); rows and products of ``sold_lately``; without a product's first
    month, which has no substitutes.
    """
    first, last = feature_window(on_date, use, months)
    daily = stored(daily.where(F.col("date").between(F.lit(first), F.lit(last))), "daily")  # read by five steps
    rows = daily.where((F.col("price") < 1e6) & (F.col("quantity") > 0)).withColumn("month", period_index(F.col("date")))
    monthly = previous_months_price(rows).join(rows.groupBy("ean", "sub_category", "month").agg(F.sum("value").alias("value")), ["ean", "month"])
    oldest = F.broadcast(monthly.select("month").distinct().orderBy("month").limit(3).agg(F.max("month").alias("__cut")))
    monthly = monthly.crossJoin(oldest).where("month > __cut").drop("__cut").fillna(0.0, ["change"])
    monthly = stored(change_of_others(monthly).select("ean", "month", "previous_price", "change", "others_change"), "monthly")
    rows = stored(rows.join(monthly, ["ean", "month"]), "rows")
    best = best_substitute(substitutes.where("relevance <= 5"), products, rows.select("ean", "month").distinct())
    days = day_multiplier(daily).select("category", "date", "proportion", (F.col("multiplier") == "x0.5").cast("int").alias("slow_day"))
    rows = rows.join(substitute_changes(rows, best), ["ean", "date"], "left").join(days, ["category", "date"])
    rows = covered_flag(rows, promotions, "ean", "date", "start", "end", "promo").withColumn("promo", F.col("promo").cast("int"))
    rows = sold_lately(rows)
    firsts = rows.groupBy("ean").agg(F.min("month").alias("__first"))
    rows = rows.join(firsts, "ean").where("month > __first").drop("__first")
    rows = rows.select("*", *calendar_flags(F.col("date"), list(range(first.year, last.year + 1))))
    return with_holidays(rows, "date", range(first.year, last.year + 1))


def regression_features(daily: DataFrame, months: int = 3) -> DataFrame:
    """Daily rows with the month's price change, that of the other products, and weekday flags; cold starts left out."""
    rest = [c for c in daily.columns if c not in ("ean", "sub_category")]
    days = spread(daily.withColumn("month", period_index(F.col("date"))).where("ean IS NOT NULL AND month IS NOT NULL"), "ean")
    # A product's days lie in one task from here on; they go along with their month, so nothing is joined back to them.
    sums = [F.sum("price").alias("__price"), F.count("price").alias("__n"), F.sum("value").alias("value")]
    monthly = days.groupBy("ean", "sub_category", "month").agg(*sums, F.collect_list(F.struct(*rest)).alias("days"))
    product, same = Window.partitionBy("ean"), Window.partitionBy("ean", "month")
    monthly = monthly.withColumn("price", F.try_divide(F.sum("__price").over(same), F.sum("__n").over(same)))
    once = F.when(F.row_number().over(same.orderBy("sub_category")) == 1, F.col("price"))  # of a month in two sub-categories
    monthly = monthly.withColumn("__once", once).withColumn("previous_price", F.avg("__once").over(product.orderBy("month").rangeBetween(-months, -1)))
    change = F.try_divide(F.col("price") - F.col("previous_price"), F.col("previous_price"))
    monthly = monthly.select("ean", "sub_category", "month", "value", "days", "previous_price", change.alias("change"), F.min("month").over(product).alias("__first"))
    monthly = stored(monthly, "monthly")
    cut = F.broadcast(monthly.select("month").distinct().orderBy("month").limit(3).agg(F.max("month").alias("__cut")))
    kept = monthly.crossJoin(cut).where((F.col("month") > F.coalesce("__cut", F.lit(0))) & (F.col("month") > F.col("__first"))).fillna(0.0, ["change"])
    kept = exclude_self_ratio(kept, ["sub_category", "month"], "change", "value", "others_change", few=True)
    rows = kept.select("ean", "month", "sub_category", F.explode("days").alias("day"), "previous_price", "change", "others_change")
    rows = rows.select("ean", "month", *[F.col("sub_category") if c == "sub_category" else F.col(f"day.{c}").alias(c) for c in daily.columns if c != "ean"], "previous_price", "change", "others_change")
    return rows.select("*", *weekday_flags(F.col("date")))


def feasible(daily: DataFrame, least_days: int = 150) -> DataFrame:
    """(ean): products with enough days of a tenth of their mean quantity at least."""
    marked = with_group(daily, ["ean"], mean_quantity=F.avg("quantity"))
    return marked.where(F.col("quantity") >= F.col("mean_quantity") / 10).groupBy("ean").agg(F.count("*").alias("n")).where(F.col("n") >= least_days).select("ean")


def low_price_variability(daily: DataFrame, band: float = 0.05, share: float = 0.9) -> DataFrame:
    """(ean, low_variability): whether more than that share of the days have a price within the band around the mean."""
    marked = with_group(daily, ["ean"], mean_price=F.avg("price"))
    near = F.col("price").between((1 - band) * F.col("mean_price"), (1 + band) * F.col("mean_price"))
    return marked.groupBy("ean").agg((F.round(100 * F.avg(near.cast("double")), 2) > 100 * share).alias("low_variability"))


def elasticity(daily: DataFrame, least_days: int = 150) -> DataFrame:
    """(ean, elasticity, r2, n): slope of log quantity over log price alone, later days weighing more; null where it isn't
    negative. Days of less than a tenth of the mean quantity are left out; products with too few days have no row."""
    product = Window.partitionBy("ean")  # a product has a row a day
    rows = daily.where("price > 0 AND quantity > 0").withColumn("mean_quantity", F.avg("quantity").over(product)).where(F.col("quantity") >= F.col("mean_quantity") / 10)
    rows = rows.withColumns({"log_price": F.log("price"), "log_quantity": F.log("quantity"), "w": F.row_number().over(product.orderBy("date"))})
    fit = weighted_least_squares(rows, "ean", "log_quantity", ["log_price"], "w").where(F.col("n") >= least_days)
    slope = F.get("coefficients", F.lit(0))
    return fit.select("ean", F.when(slope < 0, slope).alias("elasticity"), "r2", "n")


# The holidays that a model may have a term for.
MODEL_HOLIDAYS = ["jueves_santo", "viernes_santo", "30_abril", "20_mayo", "21_mayo", "19_junio", "20_junio", "15_julio", "16_julio", "14_agosto", "15_agosto", "14_septiembre", "15_septiembre", "16_septiembre", "17_septiembre", "pre_halloween", "halloween", "pre_navidad", "navidad", "pre_ano_nuevo", "ano_nuevo"]
#: What becomes of a product without an elasticity of its own.
NO_DATA, FLAT, POSITIVE, INFEASIBLE = "no data", "low variability", "positive", "infeasible"


def _calendar_terms(dates: np.ndarray, years: list[int]) -> dict[str, np.ndarray]:
    """0/1 of each row for weekdays, years, months and the model's holidays: what ``calendar_flags`` and ``with_holidays`` say."""
    days, at = np.unique(dates.astype("datetime64[D]"), return_inverse=True)
    month, year, weekday = days.astype("datetime64[M]").astype(int) % 12 + 1, days.astype("datetime64[Y]").astype(int) + 1970, (days.astype(int) + 3) % 7
    named: dict[str, list[dt.date]] = {}
    for day, name, _ in holidays(years):
        named.setdefault(name, []).append(day)
    flags = {f"weekday_{k}": weekday == k for k in range(1, 7)} | {f"year_{y}": year == y for y in years} | {f"month_{m}": month == m for m in range(1, 13)}
    flags |= {h: np.isin(days, np.array(named.get(h, []), "datetime64[D]")) for h in MODEL_HOLIDAYS}
    return {k: v[at].astype(float) for k, v in flags.items()}


def _starts(keys: pa.ChunkedArray) -> np.ndarray:
    """Where each run of equal keys starts."""
    codes = keys.combine_chunks().dictionary_encode("encode").indices.to_numpy()
    return np.concatenate(([0], np.flatnonzero(codes[1:] != codes[:-1]) + 1))


def _fit_products(t: pa.Table, years: list[int], least_days: int) -> pa.Table:
    """(ean, elasticity, status, r2, n) of the products whose days ``t`` holds, in order of product and date.

    Terms, their variation and the gates are found for all products at once; what is left for each is its solve.
    """
    starts = _starts(t["ean"])
    product = np.repeat(np.arange(len(starts)), np.diff(starts, append=t.num_rows))
    c = {k: t[k].to_numpy() for k in t.column_names if k != "ean"}
    total = lambda x: np.bincount(product, x, len(starts))
    size = np.bincount(product)
    mean = (total(c["price"]) / size)[product]
    flat = np.round(100 * (total((c["price"] >= 0.95 * mean) & (c["price"] <= 1.05 * mean)) / size), 2) > 90
    keep = c["quantity"] >= (total(c["quantity"]) / size)[product] / 10
    n = np.bincount(product[keep], minlength=len(starts))
    own = np.flatnonzero((n >= least_days) & (n > 0))
    slopes, r2, status = [None] * len(starts), [None] * len(starts), [INFEASIBLE] * len(starts)
    if len(own):
        keep &= np.isin(product, own)
        c = {k: v[keep] for k, v in c.items()}
        flags, first = _calendar_terms(c["date"], years), np.concatenate(([0], np.cumsum(n[own])[:-1]))
        months = [f"month_{m}" for m in range(2, 13)]
        sold = {k: c[k] for k in ("slow_day", "promo", "others_change", "top1", "top3")}
        later = [f"year_{y}" for y in years[1:]]
        base = {"one": np.ones(len(c["price"])), "log_price": np.log(c["price"])} | flags | sold
        names = ["one", "log_price", *[f"weekday_{k}" for k in range(1, 7)], *later, "slow_day", *MODEL_HOLIDAYS, "promo", "others_change", *months, "top1", "top3"]
        x = np.column_stack([base[k] for k in names])
        chosen = np.maximum.reduceat(x, first) > np.minimum.reduceat(x, first)  # false where a day lacks the value
        at = {k: i for i, k in enumerate(names)}
        chosen[:, :2] = True
        for y in later:  # the same as December
            chosen[:, at[y]] &= np.add.reduceat(flags[y] != flags["month_12"], first) > 0
        chosen[:, [at[m] for m in months]] = np.min([np.add.reduceat(flags[f"month_{m}"], first) for m in range(1, 13)], axis=0)[:, None] >= 5
        for k in ("top1", "top3"):
            chosen[:, at[k]] = np.add.reduceat(np.isnan(c[k]), first) == 0
        y = np.log(c["quantity"])
        for i, p in enumerate(own):
            rows = slice(first[i], first[i] + n[p])
            slope, r2[p] = _fit(x[rows][:, chosen[i]], y[rows])
            status[p] = FLAT if flat[p] else POSITIVE if slope >= 0 else "own"
            slopes[p] = round(slope, 2) if status[p] == "own" else None
    r2 = [None if v is None else round(v, 3) for v in r2]
    fitted = np.isin(np.arange(len(starts)), own)
    return pa.table({"ean": t["ean"].take(pa.array(starts)), "elasticity": pa.array(slopes, pa.float64()), "status": status, "r2": pa.array(r2, pa.float64()), "n": pa.array(n, pa.int64(), mask=~fitted)})


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float | None]:
    """(second coefficient, adjusted r2) of rows in order of date, the k-th of which weighs k."""
    n, day = len(y), np.arange(1.0, len(y) + 1)  # a product has one row a day
    root = np.sqrt(day)
    beta, _, rank, _ = np.linalg.lstsq(x * root[:, None], y * root, rcond=1e-12)
    left = float((day * (y - x @ beta) ** 2).sum())
    total = float((day * (y - np.average(y, weights=day)) ** 2).sum())
    r2 = 1 - left / total * (n - 1) / (n - rank) if n > rank and total > 0 else None
    return float(beta[1]), r2


def product_elasticity(features: DataFrame, least_days: int = 150) -> DataFrame:
    """(ean, elasticity, status, r2, n): slope of log quantity over log price of each product with the terms that its days
    allow, fitted by weighted least squares, later days weighing more; ``elasticity`` is null unless ``status`` is own.

    Terms: weekdays, years, slow days, holidays, promotion and the other products' change where they vary; months where
    each has five days; substitutes' changes where no day lacks them. Days of less than a tenth of the mean quantity are
    left out of the fit. ``features`` are those of ``processed_features``. Only what doesn't follow from the date is sent to
    the tasks, which go through their days in order of product, a batch of rows with the rest of a product at a time.
    """
    years = sorted(int(c.removeprefix("year_")) for c in features.columns if c.startswith("year_"))
    values = ["quantity", "price", "slow_day", "promo", "others_change", "top1", "top3"]
    rows = features.where("price > 0 AND quantity > 0").select("ean", "date", *[F.col(c).cast("double").alias(c) for c in values])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            days = pa.Table.from_batches([*rest, batch])
            if not days.num_rows:
                continue
            cut = int(_starts(days["ean"])[-1])  # the last product may go on in the next batch
            if cut:
                yield from _fit_products(days.slice(0, cut), years, least_days).to_batches()
            rest = days.slice(cut).to_batches()
        if rest:
            yield from _fit_products(pa.Table.from_batches(rest), years, least_days).to_batches()

    kind = rows.schema["ean"].dataType.simpleString()
    return rows.repartition("ean").sortWithinPartitions("ean", "date").mapInArrow(fit, f"ean {kind}, elasticity double, status string, r2 double, n long")


def contagion(products: DataFrame, substitutes: DataFrame, last_months: int = 24) -> DataFrame:
    """(ean, elasticity, source): own elasticity, else that of the best substitute (points over the last months, then the
    nearest weight), else of the best-selling product of the sub-category, of the category, else -1; -8 at the least.

    ``products``: ean, sub_category, category, weight, sales, elasticity or null; ``substitutes``: ean, substitute, month,
    relevance.
    """
    newest = substitutes.select("month").distinct().orderBy(F.desc("month")).limit(last_months)
    points = first_match([(F.col("relevance") == k, F.lit(v)) for k, v in POINTS.items()], F.lit(1))
    scored = substitutes.join(F.broadcast(newest), "month", "left_semi").groupBy("ean", "substitute").agg(F.sum(points).alias("points"))
    known = products.where("elasticity IS NOT NULL")
    gap = F.abs(F.col("weight") - F.col("known_weight"))
    by_substitute = first_row(
        products.where("elasticity IS NULL").select("ean", "weight").join(scored, "ean").join(known.select(F.col("ean").alias("substitute"), F.col("weight").alias("known_weight"), F.col("elasticity").alias("e1")), "substitute"),
        ["ean"], [F.desc("points"), gap, F.asc("substitute")],
    ).select("ean", "e1")
    by_substitute = stored(by_substitute, "contagion")
    step = products.join(by_substitute, "ean", "left").withColumn("e", F.coalesce("elasticity", "e1"))
    out = step.withColumn("source", F.when(F.col("elasticity").isNotNull(), "own").when(F.col("e1").isNotNull(), "substitute"))
    for level in ("sub_category", "category"):
        best = first_row(out.where("e IS NOT NULL"), [level], [F.desc("sales"), F.asc("ean")]).select(level, F.col("e").alias("__e"))
        out = stored(out, "contagion") if level == "category" else out
        out = out.join(best, level, "left").withColumn("source", F.coalesce("source", F.when(F.col("__e").isNotNull(), level))).withColumn("e", F.coalesce("e", "__e")).drop("__e")
    return out.select("ean", F.greatest(F.coalesce("e", F.lit(DEFAULT)), F.lit(FLOOR)).alias("elasticity"), F.coalesce("source", F.lit("default")).alias("source"))


def elasticity_class(elasticities: DataFrame) -> DataFrame:
    """(…, elasticity_class): high for the lower of two clusters found without the outermost percents, else low."""
    out = kmeans_1d(elasticities, [], "elasticity", 2, (0.01, 0.99), "__k")
    return out.withColumn("elasticity_class", F.when(F.col("__k") == 0, "high").otherwise("low")).drop("__k")


def product_sensitivity(sales: DataFrame, trim: float = 0.0, high_categories: int = 40, all_categories: int = 80, forced_roles: DataFrame | None = None) -> DataFrame:
    """(ean, category, family, index, cluster, role KVI/KCI/BKG) from (ean, category, family, value).

    Share within the category and the category's share, geometric mean, scaled to 0..1, the family's largest, three
    clusters without the bottom ``trim``. In the largest categories the first three products (two in the next) and their
    families count as high. ``forced_roles`` (ean, role), a list kept by hand, overrides the role of its products last of all;
    null roles don't. A product with several roles there gets the first by name.
    """
    sales = stored(sales, "sales")
    totals = sales.groupBy("category").agg(F.sum("value").alias("cat_value"))
    all_ = F.broadcast(sales.agg(F.sum("value").alias("all_value")))
    rows = sales.join(totals, "category").crossJoin(all_)
    rows = rows.withColumn("raw", geometric_mean(F.col("value") / F.col("cat_value"), F.col("cat_value") / F.col("all_value")))
    rows = stored(min_max(rows, "raw", "scaled"), "scaled")
    rows = rows.join(rows.groupBy("family").agg(F.max("scaled").alias("index")), "family")
    rows = kmeans_1d(rows, [], "index", 3, (trim, 1.0), "cluster")
    first = totals.orderBy(F.desc("cat_value"), "category").limit(all_categories)  # some dozens of rows
    place = with_rank(first, [], [F.desc("cat_value"), F.asc("category")], "cat_rank").select("category", "cat_rank")
    rows = stored(rows, "clusters")
    forced = top_k(rows.join(F.broadcast(place), "category"), ["category"], [F.desc("index"), F.desc("value"), F.asc("ean")], F.when(F.col("cat_rank") <= high_categories, 3).otherwise(2), "__n")
    high = forced.select("family").distinct().withColumn("__high", F.lit(True))
    out = rows.join(high, "family", "left").withColumn("cluster", F.when(F.col("__high"), 2).otherwise(F.col("cluster")))
    role = F.element_at(F.array(F.lit("BKG"), F.lit("KCI"), F.lit("KVI")), F.col("cluster") + 1)
    out = out.select("ean", "category", "family", "index", "cluster", role.alias("role"))
    if forced_roles is None:
        return out
    by_hand = forced_roles.where("role IS NOT NULL").groupBy("ean").agg(F.min("role").alias("__role"))
    return out.join(by_hand, "ean", "left").withColumn("role", F.coalesce("__role", "role")).drop("__role")


def _segment(role: Column, elastic: Column) -> Column:
    return first_match([((role == "BKG") & (elastic == "high"), "Hi-Lo"), ((role == "BKG") & (elastic == "low"), "Margin"), (role.isin("KCI", "KVI") & (elastic == "low"), "EDLP"), (role.isin("KCI", "KVI") & (elastic == "high"), "Low-Lower")], "Otro")


def balance_matrix(elasticities: DataFrame, sensitivity: DataFrame, sales: DataFrame) -> DataFrame:
    """(ean, elasticity, elasticity_class, role, sales, segment): products by price role and elasticity class.

    Sales are summed by product before they are joined, so that no row is repeated.
    """
    total = sales.groupBy("ean").agg(F.sum("value").alias("sales"))
    joined = elasticities.join(sensitivity.select("ean", "role"), "ean", "left").join(total, "ean", "left")
    return joined.select("ean", "elasticity", "elasticity_class", "role", "sales", _segment(F.col("role"), F.col("elasticity_class")).alias("segment"))

