"""Shapes of the regular ingests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import us_timestamp
from ..functions.text import sku_key
from ..operators.ranking import first_row
from ..sources.quality import assert_columns
from ..sources.shared import spread
from ..sources.tables import TableSpec, require_table, write_table


def found_rate(lines: DataFrame, stores: DataFrame, by: list[str]) -> DataFrame:
    """(by, store_banner, requested, completed, found_rate): share of requested order lines that were picked as asked."""
    done = F.count_if((F.col("state") == 1) & ~F.col("substituted"))
    rates = lines.groupBy(*by).agg(F.count("*").alias("requested"), done.alias("completed"))
    return rates.withColumn("found_rate", F.try_divide("completed", "requested")).join(F.broadcast(stores), "store_id", "left")


def catalog_availability(banners: dict[str, DataFrame]) -> DataFrame:
    """(date, ref_id, store_id, store_banner, inweb): mean availability by day of each banner's catalog, references up to
    18 characters and without what follows a hyphen."""
    out = None
    for banner, df in banners.items():
        rows = df.where(F.length("ref_id") < 19).withColumn("ref_id", F.regexp_replace("ref_id", "-.*", ""))
        # Most groups are a row or two, so a task that combines what it reads would hold it all.
        part = spread(rows.select("date", "ref_id", "store_id", "available"), "date", "ref_id", "store_id").groupBy("date", "ref_id", "store_id").agg(F.avg(F.col("available").cast("double")).alias("inweb")).withColumn("store_banner", F.lit(banner))
        out = part if out is None else out.unionByName(part)
    return out


def order_substitutions(lines: DataFrame) -> DataFrame:
    """(order_id, original, substitute): the lines of an order that stand for another line of it."""
    other = lines.select("order_id", F.col("line_no").alias("replaces"), F.col("ean").alias("original"))
    return lines.where("replaces IS NOT NULL").join(other, ["order_id", "replaces"]).select("order_id", "original", F.col("ean").alias("substitute"))


def ingest_full(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Replace the table, made if it is missing, by the rows; the table."""
    spec.create(df.sparkSession, "ignore")
    write_table(df, spec, "replace")
    require_table(df.sparkSession, spec.name)
    return df.sparkSession.table(spec.name)


def memberships_snapshot(memberships: DataFrame, months: int, on_date: str) -> DataFrame:
    """Memberships without check digits that ended within the last months or run on."""
    day = F.lit(on_date).cast("date")
    kept = memberships.where(F.col("end_date").isNull() | (F.col("end_date") >= F.add_months(day, -months)))
    return kept.withColumn("rut", F.substring_index("rut", "-", 1))


def image_urls(images: DataFrame, unit: Column) -> DataFrame:
    """(vtexrefid, url): the main image of each product, the first by position."""
    main = first_row(images.where(~F.col("url").ilike("%placeholder%")), ["sku"], [F.asc_nulls_last("position"), F.asc("url")])
    return main.select(sku_key(F.col("sku"), unit).alias("vtexrefid"), F.trim("url").alias("url"))


def sku_dim(skus: DataFrame, columns: list[str]) -> DataFrame:
    """Products of the shop with a number that fits 18 digits, one row each (the last changed), the named columns."""
    kept = skus.where((F.length("ean") < 19) & F.col("ean").rlike("^[0-9]+$")).withColumn("ean", F.col("ean").cast("long"))
    return first_row(kept, ["ref_id"], [F.desc_nulls_last("changed_at"), F.asc("ean")]).select(columns)


def census_dim(census: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct localities with their commune, province and region."""
    return census.select(columns).distinct()


def monthly_report(rows: DataFrame, year: int, month: int) -> DataFrame:
    """A provider's rows of one month."""
    return rows.where((F.col("year") == year) & (F.col("month") == month))


def visits(sales: DataFrame, by: list[str]) -> DataFrame:
    """(by, year, month, visits, customers, value, weight): baskets and customers of each month, and what they bought."""
    date = F.col("transaction_date")
    return sales.groupBy(*by, F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count_distinct("basket_key").alias("visits"), F.count_distinct("customer_key").alias("customers"), F.sum("value").alias("value"), F.sum("quantity").alias("weight"))


def delivery_compliance(orders: DataFrame) -> DataFrame:
    """(date, store_id, orders, on_time, compliance): share of orders delivered by the promised time."""
    per = orders.where("promised_at IS NOT NULL").groupBy(F.to_date("promised_at").alias("date"), "store_id").agg(F.count("*").alias("orders"), F.count_if(F.col("delivered_at") <= F.col("promised_at")).alias("on_time"))
    return per.withColumn("compliance", F.try_divide("on_time", "orders"))


def order_locality(orders: DataFrame, census: DataFrame) -> DataFrame:
    """Orders with the commune and region of their locality, by its name without case and blanks around."""
    name = lambda c: F.upper(F.trim(c))
    dim = first_row(census.withColumn("__k", name(F.col("locality"))), ["__k"], [F.asc("commune"), F.asc("region")]).select("__k", "commune", "region")
    return orders.withColumn("__k", name(F.col("locality"))).join(F.broadcast(dim), "__k", "left").drop("__k")


def messages(df: DataFrame, required: list[str], times: list[str], drop_status: tuple[str, ...] = (), numbers: tuple[str, ...] = (), by_month: str | None = None) -> DataFrame:
    """Landed messaging events (text columns) as rows to load: required columns there, times parsed (bad ones null),
    numbers parsed, rows of the given statuses gone, year and month of one of the times added."""
    assert_columns(df, required)
    for c in times:
        df = df.withColumn(c, us_timestamp(F.col(c)))
    for c in numbers:
        df = df.withColumn(c, F.trim(F.col(c)).try_cast("double").try_cast("long"))
    if drop_status:
        df = df.where(~F.coalesce(F.upper("Status").isin(*drop_status), F.lit(False)))
    return df.withColumns({"YEAR": F.year(by_month), "MONTH": F.month(by_month)}) if by_month else df


def period_comparison(weekly: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, week, value, previous_week, previous_year, pop, yoy): a week's value with those of the week and the year before
    (52 weeks) and the relative changes. ``week`` is a running number."""
    base = weekly.groupBy(*by, "week").agg(F.sum(value).alias(value))
    before = lambda n, name: base.select(*by, (F.col("week") + n).alias("week"), F.col(value).alias(name))
    joined = base.join(before(1, "previous_week"), [*by, "week"], "left").join(before(52, "previous_year"), [*by, "week"], "left")
    change = lambda c: F.try_divide(F.col(value) - F.col(c), F.col(c))
    return joined.withColumns({"pop": change("previous_week"), "yoy": change("previous_year")})


def control_group(customers: DataFrame, year: int) -> DataFrame:
    """Control-group rows whose period starts with the year, with the month apart."""
    return customers.where(F.col("period").like(f"{year}%")).withColumn("month", F.substring("period", 5, 2))
