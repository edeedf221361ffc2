"""Queries of sources, sinks, incremental loads, ingests, and single operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binding as b
from .functions import numbers, text
from .operators import aggregates, ranking
from .plans import ingests, substitutes
from .queries import _ASSIGNED, _by_card, _CYCLE, _substitutes, _SUBSTITUTES
from .registry import query, rounded
from .sources import incremental, quality, readers, sheets, tables
from .sources.shared import work_dir
from .streaming import cycles, push_events


def _new(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def _folder(spark: SparkSession, kind: str) -> str:
    return f"{work_dir(spark)}/{_new(kind)}"


# Tables

_CUSTOMER_SPEC = {"schema": "default", "columns": [{"name": "c_custkey", "field_type": "INTEGER", "mode": "REQUIRED"}, {"name": "c_name", "field_type": "STRING"}, {"name": "c_acctbal", "field_type": "FLOAT"}, {"name": "c_mktsegment", "field_type": "STRING"}], "clustering_fields": ["c_custkey"]}


@query(" SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def full_ingest(spark, d):
    spec = tables.TableSpec.from_json(_CUSTOMER_SPEC | {"table": _new("full_ingest")})
    return ingests.ingest_full(b.table(spark, d, "customer"), spec)


@query(" SELECT year(transaction_date) AS year, basket_key, basket_value FROM orders_ WHERE year(transaction_date) >= 1998")
def table_as_select(spark, d):
    """A table from a query, appended to once more, without its oldest partitions."""
    o = b.orders(spark, d).select("basket_key", "basket_value", F.year("transaction_date").alias("year"))
    name = f"default.{_new('as_select')}"
    tables.create_as(o.where("basket_key % 2 = 0"), name, "EMPTY", ["year"], ["basket_key"])
    tables.create_as(o.where("basket_key % 2 <> 0"), name, "APPEND", ["year"], ["basket_key"])
    tables.drop_old_partitions(spark, name, "year", "1998")
    return spark.table(name).select("year", "basket_key", "basket_value")


@query(" SELECT basket_key, channel FROM orders_ WHERE channel <> '5-LOW' UNION ALL SELECT basket_key, 'new' FROM orders_ WHERE channel = '5-LOW'")
def slice_replaced_twice(spark, d):
    """A slice of a table deleted and loaded again; the second run changes nothing."""
    o = b.orders(spark, d).select("basket_key", "channel")
    spec = tables.TableSpec(f"default.{_new('slice')}", o.schema)
    tables.write_table(o, spec, "append")
    for _ in range(2):
        tables.overwrite_slice(o.where("channel = '5-LOW'").withColumn("channel", F.lit("new")), spec, "channel IN ('5-LOW', 'new')")
    return spark.table(spec.name)


@query(" SELECT basket_key, year(transaction_date) AS year, CASE WHEN year(transaction_date) = 1997 THEN 'new' ELSE channel END AS channel FROM orders_ WHERE year(transaction_date) <> 1998")
def partitions_replaced_twice(spark, d):
    """Two years of a partitioned table deleted, one of them loaded again; only these partitions are written."""
    o = b.orders(spark, d).select("basket_key", "channel", F.year("transaction_date").alias("year"))
    spec = tables.TableSpec(f"default.{_new('years')}", o.schema, ["year"])
    tables.write_table(o, spec, "append")
    for _ in range(2):
        tables.overwrite_slice(o.where("year = 1997").withColumn("channel", F.lit("new")), spec, "year BETWEEN 1997 AND 1998")
    return spark.table(spec.name).select("basket_key", "year", "channel")


@query(" SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def gated_reload(spark, d):
    """Customers loaded through a gate, checked in the pass that stages them."""
    c = b.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    spec = tables.TableSpec(f"default.{_new('gated')}", c.schema)
    for _ in range(2):
        quality.gated_load(c, spec, ["id"], ["name", "balance"])
    return spark.table(spec.name)


@query(" SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def staged_reload(spark, d):
    """Landed pipe-separated text, staged, typed and loaded in place of what was there."""
    path, name = _folder(spark, "landed"), f"default.{_new('staged')}"
    c = b.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("  "), F.col("c_name")).alias("name"), F.col("c_acctbal").cast("string").alias("balance"))
    c.write.option("sep", "|").option("header", True).csv(path)
    staged = readers.typed(readers.read_csv(spark, path, "|"), {"id": "INTEGER", "name": "STRING", "balance": "FLOAT"})
    quality.assert_columns(staged, ["id", "name", "balance"])
    quality.assert_no_nulls(staged)
    quality.assert_unique(staged, ["id"])
    for _ in range(2):
        tables.create_as(staged, name, "TRUNCATE")
    return spark.table(name)


@query(" SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer")
def files_of_two_formats(spark, d):
    """Files with and without a header, of other separators, one of them without a column."""
    c = b.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"))
    one, two = _folder(spark, "landed"), _folder(spark, "landed")
    c.where("CAST(key AS BIGINT) % 2 = 0").write.csv(one)
    c.where("CAST(key AS BIGINT) % 2 <> 0").select("name", "key").write.option("sep", ";").option("header", True).csv(two)
    return readers.read_sources(spark, [{"path": one, "header": False}, {"path": two, "sep": ";"}], ["key", "name", "nation"])


@query(" SELECT line_no, basket_key, store_id, store_banner FROM sales LEFT JOIN stores USING (store_id)")
def enriched_on_load(spark, d):
    lines = b.sales(spark, d).select("line_no", "basket_key", "store_id").join(F.broadcast(b.stores(spark, d)), "store_id", "left")
    spec = tables.TableSpec(f"default.{_new('enriched')}", lines.schema)
    tables.write_table(lines, spec, "append")
    return spark.table(spec.name).select("line_no", "basket_key", "store_id", "store_banner")


@query(" SELECT basket_key, customer_key FROM orders_")
def changed_since(spark, d):
    """Rows of files that changed since a moment; none of a moment to come."""
    o = b.table(spark, d, "orders")
    since = lambda moment: readers.modified_since(o, moment).select(F.col("o_orderkey").alias("basket_key"), F.col("o_custkey").alias("customer_key"))
    return since("2000-01-01").union(since("2999-01-01"))


@query(" SELECT event_id, user_id, event_type, ts FROM events WHERE concat_ws('|', event_type, user_id, CAST(hour(ts) AS VARCHAR)) NOT IN (SELECT concat_ws('|', event_type, user_id, CAST(hour(ts) AS VARCHAR)) FROM events WHERE event_id % 4 = 0 AND event_type = 'click' AND CAST(ts AS DATE) >= DATE '2024-01-30' - 10)")
def new_by_composite_key(spark, d):
    e = b.table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", F.hour("ts").alias("hour"))
    target = e.where("event_id % 4 = 0").withColumn("day", F.to_date("ts"))
    return incremental.new_by_composite_key(e, target, ["event_type", "user_id", "hour"], "day", 10, "2024-01-30", event_type="click").drop("hour")


# Ingests

@query(" SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS rut, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS end_date FROM orders WHERE o_orderkey % 3 = 0 OR CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) >= DATE '2001-07-01' - INTERVAL 7 MONTH")
def memberships_snapshot(spark, d):
    k = F.col("o_orderkey")
    m = b.table(spark, d, "orders").select(k.alias("id"), F.concat(F.col("o_custkey").cast("string"), F.lit("-K")).alias("rut"), F.when(k % 3 > 0, F.date_add(F.to_date("o_orderdate"), (k % 400).cast("int"))).alias("end_date"))
    return ingests.memberships_snapshot(m, 7, b.ON_DATE)


@query(" SELECT lpad(CAST(l_partkey AS VARCHAR), 18, '0') || '-UN' AS vtexrefid, 'http://images/' || l_suppkey AS url FROM lineitem WHERE l_orderkey % 5 > 0 QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN l_linenumber < 6 THEN l_linenumber END NULLS LAST, 'http://images/' || l_suppkey) = 1")
def image_urls(spark, d):
    li = b.table(spark, d, "lineitem")
    url = F.when(F.col("l_orderkey") % 5 > 0, F.concat(F.lit("http://images/"), F.col("l_suppkey").cast("string"))).otherwise("http://images/PlaceHolder")
    images = li.select(F.col("l_partkey").alias("sku"), url.alias("url"), F.when(F.col("l_linenumber") < 6, F.col("l_linenumber")).alias("position"))
    return ingests.image_urls(images, F.lit("UN"))


@query(" SELECT ref_id, ean, name FROM (SELECT 'r' || l_partkey AS ref_id, l_orderkey AS ean, 'n' || l_linenumber AS name, l_shipdate FROM lineitem WHERE l_linenumber <> 3) QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY l_shipdate DESC NULLS LAST, ean) = 1")
def shop_products(spark, d):
    li = b.table(spark, d, "lineitem")
    ean = F.when(F.col("l_linenumber") != 3, F.col("l_orderkey").cast("string")).otherwise(F.concat(F.lit("x"), F.col("l_orderkey").cast("string")))
    skus = li.select(F.concat(F.lit("r"), F.col("l_partkey").cast("string")).alias("ref_id"), ean.alias("ean"), F.concat(F.lit("n"), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_shipdate").alias("changed_at"))
    return ingests.sku_dim(skus, ["ref_id", "ean", "name"])


@query(" SELECT DISTINCT c_mktsegment AS locality, n_name AS commune, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def census_localities(spark, d):
    n, r = b.table(spark, d, "nation"), b.table(spark, d, "region")
    c = b.table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    return ingests.census_dim(c.select(F.col("c_mktsegment").alias("locality"), F.col("n_name").alias("commune"), F.col("r_name").alias("region")), ["locality", "commune", "region"])


@query(" SELECT CAST(o_orderdate AS DATE) + 60 AS date, l_suppkey AS store_id, CAST(count(*) AS BIGINT) AS orders, CAST(count(*) FILTER (l_shipdate <= o_orderdate + INTERVAL 60 DAY) AS BIGINT) AS on_time, count(*) FILTER (l_shipdate <= o_orderdate + INTERVAL 60 DAY) / count(*) AS compliance FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def delivery_compliance(spark, d):
    li, o = b.table(spark, d, "lineitem"), b.table(spark, d, "orders")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("store_id"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")).alias("promised_at"), F.col("l_shipdate").alias("delivered_at"))
    return ingests.delivery_compliance(rows)


@query(" SELECT c_custkey AS order_id, commune, region FROM customer LEFT JOIN (SELECT n_name AS commune, r_name AS region, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey AND c_custkey % 10 > 0")
def order_locality(spark, d):
    n, r, c = b.table(spark, d, "nation"), b.table(spark, d, "region"), b.table(spark, d, "customer")
    census = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit(" "), F.lower("n_name")).alias("locality"), F.col("n_name").alias("commune"), F.col("r_name").alias("region"))
    census = census.unionByName(census.select("locality", F.concat("commune", F.lit("~")).alias("commune"), "region"))
    orders = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("order_id"), F.when(F.col("c_custkey") % 10 > 0, F.concat("n_name", F.lit("  "))).otherwise("nowhere").alias("locality"))
    return ingests.order_locality(orders, census).select("order_id", "commune", "region")


@query(" SELECT event_id, CASE WHEN event_id % 9 > 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS sent, CASE WHEN event_id % 4 > 0 THEN user_id END AS contact, CAST(year(ts) AS INTEGER) AS YEAR, CAST(month(ts) AS INTEGER) AS MONTH FROM (SELECT * REPLACE (CASE WHEN event_id % 9 > 0 THEN ts END AS ts) FROM events) WHERE event_type <> 'view'")
def messaging_events(spark, d):
    e = b.table(spark, d, "events")
    time = F.when(F.col("event_id") % 9 > 0, F.date_format("ts", "M/d/yyyy h:mm:ss a")).otherwise("soon")
    contact = F.when(F.col("event_id") % 4 > 0, F.concat(F.lit(" "), F.col("user_id").cast("string"))).otherwise("n/a")
    landed = e.select("event_id", time.alias("sent"), contact.alias("contact"), F.when(F.col("event_type") == "view", "sent").otherwise(F.col("event_type")).alias("Status"))
    out = ingests.messages(landed, ["event_id", "sent", "Status"], ["sent"], ("SENT",), ("contact",), "sent")
    return out.select("event_id", F.date_format("sent", "yyyy-MM-dd HH:mm:ss").alias("sent"), "contact", "YEAR", "MONTH")


@query(" SELECT store_id, CAST(count(DISTINCT basket_key) AS BIGINT) AS visits, CAST(count(DISTINCT customer_key) AS BIGINT) AS customers, round(sum(value), 2) AS value, sum(quantity) AS weight FROM sales WHERE year(transaction_date) = 2000 AND month(transaction_date) = 3 GROUP BY 1")
def monthly_visits(spark, d):
    report = ingests.monthly_report(ingests.visits(b.sales(spark, d), ["store_id"]), 2000, 3)
    return report.select("store_id", "visits", "customers", *rounded("value", digits=2), "weight")


@query(" SELECT basket_key, strftime(transaction_date, '%Y%m') AS period, strftime(transaction_date, '%m') AS month FROM orders_ WHERE year(transaction_date) = 2000")
def control_group(spark, d):
    return ingests.control_group(b.orders(spark, d).select("basket_key", F.date_format("transaction_date", "yyyyMM").alias("period")), 2000)


@query(" SELECT ean AS offer_id, weight AS period, brand AS mechanic, trim(regexp_replace(nm, '\\s+', ' ', 'g')) AS description, sku AS code, CAST(weight * 10 AS BIGINT) AS cycle, trim(regexp_replace(concat_ws(' ', brand, nm), '\\s+', ' ', 'g')) AS promotion_name FROM products WHERE ean % 3 > 0 AND weight % 4 > 0")
def offers_by_ean(spark, d):
    p = b.products(spark, d)
    offers = p.select(F.col("ean").alias("offer_id"), F.col("weight").alias("period"), F.col("brand").alias("mechanic"), F.col("nm").alias("description"))
    eans = p.where("ean % 3 > 0").select(F.col("ean").alias("offer_id"), F.col("sku").alias("code"))
    cycles = p.where("weight % 4 > 0").select(F.col("weight").alias("period"), (F.col("weight") * 10).cast("long").alias("cycle")).distinct()
    return sheets.offers_by_ean(offers, eans, cycles)


# Streams


def _events(spark: SparkSession, d: str) -> DataFrame:
    events = push_events.read_events(spark, f"{d.rstrip('/')}/[e]vents.parquet", b.table(spark, d, "events").schema)  # a pattern: the table may be one file
    return events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant


@query(" SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def push_events_stream(spark, d):
    """All events as a stream, each key once, inserted into a table in a run and, without effect, once more."""
    name = f"default.{_new('push_events')}"
    for _ in range(2):
        events = push_events.distinct_events(_events(spark, d), ["event_id"], "ts", "40 days")
        push_events.write_new_events(events, name, ["event_id"], _folder(spark, "stream")).awaitTermination()
    return spark.table(name).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(" SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def events_by_hour(spark, d):
    path = _folder(spark, "counts")
    push_events.write_counts(push_events.windowed_counts(_events(spark, d), "ts", "event_type"), path, _folder(spark, "stream")).awaitTermination()
    return push_events.last_counts(spark, path).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


@query(" SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2")
def final_events_by_hour(spark, d):
    """The hours that the watermark has passed, each written once."""
    path = _folder(spark, "final")
    push_events.write_final_counts(push_events.windowed_counts(_events(spark, d), "ts", "event_type"), path, _folder(spark, "stream")).awaitTermination()
    return spark.read.parquet(path).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


@query(f"{_ASSIGNED} {_CYCLE}")
def streamed_purchase_cycle(spark, d):
    """Purchase cycles from a stream of the landed purchases by card, with the last two of each customer as state."""
    path, store = _folder(spark, "purchases"), "spark.sql.streaming.stateStore.providerClass"
    bought = _by_card(spark, d).where("by_card").where(F.col("transaction_date") < F.lit(b.ON_DATE).cast("date"))
    bought.select("customer_key", F.col("transaction_date").cast("timestamp").alias("ts"), "basket_key").write.parquet(path)
    before, out = spark.conf.get(store), _folder(spark, "cycles")
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema("customer_key long, ts timestamp, basket_key long").parquet(path)
        cycles.write_last_two(stream, "customer_key", "ts", "basket_key", out, _folder(spark, "stream")).awaitTermination()
    finally:
        spark.conf.set(store, before)
    return cycles.cycles(spark, out, "2001-01-01")


# Single operators

@query(" SELECT basket_key, channel FROM orders_ WHERE channel <> '4-NOT SPECIFIED' AND channel LIKE '%-%' AND NOT channel LIKE '5%' AND regexp_matches(upper(channel), 'URGENT|HIGH|LOW')")
def sentinels_and_patterns(spark, d):
    c = F.col("channel")
    return b.orders(spark, d).where((c != "4-NOT SPECIFIED") & c.like("%-%") & ~c.like("5%") & F.upper(c).rlike("URGENT|HIGH|LOW")).select("basket_key", "channel")


@query(" SELECT s_suppkey, CAST(count(c_custkey) AS BIGINT) AS n FROM customer RIGHT JOIN supplier ON c_custkey = s_suppkey * 7 GROUP BY 1")
def right_outer_join(spark, d):
    c, s = b.table(spark, d, "customer"), b.table(spark, d, "supplier")
    return c.join(s, c.c_custkey == s.s_suppkey * 7, "right").groupBy("s_suppkey").agg(F.count("c_custkey").alias("n"))


@query(" SELECT ean, category, CAST(rank() OVER (PARTITION BY category ORDER BY weight DESC) AS INTEGER) AS place FROM products")
def rank_groups(spark, d):
    return ranking.with_rank(b.products(spark, d), ["category"], [F.desc("weight")], "place", "rank").select("ean", "category", "place")


@query(" SELECT customer_key, basket_key FROM orders_ QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY md5(concat_ws('|', basket_key, 7)), basket_key) <= 2")
def drawn_baskets(spark, d):
    """Two baskets of each customer, drawn by a hash with a seed."""
    order = [F.md5(F.concat_ws("|", "basket_key", F.lit(7)).cast("binary")), F.asc("basket_key")]
    return ranking.top_k(b.orders(spark, d), ["customer_key"], order, 2).select("customer_key", "basket_key")


@query(" SELECT customer_key, basket_key FROM orders_ QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY transaction_date DESC, basket_key DESC) <= 3")
def last_baskets(spark, d):
    return ranking.bottom_then_order(b.orders(spark, d), ["customer_key"], ["transaction_date", "basket_key"], 3).select("customer_key", "basket_key")


@query(" SELECT sub_category, ean, round(sum(value) OVER (PARTITION BY sub_category ORDER BY value DESC, ean ROWS UNBOUNDED PRECEDING) / sum(value) OVER (PARTITION BY sub_category), 6) AS share FROM (SELECT sub_category, ean, round(sum(value), 2) AS value FROM sales JOIN products USING (ean) GROUP BY 1, 2)")
def running_share(spark, d):
    per = b.sales(spark, d).join(b.products(spark, d), "ean").groupBy("sub_category", "ean").agg(F.round(F.sum("value"), 2).alias("value"))
    return aggregates.running_share(per, ["sub_category"], [F.desc("value"), F.asc("ean")], "value", "share").select("sub_category", "ean", *rounded("share"))


@query(" SELECT ean, name, CAST(value AS BIGINT) AS value FROM (UNPIVOT (SELECT ean, CAST(weight AS BIGINT) AS weight, CAST(nullif(sku % 3, 0) AS BIGINT) AS third FROM products) ON weight, third INTO NAME name VALUE value)")
def unpivoted(spark, d):
    p = b.products(spark, d).select("ean", F.col("weight").cast("long").alias("weight"), F.nullif(F.col("sku") % 3, F.lit(0)).cast("long").alias("third"))
    return aggregates.unpivot(p, ["ean"], ["weight", "third"])


@query(" SELECT category, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS stddev, min(value) AS least, round(quantile_cont(CAST(value AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST(value AS DOUBLE), 0.5), 4) AS median, round(quantile_cont(CAST(value AS DOUBLE), 0.75), 4) AS q75, max(value) AS most FROM sales JOIN products USING (ean) GROUP BY 1")
def described_values(spark, d):
    out = aggregates.described(b.sales(spark, d).join(b.products(spark, d), "ean"), ["category"], "value")
    return out.select("category", "n", *rounded("mean", "stddev", digits=4), "least", *rounded("q25", "median", "q75", digits=4), "most")


@query(" SELECT ean, ltrim(lpad(CAST(ean AS VARCHAR), 18, '0'), '0') AS bare, TRY_CAST(replace(trim(' ' || replace(CAST(weight / 4 AS VARCHAR), '.', ',') || CASE WHEN ean % 6 = 0 THEN 'kg' ELSE ' ' END), ',', '.') AS DOUBLE) AS content, round(weight / nullif(weight % 3, 0), 6) AS ratio FROM products")
def dirty_numbers(spark, d):
    w = F.col("weight")
    dirty = F.concat(F.lit(" "), F.replace((w / 4).cast("string"), F.lit("."), F.lit(",")), F.when(F.col("ean") % 6 == 0, "kg").otherwise(" "))
    return b.products(spark, d).select("ean", text.without_leading_zeros(F.lpad(F.col("ean").cast("string"), 18, "0")).alias("bare"), text.to_number(dirty).alias("content"), F.round(numbers.safe_divide(w, w % 3), 6).alias("ratio"))


@query(r""", t AS (SELECT ean, regexp_extract_all(regexp_replace(lower(nm || ' 500ml 500 ml OTROS'), '\W+', ' ', 'g'), '([a-z]+|\d+|[^\w\s]+)', 1) AS t FROM products)
SELECT ean, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i AND x NOT IN ('gr', 'g', 'otros')), ' ') AS name FROM t""")
def clean_names(spark, d):
    return b.products(spark, d).select("ean", substitutes.clean_name(F.concat("nm", F.lit(" 500ml 500 ml OTROS"))).alias("name"))


@query(f"{_SUBSTITUTES} SELECT ean, string_agg(CAST(substitute AS VARCHAR), ',' ORDER BY substitution_rank) AS substitutes FROM ranked WHERE substitution_rank <= 5 GROUP BY 1")
def substitute_lists(spark, d):
    lists = substitutes.substitute_vectors(_substitutes(spark, d))
    return lists.select("ean", F.array_join(F.transform("substitutes", lambda x: x.cast("string")), ",").alias("substitutes"))
