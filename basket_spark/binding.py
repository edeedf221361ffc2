"""The tables of a folder as the entities that the jobs work on, in Spark and as SQL with the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ON_DATE = "2001-07-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("basket_key"), F.col("o_custkey").alias("customer_key"), F.col("o_totalprice").alias("basket_value"), F.to_date("o_orderdate").alias("transaction_date"), F.col("o_orderpriority").alias("channel"))


def sales(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    lines = li.select(F.col("l_orderkey").alias("basket_key"), F.col("l_orderkey").alias("txn_key"), F.col("l_partkey").alias("ean"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("value"), F.col("l_suppkey").alias("store_id"), F.col("l_returnflag").alias("transaction_type"), F.col("l_linenumber").alias("line_no"))
    return lines.join(orders(spark, d).select("basket_key", "customer_key", "transaction_date"), "basket_key")


def baskets(spark: SparkSession, d: str) -> DataFrame:
    quantity = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("basket_key")).agg(F.sum("l_quantity").alias("basket_quantity"))
    return orders(spark, d).join(quantity, "basket_key")


def delivery(spark: SparkSession, d: str) -> DataFrame:
    """Baskets of delivery apps."""
    return orders(spark, d).where("channel = '1-URGENT'").select("basket_key")


def stores(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("store_id"), F.col("r_name").alias("store_banner"))


def products(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("ean"), F.col("p_partkey").alias("sku"), F.col("p_type").alias("category"), F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 5).cast("string")).alias("sub_category"), F.col("p_brand").alias("brand"), F.col("p_size").alias("weight"), F.col("p_name").alias("nm"), F.lit("UN").alias("unit"), F.lit(1.0).alias("sales_unit"), F.col("p_retailprice").alias("list_price"))


def cards(spark: SparkSession, d: str) -> DataFrame:
    """One or two cards of each customer, from its first order: the second starts a year after the first, which ends then."""
    first = orders(spark, d).groupBy("customer_key").agg(F.min("transaction_date").alias("first"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_acctbal").alias("balance")).join(first, "customer_key")
    limit = (F.floor(F.abs("balance")) * 60).cast("double")
    one = c.select("customer_key", (F.col("customer_key") * 10).alias("card_id"), F.col("first").alias("subscription_date"), F.when(F.col("customer_key") % 2 == 0, F.add_months("first", 12)).alias("closed_date"), limit.alias("credit_limit"))
    two = c.where("customer_key % 2 = 0").select("customer_key", (F.col("customer_key") * 10 + 1).alias("card_id"), F.add_months("first", 12).alias("subscription_date"), F.lit(None).cast("date").alias("closed_date"), limit.alias("credit_limit"))
    return one.union(two)


def daily(spark: SparkSession, d: str) -> DataFrame:
    p = products(spark, d)
    lines = sales(spark, d).join(p, "ean")
    out = lines.groupBy("ean", "sub_category", "category", F.col("transaction_date").alias("date")).agg(F.sum("value").alias("value"), F.sum("quantity").alias("quantity"))
    return out.withColumn("price", F.col("value") / F.col("quantity"))


#: The same entities for DuckDB; a query starts with ``WITH {CTE}, ...``.
CTE = """
orders_ AS (SELECT o_orderkey AS basket_key, o_custkey AS customer_key, o_totalprice AS basket_value, CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority AS channel FROM orders),
sales AS (SELECT l_orderkey AS basket_key, l_orderkey AS txn_key, l_partkey AS ean, l_quantity AS quantity, l_extendedprice AS value, l_suppkey AS store_id, l_returnflag AS transaction_type, l_linenumber AS line_no, customer_key, transaction_date FROM lineitem JOIN orders_ ON l_orderkey = basket_key),
baskets AS (SELECT o.*, q.basket_quantity FROM orders_ o JOIN (SELECT l_orderkey AS basket_key, sum(l_quantity) AS basket_quantity FROM lineitem GROUP BY 1) q USING (basket_key)),
delivery AS (SELECT basket_key FROM orders_ WHERE channel = '1-URGENT'),
stores AS (SELECT s_suppkey AS store_id, r_name AS store_banner FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
products AS (SELECT p_partkey AS ean, p_partkey AS sku, p_type AS category, p_type || '-' || CAST(p_size % 5 AS VARCHAR) AS sub_category, p_brand AS brand, p_size AS weight, p_name AS nm, 'UN' AS unit FROM part),
cust_first AS (SELECT customer_key, min(transaction_date) AS first FROM orders_ GROUP BY 1),
cards AS (
  SELECT c_custkey AS customer_key, c_custkey * 10 AS card_id, first AS subscription_date, CASE WHEN c_custkey % 2 = 0 THEN CAST(first + INTERVAL 12 MONTH AS DATE) END AS closed_date, CAST(floor(abs(c_acctbal)) * 60 AS DOUBLE) AS credit_limit FROM customer JOIN cust_first ON c_custkey = customer_key
  UNION ALL SELECT c_custkey, c_custkey * 10 + 1, CAST(first + INTERVAL 12 MONTH AS DATE), NULL, CAST(floor(abs(c_acctbal)) * 60 AS DOUBLE) FROM customer JOIN cust_first ON c_custkey = customer_key WHERE c_custkey % 2 = 0),
daily AS (SELECT ean, sub_category, category, transaction_date AS date, sum(value) AS value, sum(quantity) AS quantity, sum(value) / sum(quantity) AS price FROM sales JOIN products USING (ean) GROUP BY 1, 2, 3, 4)"""
