"""Usual products of customers, own-brand injection, and the published form of ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_week_difference, period_index, recency
from ..functions.text import sku_key
from ..operators.ranking import first_row, top_k, with_rank
from ..sources.shared import spread


def list_caps(baskets: DataFrame, top_n: int) -> DataFrame:
    """(customer_key, cap): 30 or 50 where no basket is larger than that, else ``top_n``."""
    most = F.max("basket_quantity")
    return baskets.groupBy("customer_key").agg(F.when(most <= 30, 30).when(most <= 50, 50).otherwise(top_n).alias("cap"))


def recency_score(sales: DataFrame, on_date: str, mode: str = "dcg") -> DataFrame:
    """(customer_key, ean, score): distinct transactions of each week, divided by how long ago it was, summed."""
    lines = sales.select("customer_key", "ean", "txn_key", iso_week_difference(F.lit(on_date).cast("date"), F.col("transaction_date")).alias("weeks"))
    lines = spread(lines, "customer_key", "ean").distinct()  # once for the three steps, and away from the sorts of the join before
    weekly = lines.groupBy("customer_key", "ean", "weeks").agg(F.count("*").alias("n"))
    return weekly.groupBy("customer_key", "ean").agg(F.round(F.sum(F.col("n") / recency(F.col("weeks"), mode)), 6).alias("score"))


def usuals(sales: DataFrame, baskets: DataFrame, delivery: DataFrame, on_date: str, months: int = 6, filter_months: int = 12, min_months: int = 2, top_n: int = 100, mode: str = "dcg") -> DataFrame:
    """(customer_key, ean, score, relevance): the products a customer buys most and last, as many as its baskets suggest.

    Of the ``months`` before the date, without delivery-app baskets, customers with purchases in ``min_months`` distinct
    months. Caps come from the baskets of ``filter_months``; customers without any get 30.
    """
    day = F.lit(on_date).cast("date")

    def window(df: DataFrame, n: int) -> DataFrame:
        return df.where((F.col("transaction_date") >= F.add_months(day, -n)) & (F.col("transaction_date") < day))

    lines = window(sales, months).join(delivery.select("basket_key").distinct(), "basket_key", "left_anti")
    regular = lines.groupBy("customer_key").agg(F.count_distinct(period_index(F.col("transaction_date"))).alias("m")).where(F.col("m") >= min_months).select("customer_key")
    scores = recency_score(lines.join(regular, "customer_key", "left_semi"), on_date, mode)
    ranked = with_rank(scores, ["customer_key"], [F.desc("score"), F.asc("ean")], "relevance")
    caps = list_caps(window(baskets, filter_months), top_n)
    return ranked.join(caps, "customer_key", "left").where(F.col("relevance") <= F.coalesce("cap", F.lit(30))).drop("cap")


def own_brand_candidates(usual: DataFrame, products: DataFrame, substitutes: DataFrame, own: Column) -> DataFrame:
    """(customer_key, sub_category, ean, relevance): for each usual product of another brand the best-ranked substitute in
    its sub-category that is own brand, half a place below; once for each customer, sub-category and substitute, and only
    what the customer hasn't in the list. ``own`` tells own-brand products by ``products``'s columns."""
    marked = products.select("ean", "sub_category", own.alias("own"))
    others = usual.join(marked.where("NOT own"), "ean")
    target = marked.where("own").select(F.col("ean").alias("substitute"), F.col("sub_category").alias("sub_category_2"))
    best = first_row(substitutes.join(target, "substitute").join(marked.select("ean", "sub_category"), "ean").where("sub_category = sub_category_2"), ["ean"], [F.asc("substitution_rank"), F.asc("substitute")]).select("ean", "substitute")
    found = others.join(best, "ean").groupBy("customer_key", "sub_category", F.col("substitute").alias("ean")).agg((F.min("relevance") + 0.5).alias("relevance"))
    return found.join(usual.select("customer_key", "ean"), ["customer_key", "ean"], "left_anti")


def inject_own_brand(usual: DataFrame, candidates: DataFrame, bought: DataFrame, recommended: DataFrame, keep: int = 5, seed: int = 0) -> DataFrame:
    """(customer_key, ean, relevance, injected): the list with up to ``keep`` candidates, ranked anew; equal places stay equal.

    Candidates bought in the last month come first, by relevance from the bottom; then those never recommended, in an
    order drawn by a hash. What was recommended before and not bought goes.
    """
    pair = ["customer_key", "ean"]
    marked = candidates.join(bought.select(pair).distinct().withColumn("bought", F.lit(1)), pair, "left").join(recommended.select(pair).distinct().withColumn("before", F.lit(1)), pair, "left")
    marked = marked.where("bought = 1 OR before IS NULL").fillna(0, ["bought"])
    order = [F.desc("bought"), F.when(F.col("bought") == 1, -F.col("relevance")), F.md5(F.concat_ws("|", "customer_key", "ean", F.lit(seed)).cast("binary")), F.asc("ean")]
    chosen = top_k(marked, ["customer_key"], order, keep).select(*pair, "relevance", F.lit(True).alias("injected"))
    both = usual.select(*pair, F.col("relevance").cast("double").alias("relevance"), F.lit(False).alias("injected")).unionByName(chosen)
    return with_rank(both, ["customer_key"], [F.asc("relevance")], "place", "dense_rank").select(*pair, F.col("place").alias("relevance"), "injected")


def publish_ranked(ranked: DataFrame, products: DataFrame, banner: int, on_date: str) -> DataFrame:
    """(date, customer_key, hash_string, sku_product, ean, relevance, store_banner, vtexrefid) of a ranked list."""
    dim = products.select("ean", "sku", "unit")
    return ranked.join(dim, "ean").select(F.lit(on_date).cast("date").alias("date"), "customer_key", F.md5(F.col("customer_key").cast("string").cast("binary")).alias("hash_string"), F.col("sku").alias("sku_product"), "ean", "relevance", F.lit(banner).alias("store_banner"), sku_key(F.col("sku"), F.col("unit")).alias("vtexrefid"))
