"""Price sophistication of customers and brands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import harmonic_mean, weighted_mean
from ..operators.kmeans import adaptive_kmeans, fill_by_boundaries, kmeans_1d
from ..operators.quantiles import percentiles
from ..sources.shared import stored

BRAND_SEGMENTS = ["ECONOMY", "MAINSTREAM", "PREMIUM"]


def sophistication_score(sales: DataFrame, products: DataFrame, by: list[str], min_items: int = 3) -> DataFrame:
    """(by, hm_pu_ppum, total_value): how dear what is bought is for its sub-category and unit.

    Unit price and price per unit of measure of each line over the mean of the group; means over lines weighted by
    quantity; their harmonic mean. Groups of ``by`` with ``min_items`` lines at least. The group means are an aggregate
    joined back, since few groups hold all lines.
    """
    lines = sales.join(products, "ean")
    kept = lines.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") >= min_items).select(*by)
    lines = lines.where("quantity > 0 AND value > 0 AND weight > 0").join(kept, by, "left_semi")
    lines = lines.withColumn("pu", F.col("value") / F.col("quantity")).withColumn("ppum", F.col("value") / (F.col("weight") * F.col("quantity")))
    lines = lines.withColumn("__g", F.concat(F.col("sub_category"), F.lit(" - "), F.col("unit")))
    means = lines.groupBy("__g").agg(F.avg("pu").alias("__pu"), F.avg("ppum").alias("__ppum"))
    indexed = lines.join(means, lines["__g"].eqNullSafe(means["__g"])).withColumns({"pu": F.col("pu") / F.col("__pu"), "ppum": F.col("ppum") / F.col("__ppum")})
    parts = indexed.groupBy(*by).agg(weighted_mean(F.col("pu"), F.col("quantity")).alias("a"), weighted_mean(F.col("ppum"), F.col("quantity")).alias("b"), F.sum("value").alias("total_value"))
    return parts.select(*by, harmonic_mean(F.col("a"), F.col("b")).alias("hm_pu_ppum"), "total_value")


def without_outliers(scores: DataFrame, by: str, value: str, factor: float = 10.0, least_rows: int = 500) -> DataFrame:
    """Rows up to ``factor`` times the group's mean, of groups with ``least_rows`` of them."""
    means = scores.groupBy(by).agg(F.avg(value).alias("__m"))
    kept = scores.join(means, by).where(F.col(value) <= factor * F.col("__m")).drop("__m")
    large = kept.groupBy(by).agg(F.count("*").alias("__n")).where(F.col("__n") >= least_rows).select(by)
    return kept.join(large, by, "left_semi")


def index_1_to_3(scores: DataFrame, by: str, value: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """``scores`` with ``index``: 1 up to the low percentile of the group, 3 from the high one, linear between."""
    ends = percentiles(scores, [by], F.col(value), [low, high], "__p")
    lo, hi = F.get("__p", F.lit(0)), F.get("__p", F.lit(1))
    scaled = F.coalesce(F.try_divide(F.col(value) - lo, hi - lo), F.lit(0.0))
    return scores.join(ends, by).withColumn("index", 1 + 2 * F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))).drop("__p")


def customer_segments(scores: DataFrame, min_categories: int = 3, least_rows: int = 500) -> DataFrame:
    """(customer_key, index, n_categories, segment 0..2) from (customer_key, category, hm_pu_ppum, total_value).

    Category indices are weighted by value and by how much the category's prices vary (between half and twice the mean
    variation). Customers of enough categories are clustered; the others fall to the segment by its limits.
    """
    clean = stored(without_outliers(stored(scores, "scores"), "category", "hm_pu_ppum", least_rows=least_rows), "scores")
    spread = clean.groupBy("category").agg(F.try_divide(F.stddev("hm_pu_ppum"), F.avg("hm_pu_ppum")).alias("cv"))
    mean = spread.agg(F.avg("cv").alias("mean_cv"))
    ratio = spread.crossJoin(F.broadcast(mean)).select("category", F.least(F.greatest(F.coalesce(F.try_divide("cv", "mean_cv"), F.lit(1.0)), F.lit(0.5)), F.lit(2.0)).alias("ratio"))
    indexed = index_1_to_3(clean, "category", "hm_pu_ppum").join(F.broadcast(ratio), "category")
    customers = indexed.groupBy("customer_key").agg(weighted_mean(F.col("index"), F.col("total_value") * F.col("ratio")).alias("index"), F.count("*").alias("n_categories"))
    customers = stored(customers, "customers")
    many = kmeans_1d(customers.where(F.col("n_categories") >= min_categories), [], "index", 3, (0.05, 0.95), "segment")
    many = stored(many, "segments")
    few = fill_by_boundaries(many, customers.where(F.col("n_categories") < min_categories), "index", "segment")
    return many.unionByName(few)


def brand_segments(scores: DataFrame, own: str | None = None, least: float = 0.04, least_brands: int = 3) -> DataFrame:
    """(category, brand, hm_pu_ppum, segment): ECONOMY, MAINSTREAM or PREMIUM within the category, or UNCLASSIFIED.

    Three segments where the medians of neighbours are ``least`` apart, else two, of which the larger is the mainstream; no
    classes where two aren't apart either, in categories of fewer than ``least_brands`` brands and for null scores (see
    ``adaptive_kmeans``). ``own`` is the own brand, which is MPES whatever its price.
    """
    out = adaptive_kmeans(scores, ["category"], "hm_pu_ppum", least, least_brands, label="__s")
    name = F.coalesce(F.get(F.array(*map(F.lit, BRAND_SEGMENTS)), F.col("__s") - 1), F.lit("UNCLASSIFIED"))
    return out.select("category", "brand", "hm_pu_ppum", (F.when(F.col("brand") == own, "MPES").otherwise(name) if own else name).alias("segment"))
