"""The reference's plain query shapes, kept for side-by-side benchmarks.

Each is the same logical query as its catalog key written the way the
reference writes it (unpartitioned windows, no salt, forced sort-merge).
They are *not* registered as catalog queries; ``bench.py`` times them beside
the catalog versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.money import to_double
from strata.operators import rollups
from strata.sources.tables import clickstream


def top_users_ranked_single_partition(spark: SparkSession, d: str, k: int = 1000) -> DataFrame:
    """row_number / percent_rank over unpartitioned windows (one task for all users)."""
    p = rollups.user_profiles(clickstream(spark, d))
    r = (p.withColumn("user_rank", F.row_number().over(Window.orderBy(F.col("lifetime_value").desc(), "user_id")))
          .withColumn("ltv_percentile", F.percent_rank().over(Window.orderBy("lifetime_value"))))
    return (r.filter(F.col("user_rank") <= k)
             .withColumn("lifetime_value", to_double(F.col("lifetime_value"))))


def tier_stats_sort_merge(spark: SparkSession, d: str) -> DataFrame:
    from strata.sources.tables import user_dimension

    from strata.sources.tables import clickstream as _cs

    fact = _cs(spark, d).select("event_id", "ts", "user_id", "event_type", "revenue", "session_id")
    j = fact.join(user_dimension(spark, d).hint("merge"), "user_id", "left")
    return rollups.tier_stats(j).drop("_rev_dec")


def _customer_ltv(spark: SparkSession, d: str) -> DataFrame:
    from strata.sources.tables import customer_orders

    return (customer_orders(spark, d).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("ltv")))


def user_rank_single_partition(spark: SparkSession, d: str) -> DataFrame:
    c = _customer_ltv(spark, d)
    return c.withColumn("user_rank", F.row_number().over(Window.orderBy(F.col("ltv").desc(), "user_id")))


def ltv_percentile_single_partition(spark: SparkSession, d: str) -> DataFrame:
    c = _customer_ltv(spark, d)
    return c.withColumn("ltv_percentile", F.percent_rank().over(Window.orderBy("ltv")))


def events_prices_plain_join(spark: SparkSession, d: str, how: str = "inner") -> DataFrame:
    from strata.plans.queries import _events_and_prices, _priced

    clicks, prices = _events_and_prices(spark, d)
    return _priced(clicks.join(prices.hint("merge"), "revenue", how))


def orders_lineitem_shuffle_join(spark: SparkSession, d: str) -> DataFrame:
    from strata.sources.tables import read_table

    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey)


def supplier_sums_direct(spark: SparkSession, d: str) -> DataFrame:
    from strata.operators.skew import direct_key_sums
    from strata.sources.tables import read_table

    return direct_key_sums(read_table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice")


def skew_user_stats_direct(spark: SparkSession, d: str, key: str = "user_id") -> DataFrame:
    return rollups.skew_user_stats(clickstream(spark, d), key)


PLAIN = {
    "top_users_ranked": top_users_ranked_single_partition,
    "user_rank": user_rank_single_partition,
    "ltv_percentile": ltv_percentile_single_partition,
    "salted_user_stats": skew_user_stats_direct,
    "hot_key_split_union": lambda spark, d: skew_user_stats_direct(spark, d, "revenue"),
    "tier_stats": tier_stats_sort_merge,
    "salted_join": lambda spark, d: events_prices_plain_join(spark, d, "left"),
    "hot_key_broadcast_join": events_prices_plain_join,
    "bucketed_join": orders_lineitem_shuffle_join,
    "composite_key_repartition": supplier_sums_direct,
}
