"""Reused intermediates and multi-stage plans.

An intermediate read by several outputs is computed once. Inside one job the
lineage is cut with a reliable ``checkpoint()`` (written to the cluster's
``spark.checkpoint.dir``, so a lost executor re-reads it instead of
recomputing the shuffle); across jobs of one session :func:`cached` keeps a
``MEMORY_AND_DISK`` copy and always releases it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import reliable_checkpoint

from strata.functions.columns import hour_key
from strata.functions.money import to_double


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``with cached(df) as c:`` - persist for the block, unpersist after."""
    c = df.persist(level)
    try:
        yield c
    finally:
        c.unpersist()


def session_level(clicks: DataFrame) -> DataFrame:
    """The shared intermediate: one row per (user, hour) session."""
    return (clicks.groupBy("user_id", "hour_start")
            .agg(F.count(F.lit(1)).alias("c"), F.sum("revenue").alias("r")))


def multi_rollup(clicks: DataFrame) -> DataFrame:
    """Per-user and per-hour session rollups from one materialised session table.

    The session table is checkpointed once (eagerly) and both rollups read it;
    the result is the two rollups stacked with a ``rollup`` label.
    """
    sessions = reliable_checkpoint(session_level(clicks))
    agg = [F.count(F.lit(1)).alias("sessions"), F.sum("c").alias("events"), F.sum("r").alias("_r")]
    users = sessions.groupBy("user_id").agg(*agg).select(
        F.lit("user").alias("rollup"), F.col("user_id").cast("string").alias("key"), "sessions", "events", "_r")
    hours = sessions.groupBy("hour_start").agg(*agg).select(
        F.lit("hour").alias("rollup"), hour_key("hour_start").alias("key"),
        "sessions", "events", "_r")
    return users.unionByName(hours).withColumn("revenue", to_double(F.col("_r"))).drop("_r")


def returned_revenue_by_nation_year(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                                    nation: DataFrame) -> DataFrame:
    """filter -> aggregate -> join -> join -> aggregate.

    Returned lines are reduced to one row per order *before* the join, so the
    join moves orders, not lines. ``nation`` (25 rows by definition) is
    broadcast; the other joins are left to the planner and AQE, which coalesces
    the small post-aggregate partitions.
    """
    money = lambda c: F.col(c).cast("decimal(18,2)")
    per_order = (lineitem.filter(F.col("l_returnflag") == "R")
                 .groupBy("l_orderkey")
                 .agg(F.sum(money("l_extendedprice") * (F.lit(1) - money("l_discount"))).alias("rev")))
    j = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
         .join(customer, F.col("o_custkey") == customer.c_custkey)
         .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey))
    return (j.groupBy("n_name", F.year("o_orderdate").alias("order_year"))
             .agg(F.count(F.lit(1)).alias("order_count"), F.sum("rev").alias("_r"))
             .select("n_name", F.col("order_year").cast("bigint").alias("order_year"), "order_count",
                     to_double(F.col("_r")).alias("revenue")))
