"""The reference's five jobs as composed plans over a generated clickstream.

Each scenario returns named output DataFrames - everything the job shows -
for a ``"tuned"`` variant (this library's operators) or a ``"plain"`` variant
(the direct query shapes: unpartitioned windows, unsalted distinct counts, forced
sort-merge join, uncontrolled writes). ``bench.py`` times both on the same
generated rows; all outputs go to the ``noop`` sink so nothing is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import hour_floor, money
from strata.operators import joins, layout, ranking, rollups, skew
from strata.session import reliable_checkpoint, scratch_dir
from strata.sources import generators as gen

# Generator settings per scenario (hot share of rows), after the reference's
# skew factors: memory 2.0 and broadcast 2.0 -> 20 %, shuffle 5.0 -> 50 %,
# partitions 1.0 -> 10 %, skew: one key with 80 % (the documented case).
SCENARIO_SKEW = {"memory": dict(hot_fraction=0.2), "shuffle": dict(hot_fraction=0.5),
                 "partitions": dict(hot_fraction=0.1), "broadcast": dict(hot_fraction=0.2),
                 "skew": dict(hot_fraction=0.8, hot_keys=1), "ranking": dict(hot_fraction=0.2)}
DIM_ROWS = 100_000


def as_clickstream(generated: DataFrame) -> DataFrame:
    """Generated rows in the clickstream view the rollups read."""
    ts = F.timestamp_millis("timestamp").cast("timestamp_ntz")
    return generated.select(F.col("record_id").alias("event_id"), ts.alias("ts"),
                            F.col("user_id").cast("bigint").alias("user_id"), "event_type",
                            money("revenue").alias("revenue"), hour_floor(ts).alias("hour_start"),
                            "session_id")


def memory(clicks: DataFrame, variant: str = "tuned", k: int = 1000) -> dict[str, DataFrame]:
    profiles = rollups.user_profiles(clicks)
    if variant != "plain":
        # Read by the top-k (three times) and the distribution: compute once.
        profiles = reliable_checkpoint(profiles)
    if variant == "plain":
        r = (profiles.withColumn("user_rank", F.row_number().over(Window.orderBy(F.col("lifetime_value").desc())))
             .withColumn("ltv_percentile", F.percent_rank().over(Window.orderBy("lifetime_value"))))
        top = r.filter(F.col("user_rank") <= k)
    else:
        top = ranking.top_k_ranked(profiles, "lifetime_value", "user_id", k, materialize=False)
    return {"top_users": top, "ltv_distribution": rollups.ltv_distribution(profiles)}


def shuffle(clicks: DataFrame, variant: str = "tuned") -> dict[str, DataFrame]:
    if variant == "plain":
        stats = (clicks.groupBy("user_id")
                 .agg(F.count(F.lit(1)).alias("event_count"), F.sum("revenue").cast("double").alias("total_revenue"),
                      F.countDistinct("session_id").alias("session_count"),
                      F.approx_count_distinct("event_type").alias("event_types"),
                      F.avg("revenue").alias("avg_revenue")))
        ss = (clicks.groupBy("session_id", "user_id")
              .agg(F.count(F.lit(1)).alias("session_events"),
                   F.sum("revenue").cast("double").alias("session_revenue")))
        enriched = stats.join(ss, "user_id").filter(F.col("session_revenue") > 0)
    else:
        enriched = rollups.enriched_sessions(clicks, positive_only=True)
        stats = rollups.user_stats(clicks)
    return {"revenue_buckets": rollups.revenue_buckets(stats),
            "top_enriched": enriched.orderBy(F.col("total_revenue").desc(), "user_id", "session_id").limit(10)}


def partitions(clicks: DataFrame, variant: str = "tuned") -> dict[str, DataFrame]:
    spark = clicks.sparkSession
    basic = rollups.user_stats_basic(clicks)
    path = scratch_dir(spark, f"scenario-partitions-{variant}")
    if variant == "plain":
        out = layout.write_uncontrolled(basic, path)
    else:
        out = layout.write_compacted(basic, path)
    return {"written": out, "event_type_dist": rollups.event_type_dist(clicks)}


def broadcast(clicks: DataFrame, variant: str = "tuned") -> dict[str, DataFrame]:
    spark = clicks.sparkSession
    dim = gen.gen_user_dim(gen.ids(spark, DIM_ROWS))
    fact = clicks.select("event_id", "user_id", "event_type", "revenue")   # decimal: exact sums
    j = (joins.left_join_shuffle(fact, dim, "user_id") if variant == "plain"
         else joins.left_join_broadcast(fact, dim, "user_id"))
    return {"tier_stats": rollups.tier_revenue_per_user(j),
            "top_joined": j.orderBy(F.col("revenue").desc(), "event_id").limit(10)}


def skewed(clicks: DataFrame, variant: str = "tuned") -> dict[str, DataFrame]:
    stats = rollups.skew_user_stats(clicks) if variant == "plain" else skew.salted_user_stats(clicks, 10)
    return {"top_keys": skew.key_frequency_top(clicks, "user_id", 5),
            "skew_report": skew.skew_report(clicks, "user_id"),
            "revenue_buckets": rollups.revenue_buckets(stats, with_avg_events=False),
            "top_users": stats.orderBy(F.col("total_revenue").desc(), "user_id").limit(10)}


def ranking_all(clicks: DataFrame, variant: str = "tuned") -> dict[str, DataFrame]:
    """Rank and percentile of *every* user by revenue (most users tie at 0)."""
    users = rollups.user_stats_basic(clicks).withColumn("v", F.col("total_revenue").cast("decimal(28,2)"))
    if variant == "plain":
        out = (users.withColumn("user_rank", F.row_number().over(Window.orderBy(F.col("v").desc(), "user_id")))
                    .withColumn("ltv_percentile", F.percent_rank().over(Window.orderBy("v"))))
    else:
        out = ranking.global_percent_rank(users, "v", "user_id", "ltv_percentile", rank_col="user_rank")
    return {"ranked_users": out}


SCENARIOS = {"memory": memory, "shuffle": shuffle, "partitions": partitions, "broadcast": broadcast,
             "skew": skewed, "ranking": ranking_all}


def generated_clicks(spark, rows: int, scenario: str, partitions_: int | None = None) -> DataFrame:
    return as_clickstream(gen.gen_clickstream(gen.ids(spark, rows, partitions_), **SCENARIO_SKEW[scenario]))
