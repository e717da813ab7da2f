"""Hand-computed answers on the mini clickstream (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import joins, ranking, rollups, skew


def test_user_stats(mini_clicks):
    out = rollups.user_stats(mini_clicks)
    assert rows(out, "user_id", "event_count", "total_revenue", "session_count", "event_types", "avg_revenue") == [
        (1, 2, 100.00, 2, 1, 50.0), (2, 2, 999.99, 1, 2, 499.995), (3, 1, 1000.00, 1, 1, 1000.0),
        (4, 1, 0.0, 1, 1, 0.0), (5, 2, 0.0, 1, 2, 0.0)]


def test_session_rollup_hour_boundary_and_order(mini_clicks):
    out = rollups.session_rollup(mini_clicks)
    assert rows(out, "user_id", "session_id", "event_count", "session_revenue") == [
        (1, "session_1_2024010110", 1, 99.99), (1, "session_1_2024010111", 1, 0.01), (2, "session_2_2024010110", 2, 999.99),
        (3, "session_3_2024010110", 1, 1000.00), (4, "session_4_2024010110", 1, 0.0), (5, "session_5_2024010110", 2, 0.0)]
    placed = rows(rollups.session_sequence(mini_clicks), "session_id", "position", "event_type")
    assert placed == [
        ("session_1_2024010110", 1, "purchase"), ("session_1_2024010111", 1, "purchase"),
        ("session_2_2024010110", 1, "purchase"), ("session_2_2024010110", 2, "click"), ("session_3_2024010110", 1, "purchase"),
        ("session_4_2024010110", 1, "view"), ("session_5_2024010110", 1, "view"), ("session_5_2024010110", 2, "click")]


def test_revenue_buckets_edges(mini_clicks):
    out = rollups.revenue_buckets(rollups.user_stats(mini_clicks))
    assert rows(out, "revenue_bucket", "user_count", "bucket_revenue", "avg_events") == [
        ("high", 1, 1000.0, 1.0), ("low", 2, 0.0, 1.5), ("medium", 2, 1099.99, 2.0)]


def test_rank_and_percentile_ties(mini_clicks):
    p = rollups.user_profiles(mini_clicks)
    top = ranking.top_k_ranked(p, "lifetime_value", "user_id", 1000)
    expect = [(1, 3, 0.5), (2, 2, 0.75), (3, 1, 1.0), (4, 4, 0.0), (5, 5, 0.0)]
    assert rows(top, "user_id", "user_rank", "ltv_percentile") == expect
    full = ranking.global_row_number(p, "lifetime_value", "user_id", True, "user_rank", num_partitions=3)
    pct = ranking.global_percent_rank(p, "lifetime_value", "user_id", "ltv_percentile", num_partitions=3)
    got = rows(full.join(pct.select("user_id", "ltv_percentile"), "user_id"),
               "user_id", "user_rank", "ltv_percentile")
    assert got == expect


def test_top_k_smaller_than_table(mini_clicks):
    p = rollups.user_profiles(mini_clicks)
    top = ranking.top_k_ranked(p, "lifetime_value", "user_id", 2)
    assert rows(top, "user_id", "user_rank", "ltv_percentile") == [(2, 2, 0.75), (3, 1, 1.0)]


def test_tier_revenue_per_user_null_tier(mini_clicks, mini_users):
    fact = mini_clicks.select("event_id", "user_id", "event_type", "revenue")
    j = joins.left_join_broadcast(fact, mini_users, "user_id")
    out = rollups.tier_revenue_per_user(j)
    got = rows(out, "user_tier", "event_count", "unique_users", "total_revenue", "avg_revenue", "revenue_per_user")
    assert got == [(None, 3, 2, 0.0, 0.0, 0.0), ("Premium", 5, 3, 2099.99, pytest.approx(419.998), 700.0)]


def test_filter_positive_sessions(mini_clicks):
    out = (rollups.user_stats(mini_clicks).join(rollups.session_stats(mini_clicks), "user_id")
           .filter(F.col("session_revenue") > 0))
    assert sorted(r["user_id"] for r in out.collect()) == [1, 1, 2, 3]


def test_skew_report(mini_events):
    r = skew.skew_report(mini_events, "user_id").first()
    assert (r["max_count"], r["max_share_pct"], r["median_count"]) == (2, 25.0, 2.0)
    assert (r["keys"], r["rows"]) == (5, 8)


def test_ltv_distribution(mini_clicks):
    r = rollups.ltv_distribution(rollups.user_profiles(mini_clicks)).first()
    assert (r["avg_ltv"], r["stddev_ltv"], r["min_ltv"], r["max_ltv"], r["total_revenue"]) == \
        (420.0, 531.03, 0.0, 1000.0, 2099.99)


def test_salted_equals_direct_for_every_factor(mini_clicks):
    direct = rows(rollups.skew_user_stats(mini_clicks))
    for n in range(1, 17):
        assert rows(skew.salted_user_stats(mini_clicks, n)) == direct, n


def test_empty_input(spark, mini_clicks):
    empty = mini_clicks.limit(0)
    assert rollups.user_stats(empty).count() == 0
    r = rollups.ltv_distribution(rollups.user_profiles(empty)).collect()
    assert len(r) == 1 and r[0]["total_revenue"] is None
    assert ranking.top_k_ranked(rollups.user_profiles(empty), "lifetime_value", "user_id", 10).count() == 0


def test_single_user_percent_rank_is_zero(mini_clicks):
    one = rollups.user_profiles(mini_clicks.filter("user_id = 3"))
    assert rows(ranking.top_k_ranked(one, "lifetime_value", "user_id", 10), "user_rank", "ltv_percentile") == \
        [(1, 0.0)]
    assert rows(ranking.global_percent_rank(one, "lifetime_value", "user_id", "p"), "p") == [(0.0,)]


def test_all_equal_values(mini_clicks):
    same = rollups.user_profiles(mini_clicks).withColumn("lifetime_value", F.lit(5).cast("decimal(28,2)"))
    top = ranking.top_k_ranked(same, "lifetime_value", "user_id", 10)
    assert rows(top, "user_id", "user_rank", "ltv_percentile") == [(u, u, 0.0) for u in range(1, 6)]
    full = ranking.global_row_number(same, "lifetime_value", "user_id", True, "r", num_partitions=4)
    assert rows(full, "user_id", "r") == [(u, u) for u in range(1, 6)]


def test_null_user_never_matches(spark, mini_clicks, mini_users):
    extra = spark.createDataFrame([(9, None, "purchase", 10.0)], "event_id bigint, user_id bigint, event_type string, value double")
    fact = mini_clicks.select("event_id", "user_id", "event_type", "value").unionByName(extra)
    j = joins.left_join_broadcast(fact, mini_users, "user_id")
    assert j.filter("event_id = 9").first()["user_tier"] is None
    assert rows(j.groupBy("user_tier").count()) == [(None, 4), ("Premium", 5)]


def test_sessions_of_any_size_and_null_keys(spark):
    """One session with 80 % of the events and one with NULL keys: one rollup
    row each, and positions that count their events in order."""
    from pyspark.sql import Window

    ids = spark.range(2000).withColumnRenamed("id", "event_id")
    clicks = ids.select(
        "event_id", F.timestamp_seconds(F.pmod(F.xxhash64("event_id"), F.lit(3600))).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("event_id") < 1600, 7).when(F.col("event_id") < 1900, F.lit(None)).otherwise(F.col("event_id")).cast("bigint").alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(1).cast("decimal(18,2)").alias("revenue"))
    clicks = clicks.withColumn("hour_start", F.when(F.col("user_id").isNotNull(), F.lit("1970-01-01").cast("timestamp_ntz")))
    sessions = rows(rollups.session_rollup(clicks), "event_count")
    assert len(sessions) == 102 and (1600,) in sessions and (300,) in sessions
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = rows(clicks.select("user_id", F.row_number().over(w).alias("position"), "event_id"))
    assert rows(rollups.session_sequence(clicks), "user_id", "position", "event_id") == want
    assert rollups.session_sequence(clicks.limit(0)).count() == 0
