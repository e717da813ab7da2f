"""Session, user, bucket and tier rollups over a clickstream.

Input is the clickstream view from :func:`strata.sources.clickstream`
(``user_id, ts, event_type, revenue (decimal), hour_start, session_id``).

Scale notes
-----------
* ``count/sum/min/max/avg`` need no help with hot keys: the partial
  (map-side) aggregate reduces every key to one row per map task before the
  exchange.
* A session is the pair ``(user_id, hour_start)``; grouping on that pair
  instead of the formatted ``session_id`` string keeps the shuffle key two
  fixed-width values, and the string is built once per output group.
* Distinct session counts are planned by Spark as two aggregates (first by
  ``(user, hour)``, then by user), each with a partial stage, so a user with a
  third of all rows is spread over every map task of both stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import hour_key, revenue_bucket, session_id
from strata.functions.money import ratio_2, to_double


def session_rollup(clicks: DataFrame) -> DataFrame:
    """One row per session, whatever its size: events, revenue, first/last time.

    Sessions with a NULL user or time are rows like any other. The events of a
    session in order are :func:`session_sequence`.
    """
    return session_totals(clicks).select(
        "user_id", session_id("user_id", "hour_start").alias("session_id"), "event_count",
        to_double(F.col("session_revenue")).alias("session_revenue"), "session_start", "session_end")


def session_sequence(clicks: DataFrame) -> DataFrame:
    """One row per event: its session and its position there, from 1, by
    ``(ts, event_id)``.

    This is the session's event list in long form: a list in one row would have
    to meet in one task, and has no bound. The numbering is distributed
    (:func:`strata.operators.ranking.numbered_within`), so a session with most
    of all events is spread like the rest.
    """
    from strata.operators.ranking import numbered_within

    events = clicks.select("user_id", "hour_start", "ts", "event_id", "event_type")
    placed = numbered_within(events, ["user_id", "hour_start"], ["ts", "event_id"])
    return placed.select("user_id", session_id("user_id", "hour_start").alias("session_id"), "position",
                         "event_id", "event_type", "ts")


def session_totals(clicks: DataFrame) -> DataFrame:
    """Per session scalar aggregates only (no list), keyed by ``(user_id, hour_start)``."""
    return (clicks.groupBy("user_id", "hour_start")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.sum("revenue").alias("session_revenue"),
                 F.min("ts").alias("session_start"),
                 F.max("ts").alias("session_end")))


def user_profiles(clicks: DataFrame) -> DataFrame:
    """Two-level rollup: sessions, then users.

    ``total_sessions, total_events, lifetime_value (decimal),
    avg_events_per_session, last_seen``. Both levels aggregate partially before
    their exchange, so hot users cost one row per map task.
    """
    s = session_totals(clicks)
    return (s.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_sessions"),
                 F.sum("event_count").alias("total_events"),
                 F.sum("session_revenue").alias("lifetime_value"),
                 F.max("session_end").alias("last_seen"))
            .withColumn("avg_events_per_session",
                        F.col("total_events").cast("double") / F.col("total_sessions")))


def user_profiles_out(clicks: DataFrame) -> DataFrame:
    p = user_profiles(clicks)
    return p.withColumn("lifetime_value", to_double(F.col("lifetime_value")))


def session_level(clicks: DataFrame) -> DataFrame:
    """One row per session ``(user_id, hour_start)``: events, revenue and a
    mergeable HLL sketch of its event types. The shared first stage of the
    user and session rollups: one exchange serves both."""
    return (clicks.groupBy("user_id", "hour_start")
            .agg(F.count(F.lit(1)).alias("session_events"),
                 F.sum("revenue").alias("_srev"),
                 F.hll_sketch_agg("event_type").alias("_types")))


def user_stats_from_sessions(sessions: DataFrame) -> DataFrame:
    """Per user from :func:`session_level`: sessions are counted (exactly
    distinct, one row each), sums add up, type sketches union."""
    return (sessions.groupBy("user_id")
            .agg(F.sum("session_events").alias("event_count"),
                 F.sum("_srev").alias("_rev"),
                 F.count(F.lit(1)).alias("session_count"),
                 F.hll_union_agg("_types").alias("_types"))
            .select("user_id", "event_count",
                    to_double(F.col("_rev")).alias("total_revenue"),
                    "session_count", F.hll_sketch_estimate("_types").alias("event_types"),
                    (to_double(F.col("_rev")) / F.col("event_count")).alias("avg_revenue")))


def session_stats_from_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(session_id("user_id", "hour_start").alias("session_id"), "user_id",
                           "session_events", to_double(F.col("_srev")).alias("session_revenue"))


def user_stats(clicks: DataFrame) -> DataFrame:
    """Per user: events, revenue, distinct sessions, approx distinct types, avg revenue.

    Two levels (sessions, then users), each partially aggregated before its
    exchange; the approximate distinct count is an HLL sketch union.
    """
    return user_stats_from_sessions(session_level(clicks))


def enriched_sessions(clicks: DataFrame, positive_only: bool = True) -> DataFrame:
    """Each session with its user's stats (optionally only sessions with revenue).

    Written as window aggregates over the session table partitioned by user
    instead of a self-join: two exchanges (events -> sessions -> users) and no
    join. A window partition holds one user's *sessions*, at most one per
    hour of data, so a user with a third of all events stays small here.
    """
    sessions = session_level(clicks)
    w = Window.partitionBy("user_id")
    rev = F.sum("_srev").over(w)
    events = F.sum("session_events").over(w)
    out = sessions.select(
        "user_id",
        events.alias("event_count"),
        to_double(rev).alias("total_revenue"),
        F.count(F.lit(1)).over(w).alias("session_count"),
        F.hll_sketch_estimate(F.hll_union_agg("_types").over(w)).alias("event_types"),
        (to_double(rev) / events).alias("avg_revenue"),
        session_id("user_id", "hour_start").alias("session_id"),
        "session_events",
        to_double(F.col("_srev")).alias("session_revenue"))
    return out.filter(F.col("session_revenue") > 0) if positive_only else out


def user_stats_basic(clicks: DataFrame) -> DataFrame:
    return (clicks.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("event_count"), F.sum("revenue").alias("_rev"))
            .select("user_id", "event_count", to_double(F.col("_rev")).alias("total_revenue")))


def event_type_dist(clicks: DataFrame) -> DataFrame:
    return (clicks.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("revenue").alias("_rev"))
            .select("event_type", "count", to_double(F.col("_rev")).alias("revenue")))


def session_stats(clicks: DataFrame) -> DataFrame:
    """Per session (id, user): event count and revenue."""
    return (clicks.groupBy("user_id", "hour_start")
            .agg(F.count(F.lit(1)).alias("session_events"), F.sum("revenue").alias("_rev"))
            .select(session_id("user_id", "hour_start").alias("session_id"), "user_id",
                    "session_events", to_double(F.col("_rev")).alias("session_revenue")))


def revenue_buckets(stats: DataFrame, with_avg_events: bool = True) -> DataFrame:
    """Bucket users by total revenue: users, revenue (and mean events) per bucket.

    The bucket key has three values; partial aggregation makes that harmless.
    """
    aggs = [F.count(F.lit(1)).alias("user_count"),
            F.sum(F.col("total_revenue").cast("decimal(28,2)")).alias("_rev")]
    if with_avg_events:
        aggs += [F.sum("event_count").alias("_ev")]
    out = (stats.withColumn("revenue_bucket", revenue_bucket("total_revenue"))
           .groupBy("revenue_bucket").agg(*aggs))
    cols = ["revenue_bucket", "user_count", to_double(F.col("_rev")).alias("bucket_revenue")]
    if with_avg_events:
        cols.append((F.col("_ev").cast("double") / F.col("user_count")).alias("avg_events"))
    return out.select(*cols)


def skew_user_stats(clicks: DataFrame, key: str = "user_id") -> DataFrame:
    """Per ``key`` (a user): count, revenue, distinct session hours and the
    event types as a sorted array."""
    return (clicks.groupBy(key)
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.sum("revenue").alias("_rev"),
                 F.countDistinct("hour_start").alias("session_count"),
                 F.collect_set("event_type").alias("_types"))
            .select(key, "event_count", to_double(F.col("_rev")).alias("total_revenue"),
                    "session_count", F.array_sort("_types").alias("event_types")))


def tier_stats(joined: DataFrame) -> DataFrame:
    """Per tier (NULL tier = unmatched users): events, users, revenue, mean revenue."""
    return (joined.groupBy("user_tier")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.countDistinct("user_id").alias("unique_users"),
                 F.sum("revenue").alias("_rev"))
            .select("user_tier", "event_count", "unique_users",
                    to_double(F.col("_rev")).alias("total_revenue"),
                    (to_double(F.col("_rev")) / F.col("event_count")).alias("avg_revenue"),
                    F.col("_rev").alias("_rev_dec")))


def tier_revenue_per_user(joined: DataFrame) -> DataFrame:
    t = tier_stats(joined)
    return (t.withColumn("revenue_per_user", ratio_2(F.col("_rev_dec"), F.col("unique_users")))
             .drop("_rev_dec"))


def ltv_distribution(profiles: DataFrame, value: str = "lifetime_value") -> DataFrame:
    """One row: avg, sample stddev, min, max and sum of a non-negative money column."""
    v = F.col(value)
    return profiles.agg(
        ratio_2(F.sum(v), F.count(v)).alias("avg_ltv"),
        F.round(F.stddev_samp(v.cast("double")), 2).alias("stddev_ltv"),
        to_double(F.min(v)).alias("min_ltv"),
        to_double(F.max(v)).alias("max_ltv"),
        to_double(F.sum(v)).alias("total_revenue"))


def hour_bucket(clicks: DataFrame) -> DataFrame:
    """Events and revenue per wall-clock hour (the session time bucket)."""
    return (clicks.groupBy("hour_start")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.countDistinct("user_id").alias("active_users"),
                 F.sum("revenue").alias("_rev"))
            .select(F.col("hour_start"),
                    hour_key("hour_start").alias("hour_key"),
                    "event_count", "active_users",
                    to_double(F.col("_rev")).alias("revenue")))


def groupby_keys(df: DataFrame, key: str, n_keys: int = 1000, value: str | None = None) -> DataFrame:
    """Group a large table into ``n_keys`` buckets of ``key``: rows and a sum."""
    g = df.groupBy(F.pmod(F.col(key), F.lit(n_keys)).alias("bucket"))
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(18,2)")).alias("_sum"))
    out = g.agg(*aggs)
    if value:
        out = out.withColumn("value_sum", to_double(F.col("_sum"))).drop("_sum")
    return out
