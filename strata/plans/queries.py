"""The query catalog: one Spark query and one DuckDB oracle per operator key.

``QUERIES[key](spark, sf_dir)`` returns a lazy DataFrame over the driver
tables in ``sf_dir``; ``ORACLE[key]`` is the same result in DuckDB SQL over
views named like the tables. Keys without an oracle are checked on rows only
(file layouts, partition counts, approximate sketches).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import int_mix, int_mix_sql
from strata.functions.money import ratio_2_sql, to_double
from strata.operators import heavy, iterate, joins, layout, moments, partitioner, quantiles, ranking, rollups, skew, states
from strata.plans.sql import CLICKS, CUSTOMER_LTV, PROFILES, USER_DIM, USER_STATS
from strata.session import materialize, reliable_checkpoint, scratch_dir
from strata.sources import generators as gen
from strata.sources.tables import clickstream, customer_orders, read_table, table_path, user_dimension

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOP_K = 1000          # top_users_ranked keeps ranks <= 1000
TOP_N = 10            # the "top 10" reports
SALT = 10             # salt factor of the salted aggregates


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def _clicks(spark, d):
    return clickstream(spark, d)


def _fact(spark, d):
    """The clickstream columns carried through joins."""
    c = _clicks(spark, d)
    return c.select("event_id", "ts", "user_id", "event_type",
                    to_double(F.col("revenue")).alias("revenue"), "session_id")


FACT_SQL = "e2 AS (SELECT event_id, ts, user_id, event_type, revenue::DOUBLE AS revenue, session_id FROM e)"
JOINED_COLS = "e2.event_id, e2.ts, e2.user_id, e2.event_type, e2.revenue, e2.session_id, d.user_tier, d.user_age, d.country"
DIM_COLS = ["user_tier", "user_age", "country"]


def _joined(spark, d, broadcast=True, exact_revenue=False):
    """Fact ⟕ user dimension. ``exact_revenue`` keeps revenue decimal for sums."""
    fact = _fact(spark, d)
    if exact_revenue:
        fact = _clicks(spark, d).select("event_id", "ts", "user_id", "event_type", "revenue", "session_id")
    dim = user_dimension(spark, d)
    j = (joins.left_join_broadcast(fact, dim, "user_id") if broadcast
         else joins.left_join_shuffle(fact, dim, "user_id"))
    return joins.project_star(j, fact, DIM_COLS)


# ---------------------------------------------------------------------------
# Rollups (§2.5)
# ---------------------------------------------------------------------------

@register("session_rollup", f"""
WITH {CLICKS}
SELECT user_id, session_id, count(*) AS event_count, sum(revenue)::DOUBLE AS session_revenue,
       min(ts) AS session_start, max(ts) AS session_end
FROM e GROUP BY user_id, session_id""")
def q_session_rollup(spark, d):
    return rollups.session_rollup(_clicks(spark, d))


@register("session_sequence", f"""
WITH {CLICKS}
SELECT user_id, session_id, row_number() OVER (PARTITION BY user_id, hour_start ORDER BY ts, event_id) AS position,
       event_id, event_type, ts
FROM e""")
def q_session_sequence(spark, d):
    return rollups.session_sequence(_clicks(spark, d))


@register("user_profiles", f"""
WITH {CLICKS}, {PROFILES}
SELECT user_id, total_sessions, total_events, ltv::DOUBLE AS lifetime_value, avg_events_per_session, last_seen
FROM p""")
def q_user_profiles(spark, d):
    return rollups.user_profiles_out(_clicks(spark, d))


@register("top_users_ranked", f"""
WITH {CLICKS}, {PROFILES},
r AS (SELECT *, row_number() OVER (ORDER BY ltv DESC, user_id) AS user_rank,
             percent_rank() OVER (ORDER BY ltv) AS ltv_percentile FROM p)
SELECT user_id, total_sessions, total_events, ltv::DOUBLE AS lifetime_value, avg_events_per_session,
       last_seen, user_rank, ltv_percentile
FROM r WHERE user_rank <= {TOP_K}""")
def q_top_users_ranked(spark, d):
    p = rollups.user_profiles(_clicks(spark, d))
    t = ranking.top_k_ranked(p, "lifetime_value", "user_id", TOP_K)
    return t.select("user_id", "total_sessions", "total_events",
                    to_double(F.col("lifetime_value")).alias("lifetime_value"),
                    "avg_events_per_session", "last_seen", "user_rank", "ltv_percentile")


@register("user_stats", f"""
WITH {CLICKS}, {USER_STATS}
SELECT user_id, event_count, rev::DOUBLE AS total_revenue, session_count, event_types, avg_revenue FROM u""")
def q_user_stats(spark, d):
    return rollups.user_stats(_clicks(spark, d))


@register("user_stats_basic", f"""
WITH {CLICKS}
SELECT user_id, count(*) AS event_count, sum(revenue)::DOUBLE AS total_revenue FROM e GROUP BY user_id""")
def q_user_stats_basic(spark, d):
    return rollups.user_stats_basic(_clicks(spark, d))


@register("event_type_dist", f"""
WITH {CLICKS}
SELECT event_type, count(*) AS "count", sum(revenue)::DOUBLE AS revenue FROM e GROUP BY event_type""")
def q_event_type_dist(spark, d):
    return rollups.event_type_dist(_clicks(spark, d))


@register("session_stats", f"""
WITH {CLICKS}
SELECT session_id, user_id, count(*) AS session_events, sum(revenue)::DOUBLE AS session_revenue
FROM e GROUP BY session_id, user_id""")
def q_session_stats(spark, d):
    return rollups.session_stats(_clicks(spark, d))


BUCKET_SQL = "CASE WHEN rev < 100 THEN 'low' WHEN rev < 1000 THEN 'medium' ELSE 'high' END"


@register("revenue_buckets", f"""
WITH {CLICKS}, {USER_STATS}
SELECT {BUCKET_SQL} AS revenue_bucket, count(*) AS user_count, sum(rev)::DOUBLE AS bucket_revenue,
       sum(event_count)::DOUBLE / count(*) AS avg_events
FROM u GROUP BY 1""")
def q_revenue_buckets(spark, d):
    return rollups.revenue_buckets(rollups.user_stats(_clicks(spark, d)))


@register("revenue_buckets_basic", f"""
WITH {CLICKS}, {USER_STATS}
SELECT {BUCKET_SQL} AS revenue_bucket, count(*) AS user_count, sum(rev)::DOUBLE AS bucket_revenue
FROM u GROUP BY 1""")
def q_revenue_buckets_basic(spark, d):
    return rollups.revenue_buckets(skew.salted_user_stats(_clicks(spark, d), SALT), with_avg_events=False)


SKEW_STATS_SQL = f"""
WITH {CLICKS}
SELECT user_id, count(*) AS event_count, sum(revenue)::DOUBLE AS total_revenue,
       count(DISTINCT session_id) AS session_count,
       list(DISTINCT event_type ORDER BY event_type) AS event_types
FROM e GROUP BY user_id"""


@register("skew_user_stats", SKEW_STATS_SQL)
def q_skew_user_stats(spark, d):
    return rollups.skew_user_stats(_clicks(spark, d))


@register("salted_user_stats", SKEW_STATS_SQL)
def q_salted_user_stats(spark, d):
    return skew.salted_user_stats(_clicks(spark, d), SALT)


@register("hot_key_split_union", f"""
WITH {CLICKS}
SELECT revenue::DOUBLE AS price, count(*) AS event_count, sum(revenue)::DOUBLE AS total_revenue,
       count(DISTINCT hour_start) AS session_count,
       list(DISTINCT event_type ORDER BY event_type) AS event_types
FROM e GROUP BY revenue""")
def q_hot_key_split_union(spark, d):
    """By the price of an event: most events have none, so 0 is a hot key at every scale."""
    stats = skew.hot_key_split_union(_clicks(spark, d), "revenue", SALT)
    return stats.withColumn("price", to_double(F.col("revenue"))).drop("revenue")


@register("array_set_merge", f"""
WITH {CLICKS}
SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS event_types,
       count(DISTINCT event_type) AS type_count
FROM e GROUP BY user_id""")
def q_array_set_merge(spark, d):
    return skew.array_set_merge_by(_clicks(spark, d), "user_id", SALT)


@register("hour_bucket", f"""
WITH {CLICKS}
SELECT hour_start, strftime(hour_start, '%Y%m%d%H') AS hour_key, count(*) AS event_count,
       count(DISTINCT user_id) AS active_users, sum(revenue)::DOUBLE AS revenue
FROM e GROUP BY hour_start""")
def q_hour_bucket(spark, d):
    return rollups.hour_bucket(_clicks(spark, d))


@register("ltv_distribution", f"""
WITH {CLICKS}, {PROFILES}
SELECT {ratio_2_sql('sum(ltv)', 'count(ltv)')} AS avg_ltv, round(stddev_samp(ltv::DOUBLE), 2) AS stddev_ltv,
       min(ltv)::DOUBLE AS min_ltv, max(ltv)::DOUBLE AS max_ltv, sum(ltv)::DOUBLE AS total_revenue
FROM p""")
def q_ltv_distribution(spark, d):
    return rollups.ltv_distribution(rollups.user_profiles(_clicks(spark, d)))


@register("key_frequency_top", f"""
SELECT user_id, count(*) AS "count" FROM events GROUP BY user_id ORDER BY "count" DESC, user_id LIMIT 5""")
def q_key_frequency_top(spark, d):
    return skew.key_frequency_top(read_table(spark, d, "events"), "user_id", 5)


@register("skew_report", f"""
WITH k AS (SELECT user_id, count(*) AS c FROM events GROUP BY user_id),
t AS (SELECT count(*) AS keys, sum(c)::BIGINT AS rows, max(c) AS max_count, median(c)::DOUBLE AS median_count FROM k)
SELECT keys, rows, max_count, {ratio_2_sql('max_count * 100', 'rows')} AS max_share_pct, median_count,
       {ratio_2_sql('max_count::DECIMAL(38,2) * 2', '(median_count * 2)::BIGINT')} AS max_to_median
FROM t""")
def q_skew_report(spark, d):
    return skew.skew_report(read_table(spark, d, "events"), "user_id")


@register("groupby_1000_keys", """
SELECT l_orderkey % 1000 AS bucket, count(*) AS row_count, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS value_sum
FROM lineitem GROUP BY 1""")
def q_groupby_1000_keys(spark, d):
    return rollups.groupby_keys(read_table(spark, d, "lineitem"), "l_orderkey", 1000, "l_extendedprice")


@register("approx_distinct_mergeable", """
SELECT event_type, count(DISTINCT user_id) AS distinct_values, true AS within_bound FROM events GROUP BY event_type""")
def q_approx_distinct_mergeable(spark, d):
    """Estimates from merged sketches, held against the exact counts."""
    return skew.approx_distinct_error(read_table(spark, d, "events"), "event_type", "user_id")


@register("revenue_bucket_label", f"""
WITH {CLICKS}, {USER_STATS}
SELECT user_id, rev::DOUBLE AS total_revenue, {BUCKET_SQL} AS revenue_bucket FROM u""")
def q_revenue_bucket_label(spark, d):
    from strata.functions.columns import revenue_bucket

    s = rollups.user_stats_basic(_clicks(spark, d))
    return s.select("user_id", "total_revenue", revenue_bucket("total_revenue").alias("revenue_bucket"))


# ---------------------------------------------------------------------------
# Ranks and top-k (§2.6, §2.7)
# ---------------------------------------------------------------------------

@register("user_rank", f"""
WITH {CUSTOMER_LTV}
SELECT user_id, order_count, ltv::DOUBLE AS lifetime_value,
       row_number() OVER (ORDER BY ltv DESC, user_id) AS user_rank
FROM c""")
def q_user_rank(spark, d):
    c = (customer_orders(spark, d).groupBy("user_id")
         .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("ltv")))
    r = ranking.global_row_number(c, "ltv", "user_id", True, "user_rank")
    return r.select("user_id", "order_count", to_double(F.col("ltv")).alias("lifetime_value"), "user_rank")


@register("ltv_percentile", f"""
WITH {CUSTOMER_LTV}
SELECT user_id, order_count, ltv::DOUBLE AS lifetime_value,
       percent_rank() OVER (ORDER BY ltv) AS ltv_percentile
FROM c""")
def q_ltv_percentile(spark, d):
    c = (customer_orders(spark, d).groupBy("user_id")
         .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("ltv")))
    r = ranking.global_percent_rank(c, "ltv", "user_id", "ltv_percentile")
    return r.select("user_id", "order_count", to_double(F.col("ltv")).alias("lifetime_value"), "ltv_percentile")


@register("top_users_by_revenue", f"""
WITH {CLICKS}, {USER_STATS}
SELECT user_id, event_count, rev::DOUBLE AS total_revenue, session_count
FROM u ORDER BY rev DESC, user_id LIMIT {TOP_N}""")
def q_top_users_by_revenue(spark, d):
    s = skew.salted_user_stats(_clicks(spark, d), SALT)
    return (s.orderBy(F.col("total_revenue").desc(), F.col("user_id")).limit(TOP_N)
             .select("user_id", "event_count", "total_revenue", "session_count"))


ENRICH_SQL = f"""
WITH {CLICKS}, {USER_STATS},
ss AS (SELECT session_id, user_id, count(*) AS session_events, sum(revenue)::DOUBLE AS session_revenue
       FROM e GROUP BY session_id, user_id)
SELECT u.user_id, u.event_count, u.rev::DOUBLE AS total_revenue, u.session_count, u.event_types, u.avg_revenue,
       ss.session_id, ss.session_events, ss.session_revenue
FROM u JOIN ss ON u.user_id = ss.user_id"""


def _enriched(spark, d, positive_only):
    return rollups.enriched_sessions(_clicks(spark, d), positive_only)


@register("enrich_user_sessions", ENRICH_SQL)
def q_enrich_user_sessions(spark, d):
    return _enriched(spark, d, False)


@register("filter_positive_sessions", ENRICH_SQL + " WHERE ss.session_revenue > 0")
def q_filter_positive_sessions(spark, d):
    return _enriched(spark, d, True)


@register("top_enriched_sessions", ENRICH_SQL + f"""
WHERE ss.session_revenue > 0 ORDER BY total_revenue DESC, u.user_id, ss.session_id LIMIT {TOP_N}""")
def q_top_enriched_sessions(spark, d):
    return (_enriched(spark, d, True)
            .orderBy(F.col("total_revenue").desc(), F.col("user_id"), F.col("session_id")).limit(TOP_N))


# ---------------------------------------------------------------------------
# Joins (§2.3, §2.4)
# ---------------------------------------------------------------------------

JOIN_SQL = f"WITH {CLICKS}, {FACT_SQL}, {USER_DIM} SELECT {JOINED_COLS} FROM e2 LEFT JOIN d ON e2.user_id = d.user_id"


@register("left_join_shuffle", JOIN_SQL)
def q_left_join_shuffle(spark, d):
    return _joined(spark, d, broadcast=False)


@register("left_join_broadcast", JOIN_SQL)
def q_left_join_broadcast(spark, d):
    return _joined(spark, d, broadcast=True)


@register("project_join_star", JOIN_SQL)
def q_project_join_star(spark, d):
    return _joined(spark, d, broadcast=True)


TIER_SQL = f"""
WITH {CLICKS}, {USER_DIM},
t AS (SELECT d.user_tier, count(*) AS event_count, count(DISTINCT e.user_id) AS unique_users, sum(e.revenue) AS rev
      FROM e LEFT JOIN d ON e.user_id = d.user_id GROUP BY d.user_tier)"""


@register("tier_stats", TIER_SQL + """
SELECT user_tier, event_count, unique_users, rev::DOUBLE AS total_revenue, rev::DOUBLE / event_count AS avg_revenue
FROM t""")
def q_tier_stats(spark, d):
    return rollups.tier_stats(_joined(spark, d, exact_revenue=True)).drop("_rev_dec")


@register("tier_revenue_per_user", TIER_SQL + f"""
SELECT user_tier, event_count, unique_users, rev::DOUBLE AS total_revenue, rev::DOUBLE / event_count AS avg_revenue,
       {ratio_2_sql('rev', 'unique_users')} AS revenue_per_user
FROM t ORDER BY rev DESC""")
def q_tier_revenue_per_user(spark, d):
    return rollups.tier_revenue_per_user(_joined(spark, d, exact_revenue=True)).orderBy(F.col("total_revenue").desc())


def _first_joined(spark, d, *order):
    """The first ``TOP_N`` events with their user's columns. The order is the
    fact's and the dimension is unique, so the limit goes before the join; the
    dimension is then at most one row per kept event."""
    top = _fact(spark, d).orderBy(*order).limit(TOP_N)
    users = user_dimension(spark, d).join(F.broadcast(top.select("user_id").distinct()), "user_id", "left_semi")
    return (top.join(F.broadcast(users), "user_id", "left").orderBy(*order)
            .select("event_id", "user_id", "event_type", "revenue", "user_tier", "user_age"))


@register("top_joined_events", f"""
WITH {CLICKS}, {FACT_SQL}, {USER_DIM}
SELECT e2.event_id, e2.user_id, e2.event_type, e2.revenue, d.user_tier, d.user_age
FROM e2 LEFT JOIN d ON e2.user_id = d.user_id ORDER BY e2.revenue DESC, e2.event_id LIMIT {TOP_N}""")
def q_top_joined_events(spark, d):
    return _first_joined(spark, d, F.col("revenue").desc(), F.col("event_id"))


@register("sample_joined", f"""
WITH {CLICKS}, {FACT_SQL}, {USER_DIM}
SELECT e2.event_id, e2.user_id, e2.event_type, e2.revenue, d.user_tier, d.user_age
FROM e2 LEFT JOIN d ON e2.user_id = d.user_id ORDER BY e2.event_id LIMIT {TOP_N}""")
def q_sample_joined(spark, d):
    return _first_joined(spark, d, F.col("event_id"))


# A real hot key: most events have no revenue, so the price 0 holds most rows at
# every scale, whatever the number of partitions.
PRICES_SQL = f"""
WITH {CLICKS},
prices AS (SELECT revenue, count(*) AS events_at_price, min(event_id) AS first_event FROM e GROUP BY revenue)
SELECT e.event_id, e.user_id, e.revenue::DOUBLE AS price, p.events_at_price, p.first_event
FROM e {{how}} JOIN prices p ON e.revenue = p.revenue"""


def _events_and_prices(spark, d):
    clicks = _clicks(spark, d).select("event_id", "user_id", "revenue")
    prices = clicks.groupBy("revenue").agg(F.count(F.lit(1)).alias("events_at_price"), F.min("event_id").alias("first_event"))
    return clicks, prices


def _priced(joined):
    return joined.withColumn("price", to_double(F.col("revenue"))).drop("revenue")


@register("salted_join", PRICES_SQL.format(how="LEFT"))
def q_salted_join(spark, d):
    clicks, prices = _events_and_prices(spark, d)
    return _priced(joins.salted_join(clicks, prices, "revenue", row_key=["event_id"], how="left"))


@register("hot_key_broadcast_join", PRICES_SQL.format(how="INNER"))
def q_hot_key_broadcast_join(spark, d):
    clicks, prices = _events_and_prices(spark, d)
    return _priced(joins.hot_key_join(clicks, prices, "revenue", joins.hot_keys(clicks, "revenue"), how="inner",
                                      row_key=["event_id"]))


@register("skew_join_aqe", PRICES_SQL.format(how="LEFT"))
def q_skew_join_aqe(spark, d):
    clicks, prices = _events_and_prices(spark, d)
    # A plain sort-merge join: AQE (spark.sql.adaptive.skewJoin.*) splits the
    # partition of the hot key at run time. It can only do so where both sides
    # come straight from an exchange, so the grouped side is written first.
    return _priced(clicks.join(reliable_checkpoint(prices).hint("merge"), "revenue", "left"))


@register("bucketed_join", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.l_linenumber, l.l_quantity, l.l_extendedprice
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def q_bucketed_join(spark, d):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = _bucketed_once(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"], n)
    li = _bucketed_once(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"], n)
    j = joins.bucketed_join(o, li, "o_orderkey", "l_orderkey")
    return j.select("o_orderkey", "o_custkey", "o_orderdate", "l_linenumber", "l_quantity", "l_extendedprice")


def _bucketed_once(spark, d, name, columns, n):
    """The table's columns bucketed by the first one, written on first use. The
    name carries the input's files (path, size, time), so changed input is
    written anew."""
    files = (spark.read.format("binaryFile").load(table_path(d, name))
             .agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()["h"])
    saved = f"strata_{name}_{n}_{int(files) % 10 ** 18}"
    if spark.catalog.tableExists(saved):
        return spark.table(saved)
    return joins.write_bucketed(read_table(spark, d, name).select(*columns), saved, columns[0], n,
                                scratch_dir(spark, f"{name}-bucketed"))


@register("composite_key_repartition", """
SELECT l_suppkey, count(*) AS row_count, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS value_sum
FROM lineitem GROUP BY l_suppkey""")
def q_composite_key_repartition(spark, d):
    return skew.composite_key_repartition(read_table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", "l_orderkey")


@register("project_columns", """
SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem""")
def q_project_columns(spark, d):
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                   "l_extendedprice", "l_shipdate")


@register("large_sort", "SELECT * FROM lineitem")
def q_large_sort(spark, d):
    return layout.large_sort(read_table(spark, d, "lineitem"), "l_shipdate", "l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------
# Sources and generators (§2.1)
# ---------------------------------------------------------------------------

@register("scan_parquet", "SELECT * FROM events")
def q_scan_parquet(spark, d):
    return read_table(spark, d, "events")


NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("scan_text_files", "SELECT *, true AS listed FROM events")
def q_scan_text_files(spark, d):
    """Events written as text, scanned line by line; ``listed``: the line's file
    is in the folder's listing."""
    events = read_table(spark, d, "events")
    lines, files = layout.scan_text(events, scratch_dir(spark, "events-json"), timestampNTZFormat=NTZ_FORMAT)
    parsed = lines.select(F.from_json("value", events.schema, {"timestampNTZFormat": NTZ_FORMAT}).alias("e"), "file_path")
    return (parsed.join(files.withColumn("listed", F.lit(True)).select("file_path", "listed"), "file_path", "left")
            .select("e.*", F.coalesce("listed", F.lit(False)).alias("listed")))


@register("range_scan", "SELECT unnest(range((SELECT count(*) FROM lineitem))) AS id")
def q_range_scan(spark, d):
    """Consecutive ids from 0, one for each row of the table, numbered where they lie."""
    rows = read_table(spark, d, "lineitem").select("l_orderkey")
    return ranking.consecutive_ids(rows, pinned=True).select("id")


ROW_EXPAND_K = f"(({int_mix_sql('o_orderkey')}) % 7 + 1)"


@register("row_expand", f"SELECT o_orderkey, unnest(range(0, {ROW_EXPAND_K})) AS i FROM orders")
def q_row_expand(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey")
    return gen.row_expand(o, F.pmod(int_mix("o_orderkey"), F.lit(7)) + F.lit(1), "i").select(
        "o_orderkey", F.col("i").cast("bigint").alias("i"))


@register("gen_clickstream", gen.gen_clickstream_sql("SELECT event_id AS id FROM events"))
def q_gen_clickstream(spark, d):
    return gen.gen_clickstream(read_table(spark, d, "events").select(F.col("event_id").alias("id")))


@register("gen_transactions", gen.gen_transactions_sql("SELECT o_orderkey AS id FROM orders"))
def q_gen_transactions(spark, d):
    return gen.gen_transactions(read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id")))


@register("gen_wide", gen.gen_wide_sql("SELECT event_id AS id FROM events"))
def q_gen_wide(spark, d):
    return gen.gen_wide(read_table(spark, d, "events").select(F.col("event_id").alias("id")))


@register("gen_user_dim", gen.gen_user_dim_sql("SELECT c_custkey AS id FROM customer"))
def q_gen_user_dim(spark, d):
    return gen.gen_user_dim(read_table(spark, d, "customer").select(F.col("c_custkey").alias("id")))


# ---------------------------------------------------------------------------
# Sinks and layout (§2.2)
# ---------------------------------------------------------------------------

CUSTOMER_SPEND_SQL = """
SELECT o_custkey, count(*) AS order_count, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_spent
FROM orders GROUP BY o_custkey"""


def _customer_spend(spark, d):
    o = read_table(spark, d, "orders")
    return (o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_count"),
                                       F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_s"))
             .select("o_custkey", "order_count", to_double(F.col("_s")).alias("total_spent")))


@register("write_format", "SELECT * FROM orders")
def q_write_format(spark, d):
    return layout.write_format(read_table(spark, d, "orders"), scratch_dir(spark, "orders-parquet"))


@register("write_uncontrolled", CUSTOMER_SPEND_SQL)
def q_write_uncontrolled(spark, d):
    return layout.write_uncontrolled(_customer_spend(spark, d), scratch_dir(spark, "spend-uncontrolled"))


@register("write_compacted", CUSTOMER_SPEND_SQL)
def q_write_compacted(spark, d):
    return layout.write_compacted(_customer_spend(spark, d), scratch_dir(spark, "spend-compacted"))


@register("write_file_count", 'SELECT count(*) AS "rows", 6::BIGINT AS files FROM orders')
def q_write_file_count(spark, d):
    """Orders written into six files, counted in the folder's listing."""
    path = scratch_dir(spark, "orders-six")
    back = layout.write_compacted(read_table(spark, d, "orders"), path, files=6)
    return (back.agg(F.count(F.lit(1)).alias("rows"))
            .select("rows", layout.input_bytes(spark, path).select("files").scalar().alias("files")))


@register("file_layout_report", """
SELECT o_orderstatus, count(*) AS "rows", 1::BIGINT AS files, count(*) * 2 < max(count(*)) OVER () AS any_small
FROM orders GROUP BY o_orderstatus""")
def q_file_layout_report(spark, d):
    """The files of a table written by order status, one each: rows, number of
    files, and whether one is small, under half of the largest file's size."""
    path = scratch_dir(spark, "orders-layout")
    layout.write_file_per_value(read_table(spark, d, "orders"), path, "o_orderstatus")
    half = layout.list_files(spark, path, "*.parquet").agg(F.max("file_size")).first()[0] // 2
    report = layout.file_layout_report(spark, path, small_bytes=half)
    return (report.groupBy(F.regexp_extract("file_path", "o_orderstatus=([^/]*)", 1).alias("o_orderstatus"))
            .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.bool_or("is_small").alias("any_small")))


@register("size_partitions", """
SELECT true AS has_files, true AS covers_input, true AS not_oversized, count(*) AS table_rows FROM lineitem""")
def q_size_partitions(spark, d):
    """The partition count for a table's files, checked: enough partitions of
    the target size to hold all bytes, and not one more than that (or the minimum)."""
    p = layout.size_partitions(spark, table_path(d, "lineitem"))
    room = F.col("partitions") * F.col("target_bytes")
    rows = read_table(spark, d, "lineitem").select(F.count(F.lit(1)).alias("table_rows")).scalar()
    return p.select(((F.col("files") > 0) & (F.col("input_bytes") > 0)).alias("has_files"),
                    (room >= F.col("input_bytes")).alias("covers_input"),
                    ((F.col("partitions") == 4) | (room - F.col("target_bytes") < F.col("input_bytes"))).alias("not_oversized"),
                    rows.alias("table_rows"))


RESULT_TARGET = 64 * 1024      # bytes of a partition, so that small tables need several, too


@register("size_result_partitions", f"""
WITH b AS (SELECT o_orderstatus, count(*) AS n, sum(60 + strlen(o_orderpriority))::BIGINT AS bytes FROM orders GROUP BY o_orderstatus)
SELECT o_orderstatus, n AS "rows", bytes, greatest(4, (bytes + {RESULT_TARGET} - 1) // {RESULT_TARGET})::INTEGER AS partitions FROM b""")
def q_size_result_partitions(spark, d):
    """Partition counts for results that aren't written yet, by status: rows
    times what a row takes in memory, over the wanted size of a partition."""
    orders = read_table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return layout.size_result_partitions(orders, RESULT_TARGET, by="o_orderstatus", of=["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"], overhead=28)


@register("repartition_by_size", "SELECT * FROM lineitem")
def q_repartition_by_size(spark, d):
    n = layout.partitions_for(spark, table_path(d, "lineitem"))
    return layout.repartition_by_size(read_table(spark, d, "lineitem"), n)


@register("partition_row_counts", """
SELECT count(*) AS "rows", true AS as_many_as_sized, true AS even FROM lineitem""")
def q_partition_row_counts(spark, d):
    """Rows per partition after a round-robin into the sized count: their sum,
    whether there are as many partitions as sized, and whether they are even
    (each input task deals its rows out one by one, so two partitions differ
    by a row per input task at most)."""
    n = layout.partitions_for(spark, table_path(d, "lineitem"))
    lines = read_table(spark, d, "lineitem")
    tasks = lines.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p").alias("tasks")).scalar()
    counts = layout.partition_row_counts(layout.repartition_by_size(lines, n))
    whole = counts.agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) == n).alias("as_many_as_sized"),
                       (F.max("rows") - F.min("rows")).alias("spread"))
    return whole.select("rows", "as_many_as_sized", (F.col("spread") <= tasks).alias("even"))


# ---------------------------------------------------------------------------
# Reuse and multi-stage plans (§2.12)
# ---------------------------------------------------------------------------

@register("cached_multi_rollup", f"""
WITH {CLICKS},
s AS (SELECT user_id, hour_start, count(*) AS c, sum(revenue) AS r FROM e GROUP BY user_id, hour_start)
SELECT 'user' AS rollup, user_id::VARCHAR AS "key", count(*) AS sessions, sum(c)::BIGINT AS events,
       sum(r)::DOUBLE AS revenue FROM s GROUP BY user_id
UNION ALL
SELECT 'hour' AS rollup, strftime(hour_start, '%Y%m%d%H') AS "key", count(*) AS sessions, sum(c)::BIGINT AS events,
       sum(r)::DOUBLE AS revenue FROM s GROUP BY hour_start""")
def q_cached_multi_rollup(spark, d):
    from strata.plans.reuse import multi_rollup

    return multi_rollup(_clicks(spark, d))


@register("multi_stage_rollup", """
WITH r AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2))) AS rev
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT n.n_name, year(o.o_orderdate) AS order_year, count(*) AS order_count, sum(r.rev)::DOUBLE AS revenue
FROM r JOIN orders o ON r.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate)""")
def q_multi_stage_rollup(spark, d):
    from strata.plans.reuse import returned_revenue_by_nation_year

    return returned_revenue_by_nation_year(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"),
                                           read_table(spark, d, "customer"), read_table(spark, d, "nation"))


# ---------------------------------------------------------------------------
# The same operators on the second inputs SURVEY §8 names (more keys, more ties)
# ---------------------------------------------------------------------------

def _customer_ltv(spark, d):
    return (customer_orders(spark, d).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("lifetime_value")))


@register("ltv_distribution_orders", f"""
WITH {CUSTOMER_LTV}
SELECT {ratio_2_sql('sum(ltv)', 'count(ltv)')} AS avg_ltv, round(stddev_samp(ltv::DOUBLE), 2) AS stddev_ltv,
       min(ltv)::DOUBLE AS min_ltv, max(ltv)::DOUBLE AS max_ltv, sum(ltv)::DOUBLE AS total_revenue
FROM c""")
def q_ltv_distribution_orders(spark, d):
    return rollups.ltv_distribution(_customer_ltv(spark, d))


@register("key_frequency_top_orders", """
SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY o_custkey ORDER BY "count" DESC, o_custkey LIMIT 5""")
def q_key_frequency_top_orders(spark, d):
    return skew.key_frequency_top(read_table(spark, d, "orders"), "o_custkey", 5)


@register("skew_report_lineitem", f"""
WITH k AS (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY l_partkey),
t AS (SELECT count(*) AS keys, sum(c)::BIGINT AS rows, max(c) AS max_count, median(c)::DOUBLE AS median_count FROM k)
SELECT keys, rows, max_count, {ratio_2_sql('max_count * 100', 'rows')} AS max_share_pct, median_count,
       {ratio_2_sql('max_count::DECIMAL(38,2) * 2', '(median_count * 2)::BIGINT')} AS max_to_median
FROM t""")
def q_skew_report_lineitem(spark, d):
    return skew.skew_report(read_table(spark, d, "lineitem"), "l_partkey")


@register("top_customers_ranked", f"""
WITH {CUSTOMER_LTV},
r AS (SELECT *, row_number() OVER (ORDER BY ltv DESC, user_id) AS user_rank,
             percent_rank() OVER (ORDER BY ltv) AS ltv_percentile FROM c)
SELECT user_id, order_count, ltv::DOUBLE AS lifetime_value, user_rank, ltv_percentile
FROM r WHERE user_rank <= {TOP_K}""")
def q_top_customers_ranked(spark, d):
    t = ranking.top_k_ranked(_customer_ltv(spark, d), "lifetime_value", "user_id", TOP_K)
    return t.select("user_id", "order_count", to_double(F.col("lifetime_value")).alias("lifetime_value"),
                    "user_rank", "ltv_percentile")


# ---------------------------------------------------------------------------
# Iterative jobs over a reused table (§2.12)
# ---------------------------------------------------------------------------

SHIPMENT_SQL = """
WITH RECURSIVE firsts AS (SELECT l_partkey, l_shipdate, min(l_orderkey) AS first FROM lineitem GROUP BY l_partkey, l_shipdate),
half AS (SELECT DISTINCT l.l_orderkey AS a, f.first AS b FROM lineitem l JOIN firsts f USING (l_partkey, l_shipdate) WHERE l.l_orderkey <> f.first),
links AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
reach(node, other) AS (SELECT a, a FROM links UNION SELECT r.node, k.b FROM reach r JOIN links k ON r.other = k.a),
least AS (SELECT node, min(other) AS low FROM reach GROUP BY node)"""


@register("shipment_groups", SHIPMENT_SQL + """
SELECT o_orderkey, coalesce(low, o_orderkey) AS shipment_group FROM orders LEFT JOIN least ON o_orderkey = node""")
def q_shipment_groups(spark, d):
    """Orders that can ship together: those that hold the same part on the same
    day, and what hangs together through them. A part's day links every order to
    its first one, so a popular part makes no pairs."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    firsts = lines.groupBy("l_partkey", "l_shipdate").agg(F.min("l_orderkey").alias("first"))
    links = lines.join(firsts, ["l_partkey", "l_shipdate"]).where("l_orderkey <> first").select("l_orderkey", "first")
    groups = iterate.components(links, "l_orderkey", "first")
    return (read_table(spark, d, "orders").select("o_orderkey").join(groups, F.col("o_orderkey") == F.col("node"), "left")
            .select("o_orderkey", F.coalesce("component", "o_orderkey").alias("shipment_group")))


RANK_ROUNDS = 5


def _rank_round_sql(i: int) -> str:
    return f"""
r{i} AS (SELECT n.node, ({iterate.RANK_UNIT * 15 // 100} + coalesce(g.got, 0) * 85 // 100)::BIGINT AS r
         FROM r{i - 1} n LEFT JOIN (SELECT k.dst, sum(p.r // d.degree)::BIGINT AS got FROM links k JOIN r{i - 1} p ON k.src = p.node
                                    JOIN degrees d ON k.src = d.src GROUP BY k.dst) g ON n.node = g.dst)"""


@register("supplier_part_rank", f"""
WITH links AS (SELECT -l_suppkey AS src, l_partkey AS dst FROM lineitem UNION SELECT l_partkey, -l_suppkey FROM lineitem),
degrees AS (SELECT src, count(*) AS degree FROM links GROUP BY src),
r0 AS (SELECT DISTINCT src AS node, {iterate.RANK_UNIT}::BIGINT AS r FROM links),{",".join(_rank_round_sql(i) for i in range(1, RANK_ROUNDS + 1))}
SELECT CASE WHEN node < 0 THEN 'supplier' ELSE 'part' END AS kind, abs(node) AS "key", r AS "rank" FROM r{RANK_ROUNDS}""")
def q_supplier_part_rank(spark, d):
    """Suppliers and parts ranked by each other over who delivers what: a fixed
    number of rounds over one reused link table."""
    pairs = read_table(spark, d, "lineitem").select((-F.col("l_suppkey")).alias("s"), F.col("l_partkey").alias("p")).distinct()
    with iterate.reused(pairs, "supplier-parts") as table:
        ranks = iterate.rank_rounds(table.unionByName(table.select(F.col("p").alias("s"), F.col("s").alias("p"))), "s", "p", RANK_ROUNDS)
    return ranks.select(F.when(F.col("node") < 0, "supplier").otherwise("part").alias("kind"), F.abs("node").alias("key"), "rank")


# ---------------------------------------------------------------------------
# Frequent keys by sketch, weighted partitions, mergeable moments (§2.5, §2.9)
# ---------------------------------------------------------------------------

@register("heavy_hitters", """
SELECT l_quantity, count(*) AS "count" FROM lineitem GROUP BY l_quantity
HAVING count(*) > 0.02 * (SELECT count(*) FROM lineitem)""")
def q_heavy_hitters(spark, d):
    """Quantities that more than 2 % of the lines have: half of them come close."""
    return heavy.heavy_hitters(read_table(spark, d, "lineitem"), "l_quantity", 0.02)


@register("heavy_hitters_stored", f"""
WITH {CLICKS}
SELECT revenue::DOUBLE AS price, count(*) AS "count" FROM e GROUP BY revenue HAVING count(*) > 0.001 * (SELECT count(*) FROM e)""")
def q_heavy_hitters_stored(spark, d):
    """Prices of more than 0.1 % of the events, from summaries stored by day and merged."""
    clicks = _clicks(spark, d).select("revenue", F.to_date("ts").alias("day"))
    daily = materialize(heavy.summarise(clicks, "revenue", 0.001, by=["day"]), "daily-summaries")
    candidates, n = heavy.merged(daily, 0.001)
    return (heavy.recount(clicks, "revenue", candidates, n, 0.001)
            .select(to_double(F.col("revenue")).alias("price"), "count"))


@register("weighted_partition_sums", """
SELECT l_suppkey, count(*) AS row_count, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS value_sum, true AS whole, true AS even
FROM lineitem GROUP BY l_suppkey""")
def q_weighted_partition_sums(spark, d):
    """Sums by supplier over lines that lie where their measured weights put them."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return partitioner.weighted_sums(read_table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", n)


@register("salted_ltv_distribution", f"""
WITH {CLICKS}, {PROFILES}
SELECT count(ltv) AS users, round(avg(ltv::DOUBLE), 6) AS avg_ltv, round(stddev_samp(ltv::DOUBLE), 6) AS stddev_ltv,
       min(ltv)::DOUBLE AS min_ltv, max(ltv)::DOUBLE AS max_ltv
FROM p""")
def q_salted_ltv_distribution(spark, d):
    """The lifetime value's distribution from moments of salted parts."""
    state = moments.moments(rollups.user_profiles(_clicks(spark, d)), [], "lifetime_value", "user_id")
    return moments.statistics(state, []).select(
        F.col("n").alias("users"), F.round("mean", 6).alias("avg_ltv"), F.round("stddev", 6).alias("stddev_ltv"),
        F.col("least").alias("min_ltv"), F.col("most").alias("max_ltv"))


@register("moments_by_type", """
WITH m AS (SELECT event_type, count(value) AS n, avg(value) AS mean, min(value) AS least, max(value) AS most FROM events GROUP BY event_type),
c AS (SELECT event_type, sum((value - mean) ** 2) AS m2, sum((value - mean) ** 3) AS m3, sum((value - mean) ** 4) AS m4
      FROM events JOIN m USING (event_type) GROUP BY event_type)
SELECT event_type, n, round(mean, 6) AS mean, round(sqrt(m2 / (n - 1)), 6) AS stddev, round(sqrt(n) * m3 / m2 ** 1.5, 6) AS skewness,
       round(n * m4 / m2 ** 2 - 3, 6) AS kurtosis, least, most
FROM m JOIN c USING (event_type)""")
def q_moments_by_type(spark, d):
    """The value's moments by event type, from states stored by day and merged."""
    events = read_table(spark, d, "events").withColumn("day", F.to_date("ts"))
    daily = materialize(moments.moments(events, ["day", "event_type"], "value", "event_id"), "daily-moments")
    found = moments.statistics(moments.merge_moments(daily, ["event_type"]), ["event_type"])
    return found.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "skewness", "kurtosis")], "least", "most")


# ---------------------------------------------------------------------------
# Quantile sketches, stored sketch state (§2.5, §2.6)
# ---------------------------------------------------------------------------

@register("approx_ltv_percentile", f"""
WITH {CUSTOMER_LTV}
SELECT user_id, ltv::DOUBLE AS lifetime_value, percent_rank() OVER (ORDER BY ltv) AS exact_percentile, true AS within_bound
FROM c""")
def q_approx_ltv_percentile(spark, d):
    """Percent ranks from a quantile sketch, held against the exact ones."""
    near = quantiles.approx_percent_rank(_customer_ltv(spark, d), "lifetime_value", "near")
    both = ranking.global_percent_rank(near, "lifetime_value", "user_id", "exact_percentile")
    return both.select("user_id", to_double(F.col("lifetime_value")).alias("lifetime_value"), "exact_percentile",
                       quantiles.within_error(F.col("near"), F.col("exact_percentile")).alias("within_bound"))


def _daily_state(spark, d):
    """Events sketched by day into a stored state, in two loads."""
    events = read_table(spark, d, "events").withColumn("day", F.to_date("ts"))
    path = scratch_dir(spark, "daily-state")
    early = F.dayofmonth("day") <= 15
    states.add_days(events.where(early), path, "day", "event_type", "user_id")
    return events, states.add_days(events.where(~early), path, "day", "event_type", "user_id")


@register("stored_distinct_counts", """
SELECT event_type, count(DISTINCT user_id) AS distinct_values, count(user_id) AS n, true AS within_bound FROM events GROUP BY event_type""")
def q_stored_distinct_counts(spark, d):
    """Distinct users by event type from stored daily sketches, held against the exact counts."""
    events, state = _daily_state(spark, d)
    exact = (events.groupBy("event_type", "user_id").agg(F.lit(1).alias("one"))
             .groupBy("event_type").agg(F.count("user_id").alias("distinct_values")))
    near = states.distinct_counts(state)
    off = F.abs(F.col("approx_distinct") - F.col("distinct_values"))
    return (exact.join(near, F.col("event_type") == F.col("group"))
            .select("event_type", "distinct_values", "n", (off <= F.greatest(F.lit(1.0), F.col("distinct_values") * states.HLL_ERROR)).alias("within_bound")))


@register("audience_overlap", """
WITH u AS (SELECT DISTINCT event_type, user_id FROM events),
s AS (SELECT a.event_type AS a, b.event_type AS b, count(*) AS shared FROM u a JOIN u b ON a.user_id = b.user_id AND a.event_type < b.event_type
      GROUP BY a.event_type, b.event_type)
SELECT a, b, shared, true AS within_bound FROM s""")
def q_audience_overlap(spark, d):
    """How many users two event types share, from stored theta sketches, held against the exact counts."""
    events, state = _daily_state(spark, d)
    types = events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("t"))     # a handful of types
    pairs = types.select(F.explode("t").alias("a"), "t").select("a", F.explode("t").alias("b")).where("a < b")
    exact = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    off = F.abs(F.col("approx_shared") - F.col("shared"))
    return (exact.join(states.overlaps(state), ["a", "b"])
            .select("a", "b", "shared", (off <= F.greatest(F.lit(1.0), F.col("approx_either") * states.THETA_ERROR)).alias("within_bound")))


# ---------------------------------------------------------------------------
# Compaction in place, sizes before writing, proof of order (§2.2, §2.7)
# ---------------------------------------------------------------------------

def _fragmented(spark, d):
    """Orders by status, half of them in a file a status, half in many."""
    path, orders = scratch_dir(spark, "fragmented"), read_table(spark, d, "orders")
    layout.write_file_per_value(orders.where("o_orderkey % 2 = 0"), path, "o_orderstatus")
    layout.write_partitioned(orders.where("o_orderkey % 2 = 1").repartition(12), path, "o_orderstatus", mode="append")
    return path, orders


@register("compact_in_place", "SELECT * FROM orders")
def q_compact_in_place(spark, d):
    """A folder of many small files, compacted where it lies."""
    path, orders = _fragmented(spark, d)
    layout.compact_folder(spark, path)
    return spark.read.schema(orders.schema).parquet(path).select(orders.columns)


@register("compaction_report", """
SELECT o_orderstatus, count(*) AS "rows", true AS as_packed, true AS large_untouched FROM orders GROUP BY o_orderstatus""")
def q_compaction_report(spark, d):
    """By status: rows after compacting, whether each folder has as many files as
    packed, and whether its largest file, above the limit, is the one from before."""
    path, _ = _fragmented(spark, d)
    files = lambda: materialize(layout.file_layout_report(spark, path).withColumn(
        "status", F.regexp_extract("file_path", "o_orderstatus=([^/]*)", 1)), "file-list")
    before = files()
    largest = before.groupBy("status").agg(F.max(F.struct("file_size", "file_path")).alias("top"))
    limit = largest.agg(F.min("top.file_size")).first()[0]
    plan = layout.compact_folder(spark, path, small_bytes=limit)
    packed = (plan.withColumn("status", F.regexp_extract("folder", "o_orderstatus=([^/]*)", 1)).groupBy("status")
              .agg((F.count(F.lit(1)) - F.count_distinct("bin")).alias("fewer")))
    kept = files().join(largest.select("status", F.col("top.file_path").alias("top")), "status")
    now = kept.groupBy("status").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("now"), F.bool_or(F.col("file_path") == F.col("top")).alias("large_untouched"))
    counts = before.groupBy("status").agg(F.count(F.lit(1)).alias("then"))
    return now.join(counts, "status").join(packed, "status", "left").select(
        F.col("status").alias("o_orderstatus"), "rows", (F.col("then") - F.coalesce("fewer", F.lit(0)) == F.col("now")).alias("as_packed"), "large_untouched")


@register("size_before_write", """
SELECT 'lineitem' AS name, count(*) AS "rows", true AS within_20_pct FROM lineitem
UNION ALL SELECT 'orders', count(*), true FROM orders
UNION ALL SELECT 'documents', count(*), true FROM documents""")
def q_size_before_write(spark, d):
    """The size that three tables take as Parquet, estimated before and measured after writing them."""
    out = None
    for name in ("lineitem", "orders", "documents"):
        table = spark.read.parquet(table_path(d, name))
        path = scratch_dir(spark, f"sized-{name}")
        estimate = layout.estimate_written(table)
        table.write.parquet(path)
        real = layout.input_bytes(spark, path).select("input_bytes").scalar()
        row = estimate.select(F.lit(name).alias("name"), "rows", (F.abs(F.col("bytes") - real) <= real * 0.2).alias("within_20_pct"))
        out = row if out is None else out.unionByName(row)
    return out


@register("large_sort_order", 'SELECT count(*) AS "rows", true AS in_order FROM lineitem')
def q_large_sort_order(spark, d):
    """The large sort, with the proof that its rows lie in order, within and across partitions."""
    cols = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return layout.sort_order_report(layout.large_sort(read_table(spark, d, "lineitem").select(*cols), *cols), cols)
