"""DuckDB text of the shared views, for the oracle queries."""

from strata.functions.columns import int_mix_sql

# The clickstream view of ``events`` (see strata.sources.tables.clickstream).
CLICKS = """e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CASE WHEN event_type = 'purchase' THEN value::DECIMAL(18,2) ELSE 0::DECIMAL(18,2) END AS revenue,
         date_trunc('hour', ts) AS hour_start,
         'session_' || user_id || '_' || strftime(ts, '%Y%m%d%H') AS session_id
  FROM events)"""

# The user dimension (see strata.sources.tables.user_dimension).
USER_DIM = f"""d AS (
  SELECT c_custkey AS user_id, c_mktsegment AS user_tier,
         CAST(({int_mix_sql('c_custkey', 7)}) % 100 AS INTEGER) AS user_age, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PROFILES = """s AS (
  SELECT user_id, session_id, count(*) AS c, sum(revenue) AS r, max(ts) AS m FROM e GROUP BY user_id, session_id),
p AS (
  SELECT user_id, count(*) AS total_sessions, sum(c)::BIGINT AS total_events, sum(r) AS ltv,
         sum(c)::DOUBLE / count(*) AS avg_events_per_session, max(m) AS last_seen
  FROM s GROUP BY user_id)"""

USER_STATS = """u AS (
  SELECT user_id, count(*) AS event_count, sum(revenue) AS rev,
         count(DISTINCT session_id) AS session_count, count(DISTINCT event_type) AS event_types,
         sum(revenue)::DOUBLE / count(*) AS avg_revenue
  FROM e GROUP BY user_id)"""

CUSTOMER_LTV = """c AS (
  SELECT o_custkey AS user_id, count(*) AS order_count, sum(o_totalprice::DECIMAL(18,2)) AS ltv
  FROM orders GROUP BY o_custkey)"""
