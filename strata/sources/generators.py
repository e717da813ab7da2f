"""Seeded synthetic sources: clickstream, transactions, wide table, user dimension.

Every column is an expression of ``(seed, id)``: no per-row closure, no
``rand()``, so a recomputed partition (a lost executor, a second action)
yields the same rows, and ``n`` rows means exactly ``n`` rows whatever the
partition count. The generators take a DataFrame with a bigint ``id`` column
(``spark.range(n, numPartitions=p)`` or ids derived from a real table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import (
    CATEGORIES_GENERATED,
    COUNTRY_GENERATED,
    EVENT_TYPES_GENERATED,
    PAGE_PREFIX,
    SESSION_PREFIX,
    TXN_PREFIX,
    USER_TIER_GENERATED,
    int_mix,
    int_mix_sql,
)

_TWO31 = 2 ** 31
BASE_MS = 1704067200000          # 2024-01-01T00:00:00Z, the generators' fixed "now"
DAY_MS = 86_400_000
HOUR_MS = 3_600_000

# Size presets (rows) and dataset kinds accepted by :func:`generate`.
SIZE_PRESETS = {"small": 1_000_000, "medium": 10_000_000, "large": 50_000_000, "xlarge": 100_000_000}
KINDS = ("clickstream", "transactions", "wide")


def stream(x: Column | str, seed: int, k: int) -> Column:
    """Independent 31-bit hash stream ``k`` of ``x`` under ``seed``."""
    return int_mix(int_mix(x), seed * 100 + k)


def stream_sql(x: str, seed: int, k: int) -> str:
    return int_mix_sql(int_mix_sql(x), seed * 100 + k)


def _pick(h: Column, values: tuple[str, ...]) -> Column:
    idx = F.pmod(h, F.lit(len(values)))
    out = F.lit(None).cast("string")
    for i in range(len(values) - 1, -1, -1):
        out = F.when(idx == i, F.lit(values[i])).otherwise(out)
    return out


def _pick_sql(h: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({h}) % {len(values)} {arms} END"


def ids(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Exactly ``n`` ids ``0..n-1`` in ``partitions`` splits (no lost remainder)."""
    return spark.range(0, n, 1, partitions)


def resolve_size(size: str | int) -> int:
    """A preset name or a row count."""
    if isinstance(size, int):
        return size
    return SIZE_PRESETS[size] if size in SIZE_PRESETS else int(size)


def gen_clickstream(id_df: DataFrame, hot_fraction: float = 0.1, hot_keys: int = 1000,
                    cold_keys: int = 10_000_000, seed: int = 42) -> DataFrame:
    """``record_id, timestamp (epoch ms), user_id, event_type, session_id, page_url, revenue``.

    A share ``hot_fraction`` of rows goes to users ``0..hot_keys-1``, the rest
    uniformly to ``hot_keys..hot_keys+cold_keys-1`` (``hot_fraction=0`` is
    uniform; ``hot_keys=1, hot_fraction=0.8`` is one key with 80 %). Times fall
    in the 24 hours before the fixed base time; the session is the user's hour.
    """
    i = F.col("id")
    ts = F.lit(BASE_MS) - F.pmod(stream(i, seed, 1), F.lit(DAY_MS))
    hot = stream(i, seed, 2) < F.lit(int(hot_fraction * _TWO31))
    user = F.when(hot, F.pmod(stream(i, seed, 3), F.lit(hot_keys))) \
            .otherwise(F.lit(hot_keys) + F.pmod(stream(i, seed, 4), F.lit(cold_keys)))
    etype = _pick(stream(i, seed, 5), EVENT_TYPES_GENERATED)
    base = id_df.select(i.alias("record_id"), ts.alias("timestamp"), user.cast("int").alias("user_id"),
                        etype.alias("event_type"), stream(i, seed, 6).alias("_h6"),
                        stream(i, seed, 7).alias("_h7"))
    return base.select(
        "record_id", "timestamp", "user_id", "event_type",
        F.concat(F.lit(SESSION_PREFIX), F.col("user_id").cast("string"), F.lit("_"),
                 F.floor(F.col("timestamp") / F.lit(HOUR_MS)).cast("string")).alias("session_id"),
        F.concat(F.lit(PAGE_PREFIX), F.pmod("_h6", F.lit(10000)).cast("string")).alias("page_url"),
        F.when(F.col("event_type") == "purchase",
               F.pmod("_h7", F.lit(100000)).cast("double") / F.lit(100.0))
         .otherwise(F.lit(0.0)).alias("revenue"))


def gen_clickstream_sql(id_sql: str, hot_fraction: float = 0.1, hot_keys: int = 1000,
                        cold_keys: int = 10_000_000, seed: int = 42) -> str:
    """DuckDB text producing the same rows from ``SELECT <id> AS id FROM ...``."""
    s = lambda k: stream_sql("id", seed, k)
    return f"""
WITH g AS (
  SELECT id AS record_id,
         {BASE_MS} - ({s(1)}) % {DAY_MS} AS "timestamp",
         CAST(CASE WHEN ({s(2)}) < {int(hot_fraction * _TWO31)} THEN ({s(3)}) % {hot_keys}
              ELSE {hot_keys} + ({s(4)}) % {cold_keys} END AS INTEGER) AS user_id,
         {_pick_sql(s(5), EVENT_TYPES_GENERATED)} AS event_type,
         ({s(6)}) AS h6, ({s(7)}) AS h7
  FROM ({id_sql}) ids)
SELECT record_id, "timestamp", user_id, event_type,
       '{SESSION_PREFIX}' || user_id || '_' || floor("timestamp" / {HOUR_MS})::BIGINT AS session_id,
       '{PAGE_PREFIX}' || (h6 % 10000) AS page_url,
       CASE WHEN event_type = 'purchase' THEN (h7 % 100000)::DOUBLE / 100.0 ELSE 0.0 END AS revenue
FROM g"""


def gen_transactions(id_df: DataFrame, users: int = 1_000_000, products: int = 100_000,
                     seed: int = 42) -> DataFrame:
    """``transaction_id, user_id, product_id, quantity, price, amount, timestamp, category``.

    Quantity 1..10, price 10.00..509.99, amount = quantity * price, times in
    the 30 days before the base time.
    """
    i = F.col("id")
    price = F.lit(10.0) + F.pmod(stream(i, seed, 14), F.lit(50000)).cast("double") / F.lit(100.0)
    qty = (F.pmod(stream(i, seed, 13), F.lit(10)) + F.lit(1)).cast("int")
    ts = (F.lit(BASE_MS) - F.pmod(stream(i, seed, 15), F.lit(30 * 86400)) * F.lit(1000)
          - F.pmod(stream(i, seed, 16), F.lit(1000)))
    return id_df.select(
        F.concat(F.lit(TXN_PREFIX), i.cast("string")).alias("transaction_id"),
        F.pmod(stream(i, seed, 11), F.lit(users)).cast("int").alias("user_id"),
        F.pmod(stream(i, seed, 12), F.lit(products)).cast("int").alias("product_id"),
        qty.alias("quantity"), price.alias("price"), (qty * price).alias("amount"),
        ts.alias("timestamp"), _pick(stream(i, seed, 17), CATEGORIES_GENERATED).alias("category"))


def gen_transactions_sql(id_sql: str, users: int = 1_000_000, products: int = 100_000, seed: int = 42) -> str:
    s = lambda k: stream_sql("id", seed, k)
    return f"""
WITH g AS (
  SELECT id, CAST(({s(13)}) % 10 + 1 AS INTEGER) AS quantity,
         10.0::DOUBLE + (({s(14)}) % 50000)::DOUBLE / 100.0 AS price,
         ({s(11)}) AS h11, ({s(12)}) AS h12, ({s(15)}) AS h15, ({s(16)}) AS h16, ({s(17)}) AS h17
  FROM ({id_sql}) ids)
SELECT '{TXN_PREFIX}' || id AS transaction_id, CAST(h11 % {users} AS INTEGER) AS user_id,
       CAST(h12 % {products} AS INTEGER) AS product_id, quantity, price, quantity * price AS amount,
       {BASE_MS} - (h15 % {30 * 86400}) * 1000 - h16 % 1000 AS "timestamp",
       {_pick_sql('h17', CATEGORIES_GENERATED)} AS category
FROM g"""


def gen_wide(id_df: DataFrame, columns: int = 500, seed: int = 42) -> DataFrame:
    """``id, base_value (0..999), col_1..col_N`` with ``col_i = base_value + i``, in one select."""
    base = id_df.select(F.col("id"), F.pmod(stream("id", seed, 21), F.lit(1000)).cast("int").alias("base_value"))
    return base.select("id", "base_value",
                       *[(F.col("base_value") + F.lit(j)).alias(f"col_{j}") for j in range(1, columns + 1)])


def gen_wide_sql(id_sql: str, columns: int = 500, seed: int = 42) -> str:
    cols = ", ".join(f"base_value + {j} AS col_{j}" for j in range(1, columns + 1))
    return (f"SELECT id, base_value, {cols} FROM (SELECT id, CAST(({stream_sql('id', seed, 21)}) % 1000 AS INTEGER)"
            f" AS base_value FROM ({id_sql}) ids) w")


def gen_user_dim(id_df: DataFrame, seed: int = 42) -> DataFrame:
    """``user_id, user_tier, user_age, country``: one row per id."""
    return id_df.select(F.col("id").alias("user_id"), F.lit(USER_TIER_GENERATED).alias("user_tier"),
                        F.pmod(stream("id", seed, 31), F.lit(100)).cast("int").alias("user_age"),
                        F.lit(COUNTRY_GENERATED).alias("country"))


def gen_user_dim_sql(id_sql: str, seed: int = 42) -> str:
    return (f"SELECT id AS user_id, '{USER_TIER_GENERATED}' AS user_tier, "
            f"CAST(({stream_sql('id', seed, 31)}) % 100 AS INTEGER) AS user_age, "
            f"'{COUNTRY_GENERATED}' AS country FROM ({id_sql}) ids")


def row_expand(df: DataFrame, count: Column, name: str = "i") -> DataFrame:
    """Each row becomes ``count`` rows numbered ``0..count-1`` (no closure)."""
    return df.select("*", F.explode(F.sequence(F.lit(0), count - F.lit(1))).alias(name))


def generate(spark: SparkSession, kind: str = "clickstream", size: str | int = "small",
             partitions: int | None = None, **params) -> DataFrame:
    """Dispatch on dataset kind (default clickstream) and size preset or row count."""
    id_df = ids(spark, resolve_size(size), partitions)
    if kind == "transactions":
        return gen_transactions(id_df, **params)
    if kind == "wide":
        return gen_wide(id_df, **params)
    return gen_clickstream(id_df, **params)
