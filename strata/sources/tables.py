"""Readers for the driver tables, with explicit schemas and derived views.

Schemas are declared rather than inferred so that a scan never lists or
samples files to find them, and so that column pruning and filter pushdown
reach the Parquet reader (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import hour_floor, money, session_id

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; explicit schema where known."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the clickstream the rollups expect.

    Adds ``revenue`` (the value of purchases, decimal(18,2), else 0),
    ``hour_start`` (wall-clock hour) and ``session_id`` (one per user and hour).
    Catalyst prunes whatever a query doesn't read, so e.g. the session string is
    only formatted by queries that output it; grouping uses ``hour_start``.
    """
    e = read_table(spark, sf_dir, "events")
    return with_session_columns(e)


def with_session_columns(e: DataFrame) -> DataFrame:
    hs = hour_floor("ts")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.when(F.col("event_type") == "purchase", money("value"))
         .otherwise(F.lit(0).cast("decimal(18,2)")).alias("revenue"),
        hs.alias("hour_start"),
        session_id("user_id", hs).alias("session_id"),
    )


def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension: every customer.

    ``user_id`` (= c_custkey), ``user_tier`` (= market segment), ``user_age``
    (a deterministic 0..99 from the key) and ``country`` (nation name).
    ``nation`` has 25 rows by definition, so broadcasting it is bounded.
    """
    from strata.functions.columns import int_mix

    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .select(F.col("c_custkey").alias("user_id"),
                     F.col("c_mktsegment").alias("user_tier"),
                     F.pmod(int_mix("c_custkey", 7), F.lit(100)).cast("int").alias("user_age"),
                     F.col("n_name").alias("country")))


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as transactions: ``user_id`` = customer, ``revenue`` = total price."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                    money("o_totalprice").alias("revenue"), F.col("o_orderdate").alias("ts"))
