"""Distinct counts kept as stored sketches: a new day is merged, old days aren't read again.

A state is a table of one sketch per (day, group). Adding a day writes that day's
rows; a question over any days unions their sketches. Two kinds: HLL sketches
for distinct counts, and theta sketches, which can also be intersected, for how many
values two groups share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_HLL, LG_THETA = 12, 12       # log2 of the sketches' sizes
HLL_ERROR = 3 * 1.04 / (1 << LG_HLL) ** 0.5         # three standard errors
THETA_ERROR = 3 / (1 << LG_THETA) ** 0.5            # of the union's distinct values


def daily_sketches(df: DataFrame, day: str, group: str, value: str) -> DataFrame:
    """``day``, ``group``, ``hll``, ``theta``, ``n`` of the (not null) values."""
    v = F.col(value)
    return (df.where(v.isNotNull()).groupBy(F.col(day).alias("day"), F.col(group).alias("group"))
            .agg(F.hll_sketch_agg(v, F.lit(LG_HLL)).alias("hll"), F.theta_sketch_agg(v, F.lit(LG_THETA)).alias("theta"), F.count(v).alias("n")))


def add_days(df: DataFrame, path: str, day: str, group: str, value: str) -> DataFrame:
    """Sketch the rows of ``df``, whole days, into the state at ``path`` and return
    it. Days that are there already are replaced: each is a partition folder, so
    writing a day again, as a retried job does, leaves it once."""
    spark = df.sparkSession
    (daily_sketches(df, day, group, value).repartition("day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
    return read_state(spark, path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def distinct_counts(state: DataFrame, days=None) -> DataFrame:
    """``group``, ``approx_distinct``, ``n`` over the days that ``days`` (a condition) leaves."""
    rows = state if days is None else state.where(days)
    return rows.groupBy("group").agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("approx_distinct"), F.sum("n").alias("n"))


def overlaps(state: DataFrame, days=None) -> DataFrame:
    """``a``, ``b``, ``approx_shared``, ``approx_either``: how many values each
    two groups share. Groups are few (event types, tiers); a pair is made of two
    rows of merged sketches, never of two rows of data."""
    rows = state if days is None else state.where(days)
    merged = rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.theta_union_agg("theta").alias("theta"))
    a = merged.select(F.col("group").alias("a"), F.col("theta").alias("theta_a"))
    b = merged.select(F.col("group").alias("b"), F.col("theta").alias("theta_b"))
    both = a.join(b, F.col("a") < F.col("b"))
    return both.select("a", "b", F.theta_sketch_estimate(F.theta_intersection("theta_a", "theta_b")).alias("approx_shared"),
                       F.theta_sketch_estimate(F.theta_union("theta_a", "theta_b")).alias("approx_either"))


__all__ = ["HLL_ERROR", "THETA_ERROR", "add_days", "daily_sketches", "distinct_counts", "overlaps", "read_state"]
